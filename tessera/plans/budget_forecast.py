"""Daily budget targets weighted by weekday, with actual and forecast revenue
(W5).

Stages: a one-year calendar assembled from dates seen this year and last
year's dates moved forward one year; weekday counts per month; the year's
monthly budgets; actual revenue to date padded with NULL rows for the rest of
the year; a monthly mean of revenue to pace; the forecast rule; weekday
shares of clicks per brand; daily weights per brand and month; targets; and
the final four-way LEFT join onto the calendar.

Scale notes.
* The calendar, weekday counts and budgets are bounded by the calendar (at
  most 366 dates, 12 x 7 weekday cells, brands x 12 months), so the joins
  against them are broadcast by construction.
* Raw facts are only scanned by aggregations (revenue per day and brand,
  clicks per brand and weekday, distinct dates); every window runs on those
  small results, never on raw rows.
* The "calendar CROSS JOIN brands" padding is generated per brand with
  ``sequence`` and matched to the calendar by date: its size is the size of
  the answer and it needs no cartesian product.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.dates import add_years, day_of_week, recent, year_end, year_start
from tessera.functions.numeric import typed_null
from tessera.operators.aggs import mean_exact, revenue_to_pace
from tessera.operators.joins import expand_dates
from tessera.operators.sets import union_all
from tessera.operators.windows import share_of_total
from tessera.sources.sinks import materialize


def _one_year_earlier(day: dt.date) -> dt.date:
    return day.replace(year=day.year - 1)


def ytd_calendar(source: DataFrame, as_of: dt.date) -> DataFrame:
    """Distinct dates of the current year in the source, with weekday and
    month. ``EXTRACT(YEAR FROM date) = EXTRACT(YEAR FROM today)`` is written
    as a date range so it can prune files."""
    d = F.col("date")
    return (source.where(d.between(F.lit(year_start(as_of)), F.lit(year_end(as_of))))
            .select(d.alias("future_date"), day_of_week(d).alias("dayofweek"),
                    F.month(d).alias("month"))
            .distinct())


def future_calendar(source: DataFrame, as_of: dt.date) -> DataFrame:
    """Last year's dates moved forward one year (29 February lands on
    28 February). ``DATE_ADD(date, 1 YEAR) BETWEEN year start AND year end`` is
    exactly ``date`` within last year, written as that range."""
    d = F.col("date")
    lo, hi = _one_year_earlier(year_start(as_of)), _one_year_earlier(year_end(as_of))
    moved = add_years(d, 1)
    return (source.where(d.between(F.lit(lo), F.lit(hi)))
            .select(moved.alias("future_date"), day_of_week(moved).alias("dayofweek"),
                    F.month(moved).alias("month"))
            .distinct())


def month_calendar(source: DataFrame, as_of: dt.date, full_year: bool = False) -> DataFrame:
    """The year's dates as seen in the source (U3): its dates of this year, and those of
    last year moved forward one year (29 February lands on 28 February), each once,
    with weekday and month. One scan: both years are one date range, which can prune
    files, every date is moved or kept, and one DISTINCT runs over the result.
    ``full_year=True`` instead lists every day of the year with ``sequence``
    (the source's evident intent, independent of gaps in the data)."""
    if full_year:
        days = source.sparkSession.range(1).select(
            F.explode(F.sequence(F.lit(year_start(as_of)), F.lit(year_end(as_of)))).alias("future_date"))
    else:
        d, first = F.col("date"), F.lit(year_start(as_of))
        days = (source.where(d.between(F.lit(_one_year_earlier(year_start(as_of))), F.lit(year_end(as_of))))
                .select(F.when(d < first, add_years(d, 1)).otherwise(d).alias("future_date")).distinct())
    return days.select("future_date", day_of_week("future_date").alias("dayofweek"),
                       F.month("future_date").alias("month"))


def days_in_month(calendar: DataFrame) -> DataFrame:
    """Number of each weekday in each month of the calendar (A4)."""
    return (calendar.groupBy("month", "dayofweek")
            .agg(F.count(F.lit(1)).alias("days_in_month")))


def monthly_budget(budget: DataFrame, as_of: dt.date) -> DataFrame:
    """This year's budget rows, ``period`` renamed ``month``."""
    return (budget.where(F.col("year") == as_of.year)
            .select("year", F.col("period").alias("month"), "brand_domain", "budget",
                    "current_reforecast"))


def budget_brands(budget_rows: DataFrame) -> DataFrame:
    """``SELECT DISTINCT brand_domain ... WHERE brand_domain IS NOT NULL``."""
    return budget_rows.where(F.col("brand_domain").isNotNull()).select("brand_domain").distinct()


def revenue_to_date(revenue: DataFrame, as_of: dt.date) -> DataFrame:
    """Revenue per day, month and brand from 1 January to today, with the
    revenue to pace (today's partial day NULL, additions 0) (A17)."""
    d = F.col("date")
    return (revenue.where(d.between(F.lit(year_start(as_of)), F.lit(as_of)))
            .groupBy(d.alias("event_date"), F.month(d).alias("month"), "Brand")
            .agg(F.sum("revenue").alias("revenue"),
                 revenue_to_pace("date", "revenue", "revenue_type", as_of).alias("revenue_to_pace")))


def future_rows(calendar: DataFrame, brands: DataFrame, as_of: dt.date) -> DataFrame:
    """Every calendar date after today, once per budget brand, with NULL
    measures: the source's ``calendar CROSS JOIN brands``. Each brand row is
    expanded to its dates in place (``sequence``) and kept where the calendar
    has the date; the calendar side holds at most 366 rows."""
    first, last = as_of + dt.timedelta(days=1), year_end(as_of)
    per_brand = expand_dates(brands.select(F.col("brand_domain").alias("Brand")), first, last,
                             "event_date")
    cal = F.broadcast(calendar.where(F.col("future_date").between(F.lit(first), F.lit(last)))
                      .select(F.col("future_date").alias("event_date"), "month"))
    return (per_brand.join(cal, "event_date")
            .select("event_date", "month", "Brand",
                    typed_null().alias("revenue"), typed_null().alias("revenue_to_pace")))


def actual_revenue(revenue: DataFrame, calendar: DataFrame, budget_rows: DataFrame,
                   as_of: dt.date) -> DataFrame:
    """Actuals to date ``UNION ALL`` NULL-padded future dates."""
    return union_all(revenue_to_date(revenue, as_of),
                     future_rows(calendar, budget_brands(budget_rows), as_of))


def monthly_average(actuals: DataFrame) -> DataFrame:
    """``AVG(revenue_to_pace)`` per month and brand: NULLs (today, future days)
    are skipped; days with only additions count as 0 (A3)."""
    return (actuals.groupBy("month", "Brand")
            .agg(mean_exact("revenue_to_pace").alias("monthly_average_revenue")))


def revenue_with_forecast(actuals: DataFrame, as_of: dt.date) -> DataFrame:
    """Actual revenue before today; this month's mean from today to month end;
    the (NULL) revenue for later months.

    The source joins the actuals to their own monthly means; the mean is a
    window over (month, brand) here, so the actuals are computed and shuffled
    once instead of twice."""
    w = Window.partitionBy("month", "Brand")
    pace = F.col("revenue_to_pace")
    n = F.count(pace).over(w)
    avg = F.when(n > 0, F.sum(pace).over(w).cast("double") / n)
    rev = F.col("revenue").cast("double")
    forecast = (F.when(F.col("event_date") < F.lit(as_of), rev)
                .when(F.month("event_date") == as_of.month, F.col("monthly_average_revenue"))
                .otherwise(rev))
    return (actuals.withColumn("monthly_average_revenue", avg)
            .select("event_date", "month", "Brand", rev.alias("actual_revenue"),
                    "monthly_average_revenue", forecast.alias("actual_plus_forecast_revenue")))


def weekday_shares(clicks: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of each weekday in a brand's clicks up to today (N6, N8), as
    aggregate-then-window. ``date BETWEEN date - 3 MONTH AND today`` reduces to
    ``date <= today`` (F16)."""
    c = clicks.where(recent("date", as_of)).withColumn("dayofweek", day_of_week("date"))
    return share_of_total(c, ["Brand", "dayofweek"], ["Brand"], "weekly_rate", "clicks")


def daily_weights(shares: DataFrame, weekday_days: DataFrame) -> DataFrame:
    """Share of a month's target that falls on one day of a given weekday.

    The source computes ``(w * d / SUM(w * d) OVER (brand, month)) / d`` with
    ``w = clicks_dow / clicks_brand``. The brand total cancels, leaving
    ``clicks_dow / SUM(clicks_dow * d) OVER (brand, month)``: the same number,
    computed from exact integers with a single rounding.
    """
    j = shares.join(F.broadcast(weekday_days), "dayofweek")
    total = F.sum(F.col("clicks") * F.col("days_in_month")).over(Window.partitionBy("Brand", "month"))
    return j.withColumn("daily_weighted_percent",
                        F.col("clicks").cast("double") / total.cast("double"))


def dayofweek_budget(weights: DataFrame, budget_rows: DataFrame) -> DataFrame:
    """Weights joined to their month's budget (LEFT: a brand without budget
    keeps its rows with NULL targets) (J6)."""
    b = budget_rows.select(F.col("brand_domain").alias("Brand"), "month",
                           F.col("budget").cast("double").alias("budget"),
                           F.col("current_reforecast").cast("double").alias("current_reforecast"))
    w = F.col("daily_weighted_percent")
    return (weights.join(b, ["Brand", "month"], "left")
            .withColumn("budget_daily_target", w * F.col("budget"))
            .withColumn("budget_monthly_target", w * F.col("budget") * F.col("days_in_month"))
            .withColumn("reforecast_daily_target", w * F.col("current_reforecast")))


def dated_targets(calendar: DataFrame, shares: DataFrame, targets: DataFrame) -> DataFrame:
    """Every calendar date with the targets of its weekday and month, one row a brand
    (J10): the calendar, at most 366 rows, is broadcast to the targets instead of a
    LEFT join on 84 keys. A date without targets is one on whose weekday no brand
    has a click (an anti join on seven values); it stays with NULL targets."""
    cal = calendar.select("future_date", F.col("dayofweek").alias("__dow"), F.col("month").alias("__mon"))
    wanted = ["Brand", "budget_daily_target", "reforecast_daily_target"]
    dated = (targets.join(F.broadcast(cal), (F.col("dayofweek") == F.col("__dow")) & (F.col("month") == F.col("__mon")))
             .select("future_date", "dayofweek", "month", *wanted))
    seen = shares.select(F.col("dayofweek").alias("__seen")).distinct()
    types = dict(targets.dtypes)
    bare = (calendar.join(F.broadcast(seen), F.col("dayofweek") == F.col("__seen"), "left_anti")
            .select("future_date", "dayofweek", "month", *[F.lit(None).cast(types[c]).alias(c) for c in wanted]))
    return dated.unionByName(bare)


def budget_forecast(calendar_source: DataFrame, revenue: DataFrame, clicks: DataFrame,
                    budget: DataFrame, as_of: dt.date, sort: bool = True,
                    full_year_calendar: bool = False, write_budget: bool = False) -> DataFrame:
    """One row per calendar date and brand: daily budget and reforecast
    targets, month totals, actual revenue and actual-plus-forecast revenue.

    ``full_year_calendar=True`` lists every day of the year instead of the
    dates seen in the data. ``write_budget=True`` computes this year's budget
    rows once (they are read three times): worth it when ``budget`` is an
    expensive plan rather than a small table (at sf0.1 it costs 0.4 s more
    than recomputing)."""
    # The calendar is read three times below and each read would re-scan the
    # calendar source (a fact table) twice; it is at most 366 rows, so it is
    # computed once and written to the shared folder.
    cal = materialize(month_calendar(calendar_source, as_of, full_year_calendar), "calendar")
    budget_rows = monthly_budget(budget, as_of)
    if write_budget:
        budget_rows = materialize(budget_rows, "budget")
    # at most seven rows a brand; read by the targets and by the dates without any
    shares = materialize(weekday_shares(clicks, as_of), "shares")
    targets = dayofweek_budget(daily_weights(shares, days_in_month(cal)), budget_rows)
    forecast = revenue_with_forecast(actual_revenue(revenue, cal, budget_rows, as_of), as_of)

    a = dated_targets(cal, shares, targets)
    c = budget_rows.select(F.col("brand_domain").alias("__cb"), F.col("month").alias("__cm"),
                           "budget", "current_reforecast")
    d = forecast.select(F.col("event_date").alias("__de"), F.col("Brand").alias("__db"),
                        "actual_revenue", "actual_plus_forecast_revenue")
    out = (a.join(c, (F.col("Brand") == F.col("__cb")) & (F.col("month") == F.col("__cm")), "left")
            .join(d, (F.col("__de") == F.col("future_date")) & (F.col("Brand") == F.col("__db")), "left")
            .select("Brand",
                    F.col("future_date").alias("event_date"),
                    F.col("dayofweek").cast("bigint").alias("dayofweek"),
                    "budget_daily_target",
                    F.col("budget").cast("double").alias("total_budget"),
                    "reforecast_daily_target",
                    F.col("current_reforecast").cast("double").alias("total_reforecast"),
                    "actual_revenue",
                    "actual_plus_forecast_revenue"))
    return out.orderBy(F.col("Brand").asc_nulls_last(), F.col("event_date").asc_nulls_last()) if sort else out
