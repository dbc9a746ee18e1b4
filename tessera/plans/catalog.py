"""Registry: key -> callable(spark, sf_dir) -> DataFrame.

library function over stand-in tables built from the driver's parquet files:
whole tables, with the source workloads' own parameters
(``tessera.sources.params``). Operator keys run the pipeline stage in which
the source uses that operator.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.dates import (between_dates, in_window, on_or_after, recent, year_end_col,
                                    year_start, year_start_col)
from tessera.functions.mapping import LESSON_STRANDS, grade_to_int, lesson_number, nz, subject_of
from tessera.functions.numeric import as_double, per_unit
from tessera.operators import quality, records
from tessera.operators.joins import (anti, anti_null_aware, exists_flag, join_ci, join_salted, left_join_filtered,
                                     nested_in, semi, semi_chain, semi_filtered)
from tessera.operators.windows import asc
from tessera.plans import activity_scores as w1
from tessera.plans import budget_forecast as w5
from tessera.plans import campaign_revenue as w4
from tessera.plans import lesson_summary as w2
from tessera.plans import retail
from tessera.plans import usage_by_student as w3
from tessera.plans.rosters import guid_roster, named_roster
from tessera.sources import stand_ins as si
from tessera.sources.params import (ACTIVITY_PARAMS, BUDGET_AS_OF, CAMPAIGN_FROM_DATE, LESSON_PARAMS,
                                    USAGE_PARAMS, as_date)
from tessera.sources.sinks import (buckets_for, create_table_as, drop_table, materialize, read_table,
                                   register_view, save_table, table_path, unique_name, write_table)
from tessera.sources.tables import Tables, attach, load, load_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Query run by ``entry()`` (the driver's smoke check): the deepest pipeline.
FLAGSHIP = "budget_forecast"


def register(*names: str):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        for name in names:
            QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(Tables(spark, sf_dir))
        return fn
    return deco


# ================================================================ shop
@register("retail_q1")
def _q1(t):
    """Q1: customers with a May order (W6; J13, F14)."""
    return retail.may_customers(si.shop_tables(t))


@register("retail_q2")
def _q2(t):
    """Q2: customers with no order of the book type, NOT IN over nested IN (W6; J14, J15)."""
    return retail.customers_without_type(si.shop_tables(t), si.SHOP_BOOK_TYPE)


@register("retail_q3")
def _q3(t):
    """Q3: revenue per product type, largest first (W6; J1, A2, O2)."""
    return retail.revenue_by_type(si.shop_tables(t))


@register("retail_q3_rows")
def _q3_rows(t):
    """Q3 commented variant: row-level revenue lines (W6; P6, O2)."""
    return retail.revenue_rows(si.shop_tables(t))


@register("retail_q4")
def _q4(t):
    """Q4: product type, name and state for customers in two states (W6; J2, F6)."""
    return retail.products_by_state(si.shop_tables(t), si.SHOP_EAST_STATES)


@register("retail_q4_semi")
def _q4_semi(t):
    """Q4 commented variant: product types by nested IN, no duplicates (W6; J14)."""
    return retail.product_types_by_state(si.shop_tables(t), si.SHOP_EAST_STATES)


@register("retail_q5")
def _q5(t):
    """Q5: items ordered per customer name via a derived table (W6; J12, A1, O2)."""
    return retail.quantity_by_customer(si.shop_tables(t))


@register("retail_q5_ctas")
def _q5_ctas(t):
    """Q5 commented variant: SELECT INTO a table, then the question (W6; S7)."""
    return retail.quantity_by_customer_ctas(si.shop_tables(t))


@register("scan_table")
def _scan(t):
    """``SELECT *`` scan of a named table."""
    return load(t.spark, t.sf_dir, "orders")


@register("scan_catalog_table")
def _scan_catalog(t):
    """``SELECT *`` of a table by its two-part catalog name."""
    database = f"tessera_{zlib.crc32(t.sf_dir.encode()):08x}"
    return load_table(t.spark, attach(t.spark, t.sf_dir, "orders", database))


@register("filter_month")
def _filter_month(t):
    """``MONTH(order_date) = 5``."""
    return si.shop_tables(t)["customer_orders"].where(F.month("order_date") == 5)


@register("semi_join")
def _semi_join(t):
    """``customer_id IN (SELECT .. WHERE MONTH(d) = 5)``."""
    s = si.shop_tables(t)
    may = s["customer_orders"].where(F.month("order_date") == 5)
    return semi(s["customers"], may, "customer_id").select("customer_id", "name")


def _book_buyers(s: dict[str, DataFrame]) -> tuple[DataFrame, str]:
    books = s["products"].where(F.col("product_type") == si.SHOP_BOOK_TYPE)
    return nested_in([(s["customer_orders"], "customer_id", "order_id"),
                      (s["customer_order_products"], "order_id", "product_id"),
                      (books, "product_id", None)])


@register("semi_chain")
def _semi_chain(t):
    """Three nested ``IN`` levels as a chain of semi joins."""
    s = si.shop_tables(t)
    east = s["customers"].where(F.col("state").isin(*si.SHOP_EAST_STATES))
    return semi_chain(s["products"], "product_id", [
        (s["customer_order_products"], "product_id", "order_id"),
        (s["customer_orders"], "order_id", "customer_id"),
        (east, "customer_id", None),
    ]).select("product_id", "product_type")


@register("anti_join")
def _anti_join(t):
    """``NOT EXISTS`` form: left anti join, NULL keys kept."""
    s = si.shop_tables(t)
    sub, col = _book_buyers(s)
    return anti(s["customers"], sub, "customer_id", col).select("customer_id", "name")


@register("anti_null_aware")
def _anti_null_aware(t):
    """``NOT IN`` with SQL NULL semantics."""
    s = si.shop_tables(t)
    sub, col = _book_buyers(s)
    return anti_null_aware(s["customers"], sub, "customer_id", col).select("customer_id", "name")


@register("join_inner")
def _join_inner(t):
    """Inner equi-join (J1): products x order lines."""
    s = si.shop_tables(t)
    return (s["products"].join(s["customer_order_products"], "product_id")
            .select("product_id", "product_type", "order_id", "quantity"))


@register("sink_ctas")
def _sink_ctas(t):
    """``SELECT .. INTO`` a table, re-read."""
    s = si.shop_tables(t)
    lines = (s["customer_orders"].join(s["customer_order_products"], "order_id")
             .select("order_id", "customer_id", "product_id", "quantity"))
    return create_table_as(lines, unique_name("mytable"))


# ================================================================ learning inputs
def _learning(t: Tables) -> dict[str, DataFrame]:
    return dict(org=si.org_tree(t), student_orgs=si.student_organizations(t),
                students=si.students(t), documents=si.student_documents(t),
                history=si.lesson_history(t), seq_nodes=si.sequence_nodes(t),
                lesson_nodes=si.lesson_nodes(t), strands=si.strands(t), scores=si.scores(t))


def _w1_roster(t):
    return guid_roster(si.org_tree(t), si.student_organizations(t), si.students(t),
                       si.student_documents(t), ACTIVITY_PARAMS.district)


def _w2_roster(t):
    return guid_roster(si.org_tree(t), si.student_organizations(t), si.students(t),
                       si.student_documents(t), LESSON_PARAMS.district, lower_match=True)


def _w1_lessons(t):
    i = _learning(t)
    return w1.lessons(_w1_roster(t), i["history"], i["seq_nodes"], i["lesson_nodes"],
                      i["strands"], i["scores"], ACTIVITY_PARAMS)


def _w2_lessons(t):
    i = _learning(t)
    return w2.lessons(_w2_roster(t), i["history"], i["seq_nodes"], i["lesson_nodes"],
                      i["strands"], i["scores"], LESSON_PARAMS)


# ================================================================ W1
@register("activity_scores")
def _activity_scores(t):
    """W1 pipeline: raw activity-score rows per student and lesson for one district."""
    return w1.activity_scores(**_learning(t), p=ACTIVITY_PARAMS)


@register("project_star")
def _project_star(t):
    """``SELECT b.* FROM roster a JOIN lessons b`` (P3), unsorted."""
    return w1.activity_scores(**_learning(t), p=ACTIVITY_PARAMS, sort=False)


@register("join_hierarchy")
def _join_hierarchy(t):
    """Three-level self-join over the adjacency list."""
    return _w1_roster(t)


@register("join_ci")
def _join_ci(t):
    """``LOWER(a) = LOWER(b)`` join."""
    j = join_ci(si.student_organizations(t), si.students(t), "StudentID", "_id")
    return j.select("StudentID", "OrganizationID", "_id")


@register("filter_range_closed")
def _filter_range_closed(t):
    """Closed datetime window plus the score filters."""
    return w1.spanish_scores(si.scores(t), ACTIVITY_PARAMS)


@register("filter_eq")
def _filter_eq(t):
    """AND-ed equality filters (F1)."""
    return si.scores(t).where((F.col("Product") == "ILE") & (F.col("LessonBranch") == "Main"))


@register("filter_is_null")
def _filter_is_null(t):
    """``IS NULL``."""
    return si.scores(t).where(F.col("ActivitySkippedType").isNull())


@register("filter_not_like")
def _filter_not_like(t):
    """``NOT LIKE`` with and without wildcards; NULL reasons drop."""
    return w1.completed_lessons(si.lesson_history(t), ACTIVITY_PARAMS)


@register("param_window")
def _param_window(t):
    """Parameter strings compared with datetimes."""
    return si.lesson_history(t).where(in_window("DateTime", ACTIVITY_PARAMS.start, ACTIVITY_PARAMS.end))


@register("join_composite")
def _join_composite(t):
    """Composite-key inner join on (document, lesson) (J5), ranked."""
    return _w1_lessons(t)


# ================================================================ W2
@register("lesson_summary")
def _lesson_summary(t):
    """W2 pipeline: per-student latest literacy lesson, accuracy, passed/attempted counts."""
    return _w2_rounded(w2.lesson_summary(**_learning(t), p=LESSON_PARAMS))


@register("fn_lower")
def _fn_lower(t):
    """``LOWER(dist._id) = param`` and lowered output ids."""
    return _w2_roster(t)


@register("filter_range_plus_day")
def _filter_range_plus_day(t):
    """Upper bound ``DATEADD(dd, 1, end)``, still inclusive."""
    p = LESSON_PARAMS
    return si.scores(t).where(in_window("DateTime", p.start, p.end, end_plus_days=1)
                              & (F.col("Product") == "ILE"))


@register("agg_ratio")
def _agg_ratio(t):
    """Ratio of two conditional sums with the zero-possible rule."""
    return w2.activity_ratios(si.scores(t), LESSON_PARAMS)


@register("filter_in_list")
def _filter_in_list(t):
    """``StrandID IN (4, 8, 13, 7, 14)``."""
    return si.lesson_nodes(t).where(F.col("StrandID").isin(*LESSON_STRANDS))


@register("case_category")
def _case_category(t):
    """Subject bucketing by strand id sets."""
    return si.lesson_nodes(t).select("NodeID", "StrandID", subject_of("StrandID").alias("Lesson_Type"))


@register("project_math")
def _project_math(t):
    """``CASE WHEN strand = 4 THEN order ELSE 16 + order END``."""
    return si.lesson_nodes(t).select(
        "NodeID", "StrandID", "OrderID",
        lesson_number("StrandID", "OrderID").cast("bigint").alias("Lesson_Number"))


def _w2_rounded(summary):
    """Rounded for the comparison with another engine's doubles."""
    return summary.withColumn("Overall_Accuracy", F.round("Overall_Accuracy", 6))


def _w2_lessons_rounded(t):
    return _w2_lessons(t).drop("Lesson_Passed").withColumn("Lesson_Accuracy", F.round("Lesson_Accuracy", 6))


@register("win_over_agg")
def _win_over_agg(t):
    """Window over grouped rows."""
    return _w2_lessons_rounded(t)


@register("win_rn_case")
def _win_rn_case(t):
    """``ROW_NUMBER`` partitioned by a CASE expression."""
    return _w2_lessons(t).select("Student_GUID", "Lesson_Type", "Lesson", "Lesson_Date", "Order_Num")


@register("threshold_flag")
def _threshold_flag(t):
    """``CASE WHEN accuracy >= .70 THEN 1 ELSE 0 END``; NULL is not passed."""
    return _w2_lessons(t).select(
        "Student_GUID", "Lesson", "Lesson_Date",
        F.when(F.col("Lesson_Passed"), 1).otherwise(0).cast("bigint").alias("passed"))


@register("join_fanout")
def _join_fanout(t):
    """Re-join of lessons to their roster before the summary."""
    roster = _w2_roster(t)
    return (roster.join(_w2_lessons(t), "Student_GUID")
            .select("Student_GUID", "School_GUID", "Lesson", "Lesson_Date", "Lesson_Type"))


def _w2_summary(t):
    return _w2_rounded(w2.lesson_summary(**_learning(t), p=LESSON_PARAMS))


@register("agg_pick_zero")
def _agg_pick_zero(t):
    """Pick by rank with ELSE 0 (A10)."""
    return _w2_summary(t).select("Student_GUID", "Last_literacy_lesson")


@register("agg_two_level")
def _agg_two_level(t):
    """Activity ratio -> lesson mean -> student mean."""
    return _w2_rounded(_w2_summary(t)).select("Student_GUID", "Overall_Accuracy", "Lessons_Passed_Current")


# ================================================================ W3
def _w3_roster(t):
    return named_roster(si.organizations(t), si.student_organizations2(t), si.student_info(t),
                        USAGE_PARAMS.district)


def _w3_ranked(t):
    return w3.ranked_lessons(si.progress_by_lesson(t), _w3_roster(t), USAGE_PARAMS)


def _w3_per_student(t):
    return w3.lessons_per_student(w3.worked_lessons(si.progress_by_lesson(t), USAGE_PARAMS), _w3_roster(t))


def _w3_usage_by_student(t, sort=True):
    return w3.usage_by_student(si.organizations(t), si.student_organizations2(t), si.student_info(t),
                               si.daily_usage(t), si.progress_by_lesson(t), USAGE_PARAMS, sort=sort)


@register("usage_by_student")
def _usage_by_student(t):
    """W3 pipeline: roster, session usage, first/last lessons and pass rates per student."""
    return _w3_usage_by_student(t)


@register("project_alias")
def _project_alias(t):
    """Column selection with aliases."""
    return _w3_roster(t)


@register("sort_multi")
def _sort_multi(t):
    """Multi-key ascending sort with explicit NULL placement (O1, O3)."""
    return _w3_roster(t).orderBy(asc("district_name"), asc("school_name"), asc("grade"),
                                 asc("student_id"))


@register("label_to_ordinal")
def _label_to_ordinal(t):
    """Sixteen-way label -> ordinal; unknown -> NULL (P10)."""
    return si.progress_by_lesson(t).select(
        "lesson_name", "lesson_grade_level", grade_to_int("lesson_grade_level").alias("grade_numeric"))


@register("filter_between")
def _filter_between(t):
    """``BETWEEN`` two date parameters."""
    return si.daily_usage(t).where(between_dates("usage_date", USAGE_PARAMS.start, USAGE_PARAMS.end))


@register("filter_not_bool")
def _filter_not_bool(t):
    """``NOT skipped``."""
    p = USAGE_PARAMS
    return si.progress_by_lesson(t).where(in_window("date_updated", p.start, p.end) & ~F.col("skipped"))


@register("agg_min_max", "agg_unit")
def _agg_min_max(t):
    """MIN / MAX of a date and seconds / 60.0 after SUM."""
    return w3.usage(si.daily_usage(t), _w3_roster(t), USAGE_PARAMS)


@register("win_rn_asc")
def _win_rn_asc(t):
    """``ROW_NUMBER`` ascending per two keys."""
    return _w3_ranked(t).select("student_id", "progress_area", "lesson_name", "date_updated", "taken_order")


@register("win_first_last")
def _win_first_last(t):
    """First and last rank on the same partition."""
    return _w3_ranked(t)


@register("agg_conditional")
def _agg_conditional(t):
    """Conditional sums, ELSE 0."""
    return _w3_per_student(t)


@register("agg_pick_null")
def _agg_pick_null(t):
    """Pick by rank with ELSE NULL."""
    return _w3_per_student(t).select(
        "student_id", "literacy_first", "literacy_last", "grade_level_first", "grade_level_latest")


@register("agg_rate")
def _agg_rate(t):
    """``1.0 * SUM(flag) / COUNT(*)``."""
    return _w3_per_student(t).select("student_id", "lessons_worked", "pass_rate")


@register("join_inner_left")
def _join_inner_left(t):
    """Inner join then left join."""
    return _w3_usage_by_student(t, sort=False).select("student_id", "total_session_minutes", "lessons_worked")


@register("named_view")
def _named_view(t):
    """Publish the model as a named view and read it back."""
    return register_view(_w3_usage_by_student(t, sort=False), "usage_by_student_view")


# ================================================================ W4
def _w4_inputs(t):
    return dict(advertisers=si.advertisers(t), offers=si.offers(t), affiliates=si.affiliates(t))


def _w4_from():
    return as_date(CAMPAIGN_FROM_DATE)


def _w4_combined(t):
    return w4.combined(si.conversions(t), si.clicks(t), **_w4_inputs(t), from_date=_w4_from())


@register("campaign_revenue")
def _campaign_revenue(t):
    """W4 pipeline: clicks, conversions and revenue per day, affiliate and campaign."""
    return w4.campaign_revenue(si.conversions(t), si.clicks(t), **_w4_inputs(t),
                               history=si.campaign_history(t), from_date=_w4_from())


@register("join_star_left")
def _join_star_left(t):
    """Three LEFT lookups from one fact."""
    return w4.conversion_raw(si.conversions(t), **_w4_inputs(t), from_date=_w4_from())


@register("agg_count_col", "agg_wide_grain")
def _agg_count_col(t):
    """``COUNT(transaction_id)`` on an eight-column grain."""
    return w4.conversion_clean(si.conversions(t), **_w4_inputs(t), from_date=_w4_from())


@register("agg_count_distinct")
def _agg_count_distinct(t):
    """``COUNT(DISTINCT transaction_id)``."""
    return w4.click_clean(si.clicks(t), **_w4_inputs(t), from_date=_w4_from())


@register("union_facts")
def _union_facts(t):
    """``UNION ALL`` with complementary zero columns."""
    return _w4_combined(t)


@register("agg_by_expr")
def _agg_by_expr(t):
    """Group by a computed campaign id."""
    return w4.revenue_final(_w4_combined(t))


@register("agg_sum_expr")
def _agg_sum_expr(t):
    """Sum of a cast quotient per campaign (A2)."""
    u = _w4_combined(t).withColumn("campaign_id", text.campaign_id("affiliate_sub4", "affiliate_sub3"))
    return u.groupBy("campaign_id").agg(per_unit(F.sum("revenue_cents"), 100.0).alias("tune_revenue"))


@register("agg_sum")
def _agg_sum(t):
    """``SUM`` of columns per day and affiliate (A1)."""
    raw = w4.raw_events(si.clicks(t), "click_time", "cl_rev")
    return raw.groupBy("event_date", "affiliate_id").agg(
        F.sum("cl_rev").cast("bigint").alias("revenue_cents"),
        F.sum("payout_cents").cast("bigint").alias("payout_cents"))


@register("null_to_zero")
def _null_to_zero(t):
    """``CASE WHEN x IS NULL THEN 0 ELSE x END``."""
    return si.clicks(t).select("transaction_id", "revenue_cents", nz("revenue_cents").alias("cl_rev"))


@register("campaign_id")
def _campaign_id(t):
    """Nested CASE choosing sub4 or sub3, then the regex rules."""
    c = si.clicks(t).unionByName(si.conversions(t).drop("status").withColumnRenamed(
        "conversion_time", "click_time"))
    return c.select("transaction_id", "affiliate_sub3", "affiliate_sub4",
                    text.campaign_id("affiliate_sub4", "affiliate_sub3").alias("campaign_id"))


@register("fn_regex_cmp")
def _fn_regex_cmp(t):
    """``REGEXP_SUBSTR(s, 'cmp-([0-9]{1,12})')``, whole match."""
    return si.clicks(t).select("transaction_id", "affiliate_sub4",
                               text.regex_whole("affiliate_sub4", text.CMP_PATTERN).alias("cmp_match"))


@register("fn_regex_digits")
def _fn_regex_digits(t):
    """``REPLACE(REGEXP_SUBSTR(s, '^([0-9])+_*'), '_', '')``."""
    return si.clicks(t).select(
        "transaction_id", "affiliate_sub3",
        F.replace(text.regex_whole("affiliate_sub3", text.DIGITS_PATTERN), F.lit("_"), F.lit(""))
        .alias("leading_digits"))


@register("fn_ltrim_set")
def _fn_ltrim_set(t):
    """``LTRIM(s, 'cmp-')`` strips a character set."""
    return si.clicks(t).select(
        "transaction_id", "affiliate_sub3",
        text.ltrim_set(text.regex_whole("affiliate_sub3", text.CMP_PATTERN), "cmp-").alias("campaign_digits"))


@register("filter_like")
def _filter_like(t):
    """``LIKE '%cmp%'``."""
    return si.clicks(t).where(text.like("affiliate_sub4", "%cmp%")).select("transaction_id", "affiliate_sub4")


@register("filter_not_null")
def _filter_not_null(t):
    """``IS NOT NULL``."""
    return si.conversions(t).where(F.col("affiliate_sub4").isNotNull()).select(
        "transaction_id", "affiliate_sub4")


@register("filter_from_date")
def _filter_from_date(t):
    """Lower bound only, on the event day."""
    return (w4.raw_events(si.conversions(t), "conversion_time", "cr_rev")
            .where(on_or_after("event_date", CAMPAIGN_FROM_DATE)))


@register("fn_to_date")
def _fn_to_date(t):
    """``DATE(ts)``."""
    return si.clicks(t).select("transaction_id", "click_time", F.to_date("click_time").alias("event_date"))


@register("fn_cast")
def _fn_cast(t):
    """``CAST(x AS float) / CAST(100 AS float)`` and ``1.0 *`` promotion."""
    return si.clicks(t).select(
        "transaction_id",
        per_unit(F.col("revenue_cents"), 100.0).alias("revenue"),
        as_double("payout_cents").alias("payout"))


@register("win_rn_desc")
def _win_rn_desc(t):
    """``ROW_NUMBER`` descending by date per key."""
    return w4.campaign_lookup(si.campaign_history(t), split=True)


@register("win_latest")
def _win_latest(t):
    """Newest row per key (``rank = 1``)."""
    return w4.latest_campaigns(si.campaign_history(t))


@register("join_left_on_filter")
def _join_left_on_filter(t):
    """LEFT JOIN with ``rank = 1`` in ON: unmatched ids stay."""
    ids = w4.revenue_final(_w4_combined(t)).select("campaign_id").distinct()
    lookup = w4.campaign_lookup(si.campaign_history(t))
    return left_join_filtered(ids, lookup, "campaign_id", F.col("rank") == 1).select(
        "campaign_id", "campaign_name")


# ================================================================ W5
AS_OF = BUDGET_AS_OF


def _w5(t):
    return dict(calendar_source=si.calendar_source(t, AS_OF), revenue=si.revenue_facts(t, AS_OF),
                clicks=si.click_facts(t, AS_OF), budget=si.budgets(t))


@register("budget_forecast")
def _budget_forecast(t):
    """W5 pipeline: weekday-weighted daily budget targets with actual and forecast revenue."""
    return w5.budget_forecast(**_w5(t), as_of=AS_OF)


@register("fn_date_parts")
def _fn_date_parts(t):
    """``EXTRACT(DAYOFWEEK / MONTH / YEAR)``."""
    return w5.ytd_calendar(si.calendar_source(t, AS_OF), AS_OF)


@register("fn_date_shift")
def _fn_date_shift(t):
    """``DATE_ADD(d, INTERVAL 1 YEAR)``."""
    return w5.future_calendar(si.calendar_source(t, AS_OF), AS_OF)


@register("fn_year_bounds")
def _fn_year_bounds(t):
    """``DATE_TRUNC(d, YEAR)`` and ``LAST_DAY(d, YEAR)``."""
    return (si.calendar_source(t, AS_OF).select(
        "date", year_start_col("date").alias("year_start"), year_end_col("date").alias("year_end"))
        .distinct())


@register("union_distinct")
def _union_distinct(t):
    """``SELECT DISTINCT * FROM (a UNION ALL b)``."""
    return w5.month_calendar(si.calendar_source(t, AS_OF), AS_OF)


@register("agg_count")
def _agg_count(t):
    """``COUNT(*)`` per month and weekday (A4)."""
    return w5.days_in_month(w5.month_calendar(si.calendar_source(t, AS_OF), AS_OF))


@register("agg_pace")
def _agg_pace(t):
    """Three-outcome conditional revenue."""
    r = w5.revenue_to_date(si.revenue_facts(t, AS_OF), AS_OF)
    return r.select("event_date", "month", "Brand", F.col("revenue").cast("double").alias("revenue"),
                    F.col("revenue_to_pace").cast("double").alias("revenue_to_pace"))


@register("case_null")
def _case_null(t):
    """CASE with a NULL branch first and ``!=`` falling to ELSE for NULL."""
    r = si.revenue_facts(t, AS_OF).where(F.col("date").between(F.lit(year_start(AS_OF)), F.lit(AS_OF)))
    pace = (F.when(F.col("date") == F.lit(AS_OF), F.lit(None))
            .when(F.col("revenue_type") != "Addition", F.col("revenue")).otherwise(F.lit(0)))
    return r.select("date", "Brand", "revenue_type", F.col("revenue").cast("double").alias("revenue"),
                    pace.cast("double").alias("pace_value"))


def _w5_actuals(t):
    i = _w5(t)
    cal = w5.month_calendar(i["calendar_source"], AS_OF)
    return w5.actual_revenue(i["revenue"], cal, w5.monthly_budget(i["budget"], AS_OF), AS_OF)


@register("actuals_padded")
def _actuals_padded(t):
    """``UNION ALL`` with typed-NULL padding."""
    return _w5_actuals(t).select("event_date", "month", "Brand",
                                 F.col("revenue").cast("double").alias("revenue"),
                                 F.col("revenue_to_pace").cast("double").alias("revenue_to_pace"))


@register("join_cross")
def _join_cross(t):
    """Calendar x budget brands after today (J9), generated per brand."""
    i = _w5(t)
    cal = w5.month_calendar(i["calendar_source"], AS_OF)
    brands = w5.budget_brands(w5.monthly_budget(i["budget"], AS_OF))
    return w5.future_rows(cal, brands, AS_OF).select("event_date", "month", "Brand")


@register("agg_avg")
def _agg_avg(t):
    """``AVG`` skipping NULLs (A3)."""
    return w5.monthly_average(_w5_actuals(t))


@register("distinct_rows")
def _distinct_rows(t):
    """``SELECT DISTINCT``."""
    return w5.budget_brands(w5.monthly_budget(si.budgets(t), AS_OF))


@register("win_share")
def _win_share(t):
    """``COUNT(*) OVER`` two partitions, ratio, DISTINCT."""
    return w5.weekday_shares(si.click_facts(t, AS_OF), AS_OF)


def _w5_weights(t):
    cal = w5.month_calendar(si.calendar_source(t, AS_OF), AS_OF)
    return w5.daily_weights(w5.weekday_shares(si.click_facts(t, AS_OF), AS_OF), w5.days_in_month(cal))


@register("win_normalise")
def _win_normalise(t):
    """Value / ``SUM(value) OVER (partition)``."""
    return _w5_weights(t)


@register("join_left")
def _join_left(t):
    """Composite-key LEFT join to the monthly budget."""
    return w5.dayofweek_budget(_w5_weights(t), w5.monthly_budget(si.budgets(t), AS_OF))


@register("filter_self_range")
def _filter_self_range(t):
    """``date BETWEEN date - 3 MONTH AND today`` = ``date <= today`` (F16)."""
    return (si.click_facts(t, AS_OF).where(recent("date", AS_OF))
            .groupBy("Brand").agg(F.count(F.lit(1)).alias("clicks")))


# ================================================================ records
@register("token_exists")
def _token_exists(t):
    """Token existence per request, case-sensitive."""
    return records.token_exists(si.token_requests(t), si.auth_tokens(t))


@register("token_user_exists")
def _token_user_exists(t):
    """Token and user both match."""
    return records.token_user_exists(si.token_requests(t), si.auth_tokens(t))


@register("token_lookup")
def _token_lookup(t):
    """User name per requested token, '' when absent (D3)."""
    return records.token_user_name(si.token_requests(t), si.auth_tokens(t))


def _tokens_after_insert(t):
    return records.insert_if_absent(si.auth_tokens(t), si.token_requests(t), "authToken")[0]


@register("insert_if_absent")
def _insert_if_absent(t):
    """Batch insert rejecting rows whose token, the primary key, exists."""
    return _tokens_after_insert(t)


@register("insert_rejected")
def _insert_rejected(t):
    """The rows the batch insert rejects, with the reason."""
    return records.insert_if_absent(si.auth_tokens(t), si.token_requests(t), "authToken")[2]


@register("delete_persons")
def _delete_persons(t):
    """Delete all persons of a set of users."""
    return records.delete_by_key(si.persons(t), si.delete_users(t), "descendant", "userName")


@register("dq_dangling_child")
def _dq_dangling_child(t):
    """Order lines whose product is not for sale: a product of another type counts as missing."""
    shop = si.shop_tables(t)
    sold = shop["products"].where(F.col("product_type") != si.SHOP_BOOK_TYPE)
    return quality.orphans(shop["customer_order_products"], "product_id", sold, "product_id")


@register("delete_by_key")
def _delete_by_key(t):
    """Delete all tokens of a set of users (D5; D10 is the same job on persons by descendant)."""
    return records.delete_by_key(si.auth_tokens(t), si.delete_users(t), "userName")


@register("person_exists")
def _person_exists(t):
    """Person id and descendant both match."""
    p = si.persons(t).select(F.col("id").alias("__id"), F.col("descendant").alias("__d"))
    return exists_flag(si.person_requests(t), p, [("id", "__id"), ("descendant", "__d")], "person_exists")


@register("user_person_lookup")
def _user_person_lookup(t):
    """Person id of each requested user, NULL when absent."""
    return records.lookup_value(si.user_requests(t), si.users(t), "userName", "userPersonID", "userPersonID")


@register("person_lookup")
def _person_lookup(t):
    """Person record per requested id; unknown id keeps only the id."""
    return records.person_record(si.person_id_requests(t), si.persons(t))


@register("persons_of_user")
def _persons_of_user(t):
    """All persons of each requested user, one per id."""
    return records.persons_of_user(si.family_requests(t), si.persons(t))


@register("append_person")
def _append_person(t):
    """Batch append of persons, missing parents as NULL."""
    return records.append_person(si.persons(t), si.new_persons(t))


@register("dq_unique")
def _dq_unique(t):
    """Primary-key report on the token table after the batch insert."""
    return quality.duplicate_keys(_tokens_after_insert(t), ["authToken"])


@register("dq_not_null")
def _dq_not_null(t):
    """NULL count per column of the person table."""
    return quality.null_counts(si.persons(t), si.persons(t).columns)


@register("dq_foreign_key")
def _dq_foreign_key(t):
    """Requested token rows whose user is not in the user table."""
    return quality.orphans(si.token_requests(t).select("authToken", "userName"), "userName", si.users(t), "userName")


@register("dq_self_foreign_key")
def _dq_self_foreign_key(t):
    """Father / mother / spouse ids that point at no person."""
    return quality.self_orphans(si.persons(t), "id", ["fatherID", "motherID", "spouseID"])


# ================================================================ sinks
@register("sink_overwrite")
def _sink_overwrite(t):
    """Full refresh: the table is replaced whole by the second write (S5; S9 drop is tested)."""
    name = unique_name("authToken")
    write_table(si.auth_tokens(t), name, mode="overwrite")
    return write_table(records.delete_by_key(si.auth_tokens(t), si.delete_users(t), "userName"),
                       name, mode="overwrite")


@register("sink_refresh_in_place")
def _sink_refresh(t):
    """A stored table refreshed from itself: a delete whose input is the table it
    replaces (S5, D5)."""
    name = unique_name("authToken")
    write_table(si.auth_tokens(t), name)
    return write_table(records.delete_by_key(read_table(t.spark, name), si.delete_users(t), "userName"), name)


@register("sink_drop")
def _sink_drop(t):
    """A published table before and after ``DROP TABLE IF EXISTS``, dropped twice."""
    name = f"auth_token_{zlib.crc32(t.sf_dir.encode()):08x}"
    drop_table(t.spark, name)
    write_table(si.auth_tokens(t), name)
    before = create_table_as(read_table(t.spark, name).groupBy("userName").agg(
        F.count(F.lit(1)).alias("tokens")), unique_name("counts"))
    drop_table(t.spark, name)
    drop_table(t.spark, name)
    try:
        left = read_table(t.spark, name).count()
    except AnalysisException:
        left = 0
    return before.withColumn("tokens_left", F.lit(left).cast("bigint"))


@register("join_bloom_semi")
def _join_bloom_semi(t):
    """``IN`` with the subquery's Bloom filter on the fact scan, then the exact semi join (J13):
    order lines of one market segment's customers."""
    builders = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    orders = semi_filtered(t.orders, builders, "o_custkey", "c_custkey").select("o_orderkey")
    return (semi_filtered(t.lineitem, materialize(orders, "keys"), "l_orderkey", "o_orderkey")
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@register("join_salted")
def _join_salted(t):
    """Join with counted salts on hot keys (J7): lines with their part, hot parts dealt
    over several tasks."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return join_salted(lines, t.part.select("p_partkey", "p_brand"), "l_partkey", "p_partkey", "left",
                       rows_per_salt=20).select("l_orderkey", "l_linenumber", "p_brand")


@register("join_bucketed")
def _join_bucketed(t):
    """Join and grouping of two tables bucketed on the order key, without an exchange.
    Both have as many buckets, in proportion to the lines, so a task's rows stay bounded."""
    database = f"tessera_b{zlib.crc32(t.sf_dir.encode()):08x}"
    t.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{table_path(t.spark, database)}'")
    buckets = buckets_for(t.lineitem.count())
    lines = save_table(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"),
                       [database, "lines"], buckets, ["o_orderkey"])
    orders = save_table(t.orders.select("o_orderkey", "o_orderpriority"), [database, "orders"], buckets, ["o_orderkey"])
    return (orders.join(lines, "o_orderkey").groupBy("o_orderkey", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_quantity").alias("max_quantity")))


@register("sink_append")
def _sink_append(t):
    """Append of the accepted batch rows, matched by column name."""
    name = unique_name("authToken")
    write_table(si.auth_tokens(t), name, mode="overwrite")
    accepted = records.insert_if_absent(si.auth_tokens(t), si.token_requests(t), "authToken")[1]
    return write_table(accepted.select("userName", "authToken"), name, mode="append")
