"""Clicks and conversions by day, affiliate and campaign.

Stages: conversions (approved only) and clicks are each named through three
LEFT lookups and grouped on an eight-column grain; the two results are
unioned with complementary zero columns; a campaign id is parsed from the
sub-ids and the union re-grouped on it; the newest campaign name is joined
on last.

Scale notes. Facts are first grouped on their *id* grain (ids, sub-ids,
source, day) and only the groups are joined to the name dimensions, then
re-grouped on the names. Sums and counts compose over that (a name group is a
union of id groups, and a duplicated dimension id multiplies a group's sums
exactly as it would multiply its rows), so the result is the same as joining
raw rows, while the dimension joins see groups instead of events. Clicks are
reduced to one row per (grain, transaction id), which counts 1 in the final sums,
so the exact distinct count needs no grouping of its own. The report is grouped
by affiliate id and named last: a hot affiliate is folded inside each task
before the one shuffle of its groups, and no aggregate runs on a join's task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed as fx
from tessera.functions.numeric import per_unit
from tessera.functions.dates import ntz
from tessera.functions.mapping import nz
from tessera.functions.text import campaign_id
from tessera.operators.joins import with_names
from tessera.operators.sets import union_all
from tessera.operators.windows import desc, row_number, row_number_split

ID_GRAIN = ["event_date", "advertiser_id", "offer_id", "affiliate_id", "affiliate_source",
            "affiliate_sub3", "affiliate_sub4"]
NAME_GRAIN = ["event_date", "advertiser_name", "offer_name", "affiliate_name", "affiliate_id",
              "affiliate_source", "affiliate_sub3", "affiliate_sub4"]
FINAL_GRAIN = ["event_date", "affiliate_name", "affiliate_id", "affiliate_source", "campaign_id"]


def _since(df: DataFrame, time_col: str, from_date: dt.date | None) -> DataFrame:
    """Rows on or after ``from_date``, as a range on the raw timestamp so the
    predicate is pushed into the parquet scan."""
    if from_date is None:
        return df
    return df.where(F.col(time_col) >= ntz(from_date))


def _names(df: DataFrame, advertisers: DataFrame, offers: DataFrame, affiliates: DataFrame) -> DataFrame:
    return with_names(df, [
        (advertisers, "advertiser_id", "id", {"company": "advertiser_name"}),
        (offers, "offer_id", "id", {"name": "offer_name"}),
        (affiliates, "affiliate_id", "id", {"company": "affiliate_name"}),
    ])


# The affiliate's name follows from its id, which the grain holds: it is joined last.
GROUP_GRAIN = [c for c in NAME_GRAIN if c != "affiliate_name"]


def _named_groups(groups: DataFrame, advertisers: DataFrame, offers: DataFrame, *measures) -> DataFrame:
    """``groups`` (id grain) re-grouped on advertiser and offer names."""
    named = with_names(groups, [
        (advertisers, "advertiser_id", "id", {"company": "advertiser_name"}),
        (offers, "offer_id", "id", {"name": "offer_name"}),
    ])
    return named.groupBy(*GROUP_GRAIN).agg(*measures)


def _with_affiliates(groups: DataFrame, affiliates: DataFrame, scaled: list[str]) -> DataFrame:
    """Adds the affiliate's name. An id that the dimension holds m times under one
    name multiplies the ``scaled`` measures by m, as a join of rows would."""
    names = (affiliates.groupBy(F.col("id").alias("__id"), F.col("company").alias("affiliate_name"))
             .agg(F.count(F.lit(1)).alias("__m")))
    out = groups.join(names, F.col("affiliate_id") == F.col("__id"), "left")
    times = F.coalesce("__m", F.lit(1))
    return out.select(*NAME_GRAIN, *[
        ((F.col(c) * times) if c in scaled else F.col(c)).cast("bigint").alias(c)
        for c in ("conversions", "clicks", "revenue_cents", "payout_cents")])


def raw_events(facts: DataFrame, time_col: str, rev_name: str) -> DataFrame:
    """Row-level clean-up: the day of the event and NULL revenue as 0."""
    return facts.select(
        F.to_date(time_col).alias("event_date"), "advertiser_id", "offer_id", "affiliate_id",
        "affiliate_source", "affiliate_sub3", "affiliate_sub4", "transaction_id",
        nz("revenue_cents").alias(rev_name), "payout_cents")


def conversion_raw(conversions: DataFrame, advertisers: DataFrame, offers: DataFrame,
                   affiliates: DataFrame, from_date: dt.date | None = None) -> DataFrame:
    """Approved conversions with their names, one row per conversion."""
    c = _since(conversions, "conversion_time", from_date).where(F.col("status") == fx.W4_STATUS)
    return _names(raw_events(c, "conversion_time", "cr_rev"), advertisers, offers, affiliates)


def conversion_clean(conversions: DataFrame, advertisers: DataFrame, offers: DataFrame,
                     affiliates: DataFrame, from_date: dt.date | None = None) -> DataFrame:
    """Conversions per name grain: ``COUNT(transaction_id)`` (rows with an id),
    ``0 AS clicks``, revenue and payout sums."""
    c = _since(conversions, "conversion_time", from_date).where(F.col("status") == fx.W4_STATUS)
    by_id = (raw_events(c, "conversion_time", "cr_rev").groupBy(*ID_GRAIN)
             .agg(F.count("transaction_id").alias("n"), F.sum("cr_rev").alias("rev"),
                  F.sum("payout_cents").alias("pay")))
    groups = _named_groups(by_id, advertisers, offers, F.sum("n").alias("conversions"),
                           F.lit(0).alias("clicks"), F.sum("rev").alias("revenue_cents"),
                           F.sum("pay").alias("payout_cents"))
    return _with_affiliates(groups, affiliates, ["conversions", "revenue_cents", "payout_cents"])


def click_clean(clicks: DataFrame, advertisers: DataFrame, offers: DataFrame,
                affiliates: DataFrame, from_date: dt.date | None = None) -> DataFrame:
    """Clicks per name grain: ``COUNT(DISTINCT transaction_id)`` (exact),
    ``0 AS conversions``, revenue and payout sums."""
    c = _since(clicks, "click_time", from_date)
    by_txn = (raw_events(c, "click_time", "cl_rev").groupBy(*ID_GRAIN, "transaction_id")
              .agg(F.sum("cl_rev").alias("rev"), F.sum("payout_cents").alias("pay")))
    groups = _named_groups(by_txn, advertisers, offers, F.lit(0).alias("conversions"),
                           F.countDistinct("transaction_id").alias("clicks"),
                           F.sum("rev").alias("revenue_cents"), F.sum("pay").alias("payout_cents"))
    return _with_affiliates(groups, affiliates, ["revenue_cents", "payout_cents"])


def combined(conversions: DataFrame, clicks: DataFrame, advertisers: DataFrame, offers: DataFrame,
             affiliates: DataFrame, from_date: dt.date | None = None) -> DataFrame:
    """``UNION ALL`` of both grains (U1): each side carries 0 for the other's
    measure."""
    return union_all(conversion_clean(conversions, advertisers, offers, affiliates, from_date),
                     click_clean(clicks, advertisers, offers, affiliates, from_date))


def campaign_lookup(history: DataFrame, split: bool = False) -> DataFrame:
    """``SELECT DISTINCT campaign_id, campaign_name, ROW_NUMBER() OVER
    (PARTITION BY campaign_id ORDER BY created_date DESC) AS rank``. The rank
    makes every row distinct already, so no DISTINCT shuffle is needed; ties on
    the date are broken by name. When only ``rank = 1`` is read (the final
    join) the plain window is best: Spark limits it per task before the
    shuffle. ``split=True`` numbers every row without gathering a campaign's
    history in one task."""
    order = [desc("created_date"), desc("campaign_name")]
    if split:
        h = history.select("campaign_id", "campaign_name", "created_date")
        return row_number_split(h, ["campaign_id"], order, "rank").drop("created_date")
    rank = row_number(["campaign_id"], order)
    return history.select("campaign_id", "campaign_name", rank.alias("rank"))


def latest_campaigns(history: DataFrame) -> DataFrame:
    """Rank-1 rows only: the newest name of each campaign id."""
    return campaign_lookup(history).where(F.col("rank") == 1).drop("rank")


def events_by_id(conversions: DataFrame, clicks: DataFrame, advertisers: DataFrame, offers: DataFrame,
                 from_date: dt.date | None = None) -> DataFrame:
    """Both facts (U1) under their affiliate ids, as partial groups whose measures are
    yet to be summed: conversions per id grain, clicks one row per transaction of a
    name grain (a row without a transaction id counts 0). Advertisers and offers are
    joined because names define which clicks are the same and ids that a
    dimension repeats multiply sums."""
    approved = _since(conversions, "conversion_time", from_date).where(F.col("status") == fx.W4_STATUS)
    by_id = (raw_events(approved, "conversion_time", "cr_rev").groupBy(*ID_GRAIN)
             .agg(F.count("transaction_id").alias("conversions"), F.sum("cr_rev").alias("revenue_cents")))
    by_txn = (raw_events(_since(clicks, "click_time", from_date), "click_time", "cl_rev")
              .groupBy(*ID_GRAIN, "transaction_id").agg(F.sum("cl_rev").alias("revenue_cents")))
    names = [(advertisers, "advertiser_id", "id", {"company": "advertiser_name"}),
             (offers, "offer_id", "id", {"name": "offer_name"})]
    once = (with_names(by_txn, names).groupBy(*GROUP_GRAIN, "transaction_id")
            .agg(F.sum("revenue_cents").alias("revenue_cents")))
    keys = ["event_date", "affiliate_id", "affiliate_source", "affiliate_sub3", "affiliate_sub4"]
    none = F.lit(0).cast("bigint")
    return union_all(
        with_names(by_id, names).select(*keys, none.alias("clicks"), "conversions", "revenue_cents"),
        once.select(*keys, F.col("transaction_id").isNotNull().cast("bigint").alias("clicks"),
                    none.alias("conversions"), "revenue_cents"))


def report_by_id(events: DataFrame, affiliates: DataFrame) -> DataFrame:
    """The report grain summed under affiliate ids, then named. An id that the dimension
    holds m times under one name multiplies conversions and revenue by m, as a join
    of rows would; clicks are distinct transactions and stay."""
    by_id = (events.withColumn("campaign_id", campaign_id("affiliate_sub4", "affiliate_sub3"))
             .groupBy("event_date", "affiliate_id", "affiliate_source", "campaign_id")
             .agg(*[F.sum(c).alias(c) for c in ("clicks", "conversions", "revenue_cents")]))
    names = (affiliates.groupBy(F.col("id").alias("__id"), F.col("company").alias("affiliate_name"))
             .agg(F.count(F.lit(1)).alias("__m")))
    named = by_id.join(names, F.col("affiliate_id") == F.col("__id"), "left")
    times = F.coalesce("__m", F.lit(1))
    return named.select(*FINAL_GRAIN, F.col("clicks").cast("bigint").alias("tune_clicks"),
                        (F.col("conversions") * times).cast("bigint").alias("tune_conversions"),
                        per_unit(F.col("revenue_cents") * times, fx.W4_CENTS_PER_UNIT).alias("tune_revenue"))


def revenue_final(union: DataFrame) -> DataFrame:
    """Group on the parsed campaign id (A15). Revenue is the exact cent total
    divided once by 100 (the source sums ``cents / 100.0`` row by row; the
    value is the same up to float rounding, and this form does not depend on
    summation order)."""
    return (union.withColumn("campaign_id", campaign_id("affiliate_sub4", "affiliate_sub3"))
            .groupBy(*FINAL_GRAIN)
            .agg(F.sum("clicks").cast("bigint").alias("tune_clicks"),
                 F.sum("conversions").cast("bigint").alias("tune_conversions"),
                 per_unit(F.sum("revenue_cents"), fx.W4_CENTS_PER_UNIT).alias("tune_revenue")))


def campaign_revenue(conversions: DataFrame, clicks: DataFrame, advertisers: DataFrame,
                     offers: DataFrame, affiliates: DataFrame, history: DataFrame,
                     from_date: dt.date | None = dt.date(2023, 1, 1)) -> DataFrame:
    """The governed table: daily clicks, conversions and revenue per affiliate
    and campaign, with the campaign's newest name (NULL when unknown)."""
    final = report_by_id(events_by_id(conversions, clicks, advertisers, offers, from_date), affiliates)
    names = latest_campaigns(history)
    out = final.join(names, "campaign_id", "left")
    if from_date is not None:
        out = out.where(F.col("event_date") >= F.lit(from_date))
    return out.select("event_date", "affiliate_name", "affiliate_id", "affiliate_source",
                      "campaign_name", "campaign_id", "tune_clicks", "tune_conversions",
                      "tune_revenue")
