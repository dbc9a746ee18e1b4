"""Edge rows every build must handle (FIXTURES.md 5), one assertion each."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tessera.functions import text
from tessera.functions.dates import add_years
from tessera.functions.mapping import grade_to_int
from tessera.operators import aggs, joins, quality, records


def test_not_in_with_null_in_subquery_is_empty(spark):
    probe = spark.createDataFrame([(3,), (None,)], "k int")
    subq = spark.createDataFrame([(1,), (None,)], "k int")
    assert joins.anti_null_aware(probe, subq, "k").count() == 0
    # NOT EXISTS keeps both rows: 3 matches nothing, NULL never matches
    assert rows(joins.anti(probe, subq, "k")) == [(3,), (None,)]


def test_not_in_against_empty_subquery_keeps_null_keys(spark):
    probe = spark.createDataFrame([(3,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert joins.anti_null_aware(probe, empty, "k").count() == 2


def test_not_in_without_nulls_drops_null_probe(spark):
    probe = spark.createDataFrame([(3,), (1,), (None,)], "k int")
    subq = spark.createDataFrame([(1,)], "k int")
    assert rows(joins.anti_null_aware(probe, subq, "k")) == [(3,)]


def test_not_like_is_case_insensitive_and_drops_null(spark):
    df = spark.createDataFrame([(None,), ("SKIPPED",), ("done",)], "s string")
    assert rows(df.where(text.not_like_ci("s", "%Skip%"))) == [("done",)]


def test_activity_score_zero_possible_and_all_null(spark):
    df = spark.createDataFrame(
        [("a", 0, 5, 0), ("b", 0, 5, 1), ("c", 4, 3, 0), ("c", 0, 9, 1), ("d", None, None, None)],
        "g string, possible int, correct int, mastered int")
    got = dict(df.groupBy("g").agg(aggs.activity_score("possible", "correct", "mastered").alias("s"))
               .collect())
    assert got["a"] == 0.0 and got["b"] == 1.0
    assert got["c"] == pytest.approx(4 / 5)  # (3 + 1) / (4 + 1)
    assert got["d"] is None


def test_pick_else_zero_versus_else_null(spark):
    df = spark.createDataFrame([("s", "Language", 1, 7)], "k string, t string, rn int, v int")
    cond = (F.col("t") == "Literacy") & (F.col("rn") == 1)
    r = df.groupBy("k").agg(aggs.pick("v", cond, empty=0).alias("zero"),
                            aggs.pick("v", cond).alias("null")).first()
    assert r["zero"] == 0 and r["null"] is None


def test_grade_labels(spark):
    df = spark.createDataFrame([("Unknown",), ("PreK",), ("Other",), (None,)], "g string")
    assert [r[0] for r in df.select(grade_to_int("g")).collect()] == [None, -1, 13, None]


@pytest.mark.parametrize("sub4, sub3, expected", [
    (None, "cmp-7", "7"),
    ("", "cmp-7", ""),
    ("x_cmp-12_y", None, "12"),
    ("12__ab", None, "12"),
    ("zz", None, ""),
    ("cmpX", None, ""),
])
def test_campaign_id_rules(spark, sub4, sub3, expected):
    df = spark.createDataFrame([(sub4, sub3)], "s4 string, s3 string")
    assert df.select(text.campaign_id("s4", "s3")).first()[0] == expected


def test_ltrim_strips_a_character_set(spark):
    df = spark.createDataFrame([("cmp-123",), ("mc-9",), ("pp",)], "s string")
    assert [r[0] for r in df.select(text.ltrim_set("s", "cmp-")).collect()] == ["123", "9", ""]


def test_feb_29_plus_one_year(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert df.select(add_years("d", 1)).first()[0] == dt.date(2025, 2, 28)


def _facts(spark, kind, rows_):
    schema = ("ts timestamp_ntz, advertiser_id bigint, offer_id bigint, affiliate_id bigint, "
              "affiliate_sub3 string, affiliate_sub4 string, affiliate_source string, "
              "transaction_id string, revenue_cents bigint, payout_cents bigint, status string")
    df = spark.createDataFrame(rows_, schema).withColumnRenamed("ts", kind)
    return df


def test_same_transaction_twice_counts_one_click_two_conversions(spark):
    from tessera.plans import campaign_revenue as w4
    t = dt.datetime(2024, 1, 2, 10)
    r = [(t, 1, 1, 1, "cmp-5", None, "search", "tx1", 100, 10, "approved")] * 2
    conv = _facts(spark, "conversion_time", r)
    clk = _facts(spark, "click_time", r).drop("status")
    dims = spark.createDataFrame([(1, "A")], "id bigint, company string")
    offers = spark.createDataFrame([(1, "O")], "id bigint, name string")
    c = w4.conversion_clean(conv, dims, offers, dims).first()
    k = w4.click_clean(clk, dims, offers, dims).first()
    assert (c["conversions"], c["clicks"], c["revenue_cents"]) == (2, 0, 200)
    assert (k["conversions"], k["clicks"], k["revenue_cents"]) == (0, 1, 200)


def test_affiliate_listed_twice_multiplies_sums_not_clicks(spark):
    from tessera.plans import campaign_revenue as w4
    t = dt.datetime(2024, 1, 2, 10)
    r = [(t, 1, 1, 1, "cmp-5", None, "search", "tx1", 100, 10, "approved")] * 2
    one = spark.createDataFrame([(1, "A")], "id bigint, company string")
    twice = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B")], "id bigint, company string")
    offers = spark.createDataFrame([(1, "O")], "id bigint, name string")
    conv = w4.conversion_clean(_facts(spark, "conversion_time", r), one, offers, twice)
    clk = w4.click_clean(_facts(spark, "click_time", r).drop("status"), one, offers, twice)
    of = {x["affiliate_name"]: (x["conversions"], x["revenue_cents"], x["payout_cents"]) for x in conv.collect()}
    assert of == {"A": (4, 400, 40), "B": (2, 200, 20)}
    assert {x["affiliate_name"]: (x["clicks"], x["revenue_cents"]) for x in clk.collect()} == {
        "A": (1, 400), "B": (1, 200)}


def test_campaign_renamed_and_missing(spark):
    from tessera.plans import campaign_revenue as w4
    hist = spark.createDataFrame([("5", "old", dt.date(2023, 1, 1)), ("5", "new", dt.date(2023, 6, 1))],
                                 "campaign_id string, campaign_name string, created_date date")
    assert rows(w4.latest_campaigns(hist)) == [("5", "new")]
    ids = spark.createDataFrame([("5",), ("9",)], "campaign_id string")
    lookup = w4.campaign_lookup(hist)
    got = joins.left_join_filtered(ids, lookup, "campaign_id", F.col("rank") == 1)
    assert rows(got, "campaign_id", "campaign_name") == [("5", "new"), ("9", None)]


def test_budget_forecast_rules(spark):
    """Today's revenue is left out of the mean; today and later days this
    month get the mean; later months stay NULL; additions and unknown kinds
    count as 0; a brand without budget keeps its rows with NULL targets."""
    from tessera.plans import budget_forecast as w5
    as_of = dt.date(1998, 6, 15)
    days = [dt.date(1997, 1, 1) + dt.timedelta(days=i) for i in range(365)]
    days += [dt.date(1998, 1, 1) + dt.timedelta(days=i) for i in range(166)]
    cal_src = spark.createDataFrame([(d,) for d in days], "date date")
    rev = spark.createDataFrame([
        (dt.date(1998, 6, 1), "B1", 10.0, "Recurring"),
        (dt.date(1998, 6, 2), "B1", 50.0, "Addition"),   # counts 0 toward pace
        (dt.date(1998, 6, 3), "B1", 20.0, None),         # unknown kind: 0
        (dt.date(1998, 6, 15), "B1", 99.0, "Recurring"),  # today: excluded
    ], "date date, Brand string, revenue double, revenue_type string").withColumn(
        "revenue", F.col("revenue").cast("decimal(18,4)"))
    clicks = spark.createDataFrame([(d, b) for d in days[:200] for b in ("B1", "B2")],
                                   "date date, Brand string")
    budget = spark.createDataFrame([(1998, m, "B1", 300.0, 330.0) for m in range(1, 13)],
                                   "year int, period int, brand_domain string, budget double, "
                                   "current_reforecast double")
    out = w5.budget_forecast(cal_src, rev, clicks, budget, as_of, sort=False)
    by = {(r.Brand, r.event_date): r for r in out.collect()}
    mean = (10.0 + 0 + 0) / 3
    assert by[("B1", dt.date(1998, 6, 1))].actual_plus_forecast_revenue == 10.0
    assert by[("B1", dt.date(1998, 6, 15))].actual_plus_forecast_revenue == pytest.approx(mean)
    assert by[("B1", dt.date(1998, 6, 20))].actual_plus_forecast_revenue == pytest.approx(mean)
    assert by[("B1", dt.date(1998, 7, 20))].actual_plus_forecast_revenue is None
    b2 = by[("B2", dt.date(1998, 7, 20))]
    assert b2.budget_daily_target is None and b2.total_budget is None
    june = [r.budget_daily_target for (b, d), r in by.items() if b == "B1" and d.month == 6]
    assert sum(june) == pytest.approx(300.0)


def test_fanout_of_a_student_in_two_schools(spark):
    """The re-join multiplies: n roster rows give n x n output rows."""
    from tessera.plans import activity_scores as w1
    from tessera.sources.params import Params
    org = spark.createDataFrame([("W", None, 2), ("D", "W", 0), ("S1", "D", 1), ("S2", "D", 1)],
                                "_id string, ParentID string, OrgType int")
    so = spark.createDataFrame([("s9", "s1"), ("s9", "s2")], "StudentID string, OrganizationID string")
    st = spark.createDataFrame([("S9",)], "_id string")
    docs = spark.createDataFrame([("S9", 9)], "_id string, SqlStudentDocumentId bigint")
    ts = dt.datetime(2021, 10, 12)
    hist = spark.createDataFrame([(9, "g1", "StudentAchievement", "Done", ts)],
                                 "SqlStudentDocumentId bigint, Lesson string, SatisfiedReason string, "
                                 "LessonState string, DateTime timestamp_ntz")
    seq = spark.createDataFrame([("G1", 1)], "NodeGUID string, NodeID bigint")
    nodes = spark.createDataFrame([(1, 3, 26, "Lesson one")], "NodeID bigint, OrderID int, StrandID int, Name string")
    strands = spark.createDataFrame([(26, "Spanish")], "StrandID int, Enum string")
    scores = spark.createDataFrame([(9, "g1", "A1", "Skill", "Spanish", "Main", None, 5, 4, 1, ts)],
                                   "SqlStudentDocumentId bigint, Lesson string, Activity string, Skill string, "
                                   "Product string, LessonBranch string, ActivitySkippedType string, "
                                   "NumPossible int, NumCorrect int, Mastered int, DateTime timestamp_ntz")
    p = Params("2021-10-10", "2021-10-20", "D")
    args = dict(org=org, student_orgs=so, students=st, documents=docs, history=hist, seq_nodes=seq,
                lesson_nodes=nodes, strands=strands, scores=scores, p=p)
    assert w1.activity_scores(**args).count() == 4
    assert w1.activity_scores(**args, dedupe_roster=True).count() == 2


def test_usage_without_lessons_stays_lessons_without_usage_drop(spark):
    from tessera.plans import usage_by_student as w3
    from tessera.sources.params import Params
    orgs = spark.createDataFrame([("D", "W", "Dist", "District"), ("S", "D", "School", "School")],
                                 "organizationID string, parent string, name string, orgtype string")
    so = spark.createDataFrame([("a", "S"), ("b", "S")], "studentid string, organizationID string")
    info = spark.createDataFrame([(x, "First", x, x, "en", x, x, "t") for x in ("a", "b")],
                                 "id string, grade_level string, first_name string, last_name string, "
                                 "first_language string, student_number string, sync_id string, tag string")
    usage = spark.createDataFrame([("a", dt.date(2021, 8, 3), 120, "ILE")],
                                  "student_id string, usage_date date, session_seconds bigint, product_tag string")
    prog = spark.createDataFrame([("b", "Reading", "First", "L1", 1, True, True, False, dt.datetime(2021, 8, 5))],
                                 "student_id string, progress_area string, lesson_grade_level string, "
                                 "lesson_name string, lesson_order int, completed boolean, passed boolean, "
                                 "skipped boolean, date_updated timestamp_ntz")
    out = w3.usage_by_student(orgs, so, info, usage, prog, Params("2021-08-01", "2021-09-02", "D"))
    got = out.collect()
    assert [(r.student_id, r.total_session_minutes, r.lessons_worked) for r in got] == [("a", 2.0, None)]


def test_insert_keeps_the_key_and_returns_rejected_rows(spark):
    schema = "authToken string, userName string"
    tokens = spark.createDataFrame([("t1", "u1")], schema)
    batch = spark.createDataFrame([("t1", "u1"), ("t1", "u2"), ("t2", "u3"), ("t2", "u4"), ("t3", "u5"), ("t3", "u5")], schema)
    new, accepted, rejected = records.insert_if_absent(tokens, batch, "authToken")
    assert rows(accepted) == [("t2", "u3"), ("t3", "u5")]
    assert rows(new) == [("t1", "u1"), ("t2", "u3"), ("t3", "u5")]
    assert rows(rejected) == [("t1", "u1", "row exists"), ("t1", "u2", "key exists"),
                              ("t2", "u4", "key repeated"), ("t3", "u5", "key repeated")]
    assert quality.duplicate_keys(new, ["authToken"]).count() == 0


@pytest.mark.parametrize("n", range(2, 8))
def test_exactly_seventy_per_cent_passes(spark, n):
    from tessera.functions.mapping import LESSON_STRANDS
    from tessera.plans import lesson_summary as w2
    from tessera.sources.params import LESSON_PARAMS as p
    import datetime as dt

    at = dt.datetime.fromisoformat(str(p.start)[:10]) + dt.timedelta(hours=12)
    strand = LESSON_STRANDS[0]
    make = spark.createDataFrame
    for correct, passed in ((70, True), (69, False)):
        got = w2.lesson_rows(
            make([("s", 1)], "Student_GUID string, SqlStudentDocumentId long"),
            make([(1, "g1", "StudentAchievement", "Done", at)],
                 "SqlStudentDocumentId long, Lesson string, SatisfiedReason string, LessonState string, DateTime timestamp_ntz"),
            make([("G1", 1)], "NodeGUID string, NodeID long"),
            make([(1, 5, strand, "n")], "NodeID long, OrderID long, StrandID int, Name string"),
            make([(strand, "e")], "StrandID int, Enum string"),
            make([(1, "g1", f"A{i}", "Skill", "ILE", "Main", 100, correct, 0, at) for i in range(n)],
                 "SqlStudentDocumentId long, Lesson string, Activity string, Skill string, Product string, "
                 "LessonBranch string, NumPossible int, NumCorrect int, Mastered int, DateTime timestamp_ntz"), p)
        assert [r.Lesson_Passed for r in got.collect()] == [passed]


def test_token_lookup_default_and_case(spark):
    tokens = spark.createDataFrame([("t1", "u1")], "authToken string, userName string")
    req = spark.createDataFrame([(1, "t1"), (2, "T1"), (3, "t9")], "request_id int, authToken string")
    got = records.token_user_name(req, tokens)
    assert rows(got, "request_id", "userName") == [(1, "u1"), (2, ""), (3, "")]
    flags = records.token_exists(req, tokens)
    assert rows(flags, "request_id", "token_exists") == [(1, True), (2, False), (3, False)]


def test_missing_parent_null_or_text(spark):
    schema = ("id string, descendant string, firstName string, lastName string, gender string, "
              "fatherID string, motherID string, spouseID string")
    table = spark.createDataFrame([], schema)
    new = spark.createDataFrame([("p1", "u1", "A", "B", "f", None, None, None)], schema)
    assert records.append_person(table, new).first().fatherID is None
    assert records.append_person(table, new, null_text=True).first().fatherID == "null"


def test_person_record_for_unknown_id_has_only_the_id(spark):
    schema = ("id string, descendant string, firstName string, lastName string, gender string, "
              "fatherID string, motherID string, spouseID string")
    persons = spark.createDataFrame([("p1", "u1", "A", "B", "f", None, None, None)], schema)
    req = spark.createDataFrame([(1, "p1"), (2, "p2")], "request_id int, id string")
    got = {r.request_id: r for r in records.person_record(req, persons).collect()}
    assert got[1].firstName == "A"
    assert got[2].id == "p2" and got[2].firstName is None


def test_lower_bound_only_filter(spark):
    from tessera.functions.dates import on_or_after
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (14, 15, 16)], "d date")
    assert rows(df.where(on_or_after("d", "2024-01-15"))) == [(dt.date(2024, 1, 15),), (dt.date(2024, 1, 16),)]


def test_full_year_calendar_option(spark):
    from tessera.plans import budget_forecast as w5
    src = spark.createDataFrame([(dt.date(1998, 3, 1),)], "date date")
    seen = w5.month_calendar(src, dt.date(1998, 6, 15))
    full = w5.month_calendar(src, dt.date(1998, 6, 15), full_year=True)
    assert seen.count() == 1 and full.count() == 365
    assert full.where("future_date = DATE'1998-01-04'").first().dayofweek == 1  # a Sunday


def test_usage_sums_twice_for_a_student_in_two_schools_unless_deduped(spark):
    from tessera.plans import usage_by_student as w3
    from tessera.sources.params import Params
    roster = spark.createDataFrame([("a",), ("a",)], "student_id string")
    daily = spark.createDataFrame([("a", dt.date(2021, 8, 3), 120, "ILE")],
                                  "student_id string, usage_date date, session_seconds bigint, product_tag string")
    p = Params("2021-08-01", "2021-09-02", "D")
    assert w3.usage(daily, roster, p).first().total_session_minutes == 4.0
    assert w3.usage(daily, roster, p, dedupe_roster=True).first().total_session_minutes == 2.0


def test_lesson_summary_counts_a_student_in_two_schools_twice(spark):
    from tessera.plans import lesson_summary as w2
    from tessera.sources.params import Params
    org = spark.createDataFrame([("W", None, 2), ("D", "W", 0), ("S1", "D", 1), ("S2", "D", 1)],
                                "_id string, ParentID string, OrgType int")
    so = spark.createDataFrame([("s9", "s1"), ("s9", "s2")], "StudentID string, OrganizationID string")
    st = spark.createDataFrame([("S9",)], "_id string")
    docs = spark.createDataFrame([("S9", 9)], "_id string, SqlStudentDocumentId bigint")
    ts = dt.datetime(2021, 11, 12)
    hist = spark.createDataFrame([(9, "g1", "StudentAchievement", "Done", ts)],
                                 "SqlStudentDocumentId bigint, Lesson string, SatisfiedReason string, "
                                 "LessonState string, DateTime timestamp_ntz")
    seq = spark.createDataFrame([("G1", 1)], "NodeGUID string, NodeID bigint")
    nodes = spark.createDataFrame([(1, 3, 4, "Lesson one")], "NodeID bigint, OrderID int, StrandID int, Name string")
    strands = spark.createDataFrame([(4, "Reading")], "StrandID int, Enum string")
    scores = spark.createDataFrame([(9, "g1", "A1", "Skill", "ILE", "Main", None, 4, 3, 0, ts)],
                                   "SqlStudentDocumentId bigint, Lesson string, Activity string, Skill string, "
                                   "Product string, LessonBranch string, ActivitySkippedType string, "
                                   "NumPossible int, NumCorrect int, Mastered int, DateTime timestamp_ntz")
    args = dict(org=org, student_orgs=so, students=st, documents=docs, history=hist, seq_nodes=seq,
                lesson_nodes=nodes, strands=strands, scores=scores,
                p=Params("2021-11-10", "2022-11-20", "d"))
    r = w2.lesson_summary(**args).first()
    assert (r.Last_literacy_lesson, r.Literacy_Lessons_Attempted_Current, r.Lessons_Passed_Current) == (6, 2, 2)
    assert r.Overall_Accuracy == 0.75
    d = w2.lesson_summary(**args, dedupe_roster=True).first()
    assert (d.Last_literacy_lesson, d.Literacy_Lessons_Attempted_Current) == (3, 1)


def test_window_bounds_do_not_depend_on_the_session_time_zone(spark):
    from tessera.plans.catalog import QUERIES
    from tests.conftest import SF_SMALL
    before = rows(QUERIES["param_window"](spark, SF_SMALL))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert rows(QUERIES["param_window"](spark, SF_SMALL)) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
