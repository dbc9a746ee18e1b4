"""The split row number equals the plain window, hot keys and NULL keys included."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.windows import asc, desc, row_number_split


def test_split_row_number_matches_window_with_a_hot_key(spark):
    # key 0 holds half of all rows, a NULL key and many small keys
    df = (spark.range(0, 20000)
          .withColumn("k", F.when(F.col("id") % 2 == 0, F.lit(0))
                      .when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id") % 50))
          .withColumn("v", (F.col("id") * 7919) % 1000))
    order = [desc("v"), asc("id")]
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    got = row_number_split(df, ["k"], order, "rn", num_partitions=8)
    a = {(r.id, r.rn) for r in want.select("id", "rn").collect()}
    b = {(r.id, r.rn) for r in got.select("id", "rn").collect()}
    assert len(b) == 20000 and a == b


def test_split_row_number_degenerate_inputs(spark):
    empty = spark.createDataFrame([], "k int, v int")
    assert row_number_split(empty, ["k"], [asc("v")], "rn").count() == 0
    nulls = spark.createDataFrame([(None, i) for i in range(50)], "k int, v int")
    got = sorted(r.rn for r in row_number_split(nulls, ["k"], [desc("v")], "rn", num_partitions=4).collect())
    assert got == list(range(1, 51))
    one = spark.range(0, 1000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    got = {(r.v, r.rn) for r in row_number_split(one, ["k"], [asc("v")], "rn", num_partitions=8).collect()}
    assert got == {(v, v + 1) for v in range(1000)}


def test_activity_scores_numbers_a_hot_student_correctly(spark):
    """One student holds most rows; Order_Num must still be 1..n per document,
    newest first, exactly as a single ordered pass would number them."""
    import datetime as dt

    from tessera.plans import activity_scores as w1
    from tessera.sources.params import Params

    org = spark.createDataFrame([("W", None, 2), ("D", "W", 0), ("S1", "D", 1)],
                                "_id string, ParentID string, OrgType int")
    studs = [9, 10, 11]
    so = spark.createDataFrame([(f"s{k}", "s1") for k in studs], "StudentID string, OrganizationID string")
    st = spark.createDataFrame([(f"S{k}",) for k in studs], "_id string")
    docs = spark.createDataFrame([(f"S{k}", k) for k in studs], "_id string, SqlStudentDocumentId bigint")
    base = dt.datetime(2021, 10, 10)
    hist_rows, score_rows = [], []
    for k, n in ((9, 120), (10, 3), (11, 2)):           # student 9 is hot
        for i in range(n):
            ts = base + dt.timedelta(minutes=7 * i + k)
            hist_rows.append((k, f"g{i % 5}", "StudentAchievement", "Done", ts))
    for k in studs:
        for i in range(5):
            for a in range(3):
                score_rows.append((k, f"g{i}", f"A{a}", "Skill", "Spanish", "Main", None, 5, a, 1,
                                   base + dt.timedelta(days=1)))
    hist = spark.createDataFrame(hist_rows, "SqlStudentDocumentId bigint, Lesson string, SatisfiedReason string, "
                                            "LessonState string, DateTime timestamp_ntz")
    seq = spark.createDataFrame([(f"G{i}", i) for i in range(5)], "NodeGUID string, NodeID bigint")
    nodes = spark.createDataFrame([(i, i, 26, f"Lesson {i}") for i in range(5)],
                                  "NodeID bigint, OrderID int, StrandID int, Name string")
    strands = spark.createDataFrame([(26, "Spanish")], "StrandID int, Enum string")
    scores = spark.createDataFrame(score_rows,
                                   "SqlStudentDocumentId bigint, Lesson string, Activity string, Skill string, "
                                   "Product string, LessonBranch string, ActivitySkippedType string, "
                                   "NumPossible int, NumCorrect int, Mastered int, DateTime timestamp_ntz")
    out = w1.activity_scores(org=org, student_orgs=so, students=st, documents=docs, history=hist,
                             seq_nodes=seq, lesson_nodes=nodes, strands=strands, scores=scores,
                             p=Params("2021-10-10", "2021-10-20", "D"))
    got = {}
    for r in out.collect():
        got.setdefault(r.SqlStudentDocumentId, []).append((r.Order_Num, r.DateTime))
    assert sorted(got) == studs
    for k, pairs in got.items():
        pairs.sort()
        assert [n for n, _ in pairs] == list(range(1, len(pairs) + 1))
        times = [t for _, t in pairs]
        assert times == sorted(times, reverse=True)
    assert len(got[9]) == 120 * 3
