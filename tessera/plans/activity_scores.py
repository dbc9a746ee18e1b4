"""Raw activity-score rows per student and lesson for one district.

Stages: roster; score rows in the window (one product, no assessments, no
skipped activities, main branch); lesson history joined to the lesson
catalogue (one strand, no review lessons) and to the scores on (document,
lesson), ranked newest first per document; re-joined to the roster and
sorted. The source's comment promises sums and averages but the query
returns raw rows; the code is followed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed as fx
from tessera.functions.dates import in_window
from tessera.functions.text import like_ci, not_like_ci
from tessera.operators.joins import join_ci, may_hold
from tessera.operators.windows import asc, desc, row_number_split
from tessera.plans.rosters import ROSTER_BITS, guid_roster, with_multiplicity
from tessera.sources.params import Params
from tessera.sources.sinks import materialize

OUTPUT = ["Student_GUID", "SqlStudentDocumentId", "Lesson", "SatisfiedReason", "LessonState",
          "Lesson_Number", "DateTime", "Order_Num", "Name", "Skill", "NumPossible",
          "NumCorrect", "Mastered", "sc_date", "Activity"]


def spanish_scores(scores: DataFrame, p: Params, product: str = fx.W1_PRODUCT) -> DataFrame:
    """``tbl_scores``: window closed at midnight of the end day (F2), equality
    filters (F1), ``NOT LIKE '%assessment%'`` (F8), ``IS NULL`` (F10)."""
    return scores.where(
        in_window("DateTime", p.start, p.end)
        & (F.col("Product") == product)
        & not_like_ci("Skill", fx.W1_SKILL_EXCLUDED)
        & F.col("ActivitySkippedType").isNull()
        & (F.col("LessonBranch") == fx.W1_BRANCH))


def completed_lessons(history: DataFrame, p: Params, end_plus_days: int = 0) -> DataFrame:
    """History rows in the window that were not skipped (F8, F9): NULL reasons
    fail ``NOT LIKE`` and drop out."""
    return history.where(
        in_window("DateTime", p.start, p.end, end_plus_days)
        & not_like_ci("LessonState", fx.STATE_EXCLUDED)
        & not_like_ci("SatisfiedReason", fx.REASON_EXCLUDED)
        & not_like_ci("SatisfiedReason", fx.REASON_ALTERNATE))


def spanish_catalogue(seq_nodes: DataFrame, lesson_nodes: DataFrame, strands: DataFrame,
                      strand_id: int = fx.W1_STRAND) -> DataFrame:
    """Lesson GUIDs of one strand whose enum mentions Spanish, reviews left
    out. Built first (it is a dimension) so the history joins a small side."""
    nodes = lesson_nodes.where((F.col("StrandID") == strand_id) & not_like_ci("Name", fx.W1_NAME_EXCLUDED))
    st = strands.where((F.col("StrandID") == strand_id) & like_ci("Enum", fx.W1_STRAND_ENUM)).select("StrandID")
    return seq_nodes.join(nodes, "NodeID").join(st, "StrandID")


def lessons(roster: DataFrame, history: DataFrame, seq_nodes: DataFrame, lesson_nodes: DataFrame,
            strands: DataFrame, scores: DataFrame, p: Params) -> DataFrame:
    """``tbl_lessons``: roster x history x catalogue x scores on (document,
    lesson) (J1, J4, J5), ranked newest first per document (N1) with the split row number. Every score
    row of a lesson shares the lesson's time, so the rank's tie-break runs
    over all output columns."""
    carried = [c for c in ("m",) if c in roster.columns]
    studs = roster.select("Student_GUID", "SqlStudentDocumentId", *carried)
    known = lambda table: table.where(  # noqa: E731 - rows of other districts stay out of the shuffles
        may_hold(roster, "SqlStudentDocumentId", "SqlStudentDocumentId", ROSTER_BITS))
    ldata = known(completed_lessons(history, p))
    cat = spanish_catalogue(seq_nodes, lesson_nodes, strands)
    sc = known(spanish_scores(scores, p)).select(
        "SqlStudentDocumentId", "Lesson", "Skill", "NumPossible", "NumCorrect", "Mastered",
        F.col("DateTime").alias("sc_date"), "Activity")
    j = join_ci(studs.join(ldata, "SqlStudentDocumentId"), cat, "Lesson", "NodeGUID")
    j = j.join(sc, ["SqlStudentDocumentId", "Lesson"])
    tie = ["Lesson", "Name", "sc_date", "Activity", "Skill", "NumPossible", "NumCorrect",
           "Mastered", "SatisfiedReason", "LessonState", "OrderID", "Student_GUID"]
    order = [desc("DateTime"), *[asc(c) for c in tie]]
    # A student's rows are numbered without gathering them into one task.
    ranked = row_number_split(j, ["SqlStudentDocumentId"], order, "Order_Num")
    return ranked.select(
        "Student_GUID", "SqlStudentDocumentId", "Lesson", "SatisfiedReason", "LessonState",
        F.col("OrderID").cast("bigint").alias("Lesson_Number"), "DateTime", "Order_Num",
        "Name", "Skill",
        F.col("NumPossible").cast("bigint").alias("NumPossible"),
        F.col("NumCorrect").cast("bigint").alias("NumCorrect"),
        F.col("Mastered").cast("bigint").alias("Mastered"),
        "sc_date", "Activity", *carried)


def activity_scores(org: DataFrame, student_orgs: DataFrame, students: DataFrame,
                    documents: DataFrame, history: DataFrame, seq_nodes: DataFrame,
                    lesson_nodes: DataFrame, strands: DataFrame, scores: DataFrame,
                    p: Params, dedupe_roster: bool = False, sort: bool = True) -> DataFrame:
    """``SELECT b.* FROM roster a JOIN lessons b ON Student_GUID ORDER BY Name,
    NumCorrect``. The roster is joined in the lessons step and again here, so a
    student listed under n schools appears n x n times (J16), as in the
    source; ``dedupe_roster=True`` joins distinct students the second time."""
    # The re-join only repeats each lesson row once per roster row of its
    # student, so the roster is read once: its multiplicity m rides along with
    # the rows and each row is emitted m times (m is bounded by the schools a
    # student belongs to).
    # It is written once: the lessons join it, and its Bloom filter meets both fact scans.
    roster = materialize(with_multiplicity(guid_roster(org, student_orgs, students, documents, p.district)),
                         "roster")
    b = lessons(roster, history, seq_nodes, lesson_nodes, strands, scores, p)
    copies = F.lit(1) if dedupe_roster else F.col("m")
    out = (b.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
           .select(*OUTPUT))
    # ORDER BY Name, NumCorrect; the remaining columns only break ties, so rows
    # sharing a name are spread over range partitions instead of one.
    tie = ["SqlStudentDocumentId", "DateTime", "Lesson", "Activity", "sc_date", "Order_Num"]
    return out.orderBy(asc("Name"), asc("NumCorrect"), *[asc(c) for c in tie]) if sort else out
