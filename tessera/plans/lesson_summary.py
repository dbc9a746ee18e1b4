"""Per-student lesson summary for one district.

Stages: roster; activity scores (ratio of conditional sums per student,
lesson and activity); lessons with mean accuracy and a newest-first rank per
student and subject; one pass of conditional sums per student.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed as fx
from tessera.functions.dates import in_window
from tessera.functions.mapping import LESSON_STRANDS, lesson_number, subject_of
from tessera.operators.aggs import activity_score, count_if, mean_exact
from tessera.operators.joins import join_ci, may_hold
from tessera.operators.windows import desc, row_number_split
from tessera.plans.activity_scores import completed_lessons
from tessera.plans.rosters import ROSTER_BITS, guid_roster, with_multiplicity
from tessera.sources.params import Params
from tessera.sources.sinks import materialize

# Scores are kept to twelve decimal places.
SCORE_TYPE = "decimal(18,12)"

GROUP = ["Student_GUID", "SqlStudentDocumentId", "Lesson", "SatisfiedReason", "LessonState",
         "OrderID", "DateTime", "StrandID"]


def activity_ratios(scores: DataFrame, p: Params, product: str = fx.W2_PRODUCT) -> DataFrame:
    """``tbl_scores``: per (document, lesson, activity) the share of correct
    answers, an item worth nothing scoring its mastery out of 1 (A11). The
    window ends at midnight of ``end + 1 day`` (F3, X11)."""
    s = scores.where(in_window("DateTime", p.start, p.end, end_plus_days=1)
                     & (F.col("Product") == product))
    return (s.groupBy("SqlStudentDocumentId", "Lesson", "Activity")
            .agg(activity_score("NumPossible", "NumCorrect", "Mastered").alias("Activity_Score")))


def lesson_rows(roster: DataFrame, history: DataFrame, seq_nodes: DataFrame,
                lesson_nodes: DataFrame, strands: DataFrame, scores: DataFrame,
                p: Params) -> DataFrame:
    """``tbl_lessons`` without its rank: lessons of the listed strands with
    their mean activity score (LEFT join: lessons without scores keep a NULL
    accuracy)."""
    carried = [c for c in ("m",) if c in roster.columns]
    studs = roster.select("Student_GUID", "SqlStudentDocumentId", *carried)
    known = lambda table: table.where(  # noqa: E731 - rows of other districts stay out of the shuffles
        may_hold(roster, "SqlStudentDocumentId", "SqlStudentDocumentId", ROSTER_BITS))
    ldata = known(completed_lessons(history, p, end_plus_days=1))
    nodes = lesson_nodes.where(F.col("StrandID").isin(*LESSON_STRANDS))
    cat = seq_nodes.join(nodes, "NodeID").join(strands.select("StrandID"), "StrandID")
    # decimals: sums do not depend on row order, and exactly 70 % passes
    exact = F.col("Activity_Score").cast(SCORE_TYPE)
    sc = activity_ratios(known(scores), p).groupBy("SqlStudentDocumentId", "Lesson").agg(
        mean_exact(exact).alias("Lesson_Accuracy"),
        (F.sum(exact) >= F.lit(fx.W2_PASS_THRESHOLD).cast("decimal(3,2)") * F.count(exact)).alias("Lesson_Passed"))
    j = join_ci(studs.join(ldata, "SqlStudentDocumentId"), cat, "Lesson", "NodeGUID")
    # the mean is folded per (document, lesson) before the join; the grouping after it
    # only removes repeated rows
    g = (j.join(sc, ["SqlStudentDocumentId", "Lesson"], "left")
         .select(*GROUP, *carried, "Lesson_Accuracy", "Lesson_Passed").distinct())
    return g.select(
        "Student_GUID", "SqlStudentDocumentId", "Lesson", "SatisfiedReason", "LessonState",
        lesson_number("StrandID", "OrderID").cast("bigint").alias("Lesson_Number"),
        F.col("DateTime").alias("Lesson_Date"),
        subject_of("StrandID").alias("Lesson_Type"),
        "Lesson_Accuracy", "Lesson_Passed", "OrderID", "StrandID", *carried)


# Rank order inside (student, subject): newest first; ties broken by the
# grouping columns, all descending, so the rank-1 row is also the maximum of
# ``rank_key()`` and an aggregate can find it without a window.
RANK_COLS = ["Lesson_Date", "SqlStudentDocumentId", "Lesson", "SatisfiedReason", "LessonState",
             "OrderID", "StrandID"]


def rank_key():
    return F.struct(*[F.col(c) for c in RANK_COLS])


def lessons(roster: DataFrame, history: DataFrame, seq_nodes: DataFrame, lesson_nodes: DataFrame,
            strands: DataFrame, scores: DataFrame, p: Params) -> DataFrame:
    """``tbl_lessons`` with ``Order_Num``: newest-first rank per student and
    subject, computed over the grouped rows (N4, N5)."""
    rows = lesson_rows(roster, history, seq_nodes, lesson_nodes, strands, scores, p)
    order = [desc(c) for c in RANK_COLS]
    ranked = row_number_split(rows, ["Student_GUID", "Lesson_Type"], order, "Order_Num")
    return ranked.select(
        "Student_GUID", "SqlStudentDocumentId", "Lesson", "SatisfiedReason", "LessonState",
        "Lesson_Number", "Lesson_Date", "Order_Num", "Lesson_Type", "Lesson_Accuracy", "Lesson_Passed")


def student_summary(rows: DataFrame, dedupe_roster: bool = False) -> DataFrame:
    """One pass of conditional sums per student.

    The source re-joins the lessons to the roster before summing, so a
    student listed m times counts m times in every sum (means are
    unaffected). Here the lessons are aggregated per student first (partial
    aggregation, so a student with a huge history is folded inside each task)
    and the sums are scaled by the roster multiplicity ``m`` the rows carry
    (``with_multiplicity``), so the roster is read once. The
    latest literacy lesson is the ``max_by`` of the rank key rather than the
    ``Order_Num = 1`` row of a window, which would hold a student's whole
    history in one task. ``Overall_Accuracy`` is the mean of the
    lessons' means, summed as decimals. ``dedupe_roster=True``
    counts each student once however many times the roster lists them.
    """
    t = F.col("Lesson_Type")
    achieved = F.col("SatisfiedReason") == fx.W2_ACHIEVED
    literacy = t == fx.SUBJECT_LITERACY
    per_student = rows.groupBy("Student_GUID").agg(
        F.max_by("Lesson_Number", F.when(literacy, rank_key())).alias("last_lit"),
        mean_exact(F.col("Lesson_Accuracy").cast(SCORE_TYPE)).alias("acc"),
        count_if(F.col("Lesson_Passed")).alias("passed"),
        count_if(achieved & literacy).alias("lit_passed"),
        count_if(achieved & (t == fx.SUBJECT_LANGUAGE)).alias("lang_passed"),
        count_if(achieved & (t == fx.SUBJECT_GRAMMAR)).alias("gram_passed"),
        count_if(literacy).alias("lit_tried"),
        count_if(t == fx.SUBJECT_LANGUAGE).alias("lang_tried"),
        count_if(t == fx.SUBJECT_GRAMMAR).alias("gram_tried"),
        F.max("m").alias("m"),
    )
    j = per_student
    times = F.lit(1) if dedupe_roster else F.col("m")
    return j.select(
        "Student_GUID",
        (F.coalesce(F.col("last_lit"), F.lit(0)) * times).cast("bigint").alias("Last_literacy_lesson"),
        F.col("acc").alias("Overall_Accuracy"),
        (F.col("passed") * times).alias("Lessons_Passed_Current"),
        (F.col("lit_passed") * times).alias("Literacy_Lessons_Passed_Current"),
        (F.col("lang_passed") * times).alias("Language_Lessons_Passed_Current"),
        (F.col("gram_passed") * times).alias("Grammar_Lessons_Passed_Current"),
        (F.col("lit_tried") * times).alias("Literacy_Lessons_Attempted_Current"),
        (F.col("lang_tried") * times).alias("Language_Lessons_Attempted_Current"),
        (F.col("gram_tried") * times).alias("Grammar_Lessons_Attempted_Current"),
    )


def lesson_summary(org: DataFrame, student_orgs: DataFrame, students: DataFrame,
                   documents: DataFrame, history: DataFrame, seq_nodes: DataFrame,
                   lesson_nodes: DataFrame, strands: DataFrame, scores: DataFrame,
                   p: Params, dedupe_roster: bool = False) -> DataFrame:
    # written once: the lessons join it, and its Bloom filter meets both fact scans
    roster = materialize(with_multiplicity(guid_roster(org, student_orgs, students, documents, p.district,
                                                       lower_match=True)), "roster")
    rows = lesson_rows(roster, history, seq_nodes, lesson_nodes, strands, scores, p)
    return student_summary(rows, dedupe_roster=dedupe_roster)
