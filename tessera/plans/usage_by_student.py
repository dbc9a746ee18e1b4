"""Usage and lesson progress per student for one district.

Stages: named roster; session usage per student (first and last day,
minutes); lessons in the window that were not skipped, ranked first and last
per student and area; one pass of conditional sums and first/last picks per
student; roster JOIN usage LEFT JOIN lesson summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed as fx
from tessera.functions.dates import between_dates, in_window
from tessera.functions.mapping import grade_to_int
from tessera.functions.numeric import per_unit
from tessera.operators.aggs import count_if, rate
from tessera.operators.windows import asc, first_last
from tessera.plans.rosters import named_roster
from tessera.sources.params import Params
from tessera.sources.sinks import materialize

ROSTER_COLS = ["district_name", "district_guid", "school_name", "school_guid", "grade",
               "student_id", "student_firstname", "student_lastname", "student_language",
               "student_number", "alternate_student_number", "student_tag"]
LESSON_COLS = ["lessons_worked", "lessons_passed", "pass_rate", "literacy_first", "literacy_last",
               "grade_level_first", "grade_level_latest", "Literacy_Lessons_Passed",
               "Language_Lessons_Passed", "Grammar_Lessons_Passed", "Literacy_Lessons_Attempted",
               "Language_Lessons_Attempted", "Grammar_Lessons_Attempted"]


def _listed(roster: DataFrame, dedupe_roster: bool) -> DataFrame:
    """(student_id, m): how often the roster lists each student, 1 if deduped."""
    times = F.max(F.lit(1)) if dedupe_roster else F.count(F.lit(1))
    return roster.groupBy("student_id").agg(times.alias("m"))


def usage(daily: DataFrame, roster: DataFrame, p: Params, product: str = fx.W3_PRODUCT_TAG,
          dedupe_roster: bool = False) -> DataFrame:
    """``tbl_usage``: first and last session day and total minutes.
    The source joins the roster before it sums, so a student listed twice is
    summed twice; ``dedupe_roster=True`` sums once. Here the days are folded
    per student first, in the map tasks, and the roster's count scales the sum:
    no task receives a student's raw rows."""
    d = daily.where(between_dates("usage_date", p.start, p.end) & (F.col("product_tag") == product))
    per_student = d.groupBy("student_id").agg(
        F.min("usage_date").alias("first_sessiondate"),
        F.max("usage_date").alias("last_sessiondate"),
        F.sum("session_seconds").alias("seconds"))
    return per_student.join(_listed(roster, dedupe_roster), "student_id").select(
        "student_id", "first_sessiondate", "last_sessiondate",
        per_unit(F.col("seconds") * F.col("m"), fx.SECONDS_PER_MINUTE).alias("total_session_minutes"))


def ranked_lessons(progress: DataFrame, roster: DataFrame, p: Params) -> DataFrame:
    """``tbl_lessons``: not-skipped lessons in the window (F12) with first and
    last rank per student and area (N2, N3) and the numeric grade (P10). The
    lesson name breaks ties on the update time."""
    pr = progress.where(in_window("date_updated", p.start, p.end) & ~F.col("skipped"))
    j = pr.join(roster.select("student_id"), "student_id")
    ranked = first_last(j, ["student_id", "progress_area"], "date_updated", ["lesson_name"])
    return ranked.select("student_id", "progress_area", "lesson_grade_level", "lesson_name",
                         "lesson_order", "completed", "passed", "date_updated",
                         "taken_order", "rev_taken_order",
                         grade_to_int("lesson_grade_level").alias("grade_numeric"))


def worked_lessons(progress: DataFrame, p: Params) -> DataFrame:
    """Not-skipped lessons in the window (F12) with the numeric grade (P10)."""
    pr = progress.where(in_window("date_updated", p.start, p.end) & ~F.col("skipped"))
    return pr.withColumn("grade_numeric", grade_to_int("lesson_grade_level"))


def lessons_per_student(lessons: DataFrame, roster: DataFrame, dedupe_roster: bool = False) -> DataFrame:
    """``tbl_lessons_stud``: first/last picks (ELSE NULL, A9), counts, pass
    rate (A12) and passed / attempted per area (A8) in one aggregate, for the
    roster's students. The aggregate runs before the roster join; a student
    whom the roster lists m times has every count m times, as when the rows
    were joined (``dedupe_roster=True``: once). Picks and rate do not change.

    The source numbers every lesson per (student, area) with two windows and
    keeps the rows ranked 1. Only those rows are read, so they are found with
    ``min_by`` / ``max_by`` on (update time, lesson name), the same order and
    tie-break as the windows: an aggregate folds each task's rows before the
    shuffle, where a window would sort a student's whole history in one
    task.
    """
    reading = F.col("progress_area") == fx.AREA_READING
    order = F.when(reading, F.struct("date_updated", "lesson_name"))
    passed = F.col("passed")

    def dcount(cond):
        return count_if(cond).cast("double")

    per_student = lessons.groupBy("student_id").agg(
        F.min_by("lesson_order", order).cast("bigint").alias("literacy_first"),
        F.max_by("lesson_order", order).cast("bigint").alias("literacy_last"),
        F.min_by("grade_numeric", order).cast("bigint").alias("grade_level_first"),
        F.max_by("grade_numeric", order).cast("bigint").alias("grade_level_latest"),
        F.count(F.lit(1)).alias("lessons_worked"),
        dcount(passed).alias("lessons_passed"),
        rate(passed).alias("pass_rate"),
        dcount(passed & reading).alias("Literacy_Lessons_Passed"),
        dcount(passed & (F.col("progress_area") == fx.AREA_VOCABULARY)).alias("Language_Lessons_Passed"),
        dcount(passed & (F.col("progress_area") == fx.AREA_GRAMMAR)).alias("Grammar_Lessons_Passed"),
        dcount(reading).alias("Literacy_Lessons_Attempted"),
        dcount(F.col("progress_area") == fx.AREA_VOCABULARY).alias("Language_Lessons_Attempted"),
        dcount(F.col("progress_area") == fx.AREA_GRAMMAR).alias("Grammar_Lessons_Attempted"),
    )
    counts = [c for c in per_student.columns if c.startswith("lessons_") or "_Lessons_" in c]
    return per_student.join(_listed(roster, dedupe_roster), "student_id").select(*[
        (F.col(c) * F.col("m")).alias(c) if c in counts else F.col(c) for c in per_student.columns])


def usage_by_student(organizations: DataFrame, student_orgs: DataFrame, info: DataFrame,
                     daily: DataFrame, progress: DataFrame, p: Params, sort: bool = True,
                     dedupe_roster: bool = False) -> DataFrame:
    """``roster JOIN usage LEFT JOIN lesson summary`` (J11): students without
    usage drop out, students without lessons stay with NULL lesson columns.
    The roster has no DISTINCT (as in the source), so a student listed under
    two schools is summed twice; ``dedupe_roster=True`` sums each student
    once (the output still lists each roster row)."""
    # The roster is read three times (usage, lessons, final join); written once.
    roster = materialize(named_roster(organizations, student_orgs, info, p.district), "roster")
    u = usage(daily, roster, p, dedupe_roster=dedupe_roster)
    ls = lessons_per_student(worked_lessons(progress, p), roster, dedupe_roster=dedupe_roster)
    out = (roster.join(u, "student_id").join(ls, "student_id", "left")
           .select(*ROSTER_COLS, "first_sessiondate", "last_sessiondate",
                   "total_session_minutes", *LESSON_COLS))
    if sort:
        # student_id only breaks ties (spreads a school's rows over partitions)
        out = out.orderBy(asc("district_name"), asc("school_name"), asc("grade"), asc("student_id"))
    return out
