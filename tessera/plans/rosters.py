"""Student rosters over an organisation hierarchy.

The hierarchy is an adjacency list of fixed depth, so the levels are plain
self-joins (no recursion). After the district filter the organisation side
is the schools of one district; how it is joined is left to the optimiser, and the
per-student tables are joined with shuffles on their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import fixed as fx
from tessera.functions.mapping import grade_to_int
from tessera.operators.joins import join_ci

# Bits of the Bloom filter of a district's documents (512 KB): 350,000 documents
# pass 1 % of other rows.
ROSTER_BITS = 1 << 22


def district_schools(org: DataFrame, district: str, lower_match: bool = False) -> DataFrame:
    """Schools (type 1) directly under a district (type 0) that itself hangs under a
    type-2 node. ``lower_match`` lowers the district's id before it is compared with
    the parameter."""
    dist_id = F.lower(F.col("_id")) if lower_match else F.col("_id")
    dist = org.where((F.col("OrgType") == fx.ORG_TYPE_DISTRICT) & (dist_id == district)).select(
        F.col("_id").alias("dist_id"), F.col("ParentID").alias("dist_parent"))
    top = org.where(F.col("OrgType") == fx.ORG_TYPE_TOP).select(F.col("_id").alias("top_id"))
    sch = org.where(F.col("OrgType") == fx.ORG_TYPE_SCHOOL).select(F.col("_id").alias("school_id"),
                                                  F.col("ParentID").alias("school_parent"))
    levels = (dist.join(top, F.col("top_id") == F.col("dist_parent"))
              .join(sch, F.col("school_parent") == F.col("dist_id")))
    return levels.select("dist_id", "school_id")


def guid_roster(org: DataFrame, student_orgs: DataFrame, students: DataFrame,
                documents: DataFrame, district: str, lower_match: bool = False) -> DataFrame:
    """The distinct (district, school, student, document) rows, ids in lower case: the
    hierarchy, two case-insensitive membership joins and the document join (W1, W2)."""
    schools = district_schools(org, district, lower_match)
    members = join_ci(schools, student_orgs, "school_id", "OrganizationID")
    with_students = join_ci(members, students, "StudentID", "_id")
    docs = documents.select(F.col("_id").alias("doc_student_id"), "SqlStudentDocumentId")
    j = with_students.join(docs, F.col("_id") == F.col("doc_student_id"))
    return (j.select(F.lower("dist_id").alias("District_GUID"),
                     F.lower("school_id").alias("School_GUID"),
                     F.lower("_id").alias("Student_GUID"),
                     "SqlStudentDocumentId")
            .distinct())


def named_roster(organizations: DataFrame, student_orgs: DataFrame, info: DataFrame,
                 district: str) -> DataFrame:
    """Roster with names and attributes for one district's schools (W3). No
    DISTINCT, as in the source: a student in two schools is listed twice."""
    dist = organizations.where(F.col("organizationID") == district).select(
        F.col("organizationID").alias("district_guid"), F.col("name").alias("district_name"))
    sch = organizations.where(F.col("orgtype") == fx.W3_SCHOOL).select(
        F.col("organizationID").alias("school_guid"), F.col("name").alias("school_name"),
        F.col("parent").alias("school_parent"))
    schools = dist.join(sch, F.col("school_parent") == F.col("district_guid"))
    stud = student_orgs.select(F.col("studentid").alias("student_id"),
                               F.col("organizationID").alias("member_of"))
    j = (schools.join(stud, F.col("member_of") == F.col("school_guid"))
         .join(info, F.col("id") == F.col("student_id")))
    return j.select(
        "district_name", "district_guid", "school_name", "school_guid",
        grade_to_int("grade_level").cast("bigint").alias("grade"),
        "student_id",
        F.col("first_name").alias("student_firstname"),
        F.col("last_name").alias("student_lastname"),
        F.col("first_language").alias("student_language"),
        F.col("student_number").alias("student_number"),
        F.col("sync_id").alias("alternate_student_number"),
        F.col("tag").alias("student_tag"),
    )


def with_multiplicity(roster: DataFrame, key: str = "Student_GUID") -> DataFrame:
    """The roster with ``m``, the number of roster rows of each student: the
    factor by which re-joining a result to the roster multiplies that
    student's rows (J16). A window per student, bounded by the schools one
    student belongs to."""
    return roster.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy(key)))
