"""Stand-in adapters: the driver tables reshaped into the source workloads'
tables (SURVEY section 7.3).

Every adapter is a narrow projection (plus, where a fact needs a parent's
attribute, one equi-join), so it adds no shuffle of its own beyond that join
and keeps column pruning and filter pushdown intact: a filter on a derived
column that is a plain rename (dates, keys) still reaches the parquet scan.
The oracle SQL in ``duck_oracle/`` builds the same tables independently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import ntz
from tessera.functions.mapping import GRADE_LABELS
from tessera.sources.tables import Tables


def tag(prefix: str, col: str | Column) -> Column:
    """String id ``prefix || value``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), c.cast("string"))


def label_of(index: Column) -> Column:
    """Grade label for ``index`` in 0..15; 15 is a label no mapping knows."""
    labels = [*GRADE_LABELS, "Unknown"]
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


# ---------------------------------------------------------------- learning
def org_tree(t: Tables) -> DataFrame:
    """Three-level adjacency list ``_id, ParentID, OrgType``: one root (type 2),
    regions as districts (type 0), nations as schools (type 1). Ids are upper
    case so that the ``LOWER`` calls matter."""
    root = (t.region.select(F.lit("W").alias("_id"),
                            F.lit(None).cast("string").alias("ParentID"),
                            F.lit(2).alias("OrgType"))
            .dropDuplicates())
    districts = t.region.select(tag("R", "r_regionkey").alias("_id"),
                                F.lit("W").alias("ParentID"), F.lit(0).alias("OrgType"))
    schools = t.nation.select(tag("N", "n_nationkey").alias("_id"),
                              tag("R", "n_regionkey").alias("ParentID"),
                              F.lit(1).alias("OrgType"))
    return root.unionByName(districts).unionByName(schools)


def student_organizations(t: Tables) -> DataFrame:
    return t.customer.select(tag("s", "c_custkey").alias("StudentID"),
                             tag("n", "c_nationkey").alias("OrganizationID"))


def students(t: Tables) -> DataFrame:
    return t.customer.select(tag("S", "c_custkey").alias("_id"))


def student_documents(t: Tables) -> DataFrame:
    return t.customer.select(tag("S", "c_custkey").alias("_id"),
                             F.col("c_custkey").alias("SqlStudentDocumentId"))


def lesson_key(order_key: str) -> Column:
    return tag("g", F.floor(F.col(order_key) / 8))


def lesson_history(t: Tables) -> DataFrame:
    """Lesson state history: one row per order."""
    pri = F.col("o_orderpriority")
    return t.orders.select(
        F.col("o_custkey").alias("SqlStudentDocumentId"),
        lesson_key("o_orderkey").alias("Lesson"),
        F.when(pri == "1-URGENT", "StudentAchievement")
         .when(pri == "2-HIGH", "TeacherSkip")
         .when(pri == "5-LOW", "SatisfiedByAlternateLesson")
         .when(pri == "3-MEDIUM", F.lit(None))
         .otherwise("Other").alias("SatisfiedReason"),
        F.when(F.col("o_orderstatus") == "P", "Skipped").otherwise("Done").alias("LessonState"),
        F.col("o_orderdate").alias("DateTime"),
    )


def strand_of(size: Column) -> Column:
    m = size % 7
    return (F.when(m == 0, 4).when(m == 1, 8).when(m == 2, 13).when(m == 3, 7)
            .when(m == 4, 14).otherwise(26))


def sequence_nodes(t: Tables) -> DataFrame:
    return t.part.select(tag("G", "p_partkey").alias("NodeGUID"),
                         F.col("p_partkey").alias("NodeID"))


def lesson_nodes(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("NodeID"),
        F.col("p_size").alias("OrderID"),
        strand_of(F.col("p_size")).alias("StrandID"),
        F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("Review "), F.col("p_name")))
         .otherwise(F.col("p_name")).alias("Name"),
    )


def strands(t: Tables) -> DataFrame:
    """Strand dimension: the distinct strand ids of the lesson nodes."""
    sid = F.col("StrandID")
    return (lesson_nodes(t).select("StrandID").distinct()
            .withColumn("Enum", F.when(sid == 26, "Spanish").when(sid == 4, "Reading")
                        .when(sid == 8, "Phonics").when(sid == 13, "Vocabulary")
                        .when(sid == 7, "Oral Language").otherwise("Grammar")))


def scores(t: Tables) -> DataFrame:
    """Activity scores: one row per order line; student, lesson and time come
    from the parent order (one equi-join on the order key)."""
    li = t.lineitem
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    qty = F.col("l_quantity")
    return j.select(
        F.col("o_custkey").alias("SqlStudentDocumentId"),
        lesson_key("l_orderkey").alias("Lesson"),
        tag("A", "l_linenumber").alias("Activity"),
        F.when(F.col("l_linenumber") == 7, "Assessment").otherwise("Skill").alias("Skill"),
        F.when(F.col("l_linestatus") == "O", "Spanish").otherwise("ILE").alias("Product"),
        F.when(F.col("l_tax") == 0.08, "Alt").otherwise("Main").alias("LessonBranch"),
        F.when(F.col("l_discount") == 0.1, "Skipped").alias("ActivitySkippedType"),
        F.when(F.col("l_linenumber") == 1, 0).otherwise(qty.cast("int")).alias("NumPossible"),
        F.floor(qty * (1 - F.col("l_discount"))).cast("int").alias("NumCorrect"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("Mastered"),
        F.col("o_orderdate").alias("DateTime"),
    )


def organizations(t: Tables) -> DataFrame:
    """Second organisation form: ``organizationID, parent, name, orgtype``."""
    d = t.region.select(tag("R", "r_regionkey").alias("organizationID"),
                        F.lit("W").alias("parent"), F.col("r_name").alias("name"),
                        F.lit("District").alias("orgtype"))
    s = t.nation.select(tag("N", "n_nationkey").alias("organizationID"),
                        tag("R", "n_regionkey").alias("parent"), F.col("n_name").alias("name"),
                        F.lit("School").alias("orgtype"))
    return d.unionByName(s)


def student_organizations2(t: Tables) -> DataFrame:
    return t.customer.select(tag("S", "c_custkey").alias("studentid"),
                             tag("N", "c_nationkey").alias("organizationID"))


def student_info(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        tag("S", "c_custkey").alias("id"),
        label_of(F.col("c_custkey") % 16).alias("grade_level"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(F.col("c_nationkey") % 3 == 0, "Spanish").otherwise("English").alias("first_language"),
        F.col("c_custkey").cast("string").alias("student_number"),
        tag("Y", "c_custkey").alias("sync_id"),
        F.col("c_mktsegment").alias("tag"),
    )


def daily_usage(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        tag("S", "user_id").alias("student_id"),
        F.to_date("ts").alias("usage_date"),
        F.floor(F.col("value") * 10).cast("bigint").alias("session_seconds"),
        F.when(F.col("event_type") == "error", "OTHER").otherwise("ILE").alias("product_tag"),
    )


def progress_by_lesson(t: Tables) -> DataFrame:
    o = t.orders
    pri = F.col("o_orderpriority")
    return o.select(
        tag("S", "o_custkey").alias("student_id"),
        F.when(pri.isin("1-URGENT", "4-NOT SPECIFIED"), "Reading")
         .when(pri == "2-HIGH", "Vocabulary").when(pri == "3-MEDIUM", "Grammar")
         .otherwise("Writing").alias("progress_area"),
        label_of(F.col("o_orderkey") % 16).alias("lesson_grade_level"),
        tag("Lesson ", "o_orderkey").alias("lesson_name"),
        (F.col("o_orderkey") % 120).cast("int").alias("lesson_order"),
        (F.col("o_orderstatus") != "O").alias("completed"),
        (F.col("o_orderstatus") == "F").alias("passed"),
        (F.col("o_orderstatus") == "P").alias("skipped"),
        F.col("o_orderdate").alias("date_updated"),
    )


# ---------------------------------------------------------------- marketing
def _affiliate_events(t: Tables, event_type: str, time_col: str) -> DataFrame:
    e = t.events.where(F.col("event_type") == event_type)
    k = F.get_json_object("props", "$.k")
    eid = F.col("event_id")
    sub4 = (F.when(eid % 3 == 0, F.concat(F.lit("x_cmp-"), k, F.lit("_y")))
            .when(eid % 3 == 1, F.concat(k, F.lit("__a"))))
    sub3 = (F.when(F.floor(eid / 3) % 3 == 0, F.concat(F.lit("cmp-"), k))
            .when(F.floor(eid / 3) % 3 == 1, F.concat(k, F.lit("_b")))
            .otherwise(F.lit("zz")))
    return e.select(
        F.col("ts").alias(time_col),
        F.floor(eid / 95).alias("advertiser_id"),
        F.floor(eid / 4).alias("offer_id"),
        F.col("user_id").alias("affiliate_id"),
        sub3.alias("affiliate_sub3"),
        sub4.alias("affiliate_sub4"),
        F.when(F.col("value") < 100, "search").otherwise("social").alias("affiliate_source"),
        tag("tx", F.floor(eid / 2)).alias("transaction_id"),
        F.when(eid % 10 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.round(F.col("value") * 100).cast("bigint")).alias("revenue_cents"),
        F.floor(F.col("value") * 25).cast("bigint").alias("payout_cents"),
        F.when(eid % 4 == 0, "pending").otherwise("approved").alias("status"),
    )


def conversions(t: Tables) -> DataFrame:
    return _affiliate_events(t, "purchase", "conversion_time")


def clicks(t: Tables) -> DataFrame:
    return _affiliate_events(t, "click", "click_time").drop("status")


def advertisers(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("company"))


def offers(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def affiliates(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("company"))


def campaign_history(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_size").cast("string").alias("campaign_id"),
        F.col("p_name").alias("campaign_name"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("p_partkey").cast("int")).alias("created_date"),
    )


# ---------------------------------------------------------------- budget
def _shipped_until(t: Tables, as_of: dt.date) -> DataFrame:
    """Lines shipped up to ``as_of``: the fact table as it stood that day.
    The cut is a range on the raw column, so it reaches the parquet scan."""
    return t.lineitem.where(F.col("l_shipdate") <= ntz(as_of))


def calendar_source(t: Tables, as_of: dt.date) -> DataFrame:
    return _shipped_until(t, as_of).select(F.to_date("l_shipdate").alias("date"))


def brand_lines(t: Tables, as_of: dt.date) -> DataFrame:
    li = _shipped_until(t, as_of)
    part = t.part.select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey)


def revenue_facts(t: Tables, as_of: dt.date) -> DataFrame:
    """``date, Brand, revenue, revenue_type``; revenue is exact decimal money."""
    rf = F.col("l_returnflag")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return brand_lines(t, as_of).select(
        F.to_date("l_shipdate").alias("date"),
        F.col("p_brand").alias("Brand"),
        (price * (F.lit(1) - disc)).cast("decimal(18,4)").alias("revenue"),
        F.when(rf == "R", "Addition").when(rf == "N", "Recurring").alias("revenue_type"),
    )


def click_facts(t: Tables, as_of: dt.date) -> DataFrame:
    return brand_lines(t, as_of).select(F.to_date("l_shipdate").alias("date"),
                                        F.col("p_brand").alias("Brand"))


def budgets(t: Tables) -> DataFrame:
    """``year, period, brand_domain, budget, current_reforecast`` per brand and
    month, summed from part prices; one brand has no budget at all."""
    p = t.part.where(F.col("p_brand") != "Brand#7")
    return (p.groupBy((F.lit(1997) + F.col("p_partkey") % 2).cast("int").alias("year"),
                      (F.col("p_size") % 12 + 1).cast("int").alias("period"),
                      F.col("p_brand").alias("brand_domain"))
            .agg(F.sum(F.col("p_retailprice").cast("decimal(12,2)")).alias("budget"))
            .withColumn("current_reforecast", F.col("budget") * F.lit(1.1).cast("decimal(2,1)")))


# ---------------------------------------------------------------- shop
def shop_tables(t: Tables) -> dict[str, DataFrame]:
    """The four shop tables over customer / orders / lineitem / part."""
    return {
        "customers": t.customer.select(F.col("c_custkey").alias("customer_id"),
                                       F.col("c_name").alias("name"),
                                       F.col("c_mktsegment").alias("state")),
        "customer_orders": t.orders.select(F.col("o_orderkey").alias("order_id"),
                                           F.col("o_custkey").alias("customer_id"),
                                           F.to_date("o_orderdate").alias("order_date")),
        "customer_order_products": t.lineitem.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity")),
        "products": t.part.select(F.col("p_partkey").alias("product_id"),
                                  F.col("p_type").alias("product_type"),
                                  F.col("p_retailprice").cast("decimal(12,2)").alias("price")),
    }


# Shop parameters on the stand-ins: "east coast" states and the "Book" type.
SHOP_EAST_STATES = ("MACHINERY", "FURNITURE")
SHOP_BOOK_TYPE = "ECONOMY"


# ---------------------------------------------------------------- records
def auth_tokens(t: Tables) -> DataFrame:
    """``authToken, userName``: one token per event."""
    return t.events.select(tag("t", "event_id").alias("authToken"),
                           tag("u", "user_id").alias("userName"))


def token_requests(t: Tables) -> DataFrame:
    """Probe rows derived from the tokens: a quarter exact, a quarter with a
    user that does not exist, a quarter with an unknown token and a quarter differing only
    in case (the lookups are case-sensitive)."""
    eid = F.col("event_id")
    r = eid % 4
    token = (F.when(r == 2, tag("x", eid)).when(r == 3, tag("T", eid)).otherwise(tag("t", eid)))
    user = F.when(r == 1, tag("w", "user_id")).otherwise(tag("u", "user_id"))
    return t.events.select(eid.alias("request_id"), token.alias("authToken"), user.alias("userName"))


def users(t: Tables) -> DataFrame:
    """``userName, userPersonID`` (the user table the foreign keys point at)."""
    return t.customer.select(tag("u", "c_custkey").alias("userName"),
                             tag("p", "c_custkey").alias("userPersonID"))


def persons(t: Tables) -> DataFrame:
    """Family records: parents point at lower ids, spouses sometimes past the
    last id (orphans for the foreign-key report)."""
    k = F.col("c_custkey")
    return t.customer.select(
        tag("p", k).alias("id"),
        tag("u", F.floor(k / 10)).alias("descendant"),
        F.col("c_name").alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.when(k % 2 == 0, "f").otherwise("m").alias("gender"),
        F.when(k >= 2, tag("p", F.floor(k / 2))).alias("fatherID"),
        F.when(k >= 3, tag("p", F.floor(k / 3))).alias("motherID"),
        F.when(k % 5 != 0, tag("p", k + 7)).alias("spouseID"),
    )


def delete_users(t: Tables) -> DataFrame:
    """Users whose rows are to be removed: the customers of one segment."""
    return (t.customer.where(F.col("c_mktsegment") == "AUTOMOBILE")
            .select(tag("u", "c_custkey").alias("userName")))


def person_requests(t: Tables) -> DataFrame:
    """``(request_id, id, descendant)`` probes: a third exact, a third with
    another descendant, a third with an unknown id."""
    k = F.col("c_custkey")
    r = k % 3
    return t.customer.select(
        k.alias("request_id"),
        F.when(r == 2, tag("z", k)).otherwise(tag("p", k)).alias("id"),
        F.when(r == 1, tag("u", F.floor(k / 10) + 1)).otherwise(tag("u", F.floor(k / 10))).alias("descendant"))


def user_requests(t: Tables) -> DataFrame:
    """User names to resolve, one per order; some name no user."""
    return t.orders.select(F.col("o_orderkey").alias("request_id"),
                           tag("u", F.floor(F.col("o_orderkey") / 8)).alias("userName"))


def person_id_requests(t: Tables) -> DataFrame:
    """Person ids to read, one per order; some are unknown."""
    return t.orders.select(F.col("o_orderkey").alias("request_id"),
                           tag("p", F.floor(F.col("o_orderkey") / 8)).alias("id"))


def family_requests(t: Tables) -> DataFrame:
    """Users whose family records are requested: a quarter of the descendants."""
    return t.customer.select(tag("u", F.floor(F.col("c_custkey") / 40)).alias("userName")).distinct()


def new_persons(t: Tables) -> DataFrame:
    """A batch of persons to add (one segment's customers under new ids),
    some without father, mother or spouse."""
    k = F.col("c_custkey")
    return (t.customer.where(F.col("c_mktsegment") == "BUILDING").select(
        tag("q", k).alias("id"),
        tag("u", F.floor(k / 10)).alias("descendant"),
        F.col("c_name").alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.when(k % 2 == 0, "f").otherwise("m").alias("gender"),
        F.when(k % 2 == 0, tag("p", k)).alias("fatherID"),
        F.lit(None).cast("string").alias("motherID"),
        F.when(k % 3 == 0, tag("q", k + 1)).alias("spouseID")))
