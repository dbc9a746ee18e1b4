"""The stand-in tables in DuckDB SQL (mirrors ``tessera.sources.stand_ins``)."""

from __future__ import annotations

from duck_oracle.ctes import cte


def tag(prefix: str, expr: str) -> str:
    return f"('{prefix}' || CAST({expr} AS VARCHAR))"


GRADE_LIST = ("['PreK', 'Kindergarten', 'First', 'Second', 'Third', 'Fourth', 'Fifth', "
              "'Sixth', 'Seventh', 'Eighth', 'Ninth', 'Tenth', 'Eleventh', 'Twelfth', "
              "'Other', 'Unknown']")


def grade_label(index_expr: str) -> str:
    return f"({GRADE_LIST})[({index_expr}) + 1]"


# ---------------------------------------------------------------- shop
cte("customers", """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS state FROM customer""")
cte("customer_orders", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date
FROM orders""")
cte("customer_order_products", """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem""")
cte("products", """
SELECT p_partkey AS product_id, p_type AS product_type,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM part""")

# ---------------------------------------------------------------- learning
cte("org_tree", f"""
SELECT DISTINCT 'W' AS _id, CAST(NULL AS VARCHAR) AS ParentID, 2 AS OrgType FROM region
UNION ALL
SELECT {tag('R', 'r_regionkey')}, 'W', 0 FROM region
UNION ALL
SELECT {tag('N', 'n_nationkey')}, {tag('R', 'n_regionkey')}, 1 FROM nation""")
cte("student_orgs", f"""
SELECT {tag('s', 'c_custkey')} AS StudentID, {tag('n', 'c_nationkey')} AS OrganizationID
FROM customer""")
cte("students", f"SELECT {tag('S', 'c_custkey')} AS _id FROM customer")
cte("student_docs", f"""
SELECT {tag('S', 'c_custkey')} AS _id, c_custkey AS SqlStudentDocumentId FROM customer""")
cte("lesson_history", f"""
SELECT o_custkey AS SqlStudentDocumentId,
       {tag('g', 'o_orderkey // 8')} AS Lesson,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'StudentAchievement'
                            WHEN '2-HIGH' THEN 'TeacherSkip'
                            WHEN '5-LOW' THEN 'SatisfiedByAlternateLesson'
                            WHEN '3-MEDIUM' THEN NULL
                            ELSE 'Other' END AS SatisfiedReason,
       CASE WHEN o_orderstatus = 'P' THEN 'Skipped' ELSE 'Done' END AS LessonState,
       o_orderdate AS "DateTime"
FROM orders""")
cte("sequence_node", f"SELECT {tag('G', 'p_partkey')} AS NodeGUID, p_partkey AS NodeID FROM part")
cte("lesson_node", """
SELECT p_partkey AS NodeID, p_size AS OrderID,
       CASE p_size % 7 WHEN 0 THEN 4 WHEN 1 THEN 8 WHEN 2 THEN 13 WHEN 3 THEN 7
                       WHEN 4 THEN 14 ELSE 26 END AS StrandID,
       CASE WHEN p_size % 10 = 0 THEN 'Review ' || p_name ELSE p_name END AS Name
FROM part""")
cte("strand", """
SELECT DISTINCT StrandID,
       CASE StrandID WHEN 26 THEN 'Spanish' WHEN 4 THEN 'Reading' WHEN 8 THEN 'Phonics'
                     WHEN 13 THEN 'Vocabulary' WHEN 7 THEN 'Oral Language'
                     ELSE 'Grammar' END AS Enum
FROM lesson_node""", "lesson_node")
cte("scores", f"""
SELECT o.o_custkey AS SqlStudentDocumentId,
       {tag('g', 'l.l_orderkey // 8')} AS Lesson,
       {tag('A', 'l.l_linenumber')} AS Activity,
       CASE WHEN l.l_linenumber = 7 THEN 'Assessment' ELSE 'Skill' END AS Skill,
       CASE WHEN l.l_linestatus = 'O' THEN 'Spanish' ELSE 'ILE' END AS Product,
       CASE WHEN l.l_tax = 0.08 THEN 'Alt' ELSE 'Main' END AS LessonBranch,
       CASE WHEN l.l_discount = 0.1 THEN 'Skipped' END AS ActivitySkippedType,
       CASE WHEN l.l_linenumber = 1 THEN 0 ELSE CAST(l.l_quantity AS INTEGER) END AS NumPossible,
       CAST(floor(l.l_quantity * (1 - l.l_discount)) AS INTEGER) AS NumCorrect,
       CASE WHEN l.l_returnflag = 'N' THEN 1 ELSE 0 END AS Mastered,
       o.o_orderdate AS "DateTime"
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
cte("organization", f"""
SELECT {tag('R', 'r_regionkey')} AS organizationID, 'W' AS parent, r_name AS name,
       'District' AS orgtype FROM region
UNION ALL
SELECT {tag('N', 'n_nationkey')}, {tag('R', 'n_regionkey')}, n_name, 'School' FROM nation""")
cte("student_orgs2", f"""
SELECT {tag('S', 'c_custkey')} AS studentid, {tag('N', 'c_nationkey')} AS organizationID
FROM customer""")
cte("student_info", f"""
SELECT {tag('S', 'c_custkey')} AS id,
       {grade_label('c_custkey % 16')} AS grade_level,
       c_name AS first_name, c_mktsegment AS last_name,
       CASE WHEN c_nationkey % 3 = 0 THEN 'Spanish' ELSE 'English' END AS first_language,
       CAST(c_custkey AS VARCHAR) AS student_number,
       {tag('Y', 'c_custkey')} AS sync_id, c_mktsegment AS tag
FROM customer""")
cte("daily_usage", f"""
SELECT {tag('S', 'user_id')} AS student_id, CAST(ts AS DATE) AS usage_date,
       CAST(floor(value * 10) AS BIGINT) AS session_seconds,
       CASE WHEN event_type = 'error' THEN 'OTHER' ELSE 'ILE' END AS product_tag
FROM events""")
cte("progress_by_lesson", f"""
SELECT {tag('S', 'o_custkey')} AS student_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'Reading'
            WHEN o_orderpriority = '2-HIGH' THEN 'Vocabulary'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Grammar'
            ELSE 'Writing' END AS progress_area,
       {grade_label('o_orderkey % 16')} AS lesson_grade_level,
       {tag('Lesson ', 'o_orderkey')} AS lesson_name,
       CAST(o_orderkey % 120 AS INTEGER) AS lesson_order,
       o_orderstatus <> 'O' AS completed,
       o_orderstatus = 'F' AS passed,
       o_orderstatus = 'P' AS skipped,
       o_orderdate AS date_updated
FROM orders""")

# ---------------------------------------------------------------- marketing
_AFF_COLS = f"""
       ts AS {{time_col}},
       event_id // 95 AS advertiser_id,
       event_id // 4 AS offer_id,
       user_id AS affiliate_id,
       CASE (event_id // 3) % 3 WHEN 0 THEN 'cmp-' || json_extract_string(props, '$.k')
                                WHEN 1 THEN json_extract_string(props, '$.k') || '_b'
                                ELSE 'zz' END AS affiliate_sub3,
       CASE event_id % 3 WHEN 0 THEN 'x_cmp-' || json_extract_string(props, '$.k') || '_y'
                         WHEN 1 THEN json_extract_string(props, '$.k') || '__a' END AS affiliate_sub4,
       CASE WHEN value < 100 THEN 'search' ELSE 'social' END AS affiliate_source,
       {tag('tx', 'event_id // 2')} AS transaction_id,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS revenue_cents,
       CAST(floor(value * 25) AS BIGINT) AS payout_cents"""
cte("conversions", f"""
SELECT {_AFF_COLS.format(time_col='conversion_time')},
       CASE WHEN event_id % 4 = 0 THEN 'pending' ELSE 'approved' END AS status
FROM events WHERE event_type = 'purchase'""")
cte("clicks", f"""
SELECT {_AFF_COLS.format(time_col='click_time')}
FROM events WHERE event_type = 'click'""")
cte("advertiser", "SELECT s_suppkey AS id, s_name AS company FROM supplier")
cte("offer", "SELECT p_partkey AS id, p_name AS name FROM part")
cte("affiliate", "SELECT c_custkey AS id, c_name AS company FROM customer")
cte("campaign_history", """
SELECT CAST(p_size AS VARCHAR) AS campaign_id, p_name AS campaign_name,
       DATE '2020-01-01' + CAST(p_partkey AS INTEGER) AS created_date
FROM part""")

# ---------------------------------------------------------------- budget (as of 1998-06-15)
cte("shipped", """
SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-06-15 00:00:00'""")
cte("calendar_src", "SELECT CAST(l_shipdate AS DATE) AS date FROM shipped", "shipped")
cte("brand_lines", """
SELECT s.*, p.p_brand FROM shipped s JOIN part p ON s.l_partkey = p.p_partkey""", "shipped")
cte("revenue_facts", """
SELECT CAST(l_shipdate AS DATE) AS date, p_brand AS Brand,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,4)) AS revenue,
       CASE l_returnflag WHEN 'R' THEN 'Addition' WHEN 'N' THEN 'Recurring' END AS revenue_type
FROM brand_lines""", "brand_lines")
cte("click_facts", """
SELECT CAST(l_shipdate AS DATE) AS date, p_brand AS Brand FROM brand_lines""", "brand_lines")
cte("budget_table", """
SELECT CAST(1997 + p_partkey % 2 AS INTEGER) AS year, CAST(p_size % 12 + 1 AS INTEGER) AS period,
       p_brand AS brand_domain,
       SUM(CAST(p_retailprice AS DECIMAL(12,2))) AS budget,
       SUM(CAST(p_retailprice AS DECIMAL(12,2))) * CAST(1.1 AS DECIMAL(2,1)) AS current_reforecast
FROM part WHERE p_brand <> 'Brand#7'
GROUP BY 1, 2, 3""")

# ---------------------------------------------------------------- records
cte("auth_token", f"""
SELECT {tag('t', 'event_id')} AS authToken, {tag('u', 'user_id')} AS userName FROM events""")
cte("token_requests", f"""
SELECT event_id AS request_id,
       CASE event_id % 4 WHEN 2 THEN {tag('x', 'event_id')} WHEN 3 THEN {tag('T', 'event_id')}
                         ELSE {tag('t', 'event_id')} END AS authToken,
       CASE WHEN event_id % 4 = 1 THEN {tag('w', 'user_id')} ELSE {tag('u', 'user_id')} END AS userName
FROM events""")
cte("users", f"""
SELECT {tag('u', 'c_custkey')} AS userName, {tag('p', 'c_custkey')} AS userPersonID FROM customer""")
cte("person", f"""
SELECT {tag('p', 'c_custkey')} AS id, {tag('u', 'c_custkey // 10')} AS descendant,
       c_name AS firstName, c_mktsegment AS lastName,
       CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
       CASE WHEN c_custkey >= 2 THEN {tag('p', 'c_custkey // 2')} END AS fatherID,
       CASE WHEN c_custkey >= 3 THEN {tag('p', 'c_custkey // 3')} END AS motherID,
       CASE WHEN c_custkey % 5 <> 0 THEN {tag('p', 'c_custkey + 7')} END AS spouseID
FROM customer""")
cte("delete_users", f"""
SELECT {tag('u', 'c_custkey')} AS userName FROM customer WHERE c_mktsegment = 'AUTOMOBILE'""")
cte("person_requests", f"""
SELECT c_custkey AS request_id,
       CASE WHEN c_custkey % 3 = 2 THEN {tag('z', 'c_custkey')} ELSE {tag('p', 'c_custkey')} END AS id,
       CASE WHEN c_custkey % 3 = 1 THEN {tag('u', 'c_custkey // 10 + 1')}
            ELSE {tag('u', 'c_custkey // 10')} END AS descendant
FROM customer""")
cte("user_requests", f"""
SELECT o_orderkey AS request_id, {tag('u', 'o_orderkey // 8')} AS userName FROM orders""")
cte("person_id_requests", f"""
SELECT o_orderkey AS request_id, {tag('p', 'o_orderkey // 8')} AS id FROM orders""")
cte("family_requests", f"SELECT DISTINCT {tag('u', 'c_custkey // 40')} AS userName FROM customer")
cte("new_persons", f"""
SELECT {tag('q', 'c_custkey')} AS id, {tag('u', 'c_custkey // 10')} AS descendant,
       c_name AS firstName, c_mktsegment AS lastName,
       CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
       CASE WHEN c_custkey % 2 = 0 THEN {tag('p', 'c_custkey')} END AS fatherID,
       CAST(NULL AS VARCHAR) AS motherID,
       CASE WHEN c_custkey % 3 = 0 THEN {tag('q', 'c_custkey + 1')} END AS spouseID
FROM customer WHERE c_mktsegment = 'BUILDING'""")
