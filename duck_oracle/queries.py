"""Oracle SQL per registered key (DuckDB dialect)."""

from __future__ import annotations

import duck_oracle.stand_ins  # noqa: F401  (registers the stand-in CTEs)
from duck_oracle.ctes import sql

SHOP = ("customers", "customer_orders", "customer_order_products", "products")
BOOK = "ECONOMY"
EAST = "('MACHINERY', 'FURNITURE')"

ORACLE_SQL: dict[str, str] = {}

# ---------------------------------------------------------------- shop
ORACLE_SQL["retail_q1"] = sql("""
SELECT name FROM customers
WHERE customer_id IN (SELECT customer_id FROM customer_orders WHERE month(order_date) = 5)
""", *SHOP)

ORACLE_SQL["retail_q2"] = sql(f"""
SELECT name FROM customers WHERE customer_id NOT IN (
  SELECT customer_id FROM customer_orders WHERE order_id IN (
    SELECT order_id FROM customer_order_products WHERE product_id IN (
      SELECT product_id FROM products WHERE product_type = '{BOOK}')))
""", *SHOP)

ORACLE_SQL["retail_q3"] = sql("""
SELECT p.product_type, CAST(SUM(p.price * cop.quantity) AS DOUBLE) AS revenue
FROM products p JOIN customer_order_products cop ON p.product_id = cop.product_id
GROUP BY p.product_type
ORDER BY revenue DESC
""", *SHOP)

ORACLE_SQL["retail_q3_rows"] = sql("""
SELECT p.product_type, CAST(p.price AS DOUBLE) AS price, cop.quantity,
       CAST(p.price * cop.quantity AS DOUBLE) AS revenue
FROM products p JOIN customer_order_products cop ON p.product_id = cop.product_id
ORDER BY revenue DESC
""", *SHOP)

ORACLE_SQL["retail_q4"] = sql(f"""
SELECT p.product_type, c.name, c.state
FROM products p
JOIN customer_order_products cop ON p.product_id = cop.product_id
JOIN customer_orders co ON cop.order_id = co.order_id
JOIN customers c ON co.customer_id = c.customer_id
WHERE c.state IN {EAST}
""", *SHOP)

ORACLE_SQL["retail_q4_semi"] = sql(f"""
SELECT product_type FROM products WHERE product_id IN (
  SELECT product_id FROM customer_order_products WHERE order_id IN (
    SELECT order_id FROM customer_orders WHERE customer_id IN (
      SELECT customer_id FROM customers WHERE state IN {EAST})))
""", *SHOP)

_Q5 = """
SELECT c.name, CAST(SUM(n.quantity) AS BIGINT) AS total_quantity
FROM customers c
JOIN (SELECT co.order_id, co.customer_id, cop.product_id, cop.quantity
      FROM customer_orders co JOIN customer_order_products cop ON co.order_id = cop.order_id) n
  ON c.customer_id = n.customer_id
GROUP BY c.name
ORDER BY total_quantity DESC
"""
ORACLE_SQL["retail_q5"] = sql(_Q5, *SHOP)
ORACLE_SQL["retail_q5_ctas"] = sql(_Q5, *SHOP)

import duck_oracle.workloads  # noqa: E402,F401  (registers the workload CTEs)
from duck_oracle.workloads import CAMPAIGN_CASE, SUBJECTS, grade_number  # noqa: E402

Q = ORACLE_SQL

Q["scan_table"] = "SELECT * FROM orders"
Q["scan_catalog_table"] = Q["scan_table"]
Q["join_bloom_semi"] = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                     WHERE c.c_mktsegment = 'BUILDING')"""
Q["join_salted"] = """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey"""
Q["join_bucketed"] = """
SELECT o.o_orderkey, o.o_orderpriority, count(*) AS n_lines, max(l.l_quantity) AS max_quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderpriority"""
Q["filter_month"] = sql("SELECT * FROM customer_orders WHERE month(order_date) = 5", *SHOP)
Q["semi_join"] = sql("""
SELECT customer_id, name FROM customers
WHERE customer_id IN (SELECT customer_id FROM customer_orders WHERE month(order_date) = 5)""", *SHOP)
Q["semi_chain"] = sql(f"""
SELECT product_id, product_type FROM products WHERE product_id IN (
  SELECT product_id FROM customer_order_products WHERE order_id IN (
    SELECT order_id FROM customer_orders WHERE customer_id IN (
      SELECT customer_id FROM customers WHERE state IN {EAST})))""", *SHOP)
_BOOK_SUB = f"""
  SELECT customer_id FROM customer_orders WHERE order_id IN (
    SELECT order_id FROM customer_order_products WHERE product_id IN (
      SELECT product_id FROM products WHERE product_type = '{BOOK}'))"""
Q["anti_join"] = sql(f"""
SELECT customer_id, name FROM customers c
WHERE NOT EXISTS (SELECT 1 FROM ({_BOOK_SUB}) b WHERE b.customer_id = c.customer_id)""", *SHOP)
Q["anti_null_aware"] = sql(f"""
SELECT customer_id, name FROM customers WHERE customer_id NOT IN ({_BOOK_SUB})""", *SHOP)
Q["join_inner"] = sql("""
SELECT p.product_id, p.product_type, cop.order_id, cop.quantity
FROM products p JOIN customer_order_products cop ON p.product_id = cop.product_id""", *SHOP)
Q["sink_ctas"] = sql("""
SELECT co.order_id, co.customer_id, cop.product_id, cop.quantity
FROM customer_orders co JOIN customer_order_products cop ON co.order_id = cop.order_id""", *SHOP)

# ---------------------------------------------------------------- W1
Q["activity_scores"] = sql("SELECT * FROM w1_final ORDER BY Name, NumCorrect", "w1_final")
Q["project_star"] = sql("SELECT * FROM w1_final", "w1_final")
Q["join_hierarchy"] = sql("SELECT * FROM w1_roster", "w1_roster")
Q["join_ci"] = sql("""
SELECT so.StudentID, so.OrganizationID, s._id
FROM student_orgs so JOIN students s ON lower(s._id) = lower(so.StudentID)""",
                   "student_orgs", "students")
Q["filter_range_closed"] = sql("SELECT * FROM w1_scores", "w1_scores")
Q["filter_eq"] = sql("SELECT * FROM scores WHERE Product = 'ILE' AND LessonBranch = 'Main'", "scores")
Q["filter_is_null"] = sql("SELECT * FROM scores WHERE ActivitySkippedType IS NULL", "scores")
Q["filter_not_like"] = sql("SELECT * FROM w1_history", "w1_history")
Q["param_window"] = sql("""
SELECT * FROM lesson_history
WHERE "DateTime" >= CAST('1997-01-01' AS TIMESTAMP) AND "DateTime" <= CAST('1997-12-31' AS TIMESTAMP)""",
                        "lesson_history")
Q["join_composite"] = sql("SELECT * FROM w1_lessons", "w1_lessons")

# ---------------------------------------------------------------- W2
Q["lesson_summary"] = sql("SELECT * FROM w2_final", "w2_final")
Q["fn_lower"] = sql("SELECT * FROM w2_roster", "w2_roster")
Q["filter_range_plus_day"] = sql("""
SELECT * FROM scores
WHERE "DateTime" >= TIMESTAMP '1997-01-01' AND "DateTime" <= CAST(DATE '1998-06-30' + 1 AS TIMESTAMP)
  AND Product = 'ILE'""", "scores")
Q["agg_ratio"] = sql("SELECT * FROM w2_scores", "w2_scores")
Q["filter_in_list"] = sql("SELECT * FROM lesson_node WHERE StrandID IN (4, 8, 13, 7, 14)", "lesson_node")
Q["case_category"] = sql(f"""
SELECT NodeID, StrandID, coalesce(subject, 'Other') AS Lesson_Type
FROM lesson_node LEFT JOIN {SUBJECTS} AS s(StrandID, subject) USING (StrandID)""",
                         "lesson_node")
Q["project_math"] = sql("""
SELECT NodeID, StrandID, OrderID,
       CAST(CASE WHEN StrandID = 4 THEN OrderID ELSE 16 + OrderID END AS BIGINT) AS Lesson_Number
FROM lesson_node""", "lesson_node")
Q["win_over_agg"] = sql("""
SELECT Student_GUID, SqlStudentDocumentId, Lesson, SatisfiedReason, LessonState, Lesson_Number,
       Lesson_Date, Order_Num, Lesson_Type, round(Lesson_Accuracy, 6) AS Lesson_Accuracy
FROM w2_lessons""", "w2_lessons")
Q["win_rn_case"] = sql("""
SELECT Student_GUID, Lesson_Type, Lesson, Lesson_Date, Order_Num FROM w2_lessons""", "w2_lessons")
Q["threshold_flag"] = sql("""
SELECT Student_GUID, Lesson, Lesson_Date,
       CAST(coalesce(Lesson_Passed, false) AS BIGINT) AS passed
FROM w2_lessons""", "w2_lessons")
Q["join_fanout"] = sql("""
SELECT a.Student_GUID, a.School_GUID, b.Lesson, b.Lesson_Date, b.Lesson_Type
FROM w2_roster a JOIN w2_lessons b ON b.Student_GUID = a.Student_GUID""", "w2_roster", "w2_lessons")
Q["agg_pick_zero"] = sql("SELECT Student_GUID, Last_literacy_lesson FROM w2_final", "w2_final")
Q["agg_two_level"] = sql("""
SELECT Student_GUID, Overall_Accuracy, Lessons_Passed_Current FROM w2_final""", "w2_final")

# ---------------------------------------------------------------- W3
Q["usage_by_student"] = sql("""
SELECT * FROM w3_final ORDER BY district_name, school_name, grade""", "w3_final")
Q["project_alias"] = sql("SELECT * FROM w3_roster", "w3_roster")
Q["sort_multi"] = sql("SELECT * FROM w3_roster ORDER BY district_name, school_name, grade", "w3_roster")
Q["label_to_ordinal"] = sql(f"""
SELECT lesson_name, lesson_grade_level, {grade_number('lesson_grade_level')}::INTEGER AS grade_numeric
FROM progress_by_lesson""", "progress_by_lesson")
Q["filter_between"] = sql("""
SELECT * FROM daily_usage WHERE usage_date BETWEEN DATE '1998-01-01' AND DATE '2024-01-20'""",
                          "daily_usage")
Q["filter_not_bool"] = sql("""
SELECT * FROM progress_by_lesson
WHERE date_updated BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2024-01-20' AND NOT skipped""",
                           "progress_by_lesson")
Q["agg_min_max"] = sql("SELECT * FROM w3_usage", "w3_usage")
Q["agg_unit"] = Q["agg_min_max"]
Q["win_rn_asc"] = sql("""
SELECT student_id, progress_area, lesson_name, date_updated, taken_order FROM w3_lessons""",
                      "w3_lessons")
Q["win_first_last"] = sql("SELECT * FROM w3_lessons", "w3_lessons")
Q["agg_conditional"] = sql("SELECT * FROM w3_lessons_stud", "w3_lessons_stud")
Q["agg_pick_null"] = sql("""
SELECT student_id, literacy_first, literacy_last, grade_level_first, grade_level_latest
FROM w3_lessons_stud""", "w3_lessons_stud")
Q["agg_rate"] = sql("SELECT student_id, lessons_worked, pass_rate FROM w3_lessons_stud", "w3_lessons_stud")
Q["join_inner_left"] = sql("""
SELECT student_id, total_session_minutes, lessons_worked FROM w3_final""", "w3_final")
Q["named_view"] = sql("SELECT * FROM w3_final", "w3_final")

# ---------------------------------------------------------------- W4
Q["campaign_revenue"] = sql("SELECT * FROM w4_final", "w4_final")
Q["join_star_left"] = sql("SELECT * FROM w4_conversion_raw", "w4_conversion_raw")
Q["agg_count_col"] = sql("SELECT * FROM w4_conversion_clean", "w4_conversion_clean")
Q["agg_wide_grain"] = Q["agg_count_col"]
Q["agg_count_distinct"] = sql("SELECT * FROM w4_click_clean", "w4_click_clean")
Q["union_facts"] = sql("SELECT * FROM w4_combined", "w4_combined")
Q["agg_by_expr"] = sql("SELECT * FROM w4_revenue_final", "w4_revenue_final")
Q["agg_sum_expr"] = sql(f"""
SELECT campaign_id, CAST(SUM(revenue_cents) AS DOUBLE) / 100.0 AS tune_revenue
FROM (SELECT {CAMPAIGN_CASE} AS campaign_id, revenue_cents FROM w4_combined) u
GROUP BY campaign_id""", "w4_combined")
Q["agg_sum"] = sql("""
SELECT CAST(click_time AS DATE) AS event_date, affiliate_id,
       CAST(SUM(CASE WHEN revenue_cents IS NULL THEN 0 ELSE revenue_cents END) AS BIGINT) AS revenue_cents,
       CAST(SUM(payout_cents) AS BIGINT) AS payout_cents
FROM clicks GROUP BY 1, 2""", "clicks")
Q["null_to_zero"] = sql("""
SELECT transaction_id, revenue_cents,
       CASE WHEN revenue_cents IS NULL THEN 0 ELSE revenue_cents END AS cl_rev
FROM clicks""", "clicks")
Q["campaign_id"] = sql(f"""
SELECT transaction_id, affiliate_sub3, affiliate_sub4, {CAMPAIGN_CASE} AS campaign_id
FROM (SELECT transaction_id, affiliate_sub3, affiliate_sub4 FROM clicks
      UNION ALL
      SELECT transaction_id, affiliate_sub3, affiliate_sub4 FROM conversions) u""",
                       "clicks", "conversions")
Q["fn_regex_cmp"] = sql("""
SELECT transaction_id, affiliate_sub4,
       regexp_extract(affiliate_sub4, 'cmp-([0-9]{1,12})', 0) AS cmp_match
FROM clicks""", "clicks")
Q["fn_regex_digits"] = sql("""
SELECT transaction_id, affiliate_sub3,
       replace(regexp_extract(affiliate_sub3, '^([0-9])+_*', 0), '_', '') AS leading_digits
FROM clicks""", "clicks")
Q["fn_ltrim_set"] = sql("""
SELECT transaction_id, affiliate_sub3,
       ltrim(regexp_extract(affiliate_sub3, 'cmp-([0-9]{1,12})', 0), 'cmp-') AS campaign_digits
FROM clicks""", "clicks")
Q["filter_like"] = sql("""
SELECT transaction_id, affiliate_sub4 FROM clicks WHERE affiliate_sub4 LIKE '%cmp%'""", "clicks")
Q["filter_not_null"] = sql("""
SELECT transaction_id, affiliate_sub4 FROM conversions WHERE affiliate_sub4 IS NOT NULL""",
                           "conversions")
Q["filter_from_date"] = sql("""
SELECT CAST(conversion_time AS DATE) AS event_date, advertiser_id, offer_id, affiliate_id,
       affiliate_source, affiliate_sub3, affiliate_sub4, transaction_id,
       CASE WHEN revenue_cents IS NULL THEN 0 ELSE revenue_cents END AS cr_rev, payout_cents
FROM conversions WHERE CAST(conversion_time AS DATE) >= DATE '2023-01-01'""", "conversions")
Q["fn_to_date"] = sql("""
SELECT transaction_id, click_time, CAST(click_time AS DATE) AS event_date FROM clicks""", "clicks")
Q["fn_cast"] = sql("""
SELECT transaction_id, CAST(revenue_cents AS DOUBLE) / CAST(100 AS DOUBLE) AS revenue,
       1.0 * CAST(payout_cents AS DOUBLE) AS payout
FROM clicks""", "clicks")
Q["win_rn_desc"] = sql("SELECT * FROM w4_campaign_lookup", "w4_campaign_lookup")
Q["win_latest"] = sql("""
SELECT campaign_id, campaign_name FROM w4_campaign_lookup WHERE rank = 1""", "w4_campaign_lookup")
Q["join_left_on_filter"] = sql("""
SELECT a.campaign_id, b.campaign_name
FROM (SELECT DISTINCT campaign_id FROM w4_revenue_final) a
LEFT JOIN w4_campaign_lookup b ON a.campaign_id = b.campaign_id AND rank = 1""",
                               "w4_revenue_final", "w4_campaign_lookup")

# ---------------------------------------------------------------- W5
Q["budget_forecast"] = sql("SELECT * FROM w5_final ORDER BY 1, 2", "w5_final")
Q["fn_date_parts"] = sql("SELECT * FROM w5_ytd", "w5_ytd")
Q["fn_date_shift"] = sql("SELECT * FROM w5_future", "w5_future")
Q["fn_year_bounds"] = sql("""
SELECT DISTINCT date, CAST(date_trunc('year', date) AS DATE) AS year_start,
       make_date(year(date), 12, 31) AS year_end
FROM calendar_src""", "calendar_src")
Q["union_distinct"] = sql("SELECT * FROM w5_calendar", "w5_calendar")
Q["agg_count"] = sql("SELECT * FROM w5_days", "w5_days")
Q["agg_pace"] = sql("""
SELECT event_date, month, Brand, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue_to_pace AS DOUBLE) AS revenue_to_pace
FROM w5_actuals_to_date""", "w5_actuals_to_date")
Q["case_null"] = sql("""
SELECT date, Brand, revenue_type, CAST(revenue AS DOUBLE) AS revenue,
       CAST(CASE WHEN date = DATE '1998-06-15' THEN NULL
                 WHEN revenue_type != 'Addition' THEN revenue ELSE 0 END AS DOUBLE) AS pace_value
FROM revenue_facts WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-06-15'""", "revenue_facts")
Q["actuals_padded"] = sql("""
SELECT event_date, month, Brand, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue_to_pace AS DOUBLE) AS revenue_to_pace
FROM w5_actual""", "w5_actual")
Q["join_cross"] = sql("SELECT event_date, month, Brand FROM w5_future_rows", "w5_future_rows")
Q["agg_avg"] = sql("SELECT * FROM w5_avg", "w5_avg")
Q["distinct_rows"] = sql("""
SELECT DISTINCT brand_domain FROM w5_budget WHERE brand_domain IS NOT NULL""", "w5_budget")
Q["win_share"] = sql("SELECT * FROM w5_raw_clicks", "w5_raw_clicks")
Q["win_normalise"] = sql("SELECT * FROM w5_weights", "w5_weights")
Q["join_left"] = sql("SELECT * FROM w5_targets", "w5_targets")
Q["filter_self_range"] = sql("""
SELECT Brand, COUNT(*) AS clicks FROM click_facts
WHERE date BETWEEN date - INTERVAL 3 MONTH AND DATE '1998-06-15'
GROUP BY Brand""", "click_facts")

# ---------------------------------------------------------------- records
Q["token_exists"] = sql("""
SELECT r.*, EXISTS (SELECT 1 FROM auth_token t WHERE t.authToken = r.authToken) AS token_exists
FROM token_requests r""", "token_requests", "auth_token")
Q["token_user_exists"] = sql("""
SELECT r.*, EXISTS (SELECT 1 FROM auth_token t
                    WHERE t.authToken = r.authToken AND t.userName = r.userName) AS pair_exists
FROM token_requests r""", "token_requests", "auth_token")
Q["token_lookup"] = sql("""
SELECT r.request_id, r.authToken,
       coalesce((SELECT max(t.userName) FROM auth_token t WHERE t.authToken = r.authToken), '') AS userName
FROM token_requests r""", "token_requests", "auth_token")
_AFTER_INSERT = """
SELECT authToken, userName FROM auth_token
UNION ALL
SELECT DISTINCT authToken, userName FROM token_requests r
WHERE r.authToken NOT IN (SELECT authToken FROM auth_token)"""
Q["insert_if_absent"] = sql(_AFTER_INSERT, "token_requests", "auth_token")
Q["sink_append"] = Q["insert_if_absent"]
Q["insert_rejected"] = sql("""
SELECT r.authToken, r.userName,
       CASE WHEN bool_or(t.userName = r.userName) THEN 'row exists' ELSE 'key exists' END AS reason
FROM token_requests r JOIN auth_token t USING (authToken)
GROUP BY r.request_id, r.authToken, r.userName""", "token_requests", "auth_token")
Q["delete_persons"] = sql("""
SELECT * FROM person WHERE descendant NOT IN (SELECT userName FROM delete_users)""", "person", "delete_users")
Q["dq_dangling_child"] = sql("""
SELECT * FROM customer_order_products
WHERE product_id IN (SELECT product_id FROM products WHERE product_type = 'ECONOMY')""",
                             "customer_order_products", "products")
_DELETE = """
SELECT * FROM auth_token WHERE userName NOT IN (SELECT userName FROM delete_users)"""
Q["delete_by_key"] = sql(_DELETE, "auth_token", "delete_users")
Q["sink_overwrite"] = Q["delete_by_key"]
Q["sink_refresh_in_place"] = Q["delete_by_key"]
Q["sink_drop"] = sql("""
SELECT userName, count(*) AS tokens, CAST(0 AS BIGINT) AS tokens_left FROM auth_token GROUP BY userName""",
                     "auth_token")
Q["person_exists"] = sql("""
SELECT r.*, EXISTS (SELECT 1 FROM person p WHERE p.id = r.id AND p.descendant = r.descendant)
         AS person_exists
FROM person_requests r""", "person_requests", "person")
Q["user_person_lookup"] = sql("""
SELECT r.request_id, r.userName,
       (SELECT max(u.userPersonID) FROM users u WHERE u.userName = r.userName) AS userPersonID
FROM user_requests r""", "user_requests", "users")
Q["person_lookup"] = sql("""
SELECT r.request_id, r.id, p.descendant, p.firstName, p.lastName, p.gender, p.fatherID,
       p.motherID, p.spouseID
FROM person_id_requests r LEFT JOIN person p ON p.id = r.id""", "person_id_requests", "person")
Q["persons_of_user"] = sql("""
SELECT p.descendant, p.id, p.firstName, p.lastName, p.gender, p.fatherID, p.motherID, p.spouseID
FROM person p WHERE p.descendant IN (SELECT userName FROM family_requests)""",
                           "person", "family_requests")
Q["append_person"] = sql("""
SELECT * FROM person UNION ALL SELECT * FROM new_persons""", "person", "new_persons")
Q["dq_unique"] = sql(f"""
SELECT authToken, COUNT(*) AS n_rows FROM ({_AFTER_INSERT}) t
GROUP BY authToken HAVING COUNT(*) > 1""", "token_requests", "auth_token")
Q["dq_not_null"] = sql("""
UNPIVOT (SELECT count(*) FILTER (WHERE id IS NULL) AS id,
                count(*) FILTER (WHERE descendant IS NULL) AS descendant,
                count(*) FILTER (WHERE firstName IS NULL) AS firstName,
                count(*) FILTER (WHERE lastName IS NULL) AS lastName,
                count(*) FILTER (WHERE gender IS NULL) AS gender,
                count(*) FILTER (WHERE fatherID IS NULL) AS fatherID,
                count(*) FILTER (WHERE motherID IS NULL) AS motherID,
                count(*) FILTER (WHERE spouseID IS NULL) AS spouseID
         FROM person)
ON id, descendant, firstName, lastName, gender, fatherID, motherID, spouseID
INTO NAME column_name VALUE null_count""", "person")
Q["dq_foreign_key"] = sql("""
SELECT authToken, userName FROM token_requests
WHERE userName IS NOT NULL AND userName NOT IN (SELECT userName FROM users)""",
                          "token_requests", "users")
Q["dq_self_foreign_key"] = sql("""
SELECT id, 'fatherID' AS role, fatherID AS missing_id FROM person
WHERE fatherID IS NOT NULL AND fatherID NOT IN (SELECT id FROM person)
UNION ALL
SELECT id, 'motherID', motherID FROM person
WHERE motherID IS NOT NULL AND motherID NOT IN (SELECT id FROM person)
UNION ALL
SELECT id, 'spouseID', spouseID FROM person
WHERE spouseID IS NOT NULL AND spouseID NOT IN (SELECT id FROM person)""", "person")
