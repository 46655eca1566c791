"""The sample queries once more, as plain SQL for an independent check.

Means that are rounded in the query are rounded here in integers: ``total`` and
``n`` are whole numbers, and adding half the divisor before ``//`` rounds half up.
"""

from __future__ import annotations

CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
YEAR = "CAST(year(o_orderdate) AS INTEGER)"
MONTH = "CAST(month(o_orderdate) AS INTEGER)"


def _counts(column: str, labels: dict[object, str]) -> str:
    cells = []
    for value, label in labels.items():
        literal = f"'{value}'" if isinstance(value, str) else str(value)
        cells.append(f'nullif(count(*) FILTER (WHERE {column} = {literal}), 0) AS "{label}"')
    return ", ".join(cells)


STATUS = _counts("o_orderstatus", {"F": "filled", "O": "open", "P": "pending"})
PRIORITY = _counts("priority", {1: "urgent", 2: "high", 3: "medium"})

PLACED = f"""
placed AS (
    SELECT c_nationkey AS nation_key, {MONTH} AS month, {YEAR} AS year, {CENTS} AS cents,
           o_totalprice, o_orderstatus, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority
    FROM orders JOIN customer ON c_custkey = o_custkey
)"""

MEAN_PRICE = "CAST((sum(cents) + 5 * count(*)) // (10 * count(*)) AS DOUBLE) / 10 AS mean_price"

PROFILE = f"""
SELECT nation_key, month, year, {MEAN_PRICE}, {STATUS}, {PRIORITY}
FROM placed GROUP BY nation_key, month, year"""

PEAKS = """
peaks AS (
    SELECT nation_key, month, year, max(o_totalprice) AS peak_price, max(cents) AS peak_cents
    FROM placed GROUP BY nation_key, month, year
)"""


def _donors(months: str) -> str:
    return f"""
    SELECT nation_key, month, CAST(2001 AS INTEGER) AS year,
           CAST((2 * sum(peak_cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS peak_price
    FROM peaks WHERE year IN (1998, 1999, 2000) AND month IN ({months})
    GROUP BY nation_key, month"""


FILLED = f"""
filled AS (
    SELECT nation_key, month, year, peak_price FROM peaks WHERE year = 2001
    UNION ALL
    {_donors("9, 10, 11, 12")}
)"""

SEEDED = """
seeded AS (
    SELECT event_id, user_id, nullif(event_type, 'error') AS event_type,
           CASE WHEN value >= 1 THEN value END AS value
    FROM events
)"""

DIMENSION = """
cities AS (
    SELECT 'City ' || CAST(c_custkey // 2 AS VARCHAR) AS city, n_name AS state_name,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_key,
           CAST(floor(abs(c_acctbal) / 100) AS BIGINT) AS median_age,
           CAST(floor(abs(c_acctbal)) AS BIGINT) AS female, length(c_mktsegment) + 10 * c_nationkey AS male
    FROM customer JOIN nation ON n_nationkey = c_nationkey
),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY city ORDER BY state_name, state_key, median_age, female, male) AS pick
    FROM cities
),
dimension AS (
    SELECT state_key, state_name, CAST(sum(median_age) AS DOUBLE) / count(*) AS average_age,
           CAST(sum(female) AS BIGINT) AS female_urban_population,
           CAST(sum(male) AS BIGINT) AS male_urban_population,
           CAST(sum(female + male) AS BIGINT) AS total_urban_population
    FROM ranked WHERE pick = 1 GROUP BY state_key, state_name
)"""

READINGS = f"""
readings AS (
    SELECT n_name AS state_name, {MONTH} AS month, {YEAR} + 12 AS year,
           CAST(floor(max(o_totalprice) / 10000) AS BIGINT) AS reading
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE n_regionkey <> 4
    GROUP BY n_name, {MONTH}, {YEAR}
),
completed AS (
    SELECT state_name, month, reading AS total, CAST(1 AS BIGINT) AS n FROM readings WHERE year = 2013
    UNION ALL
    SELECT state_name, month, CAST(sum(reading) AS BIGINT), count(*) FROM readings
    WHERE year BETWEEN 2010 AND 2012 AND month BETWEEN 10 AND 12
    GROUP BY state_name, month
)"""

TEMPERATURES = """
temperatures AS (
    SELECT state_key, month, CAST((200 * total + n) // (2 * n) AS DOUBLE) / 100 AS average_temperature
    FROM completed JOIN dimension USING (state_name)
)"""

PORTS = """
airports AS (
    SELECT 'K' || CAST(c_custkey AS VARCHAR) AS ident,
           CASE WHEN c_acctbal > 9500 THEN NULL
                WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(c_custkey - 1 AS VARCHAR)
                ELSE CAST(c_custkey AS VARCHAR) END AS local_code,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_key
    FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal >= -500
),
ports AS (
    SELECT ident, local_code, state_key FROM airports JOIN dimension USING (state_key)
)"""

ARRIVALS = f"""
arrivals AS (
    SELECT {MONTH} AS month, {YEAR} + 15 AS year, CAST(o_custkey AS VARCHAR) AS port,
           CASE WHEN o_totalprice >= 20000 THEN CAST(floor(o_totalprice / 6000) AS BIGINT) END AS age,
           CASE WHEN o_orderstatus = 'P' AND substring(o_orderpriority, 1, 1) = '4' THEN NULL
                WHEN o_orderstatus = 'O' AND substring(o_orderpriority, 1, 1) = '5' THEN 'X'
                WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M' ELSE 'U' END AS gender,
           CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS visa
    FROM orders
),
profiled AS (
    SELECT state_key, month, CAST(year AS INTEGER) AS year,
           CAST((20 * sum(age) + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS average_age_arrivals,
           {_counts("gender", {"F": "F", "M": "M", "U": "U", "X": "X"})},
           {_counts("visa", {1: "business", 2: "pleasure", 3: "student"})}
    FROM arrivals JOIN ports ON port = local_code
    WHERE age IS NOT NULL AND gender IS NOT NULL
    GROUP BY state_key, month, year
)"""

FACT = f"""
WITH {DIMENSION}, {READINGS}, {TEMPERATURES}, {PORTS}, {ARRIVALS},
fact AS (SELECT * FROM profiled JOIN temperatures USING (state_key, month))"""

FACT_COLUMNS = """state_key, month, year, average_age_arrivals, "F", "M", "U", "X",
    business, pleasure, student, average_temperature"""

ORACLE = {
    "scan_parquet_project": """
        SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS price,
               CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority
        FROM orders""",
    "stage_sorted": "SELECT c_nationkey, c_custkey, c_acctbal FROM customer WHERE c_nationkey = 5",
    "input_audit": """
        SELECT 'key' AS "column", count(*) FILTER (c_custkey % 7 = 0) AS missing, CAST(0 AS BIGINT) AS unparsed FROM customer
        UNION ALL SELECT 'balance', count(*) FILTER (c_custkey % 5 <> 0 AND c_acctbal IS NULL), count(*) FILTER (c_custkey % 5 = 0) FROM customer
        UNION ALL SELECT 'day', CAST(0 AS BIGINT), count(*) FILTER (c_custkey % 3 = 0) FROM customer""",
    "match_audit": """
        SELECT count(*) AS n_rows, count(*) FILTER (user_id IS NULL OR user_id NOT IN (SELECT s_suppkey FROM supplier)) AS n_unmatched
        FROM events""",
    "quarantined_rows": """
        SELECT concat_ws(',', CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END,
                         CASE WHEN c_custkey % 5 = 0 THEN 'many' ELSE CAST(c_acctbal AS VARCHAR) END,
                         CASE WHEN c_custkey % 3 = 0 THEN '2013-13-01' ELSE '2013-01-01' END) AS line,
               concat_ws(',', CASE WHEN c_custkey % 5 = 0 THEN 'balance' END, CASE WHEN c_custkey % 3 = 0 THEN 'day' END) AS faults
        FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 3 = 0""",
    "landed_rows": """
        SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS key, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS balance,
               CASE WHEN c_custkey % 3 <> 0 THEN DATE '2013-01-01' END AS day
        FROM customer""",
    "matched_counts": """
        SELECT s_nationkey AS nation_key, event_type, count(*) AS n_events
        FROM events JOIN supplier ON s_suppkey = user_id GROUP BY s_nationkey, event_type""",
    "unmatched_keys": """
        SELECT user_id AS s_suppkey, count(*) AS n FROM events
        WHERE user_id IS NULL OR user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "key_filter_join": """
        SELECT event_id, user_id, event_type, s_nationkey FROM events JOIN supplier ON s_suppkey = user_id""",
    "bucketed_join": """
        SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top_price, min(c_nationkey) AS nation_key
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""",
    "added_months": f"WITH {PLACED} {PROFILE}",
    "csv_contract_scan": """
        SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS balance, c_mktsegment AS segment
        FROM customer""",
    "csv_date_scan": f"""
        SELECT o_orderkey, o_totalprice, o_orderpriority, {YEAR} AS year, {MONTH} AS month FROM orders""",
    "monthly_files_union": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {YEAR} AS landing_year, {MONTH} AS landing_month
        FROM orders""",
    "append_union": """
        SELECT 'customer' AS kind, c_custkey AS key, c_nationkey AS nation_key FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier
        UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_nationkey FROM nation""",
    "stage_roundtrip": """
        SELECT c_nationkey, c_mktsegment, count(*) AS n_customers FROM customer GROUP BY c_nationkey, c_mktsegment""",
    "publish_refresh": """
        SELECT c_mktsegment AS segment, c_nationkey AS nation_key, count(*) AS n_customers,
               c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS share_key
        FROM customer GROUP BY c_mktsegment, c_nationkey""",
    "preview_limit": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "calendar_columns": f"SELECT o_orderkey, {YEAR} AS year, {MONTH} AS month FROM orders",
    "filter_equality": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_nationkey = 7",
    "filter_members": f"""
        SELECT o_orderkey, o_custkey, {YEAR} AS year, {MONTH} AS month FROM orders
        WHERE o_orderstatus = 'F' AND year(o_orderdate) IN (1998, 1999, 2000)
          AND month(o_orderdate) IN (10, 11, 12)""",
    "filter_before_projection": """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE year(o_orderdate) = 2001 AND o_orderpriority = '1-URGENT'""",
    "filter_not_null": f"""
        WITH {SEEDED} SELECT * FROM seeded WHERE event_type IS NOT NULL AND value IS NOT NULL""",
    "filter_is_null": f"WITH {SEEDED} SELECT event_id, user_id, value FROM seeded WHERE event_type IS NULL",
    "conform_computed_key": """
        SELECT s_suppkey, s_name, n_name, n_regionkey FROM supplier
        JOIN nation ON substring(n_name, 8, 2) = CAST(s_nationkey AS VARCHAR)""",
    "lookup_join": """
        SELECT o_orderkey, o_totalprice, o_orderstatus, c_nationkey
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "conform_by_name": f"""
        WITH {PLACED}
        SELECT nation_key AS n_nationkey, year, CAST((max(cents) + 5) // 10 AS DOUBLE) / 10 AS peak_price
        FROM placed JOIN nation ON n_nationkey = nation_key GROUP BY nation_key, year""",
    "dedup_first": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (
            SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS pick
            FROM customer) WHERE pick = 1""",
    "dimension_rollup": """
        WITH picked AS (
            SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
                   row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS pick
            FROM customer)
        SELECT c_nationkey AS nation_key, CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS mean_balance,
               CAST(sum(cents) AS BIGINT) AS sum_cents, count(*) AS n_entities
        FROM picked WHERE pick = 1 GROUP BY c_nationkey""",
    "donor_mean": f"WITH {PLACED}, {PEAKS} {_donors('9, 10, 11, 12')}",
    "impute_periods": f"WITH {PLACED}, {PEAKS}, {FILLED} SELECT * FROM filled",
    "impute_only_missing": f"""
        WITH {PLACED}, {PEAKS},
        donors AS ({_donors("1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")})
        SELECT nation_key, month, year, peak_price FROM peaks WHERE year = 2001
        UNION ALL
        SELECT nation_key, month, year, peak_price FROM donors d WHERE NOT EXISTS (
            SELECT 1 FROM peaks p WHERE p.year = 2001 AND p.nation_key = d.nation_key AND p.month = d.month)""",
    "pivot_string": f"""
        WITH {PLACED} SELECT nation_key, month, year, {STATUS} FROM placed GROUP BY nation_key, month, year""",
    "pivot_numeric": f"""
        WITH {PLACED} SELECT nation_key, month, year, {PRIORITY} FROM placed GROUP BY nation_key, month, year""",
    "group_mean_rounded": f"""
        WITH {PLACED} SELECT nation_key, month, year, {MEAN_PRICE} FROM placed GROUP BY nation_key, month, year""",
    "exact_group_mean": """
        SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean_price, round(avg(l_discount), 6) AS mean_discount,
               nullif(count(*) FILTER (WHERE l_linestatus = 'F'), 0) AS filled,
               nullif(count(*) FILTER (WHERE l_linestatus = 'O'), 0) AS open
        FROM lineitem GROUP BY l_returnflag""",
    "profile_one_pass": f"WITH {PLACED} {PROFILE}",
    "profile_preaggregated": f"WITH {PLACED} {PROFILE}",
    "profile_by_joins": f"WITH {PLACED} {PROFILE}",
    "fact_enrich": f"""
        WITH {PLACED}, {PEAKS}, {FILLED}, profiled AS ({PROFILE})
        SELECT p.*, f.peak_price FROM profiled p
        JOIN filled f ON f.nation_key = p.nation_key AND f.month = p.month""",
    "sorted_result": f"WITH {PLACED} {PROFILE} ORDER BY nation_key, month, year",
    "dq_null_counts": f"""
        WITH {SEEDED}
        SELECT 'not_null' AS rule, 'event_id' AS "column", count(*) - count(event_id) AS violations FROM seeded
        UNION ALL SELECT 'not_null', 'event_type', count(*) - count(event_type) FROM seeded
        UNION ALL SELECT 'not_null', 'value', count(*) - count(value) FROM seeded""",
    "dq_unique_key": f"""
        SELECT o_custkey, {YEAR} AS year, {MONTH} AS month, count(*) AS n FROM orders
        GROUP BY o_custkey, {YEAR}, {MONTH} HAVING count(*) > 1""",
    "dq_foreign_key": """
        SELECT user_id, count(*) AS n FROM events
        WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "dq_not_null_length": f"""
        WITH {SEEDED}
        SELECT 'not_null' AS rule, 'event_type' AS "column", count(*) - count(event_type) AS violations FROM seeded
        UNION ALL SELECT 'max_length', 'event_type', count(*) FROM seeded WHERE length(event_type) > 5""",
    "dq_contract_audit": f"""
        WITH {SEEDED}
        SELECT 'not_null' AS rule, 'user_id' AS "column", count(*) - count(user_id) AS violations FROM seeded
        UNION ALL SELECT 'not_null', 'event_type', count(*) - count(event_type) FROM seeded
        UNION ALL SELECT 'not_null', 'value', count(*) - count(value) FROM seeded
        UNION ALL SELECT 'max_length', 'event_type', count(*) FROM seeded WHERE length(event_type) > 5
        UNION ALL SELECT 'unique_key', 'user_id,event_type', count(*) FROM (
            SELECT user_id, event_type FROM seeded GROUP BY user_id, event_type HAVING count(*) > 1)
        UNION ALL SELECT 'foreign_key', 'user_id', count(*) FROM seeded
            WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
    "dq_checked_write": f"""
        WITH {SEEDED}
        SELECT 'not_null' AS rule, 'user_id' AS "column", count(*) - count(user_id) AS violations FROM seeded
        UNION ALL SELECT 'not_null', 'event_type', count(*) - count(event_type) FROM seeded
        UNION ALL SELECT 'not_null', 'value', count(*) - count(value) FROM seeded
        UNION ALL SELECT 'max_length', 'event_type', count(*) FROM seeded WHERE length(event_type) > 5
        UNION ALL SELECT 'unique_key', 'user_id,event_type', count(*) FROM (
            SELECT user_id, event_type FROM seeded GROUP BY user_id, event_type HAVING count(*) > 1)
        UNION ALL SELECT 'foreign_key', 'user_id', count(*) FROM seeded
            WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
    "star_dimension": f"WITH {DIMENSION} SELECT * FROM dimension",
    "star_calendar": f"""
        WITH {READINGS}
        SELECT state_name, CAST(total AS DOUBLE) / n AS average_temperature, month,
               CAST(2013 AS INTEGER) AS year
        FROM completed""",
    "star_temperature": f"WITH {DIMENSION}, {READINGS}, {TEMPERATURES} SELECT * FROM temperatures",
    "star_ports": f"WITH {DIMENSION}, {PORTS} SELECT ident, local_code, state_key FROM ports",
    "star_profile": f"WITH {DIMENSION}, {PORTS}, {ARRIVALS} SELECT * FROM profiled",
    "star_fact": f"{FACT} SELECT {FACT_COLUMNS} FROM fact",
    "report_visa_mix": f"""
        {FACT} SELECT month, business, pleasure, student, average_temperature
        FROM fact JOIN dimension USING (state_key) WHERE state_key = '05' ORDER BY month""",
    "report_gender_mix": f"""
        {FACT} SELECT month, "F", "M", "U", "X", average_temperature
        FROM fact JOIN dimension USING (state_key) WHERE state_key = '05' ORDER BY month""",
    "full_refresh_run": f"{FACT} SELECT {FACT_COLUMNS} FROM fact",
    "full_refresh_dimension": f"WITH {DIMENSION} SELECT * FROM dimension",
}
