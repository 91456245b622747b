"""Equivalent SQL of each registered query, for an independent engine that has
the driver's tables as views. Stamps and file names are the fixed values the
queries pass."""

from landfall.plans.landings import FILE_NAMES as FN
from landfall.plans.landings import FIXED_STAMP as STAMP

_MONEY = "CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


def _money(c):
    return _MONEY.format(c=c)


def _family(x):
    return (f"CASE WHEN regexp_matches({x}, '\\S\\s+\\S+$') THEN regexp_extract({x}, '^(.*\\S)\\s+\\S+$', 1) "
            f"ELSE nullif(trim({x}), '') END")


def _given(x):
    return f"nullif(regexp_extract({x}, '\\S\\s+(\\S+)$', 1), '')"


PROVIDERS = f"""
SELECT CAST(p_partkey AS VARCHAR) AS "Provider NPI",
       {_family('p_name')} AS "Provider Last Name",
       {_given('p_name')} AS "Provider First Name",
       p_type AS "Degree",
       CASE WHEN p_size % 2 = 0 THEN 'Active' ELSE 'Inactive' END AS "Current Status",
       CAST(p_size AS VARCHAR) AS "Department ID",
       p_brand AS "Department Name",
       p_type AS "Section Name",
       strftime(DATE '1994-01-01' + p_size, '%m-%d-%Y') AS "Start Date",
       CASE WHEN p_size % 2 = 0 THEN NULL
            ELSE strftime(DATE '1994-01-01' + (p_size + 365), '%m-%d-%Y') END AS "End Date",
       {_money('p_retailprice')} AS "Specialty",
       '{FN['providers']}' AS "File Name",
       '{STAMP}' AS "Load Timestamp"
FROM part
"""

APPOINTMENTS = f"""
SELECT CAST(user_id AS VARCHAR) AS "Patient MRN",
       event_type AS "Provider Last Name",
       'u' || CAST(user_id AS VARCHAR) AS "Provider First Name",
       CAST(event_id AS VARCHAR) AS "Department ID",
       props AS "Department Name",
       strftime(ts, '%m-%d-%Y') AS "Appointment Date",
       strftime(ts, '%H:%M') AS "Appointment Time",
       event_type AS "Appointment Type",
       {_money('value')} AS "Appointment Description",
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'Booked' END AS "Appointment Status",
       '{FN['appointments']}' AS "File Name",
       '{STAMP}' AS "Load Timestamp"
FROM events
"""

DEMOGRAPHICS = f"""
SELECT CAST(c_custkey AS VARCHAR) AS "Patient MRN",
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%m-%d-%Y') END AS "Patient DOB",
       nullif(regexp_replace(c_name, '\\D', '', 'g'), '') AS "Patient Phone Number",
       CAST(c_nationkey AS VARCHAR) AS "Nation Key",
       {_money('c_acctbal')} AS "Account Balance",
       CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'None'
            ELSE c_mktsegment END AS "Segment",
       '{STAMP}' AS "Load Timestamp",
       '{FN['demographics']}' AS "File Name"
FROM customer
"""

VISITS_COLUMNS = f"""CAST(o_custkey AS VARCHAR) AS "Patient MRN",
       CAST(o_orderkey AS VARCHAR) AS "Visit ID",
       strftime(o_orderdate, '%m-%d-%Y') AS "Admit Date or Service Date",
       o_orderstatus AS "Visit Status",
       {_money('o_totalprice')} AS "Charge",
       o_orderpriority AS "Priority\""""

VISITS = f"""
SELECT {VISITS_COLUMNS},
       '{STAMP}' AS "Load Timestamp",
       '{FN['visits']}' AS "File Name"
FROM orders
"""

RX_ORDERS = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS "Order ID",
       CAST(l_linenumber AS VARCHAR) AS "Line Number",
       CAST(l_suppkey AS VARCHAR) AS "Pharmacy ID",
       'drug ' || CAST(l_partkey AS VARCHAR) AS "Drug Name",
       {_money('l_quantity')} AS "Quantity",
       strftime(l_shipdate, '%m-%d-%Y') AS "Date Sent",
       l_returnflag AS "Return Flag",
       '{STAMP}' AS "Load Timestamp",
       '{FN['rx_orders']}' AS "File Name"
FROM lineitem
"""

_SEGMENT = ("CASE c_custkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN 'None' WHEN 3 THEN '' "
            "ELSE c_mktsegment END")
_TOKENS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
           "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'n/a', 'nan', 'null'")

_ORDER_STATE = "CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN '{open}' ELSE 'STOPPED' END"

_SCHEME = "^[A-Za-z][A-Za-z0-9+.\\-]*://"
_KEY = f"url_decode(regexp_replace(regexp_extract(url, '{_SCHEME}[^/?#]*([^?#]*)', 1), '^/+', ''))"

ORACLE = {
    "feed_providers": PROVIDERS,
    "feed_appointments": APPOINTMENTS,
    "feed_demographics": DEMOGRAPHICS,
    "feed_visits": VISITS,
    "feed_rx_orders": RX_ORDERS,
    "scan_delimited": f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       {_money('c_acctbal')} AS c_acctbal, c_mktsegment
FROM customer""",
    "scan_quoted": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source
FROM documents""",
    "scan_comma": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       {_money('s_acctbal')} AS s_acctbal
FROM supplier""",
    "rename_column": """
SELECT p_partkey, p_name AS "Part Name", p_brand, p_type, p_size, p_retailprice FROM part""",
    "closed_projection": "SELECT s_name, s_suppkey FROM supplier",
    "open_projection": """
SELECT s_suppkey, upper(s_name) AS s_name, s_nationkey, s_acctbal, 'suppliers' AS "Feed" FROM supplier""",
    "load_stamp": f"""
SELECT event_id, left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS ts_text, '{STAMP}' AS "Load Timestamp"
FROM events""",
    "file_lineage": f"""
SELECT page_id,
       regexp_extract(url, '{_SCHEME}([^/?#]*)', 1) AS store,
       {_KEY} AS key,
       regexp_extract({_KEY}, '[^/]*$', 0) AS key_name,
       'pages.parquet' AS "File Name"
FROM pages""",
    "null_tokens": f"""
SELECT c_custkey, CASE WHEN s IN ({_TOKENS}) THEN NULL ELSE s END AS segment
FROM (SELECT c_custkey, {_SEGMENT} AS s FROM customer)""",
    "fill_missing": f"""
SELECT c_custkey, coalesce(t, '') AS segment_filled, nullif(coalesce(t, ''), '') AS segment_back
FROM (SELECT c_custkey, CASE WHEN s IN ({_TOKENS}) THEN NULL ELSE s END AS t
      FROM (SELECT c_custkey, {_SEGMENT} AS s FROM customer))""",
    "empty_to_null": """
SELECT c_custkey, nullif(CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' ELSE c_name END, '') AS name_or_null
FROM customer""",
    "date_strict": "SELECT o_orderkey, strftime(o_orderdate, '%m-%d-%Y') AS order_date FROM orders",
    "date_lenient": """
SELECT event_id, CASE WHEN event_id % 13 IN (0, 1) THEN NULL ELSE strftime(ts, '%m-%d-%Y') END AS event_date
FROM events""",
    "time_strict": "SELECT event_id, strftime(ts, '%H:%M') AS event_time FROM events",
    "digits_only": """
SELECT c_custkey, nullif(regexp_replace(c_name, '\\D', '', 'g'), '') AS phone,
       regexp_replace(CAST(c_custkey AS VARCHAR), '\\D', '', 'g') AS key_digits
FROM customer""",
    "name_parts": f"""
SELECT p_partkey,
       {_family('p_name')} AS family, {_given('p_name')} AS given,
       {_family("(p_brand || '  ' || p_name)")} AS family_spaced,
       {_given("(p_brand || '  ' || p_name)")} AS given_spaced,
       {_family('p_type')} AS family_single, {_given('p_type')} AS given_single
FROM part""",
    "message_text": f"""
SELECT o_orderkey,
       'Load finished - visits - Status: ' || status AS subject,
       'The load visits has ' || status || ' for file ' || file || '.' ||
       CASE WHEN status = 'SUCCEEDED' THEN '' ELSE ' Error: ' || coalesce(error, 'No error message provided') END
         AS message
FROM (SELECT o_orderkey, {_ORDER_STATE.format(open='FAILED')} AS status,
             'visit_' || CAST(o_orderkey AS VARCHAR) || '.txt' AS file,
             CASE WHEN starts_with(o_orderpriority, '1-') THEN NULL ELSE o_orderpriority END AS error
      FROM orders)""",
    "route_feed": """
SELECT page_id,
       CASE WHEN starts_with(url, 'http://blog.') THEN 'blog'
            WHEN starts_with(url, 'https://m.') THEN 'mobile'
            WHEN starts_with(url, 'https://') THEN 'secure'
            WHEN starts_with(url, 'ftp://') THEN 'files' END AS route
FROM pages""",
    "terminal_state": f"""
SELECT o_orderkey, state, state IN ('SUCCEEDED', 'FAILED', 'STOPPED') AS terminal
FROM (SELECT o_orderkey, {_ORDER_STATE.format(open='RUNNING')} AS state FROM orders)""",
    "count_rows": "SELECT count(*) AS rows_read FROM orders",
    "reconcile": f"""
SELECT 'visits' AS feed, '{FN['visits']}' AS file, 'SUCCEEDED' AS status, count(*) AS rows_read,
       CAST(0 AS BIGINT) AS rows_quarantined, count(*) AS rows_target, true AS content_equal
FROM orders""",
    "head_rows": f"""
SELECT * FROM ({VISITS}) ORDER BY "Visit ID" LIMIT 10""",
    "long_rows": """
SELECT CAST(o_orderkey AS VARCHAR) AS visit_id,
       CASE WHEN o_orderkey % 50 = 0 THEN 'long_row' ELSE 'loaded' END AS outcome,
       CASE WHEN o_orderkey % 50 = 0
            THEN CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|'
                 || o_orderpriority || '|extra' END AS raw_record
FROM orders""",
    "strict_utf8": """
SELECT count(*) FILTER (WHERE l_orderkey % 97 = 0 AND l_linenumber = 1) AS bad_lines, count(*) AS lines
FROM lineitem""",
    "load_audit": f"""
SELECT 'demographics' AS feed, '{FN['demographics']}' AS file, 'SUCCEEDED' AS status,
       count(*) AS rows_read, count(*) AS rows_target, CAST(NULL AS VARCHAR) AS error_type,
       'The load demographics has SUCCEEDED for file {FN['demographics']}.' AS message,
       count(*) FILTER (WHERE c_custkey % 17 = 0) AS lost_dates, CAST(0 AS BIGINT) AS lost_phones
FROM customer
UNION ALL
SELECT 'providers', '{FN['providers_bad']}', 'FAILED', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'DataError',
       'The load providers has FAILED for file {FN['providers_bad']}. Error: load check failed: feed providers, column Start Date: unreadable date', NULL, NULL
UNION ALL
SELECT 'providers', '{FN['providers_missing']}', 'FAILED', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
       'SourceMissing', 'The load providers has FAILED for file {FN['providers_missing']}. Error: source not found', NULL, NULL
UNION ALL
SELECT 'appointments', '{FN['visits']}', 'FAILED', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'HeaderError',
       'The load appointments has FAILED for file {FN['visits']}. Error: missing required columns: '
       || '[''Appointment Time'', ''Appointment Date'', ''Provider Name'']', NULL, NULL""",
    "line_ends": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       nullif(replace(text, chr(10), CASE WHEN doc_id % 2 = 0 THEN chr(13) || chr(10) ELSE chr(13) END), '') AS text
FROM documents""",
    "quoted_breaks": f"""
SELECT 'visits' AS feed, '{FN['visits_breaks']}' AS file, 'FAILED' AS status, CAST(NULL AS BIGINT) AS rows_target,
       CAST(count(*) AS VARCHAR) || ' lines hold a quoted field with a line break; load feed visits with multi_line=True' AS error
FROM orders WHERE o_orderkey % 64 = 1
UNION ALL
SELECT 'visits', '{FN['visits_breaks']}', 'SUCCEEDED', count(*), NULL FROM orders""",
    "pointer_by_arrival": RX_ORDERS,
    "dead_letters": """
SELECT 'providers' AS feed, 'ERROR' AS status, CAST(n AS INTEGER) AS attempt, count(*) AS rows_target, true AS given_up
FROM part, range(1, 4) AS tries(n) GROUP BY n
UNION ALL SELECT 'providers', 'DEAD', 3, NULL, true
UNION ALL SELECT 'visits', 'SUCCEEDED', 1, count(*), false FROM orders""",
    "audit_epochs": """
SELECT 'visits' AS feed, 'SUCCEEDED' AS status, CAST(2 AS BIGINT) AS loads, CAST(2 * count(*) AS BIGINT) AS rows_target FROM orders
UNION ALL SELECT 'providers', 'SUCCEEDED', 1, count(*) FROM part
UNION ALL SELECT 'demographics', 'SUCCEEDED', 1, count(*) FROM customer""",
    "whole_drops": f"""
SELECT '{FN['visits_wave'].format(wave='w1')}' AS file, 'SUCCEEDED' AS status, count(*) AS rows_target FROM orders
UNION ALL SELECT '{FN['visits_wave'].format(wave='w2')}', 'HELD', NULL""",
    "file_intake": f"""
SELECT {VISITS_COLUMNS},
       'w3' AS "Wave",
       '{STAMP}' AS "Load Timestamp",
       '{FN['visits_wave'].format(wave='w3')}' AS "File Name"
FROM orders""",
    "latest_wins": f"""
SELECT 'visits' AS feed, '{FN['visits_wave'].format(wave='w1')}' AS file, 'SUPERSEDED' AS status,
       CAST(NULL AS BIGINT) AS rows_read, CAST(NULL AS BIGINT) AS rows_target
UNION ALL
SELECT 'visits', '{FN['visits_wave'].format(wave='w2')}', 'SUCCEEDED', count(*), count(*) FROM orders
UNION ALL
SELECT 'visits', '{FN['visits_wave'].format(wave='w3')}', 'SUCCEEDED', count(*), count(*) FROM orders""",
}
