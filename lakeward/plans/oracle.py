"""DuckDB SQL that computes, independently, what each registered query in
:mod:`lakeward.plans.catalog` must return (same column names)."""

from __future__ import annotations

from . import flows, rules

_ISO = (
    "CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
    "ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END"
)


def _iso(c: str) -> str:
    return _ISO.format(c=c)


def _not_null_row(col: str, var: str, aliased: bool = False) -> str:
    name, ok, msg = (" AS check_name", " AS passed", " AS message") if aliased else ("", "", "")
    return (
        f"SELECT 'not_null:{col}'{name}, {var} = 0{ok}, CASE WHEN {var} = 0 THEN '''{col}'' OK' "
        f"ELSE '''{col}'' has ' || CAST({var} AS VARCHAR) || ' null(s)' END{msg} FROM a"
    )


_ORDERS_SUITE = f"""
WITH src AS (
  SELECT o_orderkey, o_custkey, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders
), a AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE o_orderkey IS NULL) AS nk,
         count(*) FILTER (WHERE o_custkey IS NULL) AS nc,
         count(*) FILTER (WHERE o_orderpriority IS NULL) AS np,
         (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM src)) AS nd
  FROM src
)
SELECT 'schema' AS check_name, true AS passed, 'Schema OK' AS message FROM a
UNION ALL SELECT 'row_count', n >= 1, CAST(n AS VARCHAR) || ' rows (minimum 1)' FROM a
UNION ALL {_not_null_row('o_orderkey', 'nk')}
UNION ALL {_not_null_row('o_custkey', 'nc')}
UNION ALL {_not_null_row('o_orderpriority', 'np')}
UNION ALL SELECT 'no_duplicates:[''o_orderkey'']', n - nd = 0,
  CASE WHEN n - nd = 0 THEN 'No duplicates on [''o_orderkey'']'
       ELSE CAST(n - nd AS VARCHAR) || ' duplicate row(s) on [''o_orderkey'']' END FROM a
"""

_NOT_NULL = f"""
WITH a AS (
  SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS nk,
         count(*) FILTER (WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL) AS np
  FROM orders)
{_not_null_row('o_orderkey', 'nk', aliased=True)}
UNION ALL {_not_null_row('o_orderpriority', 'np')}
UNION ALL SELECT 'not_null:o_comment', false, 'Column ''o_comment'' not found'
"""

_NULL_RATE = """
WITH a AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL) AS k FROM orders
), r AS (SELECT CAST(k AS DOUBLE) / greatest(n, 1) AS rate FROM a)
SELECT 'null_rate:o_orderpriority' AS check_name, rate <= 0.25 AS passed,
  '''o_orderpriority'' null rate ' || printf('%.2f', rate * 100) || '% (max 25.00%)' AS message FROM r
UNION ALL
SELECT 'null_rate:o_orderpriority', rate <= 0.1,
  '''o_orderpriority'' null rate ' || printf('%.2f', rate * 100) || '% (max 10.00%)' FROM r
"""

_NO_DUPLICATES = """
WITH a AS (
  SELECT count(*) AS n,
         (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS nd
  FROM lineitem
)
SELECT 'no_duplicates:[''l_orderkey'', ''l_linenumber'']' AS check_name, n = nd AS passed,
  CASE WHEN n = nd THEN 'No duplicates on [''l_orderkey'', ''l_linenumber'']'
       ELSE CAST(n - nd AS VARCHAR) || ' duplicate row(s) on [''l_orderkey'', ''l_linenumber'']' END AS message
FROM a
UNION ALL SELECT 'row_count', n >= 1, CAST(n AS VARCHAR) || ' rows (minimum 1)' FROM a
"""

_LINEITEM_FIRST = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
             l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
             l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
  FROM lineitem)
WHERE rn = 1
"""

_SANITIZE_TEXT = (
    "CASE WHEN lower(regexp_replace(replace({c}, chr(0), ''), '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')) "
    "IN ('nan', 'nat') THEN NULL ELSE replace({c}, chr(0), '') END"
)

_SANITIZE = f"""
WITH src AS (
  SELECT o_orderkey, o_orderstatus,
         CASE o_orderpriority WHEN '5-LOW' THEN ' NaN' || chr(9)
                              WHEN '4-NOT SPECIFIED' THEN 'NaT'
                              WHEN '1-URGENT' THEN chr(160) || 'nan'
                              ELSE o_orderpriority END AS p,
         o_orderdate, o_totalprice
  FROM orders)
SELECT o_orderkey,
       {_SANITIZE_TEXT.format(c='o_orderstatus')} AS o_orderstatus,
       {_SANITIZE_TEXT.format(c='p')} AS o_orderpriority,
       {_iso('o_orderdate')} AS o_orderdate,
       CASE WHEN isnan(o_totalprice) THEN NULL ELSE o_totalprice END AS o_totalprice
FROM src
"""


def _allow(pattern: str) -> str:
    return (
        f"(regexp_matches(rel, '{pattern}') AND strpos(ltrim(substr(rel, "
        f"length(regexp_extract(rel, '^(?s:.*?)(?:{pattern})', 0)) + 1), '/'), '/') = 0)"
    )


_ALLOWLIST = f"""
WITH p AS (SELECT page_id, url, starts_with(url, 'https://') AS inside, substr(url, 9) AS rel FROM pages)
SELECT page_id, url FROM p
WHERE NOT inside
   OR {_allow('example\\.com/en/')}
   OR {_allow('^blog\\.[a-z]+\\.example\\.org/')}
   OR {_allow('/fr/')}
"""

_MESSAGES = """
SELECT event_id AS message_id, CAST(ts AS DATE) AS date,
       'user' || CAST(user_id AS VARCHAR) || '@reports.example.org' AS sender,
       'Daily report ' || event_type AS subject,
       'report_' || CAST(event_id AS VARCHAR) || '.CSV' AS filename,
       'event_id,user_id,event_type' || chr(10) || CAST(event_id AS VARCHAR) || ',' ||
         CAST(user_id AS VARCHAR) || ',' || event_type || chr(10) AS payload_text
FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type = 'purchase'
"""

_MAILED = """
SELECT event_id, user_id, event_type FROM (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
         row_number() OVER (
           PARTITION BY user_id, event_type
           ORDER BY CAST(event_id AS VARCHAR) || '/0/report_' || CAST(event_id AS VARCHAR) ||
                    CASE WHEN event_type = 'purchase' THEN '.CSV' ELSE '.csv' END) AS rn
  FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15')
WHERE rn = 1
"""

_RESPONSES = """
WITH r AS (
  SELECT 'event/' || CAST(event_id AS VARCHAR) AS call_id,
         CASE WHEN event_type = 'error' THEN 204 ELSE 200 END AS status,
         'application/json; charset=utf-8' AS content_type,
         CASE WHEN event_type = 'error' THEN '' ELSE props END AS body
  FROM events
  UNION ALL SELECT 'page/' || CAST(page_id AS VARCHAR), 200, 'text/html', html FROM pages
  UNION ALL SELECT 'doc/' || CAST(doc_id AS VARCHAR), 200, 'Application/JSON', text FROM documents
), k AS (
  SELECT call_id, status, body,
    CASE WHEN status = 204 OR body IS NULL OR length(body) = 0 THEN 'no_content'
         WHEN NOT contains(lower(coalesce(content_type, '')), 'application/json') THEN 'text'
         WHEN json_valid(body) THEN 'json'
         ELSE 'invalid_json' END AS kind
  FROM r)
SELECT call_id, status, kind,
       CASE WHEN kind = 'json' THEN CAST(json_extract(body, '$.k') AS BIGINT) END AS payload_k,
       md5(CASE WHEN kind IN ('text', 'invalid_json') THEN body END) AS text_md5
FROM k
"""

ORACLE_SQL: dict[str, str] = {
    "validate_dataframe": _ORDERS_SUITE,
    "check_not_null": _NOT_NULL,
    "landing_flow": _ORDERS_SUITE,
    "bronze_promotion": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, 'run-20240101' AS _run_id
FROM orders
""",
    "check_null_rate": _NULL_RATE,
    "check_no_duplicates": _NO_DUPLICATES,
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "relationships": """
SELECT * FROM lineitem l
WHERE l.l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
""",
    "column_stats": """
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey__nulls, min(o_orderkey) AS o_orderkey__min, max(o_orderkey) AS o_orderkey__max,
  count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey__nulls, min(o_custkey) AS o_custkey__min, max(o_custkey) AS o_custkey__max,
  count(*) FILTER (WHERE o_totalprice IS NULL) AS o_totalprice__nulls, min(o_totalprice) AS o_totalprice__min, max(o_totalprice) AS o_totalprice__max,
  count(*) FILTER (WHERE o_orderdate IS NULL) AS o_orderdate__nulls, min(o_orderdate) AS o_orderdate__min, max(o_orderdate) AS o_orderdate__max,
  count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority__nulls, min(o_orderpriority) AS o_orderpriority__min, max(o_orderpriority) AS o_orderpriority__max
FROM orders
""",
    "remove_duplicates": _LINEITEM_FIRST,
    "silver_lineitem": f"""
SELECT l_orderkey AS l_order_key, l_partkey AS l_part_key, l_suppkey AS l_supp_key, l_linenumber, l_quantity,
       l_extendedprice, l_discount, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END AS l_tax, l_returnflag,
       l_linestatus, l_shipdate
FROM ({_LINEITEM_FIRST.strip()}) AS first_rows
""",
    "silver_rejects": """
SELECT CAST(l_orderkey AS VARCHAR) AS l_order_key, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       'l_tax' AS "column", 'n/a' AS "value", 'double' AS "type"
FROM lineitem WHERE l_returnflag = 'R'
""",
    "latest_run": """
SELECT event_type, run_date, event_id, ts, user_id, value FROM (
  SELECT *, CAST(ts AS DATE) AS run_date,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
""",
    "upsert_partial": """
WITH t AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_orderdate
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_custkey
), b AS (
  SELECT o_custkey, max(o_orderdate) AS last_orderdate, max(o_orderpriority) AS top_priority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY o_custkey
)
SELECT CASE WHEN b.o_custkey IS NOT NULL THEN b.o_custkey ELSE t.o_custkey END AS o_custkey,
       t.n_orders,
       CASE WHEN b.o_custkey IS NOT NULL THEN b.last_orderdate ELSE t.last_orderdate END AS last_orderdate,
       b.top_priority
FROM t FULL OUTER JOIN b ON t.o_custkey = b.o_custkey
""",
    "last_per_user": """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""",
    "flatten_nested": """
SELECT o_orderstatus AS status, o_totalprice AS total, o_orderkey AS order__key,
       o_orderdate AS order__meta__date, o_orderpriority AS order__meta__priority, o_custkey AS customer__key
FROM orders
""",
    "strict_payloads": """
WITH r AS (
  SELECT 'event/' || CAST(event_id AS VARCHAR) AS call_id,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, event_type, props
  FROM events)
SELECT call_id, 0 AS element, CAST(json_extract(props, '$.k') AS BIGINT) AS k, true AS valid
FROM r WHERE status = 200
UNION ALL
SELECT call_id, 1, CAST(json_extract(props, '$.k') AS BIGINT), true FROM r WHERE event_type = 'purchase'
UNION ALL
SELECT call_id, NULL, NULL, false FROM r WHERE status <> 200
UNION ALL
SELECT 'page/' || CAST(page_id AS VARCHAR), NULL, NULL, false FROM pages
""",
    "file_stats": """
SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows,
       min(l_orderkey) AS l_orderkey__min, max(l_orderkey) AS l_orderkey__max,
       min(l_shipdate) AS l_shipdate__min, max(l_shipdate) AS l_shipdate__max
FROM lineitem
""",
    "append_evolve": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS VARCHAR) END AS o_orderdate,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders
""",
    "upsert_table": """
WITH t AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_orderdate
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_custkey
), b AS (
  SELECT o_custkey, max(o_orderdate) AS last_orderdate, max(o_orderpriority) AS top_priority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY o_custkey
)
SELECT CAST(coalesce(b.o_custkey, t.o_custkey) AS VARCHAR) AS o_custkey,
       CAST(t.n_orders AS VARCHAR) AS n_orders,
       CAST(CASE WHEN b.o_custkey IS NOT NULL THEN b.last_orderdate ELSE t.last_orderdate END AS VARCHAR) AS last_orderdate,
       b.top_priority
FROM t FULL OUTER JOIN b ON t.o_custkey = b.o_custkey
""",
    "union_by_name": """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""",
    "flatten_records": """
SELECT event_id, ts, user_id, event_type, value, json_extract_string(props, '$.k') AS props__k FROM events
""",
    "sanitize_values": _SANITIZE,
    "iso_text": f"SELECT event_id, {_iso('ts')} AS ts_iso FROM events",
    "positional_rename": """
SELECT l_orderkey AS order_key, l_partkey AS col_1, l_suppkey AS col_2, l_linenumber AS line_number,
       l_quantity AS quantity, l_extendedprice AS col_5, l_discount AS col_6, l_tax AS col_7,
       l_returnflag AS col_8, l_linestatus AS col_9, l_shipdate AS col_10
FROM lineitem
""",
    "cast_text": """
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations
""",
    "constraint_name": """
WITH s AS (
  SELECT p_partkey,
         regexp_replace('uq_' || p_type || '_' || concat_ws('_', p_brand, p_name), '[^\\w]', '_', 'g') AS s
  FROM part)
SELECT p_partkey, substr(s, 1, 54) || '_' || substr(sha1(s), 1, 8) AS constraint_name FROM s
""",
    "landing_paths": """
SELECT event_id, path, event_type AS source, 'events' AS entity, CAST(ts AS DATE) AS run_date,
       'run' || CAST(event_id AS VARCHAR) AS run_id
FROM (SELECT *, 'data-lake/' || event_type || '/events/' || strftime(ts, '%Y/%m/%d') || '/run' ||
               CAST(event_id AS VARCHAR) || '.parquet' AS path FROM events)
""",
    "row_checksum": f"""
SELECT o_orderkey,
       md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                     {_iso('o_orderdate')}, o_orderpriority)) AS row_md5
FROM orders
""",
    "allowlist_paths": _ALLOWLIST,
    "message_select": _MESSAGES,
    "mailed_reports": _MAILED,
    "response_classify": _RESPONSES,
    "zip_reports": """
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role,
       'turn_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.CSV' AS member
FROM conversations
""",
    "source_watermark": "SELECT count(*) AS n_rows, min(ts) AS min_ts, max(ts) AS watermark FROM events",
    "gold_region_orders": """
SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, year(o_orderdate)
""",
    **flows.SQL,
    **rules.SQL,
}
