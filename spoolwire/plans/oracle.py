"""DuckDB SQL computing what each registered query must return (tables are views)."""

from __future__ import annotations

# The events topic: partition = event_id mod 3, offsets in event_id order, JSON of string fields.
_EV = """
WITH ev AS (
  SELECT event_id, event_type, ts,
         (event_id % 3)::INTEGER AS "partition",
         row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS "offset",
         to_json(struct_pack(event_id := event_id::VARCHAR, ts := ts::VARCHAR, user_id := user_id::VARCHAR,
                 event_type := event_type, value := value::VARCHAR, props := props))::VARCHAR AS v,
         event_id::VARCHAR AS s_event_id, ts::VARCHAR AS s_ts, user_id::VARCHAR AS s_user_id,
         value::VARCHAR AS s_value, props
  FROM events)
"""

_EVENT_FIELDS = (
    "s_event_id AS event_id, s_ts AS ts, s_user_id AS user_id, event_type, s_value AS value, props"
)

_CUSTOMER = (
    "SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, "
    "c_acctbal::VARCHAR AS c_acctbal, c_mktsegment FROM customer"
)

_RAGGED = """
SELECT
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_custkey::VARCHAR END AS c_custkey,
  CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN ''
       WHEN c_mktsegment = 'MACHINERY' THEN c_name || ', "' || c_mktsegment || '"'
       ELSE c_name END AS c_name,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_nationkey::VARCHAR END AS c_nationkey,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' WHEN c_mktsegment = 'BUILDING' THEN NULL
       ELSE c_acctbal::VARCHAR END AS c_acctbal,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' WHEN c_mktsegment = 'BUILDING' THEN NULL
       ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN to_json([c_name, ''])::VARCHAR
       WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0 THEN to_json(['', ''])::VARCHAR ELSE NULL END AS _overflow
FROM customer
"""

_ORDER_FIELDS = (
    "o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, "
    "o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority"
)

_EVENT_SCHEMA = "OBJECT<event_id: STRING, event_type: STRING, props: STRING, ts: STRING, user_id: STRING, value: STRING>"

def _binary_wire() -> str:
    """Builds the bytes of every document's record (as hex) and reads its fields back from them."""
    fields = ["doc_id::VARCHAR", "text", "nullif(lang, 'en')", "source", "n_chars::VARCHAR"]
    one = "CASE WHEN {0} IS NULL THEN 'FFFFFFFF' ELSE format('{{:08X}}', octet_length(encode({0}))) || hex(encode({0})) END"
    wire = " || ".join(one.format(f) for f in fields)
    sql = f"""
WITH w0 AS (
  SELECT (doc_id % 3)::INTEGER AS "partition", row_number() OVER (PARTITION BY doc_id % 3 ORDER BY doc_id) - 1 AS "offset",
         {wire} AS h, 1 AS p FROM documents)"""
    for k, name in enumerate(["doc_id", "text", "lang", "source", "n_chars"]):
        sql += f""",
w{k + 1} AS (
  SELECT * REPLACE (p + 8 + 2 * coalesce(n, 0) AS p) RENAME (n AS n{k}), decode(unhex(substr(h, p + 8, 2 * n))) AS {name}
  FROM (SELECT *, CASE substr(h, p, 8) WHEN 'FFFFFFFF' THEN NULL ELSE ('0x' || substr(h, p, 8))::BIGINT END AS n FROM w{k}))"""
    return sql + """
SELECT "partition", "offset", md5(unhex(h)) AS value_md5, doc_id, text, lang, source, n_chars FROM w5"""


ORACLE: dict[str, str] = {
    "ingest_roundtrip": (
        "SELECT NULL::VARCHAR AS key, o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, "
        "o_orderstatus, o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, "
        "o_orderpriority FROM orders"
    ),
    "ingest_lineitem": (
        "SELECT NULL::VARCHAR AS key, l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey, "
        "l_suppkey::VARCHAR AS l_suppkey, l_linenumber::VARCHAR AS l_linenumber, "
        "l_quantity::VARCHAR AS l_quantity, l_extendedprice::VARCHAR AS l_extendedprice, "
        "l_discount::VARCHAR AS l_discount, l_tax::VARCHAR AS l_tax, l_returnflag, l_linestatus, "
        "l_shipdate::VARCHAR AS l_shipdate FROM lineitem"
    ),
    "csv_scan": _CUSTOMER,
    "csv_documents": (
        "SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars FROM documents"
    ),
    "csv_documents_split": (
        "SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars FROM documents"
    ),
    "csv_ragged": _RAGGED,
    "header_record": (
        "SELECT 'c_custkey' AS c_custkey, 'c_name' AS c_name, 'c_nationkey' AS c_nationkey, "
        "'c_acctbal' AS c_acctbal, 'c_mktsegment' AS c_mktsegment UNION ALL " + _CUSTOMER
    ),
    "drop_empty": f"SELECT * FROM ({_RAGGED}) WHERE c_custkey <> '' OR _overflow IS NOT NULL",
    "load_report": (
        "SELECT 'data' AS topic, count(*) AS rows_in, "
        "count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD' OR c_custkey % 2 = 0) AS rows_sent, "
        "count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 1) AS rows_skipped, "
        "count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE' OR c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0) AS rows_long, "
        "'ok' AS status FROM customer"
    ),
    "upload_ragged": f"""
SELECT CASE WHEN _overflow IS NULL
  THEN to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_nationkey := c_nationkey,
                           c_acctbal := c_acctbal, c_mktsegment := c_mktsegment))::VARCHAR
  ELSE to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_nationkey := c_nationkey, c_acctbal := c_acctbal,
                           c_mktsegment := c_mktsegment, "null" := from_json(_overflow, '["VARCHAR"]')))::VARCHAR END AS value
FROM ({_RAGGED}) WHERE c_custkey <> '' OR _overflow IS NOT NULL""",
    "csv_messy": """
SELECT c_custkey::VARCHAR || CASE WHEN c_custkey % 7 IN (1, 2) THEN '" x' ELSE '' END AS id,
  CASE c_custkey % 7 WHEN 2 THEN 'first ' || c_name || chr(10) || 'second' WHEN 3 THEN 'x' || chr(13) || 'y'
    WHEN 6 THEN 'say "hi", ' || c_name ELSE c_name END AS a,
  CASE c_custkey % 7 WHEN 2 THEN '7"' ELSE c_mktsegment END AS b
FROM customer
UNION ALL SELECT '   ', NULL, NULL FROM customer WHERE c_custkey % 7 = 4""",
    "upload_messy": """
SELECT NULL::VARCHAR AS key, c_custkey::VARCHAR AS id, c_name AS a, c_mktsegment AS b FROM customer
UNION ALL
SELECT NULL, CASE c_custkey % 6 WHEN 1 THEN chr(9) WHEN 2 THEN chr(12) WHEN 3 THEN chr(1) ELSE ' ' || chr(9) || ' ' END, NULL, NULL
FROM customer WHERE c_custkey % 6 BETWEEN 1 AND 4""",
    "upload_in_order": f"""
WITH o AS (SELECT {_ORDER_FIELDS}, row_number() OVER (ORDER BY orders.o_orderkey) - 1 AS rn,
                  count(*) OVER () // 3 AS q, count(*) OVER () % 3 AS r FROM orders),
p AS (SELECT *, (CASE WHEN rn < r * (q + 1) THEN rn // (q + 1) ELSE r + (rn - r * (q + 1)) // greatest(q, 1) END)::INTEGER AS "partition" FROM o)
SELECT "partition", rn - ("partition" * q + least("partition", r)) AS "offset",
  to_json(struct_pack(o_orderkey := o_orderkey, o_custkey := o_custkey, o_orderstatus := o_orderstatus,
    o_totalprice := o_totalprice, o_orderdate := o_orderdate, o_orderpriority := o_orderpriority))::VARCHAR AS value
FROM p""",
    "source_numbers": f"""
SELECT row_number() OVER (ORDER BY orders.o_orderkey) AS record_no,
       row_number() OVER (PARTITION BY orders.o_orderkey // 8192 ORDER BY orders.o_orderkey) AS file_record_no, {_ORDER_FIELDS}
FROM orders""",
    "source_head": f"""
SELECT row_number() OVER (ORDER BY orders.o_orderkey) AS record_no, {_ORDER_FIELDS}
FROM orders ORDER BY orders.o_orderkey LIMIT 5""",
    "missing_source": """
SELECT count(*) AS rows_in, count(*) AS rows_sent, 'ok' AS status, NULL::VARCHAR AS error FROM customer
UNION ALL SELECT NULL, NULL, 'failed', 'SourceNotFound'""",
    "utf8_locate": _EV
    + """, l AS (
  SELECT event_id // 5000 AS file_no, event_type, v, strlen(v) AS n,
         row_number() OVER w AS line, sum(strlen(v) + 1 + (event_type = 'error')::INTEGER) OVER w AS upto
  FROM ev WINDOW w AS (PARTITION BY event_id // 5000 ORDER BY event_id))
SELECT file_no, line, (upto - 2)::BIGINT AS byte, left(v || chr(65533), 100) AS text FROM l WHERE event_type = 'error'""",
    "envelope": _EV + 'SELECT "partition", "offset", v AS value FROM ev',
    "topic_range": _EV
    + 'SELECT "partition", "offset", v AS value FROM ev '
    'WHERE NOT ("partition" = 0 AND "offset" < 100) AND NOT ("partition" = 1 AND "offset" < 200) '
    'AND NOT ("partition" = 2 AND "offset" >= 3000)',
    "parse_records": _EV + f"SELECT NULL::VARCHAR AS key, {_EVENT_FIELDS} FROM ev",
    "quarantine": _EV
    + """SELECT "partition", "offset",
       CASE WHEN event_type = 'error' THEN NULL ELSE s_event_id END AS event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE s_ts END AS ts,
       CASE WHEN event_type = 'error' THEN NULL ELSE s_user_id END AS user_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE s_value END AS value,
       CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props,
       CASE WHEN event_type = 'error' THEN left(v, length(v) - 1) END AS _corrupt_record
FROM ev""",
    "quarantine_good": _EV
    + f"""SELECT "partition", "offset", {_EVENT_FIELDS} FROM ev WHERE event_type <> 'error'""",
    "parse_any": _EV
    + f"""SELECT "partition", "offset", s_event_id AS event_id, json_extract(props, '$.k')::BIGINT AS k,
       '{_EVENT_SCHEMA}' AS json_schema FROM ev""",
    "positions": _EV + 'SELECT "partition", "offset", NULL::VARCHAR AS key, v AS value FROM ev',
    "utf8_check": _EV + """SELECT "partition", "offset", event_type <> 'error' AS ok FROM ev""",
    "utf8_audit": (
        "SELECT count(*) AS lines, count(*) FILTER (WHERE event_type = 'error') AS bad_lines FROM events"
    ),
    "text_prefix": (
        "SELECT doc_id::VARCHAR AS doc_id, length(text)::BIGINT AS chars, strlen(text)::BIGINT AS bytes, "
        "true AS utf8_ok, substr(text, 1, 100) AS head FROM documents"
    ),
    "progress": _EV
    + """, p AS (
  SELECT "partition", "offset" + 1 AS line_count, epoch_us(ts) AS us,
         min(epoch_us(ts)) OVER (PARTITION BY "partition") AS us0
  FROM ev)
SELECT "partition", line_count, round(line_count * 1000000.0::DOUBLE / nullif(us - us0, 0), 6) AS rps
FROM p WHERE line_count % 1000 = 0""",
    "first_records": _EV
    + 'SELECT "partition", "offset", "offset" + 1 AS record_no, v AS value FROM ev WHERE "offset" < 5',
    "progress_holes": _EV
    + """, p AS (
  SELECT "partition", row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS line_count, epoch_us(ts) AS us,
         min(epoch_us(ts)) OVER (PARTITION BY "partition") AS us0
  FROM ev WHERE event_type <> 'error')
SELECT "partition", line_count, round(line_count * 1000000.0::DOUBLE / nullif(us - us0, 0), 6) AS rps
FROM p WHERE line_count % 1000 = 0""",
    "first_records_holes": _EV
    + """, p AS (
  SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS record_no FROM ev WHERE event_type <> 'error')
SELECT "partition", "offset", record_no, v AS value FROM p WHERE record_no <= 5""",
    "console_preview": _EV
    + f"""SELECT "partition", "offset", NULL::VARCHAR AS key, {_EVENT_FIELDS}
FROM ev ORDER BY "partition", "offset" LIMIT 20""",
    "schema_profile": _EV
    + f"""SELECT "partition", count(*) AS records, '{_EVENT_SCHEMA}' AS json_schema FROM ev GROUP BY 1""",
    "schema_drift": _EV
    + """, m AS (SELECT *, event_id % 11 = 0 AS broken FROM ev),
d AS (
  SELECT "partition", "offset", '$.uid' AS path, 'added' AS drift, NULL AS declared,
         CASE WHEN user_id IS NULL THEN 'VOID' ELSE 'STRING' END AS found
  FROM m JOIN events USING (event_id) WHERE event_id % 5 = 0 AND NOT broken
  UNION ALL SELECT "partition", "offset", '$.event_id', 'changed', 'STRING', 'BIGINT' FROM m WHERE event_id % 7 = 0 AND NOT broken
  UNION ALL SELECT "partition", "offset", '$', 'changed', 'OBJECT', 'MALFORMED' FROM m WHERE broken
  UNION ALL SELECT "partition", "offset", '$.user_id', 'missing', 'STRING', NULL FROM m WHERE event_id % 5 = 0 OR broken
  UNION ALL SELECT "partition", "offset", '$.' || c, 'missing', 'STRING', NULL
  FROM m, (SELECT unnest(['event_id', 'ts', 'event_type', 'value', 'props']) AS c) WHERE broken)
SELECT "partition", path, drift, declared, found, count(*) AS records, min("offset") AS first_offset FROM d GROUP BY ALL""",
    "offset_gaps": _EV
    + """, kept AS (
  SELECT "partition", "offset",
         lead("offset") OVER (PARTITION BY "partition" ORDER BY "offset") AS next_offset
  FROM ev WHERE event_type <> 'error')
SELECT "partition", "offset", next_offset, next_offset - "offset" - 1 AS missing
FROM kept WHERE next_offset > "offset" + 1""",
    "missing_ranges": _EV
    + """, lost AS (
  SELECT "partition", "offset" FROM ev
  WHERE "partition" = 0 AND "offset" >= 500 OR "partition" = 1 AND event_type = 'error' OR "partition" = 2),
runs AS (SELECT *, "offset" - row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS run FROM lost)
SELECT "partition", min("offset") AS first_missing, max("offset") + 1 AS end_missing, count(*) AS missing
FROM runs GROUP BY "partition", run""",
    "keyed_publish": f"""
SELECT c_mktsegment AS key, to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_nationkey := c_nationkey,
  c_acctbal := c_acctbal, c_mktsegment := c_mktsegment))::VARCHAR AS value
FROM ({_CUSTOMER})""",
    "csv_wire": _EV + f'SELECT "partition", "offset", {_EVENT_FIELDS} FROM ev',
    "binary_wire": _binary_wire(),
    "topic_checked": _EV + 'SELECT "partition", "offset", v AS value FROM ev',
    "stream_from_offsets": _EV
    + 'SELECT "partition", "offset", v AS value FROM ev '
    'WHERE NOT ("partition" = 0 AND "offset" < 100) AND NOT ("partition" = 2 AND "offset" < 2500)',
    "stream_drain": _EV
    + 'SELECT "partition", "offset", NULL::VARCHAR AS key, v AS value, event_type FROM ev',
    "variant_fields": _EV + 'SELECT "partition", "offset", event_type, s_user_id AS user_id FROM ev',
    "stream_resume": _EV
    + """, halves AS (
  SELECT *, count(*) FILTER (event_id % 2 = 0) OVER (PARTITION BY "partition") AS n_even,
         row_number() OVER (PARTITION BY "partition", event_id % 2 ORDER BY event_id) - 1 AS rn
  FROM ev)
SELECT "partition", n_even + rn AS "offset", v AS value FROM halves WHERE event_id % 2 = 1""",
    "stream_quarantine": _EV
    + """SELECT "partition", "offset", event_type = 'error' AS quarantined,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN left(v, length(v) - 1) END AS _corrupt_record
FROM ev""",
}
ORACLE["stream_live_progress"] = ORACLE["progress"]
ORACLE["stream_gaps"] = ORACLE["offset_gaps"]
ORACLE["stream_once"] = ORACLE["envelope"]
ORACLE["stream_distinct"] = _EV + "SELECT v AS value FROM ev"
