"""Independent SQL for the registered queries, on the base tables only."""

from __future__ import annotations

from .queries import ORDER_KEY_SHIFT, STREAM_SLICES

# The change log as columns: what each event's envelope says, never its text.
LOG = """
log AS (
  SELECT event_id AS seq, ts, event_type, user_id,
         CAST(user_id AS VARCHAR) AS id,
         event_type || '_' || CAST(event_id AS VARCHAR) AS name,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS modify_time,
         'k' || regexp_extract(props, '"k": *([0-9]+)', 1) AS address,
         event_id % 50 = 7 AS malformed,
         event_type = 'error' AS deleted,
         CASE WHEN event_id % 10 = 9 THEN 'other_db'
              WHEN user_id % 4 = 3 THEN 'cdc_dev_db' ELSE 'cdc_test_db' END AS db,
         CASE WHEN event_id % 10 = 9 THEN 'x' WHEN event_id % 10 = 8 THEN 'unknown_tb'
              WHEN user_id % 4 = 0 THEN 'test_tb_01' WHEN user_id % 4 = 1 THEN 'test_tb_02'
              WHEN user_id % 4 = 2 THEN 'test_tb_no_time' ELSE 'dev_tb_01' END AS tb
  FROM events
),
outcome AS (
  SELECT *,
         CASE WHEN malformed OR deleted THEN '_reject' ELSE target END AS dest,
         CASE WHEN malformed THEN 'malformed' WHEN deleted THEN 'after_null'
              WHEN target = '_reject' THEN 'table_unmatched' END AS reject_reason
  FROM (SELECT *, CASE WHEN db = 'other_db' THEN '_unrouted' WHEN tb = 'unknown_tb' THEN '_reject'
                       WHEN tb IN ('test_tb_01', 'test_tb_02') THEN 'test_tb_union'
                       ELSE tb END AS target FROM log)
),
tb_union AS (
  SELECT seq, id, name, modify_time AS create_time, modify_time, tb
  FROM outcome WHERE dest = 'test_tb_union'
)
"""

DIMS = """
dims AS (SELECT id, name, modify_time, seq FROM tb_union WHERE name NOT LIKE 'purchase%'),
facts AS (SELECT id, name, seq FROM log WHERE event_type = 'purchase')
"""

VERSIONS = """
versions AS (SELECT *, seq AS valid_from, lead(seq) OVER (PARTITION BY id ORDER BY seq) AS valid_to
             FROM dims)
"""

NEW_ORDERS = f"""
later AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey + {ORDER_KEY_SHIFT} ELSE o_orderkey END
           AS o_orderkey,
         o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 50 <> 0
),
diff AS (
  SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
         CASE WHEN b.o_orderkey IS NULL THEN 'c' WHEN a.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op,
         b.o_totalprice AS old_price, a.o_totalprice AS new_price,
         CASE WHEN a.o_orderkey IS NULL THEN b.o_orderstatus ELSE a.o_orderstatus END AS o_orderstatus,
         CASE WHEN a.o_orderkey IS NULL THEN b.o_orderpriority ELSE a.o_orderpriority END
           AS o_orderpriority
  FROM orders b FULL OUTER JOIN later a ON a.o_orderkey = b.o_orderkey
  WHERE b.o_totalprice IS DISTINCT FROM a.o_totalprice
     OR b.o_orderkey IS NULL OR a.o_orderkey IS NULL
)
"""


def _decimal_bytes(column: str) -> str:
    unscaled = f"CAST(round({column} * 100) AS BIGINT)"
    return f"""to_base64(unhex(right(printf('%016X', {unscaled}), 2 * (CASE
        WHEN {unscaled} BETWEEN -128 AND 127 THEN 1
        WHEN {unscaled} BETWEEN -32768 AND 32767 THEN 2
        WHEN {unscaled} BETWEEN -8388608 AND 8388607 THEN 3
        WHEN {unscaled} BETWEEN -2147483648 AND 2147483647 THEN 4 ELSE 8 END))))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _latest(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (
        f" SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    )


def _stream_tables(deletes: bool) -> str:
    """Per table: the newest slice with the id, its greatest precombine row."""
    taken = "NOT malformed" if deletes else "NOT malformed AND NOT deleted"
    drop = "WHERE NOT deleted" if deletes else ""
    return _with(LOG) + f""",
    sliced AS (
      SELECT *, seq * {STREAM_SLICES} // ((SELECT max(event_id) FROM events) + 1) AS slice,
             CASE WHEN target = 'test_tb_no_time' THEN name ELSE modify_time END AS precombine
      FROM outcome WHERE {taken} AND target NOT IN ('_reject', '_unrouted')
    ),
    newest AS ({_latest("sliced", "target, id", "slice DESC, precombine DESC, seq DESC")})
    SELECT target AS dest, id, name,
           CASE WHEN target <> 'test_tb_no_time' THEN modify_time END AS create_time,
           CASE WHEN target <> 'test_tb_no_time' THEN modify_time END AS modify_time,
           CASE WHEN target = 'dev_tb_01' THEN address END AS address,
           strftime(date_trunc('week', ts), '%Y-%m-%d') AS logday, '12' AS hh
    FROM newest {drop}"""


CHECKS: dict[str, str] = {
    "customer_round_trip": """
        SELECT 'shop' AS db, 'customer' AS "table", 'r' AS op,
               CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
        FROM customer""",
    "customer_messages": """
        SELECT 'shop.customer.' || CAST(c_custkey AS VARCHAR) AS key,
               '{"before":null,"after":{"c_custkey":' || CAST(c_custkey AS VARCHAR)
               || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment
               || '"},"source":{"db":"shop","table":"customer"},"op":"r","ts_ms":0}' AS value
        FROM customer""",
    "decimal_text": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS price,
               CAST(CAST(l_discount AS DECIMAL(6,4)) AS VARCHAR) AS discount
        FROM lineitem""",
    "decimal_bytes": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {_decimal_bytes("c_acctbal")} AS balance,
               {_decimal_bytes("c_acctbal")} AS wide_balance
        FROM customer""",
    "generic_fields": _with(LOG) + """
        SELECT seq, db, tb AS "table", field,
               CASE field WHEN 'id' THEN id WHEN 'name' THEN name WHEN 'address' THEN address
                          ELSE modify_time END AS content
        FROM log, (VALUES ('id'), ('name'), ('create_time'), ('modify_time'), ('address')) f(field)
        WHERE NOT malformed AND NOT deleted""",
    "flat_facts": _with(LOG) + " SELECT seq, id, name FROM log WHERE event_type = 'purchase'",
    "line_pairs": """
        SELECT event_id AS seq,
               CASE WHEN event_type IN ('click', 'purchase') OR event_type NOT IN ('error', 'view')
                    THEN CAST(user_id AS VARCHAR) END AS id,
               CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS name,
               CASE WHEN event_type IN ('error', 'view') THEN 'malformed' END AS parse_error
        FROM events""",
    "include_list": _with(LOG) + """
        SELECT seq, db, tb AS "table", CASE WHEN deleted THEN 'd' ELSE 'c' END AS op
        FROM log WHERE NOT malformed AND (db = 'other_db' OR tb IN ('test_tb_01', 'test_tb_02'))""",
    "start_latest": _with(LOG) + """
        SELECT seq, db, tb AS "table" FROM log
        WHERE NOT malformed AND NOT deleted
          AND seq > (SELECT max(event_id) // 2 FROM events)""",
    "start_initial": _with(LOG) + """
        SELECT db, "table", op, count(*) AS changes FROM (
          SELECT DISTINCT user_id, 'cdc_test_db' AS db, 'users' AS "table", 'r' AS op FROM events
          UNION ALL
          SELECT user_id, CASE WHEN NOT malformed THEN db END, CASE WHEN NOT malformed THEN tb END,
                 CASE WHEN NOT malformed THEN CASE WHEN deleted THEN 'd' ELSE 'c' END END
          FROM log)
        GROUP BY db, "table", op""",
    "routing_outcomes": _with(LOG) + """
        SELECT dest, reject_reason, count(*) AS changes FROM outcome GROUP BY dest, reject_reason""",
    "rejected_texts": _with(LOG) + """, texts AS (
        SELECT *, '{"id":' || CASE WHEN turn = 13 THEN 'null' ELSE '"' || id || '"' END
               || ',"name":' || CASE WHEN turn = 12 THEN '{"x":1}' ELSE '"' || name || '"' END
               || ',"create_time":"' || modify_time || '","modify_time":"' || modify_time
               || '","address":"' || address || '"}' AS image
        FROM (SELECT *, seq % 60 AS turn FROM outcome)),
        judged AS (
        SELECT seq, CASE WHEN malformed THEN 'malformed' WHEN turn = 11 THEN 'source_missing'
                         WHEN deleted THEN 'after_null' WHEN target = '_unrouted' THEN 'unrouted'
                         WHEN target = '_reject' THEN 'table_unmatched' WHEN turn = 12 THEN 'projection'
                         WHEN turn = 13 THEN 'null_key' END AS outcome,
               CASE WHEN malformed THEN 'not json'
                    ELSE '{"before":' || CASE WHEN deleted THEN image ELSE 'null' END
                         || ',"after":' || CASE WHEN deleted THEN 'null' ELSE image END
                         || ',"source":{"db":"' || db || '",'
                         || CASE WHEN turn = 11 THEN '"tables":""' ELSE '"table":"' || tb || '"' END
                         || '},"op":"' || CASE WHEN deleted THEN 'd' ELSE 'c' END
                         || '","ts_ms":' || epoch_us(ts) // 1000 || '}' END AS value
        FROM texts)
        SELECT seq, CASE WHEN outcome = 'unrouted' THEN '_unrouted' ELSE '_reject' END AS dest,
               nullif(outcome, 'unrouted') AS reject_reason, value
        FROM judged WHERE outcome IS NOT NULL""",
    "shard_union": _with(LOG) + " SELECT seq, id, name, create_time, modify_time FROM tb_union",
    "shard_origin": _with(LOG)
    + _latest(
        "tb_union", "tb, id", "modify_time DESC, seq DESC",
        "seq, tb AS shard, id, name, create_time, modify_time",
    ),
    "dimension_rows": _with(LOG) + """
        SELECT seq, CASE WHEN tb = 'test_tb_01' THEN id ELSE 'null' END AS id,
               CASE WHEN tb = 'test_tb_01' THEN name ELSE 'null' END AS name,
               CASE WHEN tb = 'test_tb_01' THEN modify_time ELSE 'null' END AS create_time,
               CASE WHEN tb = 'test_tb_01' THEN modify_time ELSE 'null' END AS modify_time
        FROM log WHERE NOT malformed AND NOT deleted""",
    "shard_keys": _with(LOG) + """
        SELECT CASE WHEN malformed THEN '..'
                    ELSE db || '.' || tb || '.' || CASE WHEN deleted THEN '' ELSE id END END
                 AS partition_key, count(*) AS messages
        FROM log GROUP BY 1 UNION ALL SELECT '0', count(*) FROM log""",
    "message_order": _with(LOG) + """, keyed AS (
        SELECT CASE WHEN malformed THEN '..'
                    ELSE db || '.' || tb || '.' || CASE WHEN deleted THEN '' ELSE id END END
                 AS partition_key, seq FROM log)
        SELECT partition_key, seq,
               CAST(row_number() OVER (PARTITION BY partition_key ORDER BY seq) AS INTEGER) AS place
        FROM keyed""",
    "latest_union": _with(LOG)
    + _latest(
        "tb_union", "id", "modify_time DESC, seq DESC", "seq, id, name, create_time, modify_time"
    ),
    "latest_by_name": _with(LOG)
    + _latest(
        "(SELECT * FROM outcome WHERE dest = 'test_tb_no_time')", "id", "name DESC, seq DESC",
        "seq, id, name",
    ),
    "latest_lineitem": _latest(
        "lineitem", "l_orderkey, l_linenumber",
        "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
        "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC",
    ),
    "upsert_incoming": _with(LOG)
    + _latest(
        "tb_union", "id", "seq % 2, modify_time DESC, seq DESC",
        "seq, id, name, create_time, modify_time",
    ),
    "upsert_greatest": _with(LOG)
    + _latest(
        "tb_union", "id", "modify_time DESC, seq DESC", "seq, id, name, create_time, modify_time"
    ),
    "upsert_in_partitions": _latest(
        "(SELECT *, strftime(ts, '%Y-%m-%d') AS logday, strftime(ts, '%I') AS hh FROM events)",
        "user_id, logday, hh",
        "CASE WHEN event_type IN ('click', 'purchase') THEN 0 ELSE 1 END, ts DESC, event_id DESC",
    ),
    "upsert_deletes": f"""
        SELECT * FROM ({_latest("events", "user_id", "ts DESC, event_id DESC")})
        WHERE event_type <> 'error'""",
    "diff_orders": _with(NEW_ORDERS) + " SELECT o_orderkey, op, old_price, new_price FROM diff",
    "diff_applied": _with(NEW_ORDERS) + " SELECT * FROM later",
    "captured_orders": _with(NEW_ORDERS) + """
        SELECT op, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority
        FROM diff""",
    "purchase_temporal_join": _with(LOG, DIMS) + """
        SELECT f.id, f.name, f.seq, d.id AS id0, d.name AS name0, d.modify_time, d.seq AS seq0
        FROM facts f ASOF JOIN dims d ON f.id = d.id AND f.seq >= d.seq""",
    "purchase_temporal_left": _with(LOG, DIMS) + """
        SELECT f.id, f.name, f.seq, d.id AS id0, d.name AS name0, d.modify_time, d.seq AS seq0
        FROM facts f ASOF LEFT JOIN dims d ON f.id = d.id AND f.seq >= d.seq""",
    "error_temporal_join": """
        SELECT f.user_id, f.ts, f.event_id, d.event_id AS error_id
        FROM (SELECT * FROM events WHERE event_type <> 'error') f
        ASOF JOIN (SELECT * FROM events WHERE event_type = 'error') d
          ON f.user_id = d.user_id AND f.ts >= d.ts""",
    "dimension_versions": _with(LOG, DIMS, VERSIONS) + " SELECT * FROM versions",
    "dimension_as_of": _with(LOG, DIMS, VERSIONS) + """
        SELECT versions.* FROM versions, (SELECT max(event_id) // 2 AS moment FROM events)
        WHERE valid_from <= moment AND (valid_to IS NULL OR moment < valid_to)""",
    "stream_to_tables": _stream_tables(deletes=False),
    "stream_to_tables_deletes": _stream_tables(deletes=True),
    "stream_temporal_join": _with(LOG, DIMS) + """
        SELECT f.seq, f.id, f.name, d.seq AS seq0, d.id AS id0, d.name AS name0,
               d.modify_time AS create_time, d.modify_time
        FROM facts f
        ASOF JOIN (SELECT * FROM tb_union WHERE tb = 'test_tb_01' AND name NOT LIKE 'purchase%') d
          ON f.id = d.id AND f.seq >= d.seq""",
    "stream_lines_join": """
        SELECT f.event_id AS seq, CAST(f.user_id AS VARCHAR) AS id, f.event_type AS name,
               d.event_id AS seq0, CAST(d.user_id AS VARCHAR) AS id0, d.event_type AS name0
        FROM (SELECT * FROM events WHERE event_type = 'purchase') f
        ASOF JOIN (SELECT * FROM events WHERE event_type <> 'purchase') d
          ON f.user_id = d.user_id AND f.event_id >= d.event_id""",
    "stream_text_lines": """
        SELECT f.event_id // 4 AS moment, f.event_id AS seq, CAST(f.user_id % 3 AS VARCHAR) AS id,
               f.event_type AS name, d.event_id // 4 AS moment0, d.event_id AS seq0,
               CAST(d.user_id % 3 AS VARCHAR) AS id0, d.event_type AS name0
        FROM (SELECT * FROM events WHERE event_type = 'purchase') f
        ASOF JOIN (SELECT * FROM events WHERE event_type <> 'purchase') d
          ON f.user_id % 3 = d.user_id % 3 AND f.event_id >= d.event_id""",
    "captured_to_tables": _with(LOG)
    + _latest("tb_union", "id", "modify_time DESC, seq DESC", "id, name, create_time, modify_time"),
}

CHECKS["hot_temporal_left"] = CHECKS["purchase_temporal_left"]
CHECKS["hot_versions"] = CHECKS["dimension_versions"]
