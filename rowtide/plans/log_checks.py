"""Independent SQL for the queries of ``log_queries``, on the base tables only."""

from __future__ import annotations

from .checks import DIMS, LOG
from .log_queries import SNAPSHOT_PARTS

ORDER_LOG = """
order_log AS (
  SELECT event_id * 7919 % ((SELECT max(o_orderkey) FROM orders) // 4 + 50) * 4 + 1 AS o_orderkey,
         event_type AS o_orderstatus, value AS o_totalprice, event_id AS seq, event_type = 'error' AS gone
  FROM events
)
"""

CHECKS: dict[str, str] = {
    "snapshot_with_running_log": f"""WITH {ORDER_LOG}, both_sides AS (
        SELECT o_orderkey, o_orderstatus, o_totalprice, 0 AS seq, false AS gone FROM orders
        UNION ALL SELECT * FROM order_log), newest AS (
        SELECT * FROM both_sides QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
        SELECT CAST(parts AS INTEGER) AS parts, o_orderkey, o_orderstatus, o_totalprice
        FROM newest, (VALUES {", ".join(f"({n})" for n in SNAPSHOT_PARTS)}) p(parts) WHERE NOT gone""",
    "stream_state_join": f"""WITH {LOG}, {DIMS}
        SELECT f.id, f.name, f.seq, d.id AS id0, d.name AS name0, d.modify_time, d.seq AS seq0
        FROM facts f ASOF JOIN dims d ON f.id = d.id AND f.seq >= d.seq
        WHERE f.seq * 4 // ((SELECT max(event_id) FROM events) + 1) > 0""",
    "late_changes_after_deletes": """
        SELECT CAST(user_id AS VARCHAR) AS id, CASE WHEN event_type <> 'error' THEN event_type END AS name,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS modify_time
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "versions_kept_up": f"""WITH {LOG}, {DIMS}
        SELECT id, name, modify_time, modify_time AS valid_from,
               lead(modify_time) OVER (PARTITION BY id ORDER BY modify_time) AS valid_to
        FROM dims""",
    "log_completeness": """WITH kept AS (
        SELECT event_id FROM events WHERE event_id * 7919 % 101 >= 9 AND event_id % 1000 NOT BETWEEN 400 AND 520),
        log AS (SELECT event_id % 3 AS partition, event_id // 3 AS "offset" FROM (
            SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE event_id % 97 = 5)),
        seen AS (SELECT partition, "offset", count(*) AS n,
                        lag("offset") OVER (PARTITION BY partition ORDER BY "offset") AS before
                 FROM log GROUP BY partition, "offset")
        SELECT partition, 'missing' AS kind, before + 1 AS first, "offset" - 1 AS last, 0 AS copies
        FROM seen WHERE "offset" - before > 1
        UNION ALL SELECT partition, 'repeated', "offset", "offset", n FROM seen WHERE n > 1""",
    "diff_orders_by_range": """WITH later AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 1024 < 32 AND o_orderkey % 7 = 0 THEN o_totalprice + 1
                                ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE NOT (o_orderkey % 1024 < 32 AND o_orderkey % 5 = 0)
        UNION ALL SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderkey % 1024 < 4)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               CASE WHEN b.o_orderkey IS NULL THEN 'c' WHEN a.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op,
               b.o_totalprice AS old_price, a.o_totalprice AS new_price
        FROM orders b FULL JOIN later a ON a.o_orderkey = b.o_orderkey
        WHERE a.o_totalprice IS DISTINCT FROM b.o_totalprice""",
    "lineitem_count_changes": """SELECT l_orderkey, l_returnflag, l_quantity, CAST(sum(n) AS BIGINT) AS copies FROM (
        SELECT l_orderkey, l_returnflag, l_quantity, -1 AS n FROM lineitem WHERE l_partkey % 13 = 0
        UNION ALL SELECT l_orderkey, l_returnflag, l_quantity, 1 FROM lineitem WHERE l_suppkey % 17 = 0)
        GROUP BY ALL HAVING sum(n) <> 0""",
    "keys_on_shards": """SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS key, count(*) AS messages,
               CAST(sum(strlen(props)) AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS shards
        FROM events GROUP BY 1""",
    "request_limits": """SELECT count(*) AS messages, CAST(sum(strlen(props)) AS BIGINT) AS bytes,
               CAST(0 AS BIGINT) AS requests_over_limit, CAST(0 AS BIGINT) AS shards_over_bound FROM events""",
    "stream_once": """SELECT event_id AS seq, event_id % 3 AS partition, event_id // 3 AS "offset",
        event_type AS name FROM events""",
    "fields_over_time": """WITH log AS (
        SELECT user_id % 3 AS tb, event_id AS seq, event_id > (SELECT max(event_id) // 2 FROM events) AS late
        FROM events WHERE event_id % 50 <> 7),
        fields AS (SELECT tb, seq, 'id' AS field, 'BIGINT' AS type FROM log
                   UNION ALL SELECT tb, seq, 'v', 'VARIANT' FROM log
                   UNION ALL SELECT tb, seq, 'old', 'BOOLEAN' FROM log WHERE NOT late
                   UNION ALL SELECT tb, seq, 'note', 'STRING' FROM log WHERE late)
        SELECT tb, field, type, min(seq) AS first, max(seq) AS last, count(*) AS rows,
               min(seq) > (SELECT min(seq) FROM log l WHERE l.tb = fields.tb) AS added,
               max(seq) < (SELECT max(seq) FROM log l WHERE l.tb = fields.tb) AS gone
        FROM fields GROUP BY tb, field, type""",
    "moved_keys": """SELECT CAST(user_id AS VARCHAR) AS id, event_type AS name,
               lpad(CAST(event_id AS VARCHAR), 18, '0') AS place_in_log, CAST(event_id % 7 AS VARCHAR) AS part
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "snapshot_splits": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
}
