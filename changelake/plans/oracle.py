"""DuckDB SQL computing each registered query's rows from the base tables."""

from __future__ import annotations

from itertools import combinations

from changelake.plans.fixtures import KEY_TABLES

# Order image as the fixtures render it: money DECIMAL(18,2), date as text.
_ORDER_ROWS = """
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
         o_orderpriority
  FROM orders"""

_VERSIONS = f"""
  rows_ AS ({_ORDER_ROWS}),
  old_v AS (SELECT * FROM rows_ WHERE o_orderpriority <> '1-URGENT'),
  new_v AS (
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END
             AS o_orderstatus,
           CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END
                AS DECIMAL(18,2)) AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM rows_ WHERE o_orderpriority <> '5-LOW')"""


def _json_image(alias: str, cols: list[str]) -> str:
    return "json_object(" + ", ".join(f"'{c}', {alias}.{c}" for c in cols) + ")::VARCHAR"


_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


_RARE_VERSIONS = f"""
  rows_ AS (SELECT *, (o_orderkey // 256) % 16 = 3 AS ranged, o_orderkey % 50 AS kind FROM ({_ORDER_ROWS})),
  old_v AS (SELECT * EXCLUDE (ranged, kind) FROM rows_ WHERE NOT (ranged AND kind = 1)),
  new_v AS (
    SELECT * EXCLUDE (ranged, kind)
             REPLACE (CAST(CASE WHEN ranged AND kind = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice)
    FROM rows_ WHERE NOT (ranged AND kind = 2))"""


def _minimal_keys(size: int = 3) -> str:
    """Every set of columns counted; unique ones without a smaller one inside."""
    sets = [(t, c) for t, columns in KEY_TABLES.items() for k in range(1, size + 1) for c in combinations(columns, k)]
    counted = " UNION ALL ".join(
        f"SELECT '{t}' AS t, {list(c)} AS cols, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(c)} FROM {t})) = count(*) "
        f"AND {' AND '.join(f'count({x}) = count(*)' for x in c)} AS is_key FROM {t}" for t, c in sets)
    return f"""
      WITH k AS (SELECT t, cols FROM ({counted}) WHERE is_key)
      SELECT t AS table_name, array_to_string(cols, ',') AS key_columns, CAST(len(cols) AS INTEGER) AS n_columns FROM k
      WHERE NOT EXISTS (SELECT 1 FROM k s WHERE s.t = k.t AND len(s.cols) < len(k.cols) AND list_has_all(k.cols, s.cols))"""


def _audit(cols: list[str], versions: str = _VERSIONS) -> str:
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in _VALUES)
    return f"""
  {versions},
  joined AS (
    SELECT COALESCE(n.o_orderkey, o.o_orderkey) AS k,
           CASE WHEN o.o_orderkey IS NULL THEN 'I' WHEN n.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS operation,
           CASE WHEN o.o_orderkey IS NOT NULL THEN {_json_image('o', cols)} END AS old_data,
           CASE WHEN n.o_orderkey IS NOT NULL THEN {_json_image('n', cols)} END AS new_data
    FROM old_v o FULL OUTER JOIN new_v n ON o.o_orderkey = n.o_orderkey
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR {changed}),
  audit AS (
    SELECT sha256('tpch|orders|' || CAST(k AS VARCHAR) || '|' || operation || '|v2') AS audit_log_id,
           'tpch' AS db_name, 'orders' AS table_name, CAST(k AS VARCHAR) AS record_id,
           operation, old_data, new_data, false AS is_in_kafka
    FROM joined)"""


def _env_image(alias_status: str) -> str:
    return (
        "{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, "
        f"'o_orderstatus': {alias_status}, "
        "'o_totalprice': CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), "
        "'o_orderdate': epoch_ms(o_orderdate), 'o_orderpriority': o_orderpriority}"
    )


_PUBLISH_FROM_INSERTS = f"""
  ins AS (
    SELECT CAST(src.o_orderkey AS VARCHAR) AS record_id,
           {_json_image('r', _ALL)} AS new_data,
           epoch_ms(src.o_orderdate) // 1000 AS secs,
           strftime(src.o_orderdate, '%Y-%m-%d') AS data
    FROM orders src, LATERAL (SELECT src.o_orderkey, src.o_custkey, src.o_orderstatus,
           CAST(src.o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
           strftime(src.o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, src.o_orderpriority) r),
  pub AS (
    SELECT record_id, 'I' AS operation,
           sha256('POSTGRESQLtpchorders' || record_id) AS hash_id,
           sha256('POSTGRESQLtpchorders' || record_id || CAST(secs AS VARCHAR)) AS hash_pk,
           sha256(new_data) AS hash_record, secs AS timestamp_epoch, data, new_data
    FROM ins)"""


def _line_values(status: str) -> str:
    return (
        "[CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
        "CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR), "
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), "
        "CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), "
        f"l_returnflag, {status}, strftime(l_shipdate, '%Y-%m-%d')]"
    )


_ASOF = """
  WITH m AS (
    SELECT user_id, event_id AS pos, 'db_' || CAST(user_id AS VARCHAR) AS db_name,
           't_' || CAST(event_id AS VARCHAR) AS table_name
    FROM events WHERE event_type = 'error'),
  e AS (SELECT event_id, user_id FROM events WHERE event_type <> 'error' OR event_type IS NULL)
  SELECT e.event_id AS position, e.user_id AS table_id,
         COALESCE(m.db_name, 'unknown_db') AS db_name, COALESCE(m.table_name, 'unknown_table') AS table_name
  FROM e ASOF LEFT JOIN m ON e.user_id = m.user_id AND e.event_id >= m.pos"""

_H = "('0x' || substr(sha256('42:{salt}:' || CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT"


def _uuid(salt: str) -> str:
    hx = f"sha256('42:{salt}:' || CAST(o_orderkey AS VARCHAR))"
    return (f"substr({hx},1,8) || '-' || substr({hx},9,4) || '-' || substr({hx},13,4) || '-' || "
            f"substr({hx},17,4) || '-' || substr({hx},21,12)")


def _pick(options: tuple[str, ...], salt: str) -> str:
    lst = "[" + ", ".join(f"'{o}'" for o in options) + "]"
    return f"{lst}[({_H.format(salt=salt)} % {len(options)}) + 1]"


def oracle_sql() -> dict[str, str]:
    from changelake.sources.synth import CITIES, COMPANIES, COUNTRIES, PAYMENT_METHODS

    env_rows = """
      SELECT o.*,
        CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'F' THEN 'u' ELSE 'd' END AS op,
        epoch_ms(o_orderdate) AS ts_ms
      FROM orders o"""
    before_cols = ", ".join(
        f"CASE WHEN o_orderstatus = 'O' THEN NULL "
        f"WHEN o_orderstatus = 'F' THEN {expr_f} ELSE {expr} END AS before_{name}"
        for name, expr, expr_f in [
            ("o_orderkey", "o_orderkey", "o_orderkey"),
            ("o_custkey", "o_custkey", "o_custkey"),
            ("o_orderstatus", "o_orderstatus", "'O'"),
            ("o_totalprice", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
             "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"),
            ("o_orderdate", "epoch_ms(o_orderdate)", "epoch_ms(o_orderdate)"),
            ("o_orderpriority", "o_orderpriority", "o_orderpriority"),
        ]
    )
    after_cols = ", ".join(
        f"CASE WHEN o_orderstatus IN ('O', 'F') THEN {expr} END AS after_{name}"
        for name, expr in [
            ("o_orderkey", "o_orderkey"),
            ("o_custkey", "o_custkey"),
            ("o_orderstatus", "o_orderstatus"),
            ("o_totalprice", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"),
            ("o_orderdate", "epoch_ms(o_orderdate)"),
            ("o_orderpriority", "o_orderpriority"),
        ]
    )
    sql: dict[str, str] = {}
    sql["envelope_decode"] = f"SELECT {before_cols}, {after_cols}, op, ts_ms FROM ({env_rows})"
    sql["date_partition_counts"] = f"""
      SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
             CAST(day(o_orderdate) AS INTEGER) AS day, op, COUNT(*) AS n
      FROM ({env_rows}) GROUP BY 1, 2, 3, 4"""
    sql["lake_month_scan"] = """
      SELECT event_id, user_id, event_type, value, CAST(year(ts) AS INTEGER) AS year,
             CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
      FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'"""
    sql["stream_append_lake"] = """
      SELECT event_id, ts, user_id, event_type, value, props, CAST(year(ts) AS INTEGER) AS year,
             CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
      FROM events"""
    sql["bad_message_split"] = """
      SELECT CAST(event_id AS VARCHAR) AS key,
             CASE WHEN event_type IN ('error', 'signup') THEN 'bad' ELSE 'good' END AS status,
             CASE event_type WHEN 'error' THEN 'corrupt' WHEN 'signup' THEN
               CASE event_id % 4 WHEN 0 THEN 'tombstone' WHEN 1 THEN 'no_payload' WHEN 2 THEN 'no_ts_ms' ELSE 'ts_ms_out_of_range' END END AS reason,
             CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type
      FROM events"""
    sql["json_field"] = """
      SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
    sql["json_topic"] = """
      SELECT CAST(event_id AS VARCHAR) AS key,
             CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
             CASE event_type WHEN 'error' THEN 'corrupt' WHEN 'signup' THEN 'tombstone' END AS reason
      FROM events"""
    sql["publish_keys"] = f"""
      WITH {_PUBLISH_FROM_INSERTS}
      SELECT record_id, operation, hash_id, hash_pk, hash_record, timestamp_epoch, data FROM pub"""
    published = """
      SELECT record_id AS key,
             json_object('db_type', 'POSTGRESQL', 'db_name', db_name, 'table_name', table_name,
                         'record_id', record_id, 'new_data', new_data,
                         'hash_id', sha256('POSTGRESQL' || db_name || table_name || record_id),
                         'hash_pk', sha256('POSTGRESQL' || db_name || table_name || record_id || '1717243200'),
                         'hash_record', sha256(new_data), 'operation', operation,
                         'timestamp_epoch', 1717243200, 'data', '2024-06-01')::VARCHAR AS value,
             'kfk_stream_' || table_name AS topic"""
    sql["publish_envelope"] = f"WITH {_audit(_ALL)} {published} FROM audit"
    sql["pending_filter"] = """
      SELECT event_id, event_type FROM (
        SELECT event_id, event_type,
               CASE WHEN event_type = 'purchase' THEN true WHEN event_type = 'view' THEN NULL ELSE false END
                 AS is_in_kafka
        FROM events) WHERE is_in_kafka = false"""
    sql["audit_capture_full"] = f"WITH {_audit(_ALL)} SELECT * FROM audit"
    sql["audit_capture_ranges"] = f"WITH {_audit(_ALL, _RARE_VERSIONS)} SELECT * FROM audit"
    sql["audit_capture_subset"] = f"WITH {_audit(['o_orderstatus', 'o_totalprice'])} SELECT * FROM audit"
    sql["unpublished_antijoin"] = f"""
      WITH {_audit(_ALL)}
      SELECT a.audit_log_id, a.record_id, a.operation FROM audit a
      WHERE NOT EXISTS (
        SELECT 1 FROM audit l
        WHERE l.audit_log_id = a.audit_log_id
          AND json_extract_string(COALESCE(l.new_data, l.old_data), '$.o_orderstatus') = 'F')"""
    sql["key_violations"] = """
      SELECT l_orderkey, COUNT(*) AS n,
             CASE WHEN l_orderkey IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS violation
      FROM (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS l_orderkey FROM lineitem)
      GROUP BY l_orderkey HAVING COUNT(*) > 1 OR l_orderkey IS NULL"""
    sql["member_join"] = """
      SELECT o.o_orderkey AS orderkey, o.o_orderpriority, l.l_linenumber, l.l_partkey
      FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
       AND list_contains(generate_series(1, TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)),
                         l.l_linenumber)"""
    sql["table_map_lookup"] = _ASOF
    sql["table_map_static"] = """
      SELECT e.event_id, e.user_id AS table_id, COALESCE(c.c_mktsegment, 'unknown_db') AS db_name,
             COALESCE(c.c_name, 'unknown_table') AS table_name
      FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey"""
    sql["row_event_explode"] = f"""
      WITH j AS (
        SELECT l.*, CASE o.o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPDATE' ELSE 'DELETE' END AS event
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
      SELECT event,
             CASE WHEN event = 'UPDATE'
               THEN '{{"event":"UPDATE","database":"tpch","table":"lineitem","before":'
                    || to_json({_line_values("'O'")}) || ',"after":' || to_json({_line_values('l_linestatus')}) || '}}'
               ELSE '{{"event":"' || event || '","database":"tpch","table":"lineitem","values":'
                    || to_json({_line_values('l_linestatus')}) || '}}'
             END AS message
      FROM j"""
    sql["row_event_raw"] = f"""
      WITH j AS (
        SELECT l.*, CASE o.o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPDATE' ELSE 'DELETE' END AS event
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
      SELECT event,
             CASE WHEN event = 'UPDATE'
               THEN '{{"event":"UPDATE","database":"tpch","table":"lineitem","before":['
                    || array_to_string({_line_values("'O'")}, ',') || '],"after":['
                    || array_to_string({_line_values('l_linestatus')}, ',') || ']}}'
               ELSE '{{"event":"' || event || '","database":"' || CASE event WHEN 'DELETE' THEN 'null' ELSE 'tpch' END
                    || '","table":"lineitem","values":[' || array_to_string({_line_values('l_linestatus')}, ',') || ']}}'
             END AS message
      FROM j"""
    ev_row = ("[CAST(event_id AS VARCHAR), CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), props]")
    ev_row_after = ("[CAST(event_id AS VARCHAR), CAST(CAST(value + 1 AS DECIMAL(18,2)) AS VARCHAR), props]")
    sql["row_event_filter"] = f"""
      SELECT CASE event_type WHEN 'purchase' THEN 'INSERT' WHEN 'click' THEN 'UPDATE' ELSE 'DELETE' END
               AS event_type,
             user_id AS table_id,
             CASE WHEN event_type = 'click'
               THEN to_json([{{'before': {ev_row}, 'after': {ev_row_after}}}])::VARCHAR
               ELSE to_json([{ev_row}])::VARCHAR END AS rows
      FROM events WHERE event_type IN ('purchase', 'click', 'signup')"""
    env_before = (
        "CASE WHEN o_orderstatus = 'F' THEN to_json(" + _env_image("'O'") + ")::VARCHAR "
        "WHEN o_orderstatus = 'O' THEN NULL ELSE to_json(" + _env_image("o_orderstatus") + ")::VARCHAR END"
    )
    env_after = ("CASE WHEN o_orderstatus IN ('O', 'F') THEN to_json(" + _env_image("o_orderstatus")
                 + ")::VARCHAR END")
    row_vals = ("[CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
                "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), "
                "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority]")
    sql["changelog_union"] = f"""
      WITH {_PUBLISH_FROM_INSERTS}
      SELECT 'envelope' AS form, 'tpch' AS db, 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS record_key,
             CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'F' THEN 'U' ELSE 'D' END AS op,
             {env_before} AS before, {env_after} AS after, epoch_ms(o_orderdate) AS ts_ms
      FROM orders
      UNION ALL
      SELECT 'publish', 'tpch', 'orders', record_id, 'I', NULL, new_data, timestamp_epoch * 1000 FROM pub
      UNION ALL
      SELECT 'row_event', 'tpch', 'orders', CAST(o_orderkey AS VARCHAR), 'I', NULL, to_json({row_vals})::VARCHAR,
             NULL
      FROM orders"""
    sql["dedup_redelivered"] = """
      SELECT CAST(event_id AS VARCHAR) AS audit_log_id, event_type, value FROM events"""
    sql["dedup_ledger"] = """
      SELECT CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS audit_log_id, event_type, value,
             CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
      FROM events"""
    sql["table_map_stream"] = _ASOF
    sql["envelope_stream_lake"] = f"""
      SELECT {before_cols}, {after_cols}, op, ts_ms, CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
      FROM ({env_rows})"""
    sql["audit_publish_stream"] = sql["publish_envelope"]
    sql["row_log_publish"] = """
      WITH m AS (
        SELECT user_id, event_id AS pos, 'db_' || CAST(user_id AS VARCHAR) AS db_name,
               't_' || CAST(event_id AS VARCHAR) AS table_name
        FROM events WHERE event_type = 'error'),
      e AS (SELECT event_id, user_id FROM events WHERE event_type <> 'error' OR event_type IS NULL),
      j AS (
        SELECT e.event_id, COALESCE(m.db_name, 'unknown_db') AS db_name,
               COALESCE(m.table_name, 'unknown_table') AS table_name
        FROM e ASOF LEFT JOIN m ON e.user_id = m.user_id AND e.event_id >= m.pos)
      SELECT 'default_key' AS key,
             '{"event":"INSERT","database":"' || db_name || '","table":"' || table_name || '","values":'
               || to_json([CAST(event_id AS VARCHAR)]) || '}' AS value,
             'mysql.binlog.events' AS topic
      FROM j"""
    sql["lake_and_quarantine"] = f"""
      WITH m AS (
        SELECT *, CASE WHEN o_orderstatus = 'P' THEN
                    CASE o_orderpriority WHEN '1-URGENT' THEN 'tombstone' WHEN '2-HIGH' THEN 'corrupt'
                      WHEN '3-MEDIUM' THEN 'no_payload' WHEN '4-NOT SPECIFIED' THEN 'no_ts_ms'
                      ELSE 'ts_ms_out_of_range' END END AS reason
        FROM ({env_rows}))
      SELECT CAST(o_orderkey AS VARCHAR) AS key, reason,
             CASE WHEN reason IS NULL THEN op END AS op,
             CASE WHEN reason IS NULL THEN ts_ms END AS ts_ms,
             CASE WHEN reason IS NULL AND o_orderstatus IN ('O', 'F')
               THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS after_totalprice,
             CASE WHEN reason IS NULL THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
             CASE WHEN reason IS NULL THEN CAST(month(o_orderdate) AS INTEGER) END AS month,
             CASE WHEN reason IS NULL THEN CAST(day(o_orderdate) AS INTEGER) END AS day
      FROM m"""
    sql["quarantine_redrive"] = f"""
      WITH m AS (
        SELECT *, CASE WHEN o_orderstatus = 'P' THEN
                    CASE o_orderpriority WHEN '1-URGENT' THEN 'tombstone' WHEN '2-HIGH' THEN 'corrupt'
                      WHEN '3-MEDIUM' THEN 'no_payload' WHEN '4-NOT SPECIFIED' THEN 'no_ts_ms'
                      ELSE 'ts_ms_out_of_range' END
                  WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'no_ts_ms' END AS reason
        FROM ({env_rows}))
      SELECT CAST(o_orderkey AS VARCHAR) AS key, reason,
             CASE WHEN reason IS NULL THEN op END AS op,
             CASE WHEN reason IS NULL THEN ts_ms END AS ts_ms,
             CASE WHEN reason IS NULL AND o_orderstatus = 'F' THEN o_custkey END AS before_custkey,
             CASE WHEN reason IS NULL AND o_orderstatus IN ('O', 'F')
               THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS after_totalprice,
             CASE WHEN reason IS NULL THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
             CASE WHEN reason IS NULL THEN CAST(month(o_orderdate) AS INTEGER) END AS month,
             CASE WHEN reason IS NULL THEN CAST(day(o_orderdate) AS INTEGER) END AS day
      FROM m"""
    sql["lake_snapshots"] = f"""
      SELECT CAST(o_orderkey AS VARCHAR) AS key, op, ts_ms,
             CASE WHEN o_orderstatus IN ('O', 'F') THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS after_totalprice,
             CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
             CAST(day(o_orderdate) AS INTEGER) AS day
      FROM ({env_rows}) WHERE o_orderstatus <> 'P' AND ts_ms BETWEEN 820454400000 AND 825551999999"""
    sql["audit_ledger_runs"] = f"""
      WITH {_audit(_ALL)}
      SELECT audit_log_id, record_id AS key, CAST(CAST(record_id AS BIGINT) % 6 AS INTEGER) AS poll FROM audit"""
    sql["table_map_late"] = _ASOF
    sql["row_event_counts"] = """
      SELECT kind, count(*) AS n FROM (
        SELECT CASE WHEN event_type = 'click' AND event_id % 10 = 0 THEN 'bad'
                    WHEN event_type IN ('purchase', 'click', 'signup') THEN 'row'
                    WHEN event_type = 'view' THEN 'unhandled' ELSE 'ignored' END AS kind
        FROM events) GROUP BY kind"""
    sql["offset_coverage"] = """
      WITH o AS (SELECT event_id % 3 AS p, event_id // 3 AS off FROM events),
      landed AS (SELECT * FROM o WHERE off % 1000 NOT BETWEEN 500 AND 504),
      each AS (SELECT p, off, sum(CASE WHEN off % 777 < 3 THEN 2 ELSE 1 END) AS n FROM landed GROUP BY p, off),
      runs AS (SELECT p, off, n, off - row_number() OVER (PARTITION BY p ORDER BY off) AS run FROM each),
      r AS (SELECT p, min(off) AS lo, max(off) AS hi, CAST(sum(n) AS BIGINT) AS n_records FROM runs GROUP BY p, run),
      g AS (SELECT p, coalesce(lag(hi) OVER (PARTITION BY p ORDER BY lo), -1) + 1 AS lo, lo - 1 AS hi FROM r),
      c AS (SELECT p, CASE WHEN min(lo) <= 0 THEN arg_min(hi, lo) + 1 ELSE 0 END AS committed FROM r GROUP BY p)
      SELECT 't' AS topic, CAST(p AS INTEGER) AS partition, kind, lo, hi, n_records, n_repeated, committed FROM (
        SELECT p, 'landed' AS kind, lo, hi, n_records, n_records - (hi - lo + 1) AS n_repeated FROM r
        UNION ALL SELECT p, 'gap', lo, hi, NULL, NULL FROM g WHERE hi >= lo) JOIN c USING (p)"""
    sql["net_change"] = """
      WITH e AS (
        SELECT event_id, event_id % 5 AS form, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS k,
               CASE (event_id // 2) % 4 WHEN 0 THEN 'I' WHEN 3 THEN 'D' ELSE 'U' END AS op FROM events),
      c AS (
        SELECT event_id * 1000 AS pos, k, op,
               CASE WHEN op = 'I' OR form IN (2, 3) THEN NULL
                    WHEN form < 2 THEN json_object('k', k, 'v', 'b' || event_id)::VARCHAR
                    ELSE to_json([k, 'b' || event_id])::VARCHAR END AS before,
               CASE WHEN op = 'D' THEN NULL
                    WHEN form < 4 THEN json_object('k', k, 'v', 'a' || event_id)::VARCHAR
                    ELSE to_json([k, 'a' || event_id])::VARCHAR END AS after
        FROM e WHERE k IS NOT NULL),
      l AS (SELECT *, lag(op) OVER (PARTITION BY k ORDER BY pos) AS prev FROM c),
      f AS (
        SELECT k, arg_min(op, pos) AS first_op, arg_max(op, pos) AS last_op, min(pos) AS lo, max(pos) AS hi,
               arg_min({'x': before}, pos).x AS before, arg_max({'x': after}, pos).x AS after, count(*) AS n_changes,
               count(*) FILTER ((prev = 'D' AND op <> 'I') OR (prev IN ('I', 'U') AND op = 'I')) AS n_impossible
        FROM l GROUP BY k)
      SELECT k AS record_key,
             CASE WHEN first_op = 'I' AND last_op <> 'D' THEN 'I' WHEN first_op <> 'I' AND last_op <> 'D' THEN 'U'
                  WHEN first_op <> 'I' THEN 'D' END AS op,
             CASE WHEN first_op <> 'I' THEN before END AS before, CASE WHEN last_op <> 'D' THEN after END AS after,
             lo AS first_position, hi AS last_position, n_changes, n_impossible
      FROM f"""
    sql["key_discovery"] = _minimal_keys()
    sql["member_index"] = """
      SELECT s_nationkey AS nation, s_suppkey, c_custkey, c_name FROM supplier
      LEFT JOIN customer ON c_nationkey = s_nationkey AND c_custkey BETWEEN s_suppkey AND s_suppkey + 999"""
    sql["lake_sql_table"] = """
      WITH e AS (
        SELECT event_type, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day
        FROM events WHERE ts IS NOT NULL)
      SELECT event_type, year, month, day, count(*) AS n,
             CAST(sum(count(*)) OVER (PARTITION BY year, month, day) AS BIGINT) AS day_n
      FROM e GROUP BY event_type, year, month, day"""
    sql["audit_publish_many"] = f"""
      WITH {_audit(_ALL)},
      cust AS (
        SELECT *, CASE c_nationkey WHEN 1 THEN 'I' WHEN 2 THEN 'D' END AS operation FROM customer),
      changes AS (
        SELECT db_name, table_name, record_id, operation, new_data FROM audit
        UNION ALL
        SELECT 'tpch', 'customer', CAST(c_custkey AS VARCHAR), operation,
               CASE WHEN operation = 'I' THEN json_object('c_custkey', c_custkey, 'c_name', c_name)::VARCHAR END
        FROM cust WHERE operation IS NOT NULL)
      {published} FROM changes"""
    sql["audit_versions"] = f"""
      WITH {_audit(_ALL)},
      third AS (SELECT * REPLACE (CAST(o_totalprice + 2 AS DECIMAL(18,2)) AS o_totalprice)
                FROM new_v WHERE o_orderpriority = '2-HIGH')
      SELECT audit_log_id, record_id, operation, new_data, 0 AS poll FROM audit
      UNION ALL
      SELECT sha256('tpch|orders|' || CAST(o_orderkey AS VARCHAR) || '|U|v3'), CAST(o_orderkey AS VARCHAR), 'U',
             {_json_image('third', _ALL)}, 1
      FROM third"""
    sql["audit_capture_once"] = f"""
      WITH {_audit(_ALL)},
      third AS (SELECT * REPLACE (CAST(o_totalprice + 2 AS DECIMAL(18,2)) AS o_totalprice)
                FROM new_v WHERE o_orderpriority = '2-HIGH')
      SELECT audit_log_id, record_id, operation, new_data, 0 AS poll FROM audit
      UNION ALL
      SELECT sha256('tpch|orders|' || CAST(o_orderkey AS VARCHAR) || '|U|v3'), CAST(o_orderkey AS VARCHAR), 'U',
             {_json_image('third', _ALL)}, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END
      FROM third"""
    sql["synth_transactions"] = f"""
      SELECT {_uuid('txn')} AS transaction_id,
             'user_' || CAST({_H.format(salt='user')} % 100000 AS VARCHAR) AS user_id,
             TIMESTAMP '2024-01-01 00:00:00' + to_seconds({_H.format(salt='time')} % 86400) AS timestamp,
             CAST(CAST((1000 + {_H.format(salt='amount')} % 99001) AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) AS amount,
             {_pick(CITIES, 'city')} AS city,
             {_pick(COUNTRIES, 'country')} AS country,
             {_pick(COMPANIES, 'merchant')} AS merchant_name,
             {_pick(PAYMENT_METHODS, 'payment')} AS payment_method,
             {_uuid('affiliate')} AS affiliateId
      FROM orders"""
    return sql
