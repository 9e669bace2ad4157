"""Equivalent SQL for the queries, over the same tables."""

from __future__ import annotations

_EVENT = "event_id, ts, user_id, value"
_PAIR = "l_orderkey, l_linenumber"
_LINE = f"{_PAIR}, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag"
_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_TARGET = "tgt AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"
_SOURCE = f"""src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
         o_orderpriority
  FROM orders WHERE o_orderdate > TIMESTAMP '1997-07-01')"""
_MERGED = """
  SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
  UNION ALL SELECT * FROM src"""

# Line items through the four rules in sequence.
_TAGGED = f"""
  s1 AS (SELECT *, CASE WHEN NOT (l_quantity BETWEEN 3 AND 48) THEN 'quantity_range' END AS f1
         FROM lineitem),
  s2 AS (SELECT *, coalesce(f1, CASE WHEN NOT regexp_matches(l_returnflag, '^[AN]$')
                                     THEN 'flag_known' END) AS f2 FROM s1),
  s3 AS (SELECT *, coalesce(f2, CASE WHEN count(CASE WHEN f2 IS NULL THEN 1 END)
                                          OVER (PARTITION BY {_PAIR}) > 1
                                     THEN 'pair_unique' END) AS f3 FROM s2),
  tagged AS (SELECT *, coalesce(f3, CASE WHEN NOT (l_discount < 0.09)
                                         THEN 'discount_low' END) AS failed_rule FROM s3)"""

_EVERY = f"""
  marked AS (SELECT *, count(*) OVER (PARTITION BY {_PAIR}) > 1 AS twice FROM lineitem)"""

_TEXT_TIMES = """
  texts AS (SELECT event_id, event_type,
    CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                    WHEN 'signup' THEN strftime(ts, '%Y-%m-%d')
                    WHEN 'error' THEN 'at ' || strftime(ts, '%d.%m.%Y')
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS seen FROM events),
  times AS (SELECT *, TRY_CAST(seen AS TIMESTAMP) AS t FROM texts)"""

_RUNS = """
  runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(o_custkey AS VARCHAR) AS pipeline_id,
    o_orderdate AS execution_start,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 HOUR END AS execution_end,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS watermark_end,
    o_orderkey AS records_read,
    CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'RUNNING' ELSE 'SUCCESS' END AS status
    FROM orders)"""

_STEPS = """
  steps AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS step_run_id,
    CAST(l_orderkey AS VARCHAR) AS run_id,
    CASE l_returnflag WHEN 'R' THEN 'extract' WHEN 'A' THEN 'dq_checks' ELSE 'target_load' END
      AS step_name,
    l_shipdate AS start_time, l_shipdate + to_minutes(CAST(l_quantity AS BIGINT)) AS end_time,
    CASE l_linestatus WHEN 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    l_partkey AS records_processed FROM lineitem)"""

_RECON = """
  counts AS (SELECT CAST(o_custkey AS VARCHAR) AS pipeline_id, count(*) AS source_count,
    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS target_inserted_count,
    count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS target_updated_count,
    count(CASE WHEN o_orderstatus = 'P' AND o_totalprice < 400000 THEN 1 END) AS quarantine_count
    FROM orders GROUP BY 1),
  recon AS (SELECT *,
    source_count - target_inserted_count - target_updated_count - quarantine_count
      AS discrepancy_count,
    CASE WHEN source_count = target_inserted_count + target_updated_count + quarantine_count
         THEN 'RECONCILED' ELSE 'DISCREPANCY' END AS reconciliation_status FROM counts)"""

_WATERMARKS = """
  log AS (SELECT CAST(event_id AS VARCHAR) AS watermark_id, CAST(user_id AS VARCHAR) AS pipeline_id,
    ts AS last_watermark_value,
    CAST(CASE WHEN event_type = 'view' THEN 60 ELSE 0 END AS BIGINT) AS lookback_minutes,
    CASE WHEN event_type = 'purchase' THEN 'ACTIVE' ELSE 'NONE' END AS backfill_status,
    CASE WHEN event_type = 'purchase' THEN ts - INTERVAL 2 DAY END AS backfill_start,
    CASE WHEN event_type = 'purchase' THEN ts - INTERVAL 1 DAY END AS backfill_end,
    ts AS updated_at FROM events),
  state AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id
    ORDER BY updated_at DESC, watermark_id DESC) AS rn FROM log) WHERE rn = 1)"""

_EVENT_TAGGED = """
  u AS (SELECT *, count(*) OVER (PARTITION BY event_id) AS n FROM events),
  good AS (SELECT *, (n = 1 AND event_type IN ('view', 'click', 'purchase', 'signup')
                      AND value < 90) AS ok FROM u)"""

_LANDED = """
  batches AS (SELECT event_id, ts, user_id, event_type, value,
              strftime(ts, '%Y-%m-%d') AS batch_id FROM events)"""


def _outcome(order: int, rule: str, action: str, failed: str, status: str) -> str:
    return (
        f"SELECT {order} AS rule_order, '{rule}' AS rule_id, '{action}' AS action_on_fail, "
        f"n AS failed_records, CASE WHEN n > 0 THEN '{status}' ELSE 'PASSED' END AS status "
        f"FROM (SELECT count(CASE WHEN {failed} THEN 1 END) AS n FROM tagged)"
    )


def _outcomes(*rules: tuple[str, str, str]) -> str:
    status = {
        "QUARANTINE": "FAILED_QUARANTINED",
        "WARN": "FAILED_WARN",
        "FAIL_PIPELINE": "FAILED_HALTED",
    }
    return " UNION ALL ".join(
        _outcome(i, rule, action, failed, status[action])
        for i, (rule, action, failed) in enumerate(rules)
    )


def _violations(*checks: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST(({sql}) AS BIGINT) AS violations"
        for column, check, sql in checks
    )


_ALL = "SELECT count(*) FROM customer"
_NONE = "SELECT 0"

SQL: dict[str, str] = {
    "ingest_full": f"SELECT {_EVENT}, event_type, props, 'batch-001' AS batch_id FROM events",
    "lineage_stamp": """SELECT event_id, 'batch-001' AS batch_id, 'events.parquet' AS source_file,
        TIMESTAMP '2024-02-01' AS loaded_at FROM events""",
    "incremental_window": f"""SELECT {_EVENT} FROM events
        WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
    "incremental_lookback": f"""SELECT {_EVENT} FROM events
        WHERE ts > TIMESTAMP '2024-01-10' - INTERVAL 60 MINUTE
          AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
    "backfill_window": f"""SELECT {_EVENT} FROM events
        WHERE ts > TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-05 06:00:00'""",
    "control_windows": f"""WITH {_WATERMARKS}
        SELECT pipeline_id, backfill_status,
          CASE WHEN backfill_status = 'ACTIVE' THEN backfill_start
               ELSE last_watermark_value - to_minutes(lookback_minutes) END AS window_start,
          CASE WHEN backfill_status = 'ACTIVE' THEN backfill_end
               ELSE TIMESTAMP '2024-02-01' END AS window_end FROM state""",
    "incremental_string_ts": f"""WITH {_TEXT_TIMES} SELECT event_id, event_type, seen FROM times
        WHERE t > TIMESTAMP '2024-01-10' AND t <= TIMESTAMP '2024-01-20 12:00:00'""",
    "unreadable_times": f"""WITH {_TEXT_TIMES} SELECT count(*) AS total_rows,
        count(CASE WHEN t > TIMESTAMP '2024-01-10' AND t <= TIMESTAMP '2024-01-20 12:00:00'
              THEN 1 END) AS window_rows,
        count(CASE WHEN t <= TIMESTAMP '2024-01-10' THEN 1 END) AS before_rows,
        count(CASE WHEN t > TIMESTAMP '2024-01-20 12:00:00' THEN 1 END) AS after_rows,
        count(CASE WHEN seen IS NULL THEN 1 END) AS null_rows,
        count(CASE WHEN seen IS NOT NULL AND t IS NULL THEN 1 END) AS unreadable_rows FROM times""",
    "null_watermark_rows": """WITH o AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d
            FROM orders)
        SELECT count(*) AS total_rows,
        count(CASE WHEN d > TIMESTAMP '1996-01-01' AND d <= TIMESTAMP '1999-01-01' THEN 1 END)
          AS window_rows,
        count(CASE WHEN d <= TIMESTAMP '1996-01-01' THEN 1 END) AS before_rows,
        count(CASE WHEN d > TIMESTAMP '1999-01-01' THEN 1 END) AS after_rows,
        count(CASE WHEN d IS NULL THEN 1 END) AS null_rows,
        CAST(0 AS BIGINT) AS unreadable_rows FROM o""",
    "next_watermark": """SELECT coalesce(max(ts), TIMESTAMP '2024-01-10') AS watermark FROM events
        WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
          AND value < 60 AND regexp_matches(event_type, '^[^e]')""",
    "dq_not_null": """SELECT event_id, user_id, 'typed' AS failed_rule, 'run-1' AS execution_id
        FROM events WHERE nullif(event_type, 'error') IS NULL""",
    "dq_range": """SELECT c_custkey, c_acctbal, 'balance_positive' AS failed_rule,
        'run-1' AS execution_id FROM customer WHERE NOT (c_acctbal > 0) OR c_acctbal IS NULL""",
    "dq_regex": """SELECT c_custkey, c_name, 'name_form' AS failed_rule, 'run-1' AS execution_id
        FROM customer WHERE NOT regexp_matches(c_name, '^Customer#[0-9]*[05]$')""",
    "dq_unique": f"""SELECT {_PAIR}, l_partkey, l_suppkey, l_quantity,
        'pair_unique' AS failed_rule, 'run-1' AS execution_id
        FROM (SELECT *, count(*) OVER (PARTITION BY {_PAIR}) AS n FROM lineitem) WHERE n > 1""",
    "dq_unique_nulls": """WITH o AS (SELECT o_orderkey,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k FROM orders)
        SELECT o_orderkey, k, 'k_unique' AS failed_rule, 'run-1' AS execution_id
        FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM o) WHERE n > 1""",
    "dq_first_failure": f"WITH {_TAGGED} SELECT {_LINE}, failed_rule FROM tagged",
    "dq_clean_rows": f"WITH {_TAGGED} SELECT {_LINE} FROM tagged WHERE failed_rule IS NULL",
    "dq_quarantine_rows": f"""WITH {_TAGGED} SELECT {_LINE}, failed_rule, 'run-1' AS execution_id
        FROM tagged WHERE failed_rule IS NOT NULL""",
    "dq_metrics": f"""WITH {_TAGGED} SELECT count(*) AS read_count,
        count(CASE WHEN failed_rule IS NULL THEN 1 END) AS passed_count,
        count(failed_rule) AS failed_count, CAST(0 AS BIGINT) AS warned_count FROM tagged""",
    "dq_outcomes": f"WITH {_TAGGED} "
    + _outcomes(
        *(
            (r, "QUARANTINE", f"failed_rule = '{r}'")
            for r in ("quantity_range", "flag_known", "pair_unique", "discount_low")
        )
    ),
    "dq_warn_counts": f"""WITH q AS (SELECT *, l_quantity BETWEEN 3 AND 48 AS alive FROM lineitem),
        tagged AS (SELECT *, count(CASE WHEN alive THEN 1 END) OVER (PARTITION BY {_PAIR}) AS n
                   FROM q) """
    + _outcomes(
        ("tax_high", "WARN", "NOT (l_tax < 0.07)"),
        ("quantity_range", "QUARANTINE", "NOT alive"),
        ("flag_known", "WARN", "alive AND NOT regexp_matches(l_returnflag, '^[AN]$')"),
        ("pair_unique", "WARN", "alive AND n > 1"),
        ("price_positive", "FAIL_PIPELINE", "alive AND NOT (l_extendedprice > 0)"),
        ("status_known", "FAIL_PIPELINE", "alive AND l_linestatus IS NULL"),
    ),
    "dq_all_failures": f"""WITH {_EVERY}
        SELECT {_LINE}, 'small_quantity' AS failed_rule FROM marked WHERE NOT (l_quantity > 5)
        UNION ALL SELECT {_LINE}, 'taxed' FROM marked WHERE NOT (l_tax > 0)
        UNION ALL SELECT {_LINE}, 'shipped_late' FROM marked WHERE NOT (year(l_shipdate) < 2001)
        UNION ALL SELECT {_LINE}, 'pair_unique' FROM marked WHERE twice""",
    "dq_independent_clean": f"""WITH {_EVERY} SELECT {_LINE} FROM marked
        WHERE l_quantity > 5 AND l_tax > 0 AND year(l_shipdate) < 2001 AND NOT twice""",
    "dq_distinct_quarantine": """SELECT event_id, ts, user_id, event_type, value,
        'value_low' AS failed_rule, 'run-2' AS execution_id FROM events WHERE NOT (value < 60)""",
    "schema_conformance": _violations(
        ("c_custkey", "present", _NONE),
        ("c_custkey", "type", _NONE),
        ("c_custkey", "castable", _NONE),
        ("c_custkey", "not_null", f"{_ALL} WHERE c_custkey IS NULL"),
        ("c_name", "present", _NONE),
        ("c_name", "type", _ALL),
        ("c_name", "castable", f"{_ALL} WHERE TRY_CAST(c_name AS BIGINT) IS NULL"),
        ("c_nationkey", "present", _NONE),
        ("c_nationkey", "type", _ALL),
        ("c_nationkey", "castable", _NONE),
        ("c_nationkey", "not_null", f"{_ALL} WHERE c_nationkey IS NULL"),
        ("c_acctbal", "present", _NONE),
        ("c_acctbal", "type", _NONE),
        ("c_acctbal", "castable", _NONE),
        ("c_acctbal", "not_null", f"{_ALL} WHERE c_acctbal IS NULL"),
        ("c_mktsegment", "present", _NONE),
        ("c_mktsegment", "type", _ALL),
        ("c_mktsegment", "castable", f"{_ALL} WHERE TRY_CAST(c_mktsegment AS DATE) IS NULL"),
        ("c_phone", "present", _ALL),
        (
            "c_custkey",
            "unique",
            "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM customer "
            "GROUP BY c_custkey HAVING count(*) > 1)",
        ),
    ),
    "schema_conform_rows": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
        CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
        TRY_CAST(o_orderpriority AS BIGINT) AS o_orderpriority, CAST(NULL AS VARCHAR) AS o_clerk
        FROM orders""",
    "schema_rules": f"""WITH s1 AS (SELECT *,
            CASE WHEN nullif(l_tax, 0.0) IS NULL THEN 'l_tax_not_null' END AS f1 FROM lineitem),
        tagged AS (SELECT *, coalesce(f1, CASE WHEN count(CASE WHEN f1 IS NULL THEN 1 END)
            OVER (PARTITION BY {_PAIR}) > 1 THEN 'primary_key' END) AS failed_rule FROM s1) """
    + _outcomes(
        *(
            (r, "QUARANTINE", f"failed_rule = '{r}'")
            for r in (
                "l_orderkey_not_null",
                "l_linenumber_not_null",
                "l_tax_not_null",
                "primary_key",
            )
        )
    ),
    "dedup_latest_row": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY {_PAIR} ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
            l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
            l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "classify_changes": f"""WITH {_TARGET}, {_SOURCE} SELECT count(*) AS source_count,
        count(CASE WHEN o_orderkey NOT IN (SELECT o_orderkey FROM tgt) THEN 1 END)
          AS inserted_count,
        count(CASE WHEN o_orderkey IN (SELECT o_orderkey FROM tgt) THEN 1 END) AS updated_count
        FROM src""",
    "merge_upsert": f"WITH {_TARGET}, {_SOURCE} {_MERGED}",
    "merge_newer": f"""WITH {_TARGET},
        src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
            CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 365 DAY ELSE o_orderdate END
              AS o_orderdate, o_orderpriority
            FROM orders WHERE o_orderdate > TIMESTAMP '1997-07-01')
        SELECT t.* FROM tgt t LEFT JOIN src s ON t.o_orderkey = s.o_orderkey
          WHERE s.o_orderkey IS NULL OR s.o_orderdate < t.o_orderdate
        UNION ALL
        SELECT s.* FROM src s LEFT JOIN tgt t ON t.o_orderkey = s.o_orderkey
          WHERE t.o_orderkey IS NULL OR s.o_orderdate >= t.o_orderdate""",
    "merge_repeated_target": f"""WITH lines AS (SELECT {_PAIR}, l_suppkey, l_quantity, l_shipdate
            FROM lineitem),
        src AS (SELECT * EXCLUDE (rn) FROM (SELECT {_PAIR}, l_suppkey,
              l_quantity + 100 AS l_quantity, l_shipdate, row_number() OVER (PARTITION BY {_PAIR}
              ORDER BY l_shipdate DESC, l_suppkey DESC, l_quantity DESC) AS rn
            FROM lines WHERE l_linenumber <= 2) WHERE rn = 1),
        tgt AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1999-01-01' OR l_linenumber > 2)
        SELECT t.l_orderkey, t.l_linenumber,
          CASE WHEN s.l_orderkey IS NULL THEN t.l_suppkey ELSE s.l_suppkey END AS l_suppkey,
          CASE WHEN s.l_orderkey IS NULL THEN t.l_quantity ELSE s.l_quantity END AS l_quantity,
          CASE WHEN s.l_orderkey IS NULL THEN t.l_shipdate ELSE s.l_shipdate END AS l_shipdate
        FROM tgt t LEFT JOIN src s USING ({_PAIR})
        UNION ALL SELECT * FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt
          WHERE tgt.l_orderkey = src.l_orderkey AND tgt.l_linenumber = src.l_linenumber)""",
    "merge_latest": f"""WITH lines AS (SELECT {_PAIR}, l_suppkey, l_quantity, l_shipdate
            FROM lineitem),
        tgt AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {_PAIR}
              ORDER BY l_shipdate DESC, l_suppkey DESC, l_quantity DESC) AS rn
            FROM lines WHERE l_linenumber <= 4) WHERE rn = 1),
        src AS (SELECT * EXCLUDE (rn) FROM (SELECT {_PAIR}, l_suppkey, -l_quantity AS l_quantity,
              l_shipdate, row_number() OVER (PARTITION BY {_PAIR}
              ORDER BY l_shipdate DESC, l_suppkey DESC, -l_quantity DESC) AS rn
            FROM lines WHERE l_linenumber >= 4) WHERE rn = 1)
        SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src
          WHERE tgt.l_orderkey = src.l_orderkey AND tgt.l_linenumber = src.l_linenumber)
        UNION ALL SELECT * FROM src""",
    "load_bootstrap": f"SELECT {_PAIR}, l_partkey, l_suppkey FROM lineitem",
    "load_append": f"WITH {_TARGET}, {_SOURCE} SELECT * FROM tgt UNION ALL SELECT * FROM src",
    "load_overwrite": f"WITH {_SOURCE} SELECT * FROM src",
    "load_merge": f"WITH {_TARGET}, {_SOURCE} {_MERGED}",
    "partition_overwrite": f"""WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year
            FROM orders)
        SELECT * FROM o WHERE o_year <> 1996
        UNION ALL SELECT {_ORDER.replace("o_totalprice", "o_totalprice + 1")}, o_year FROM o
        WHERE o_year = 1996 AND o_orderstatus <> 'P'""",
    "merge_partitions": f"""WITH {_TARGET}, {_SOURCE}, merged AS ({_MERGED})
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM merged""",
    "update_rows": """SELECT CAST(c_custkey AS VARCHAR) AS pipeline_id,
        CASE WHEN c_acctbal > 0 THEN c_name ELSE upper(c_name) END AS pipeline_name,
        TRUE AS is_active FROM customer""",
    "resolve_tables": """WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS table_id,
            CAST(o_custkey AS VARCHAR) AS pipeline_id,
            CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'landing' WHEN '3' THEN 'silver'
                 WHEN '4' THEN 'gold' ELSE 'bronze' END AS layer,
            '/data/' || o_orderkey AS storage_path,
            CASE o_orderstatus WHEN 'F' THEN 'json' ELSE 'csv' END AS file_format,
            CASE o_orderstatus WHEN 'P' THEN 'merge' ELSE 'append' END AS write_mode FROM orders),
        src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id
            ORDER BY table_id) AS rn FROM t WHERE layer = 'landing') WHERE rn = 1),
        tgt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id
            ORDER BY layer, table_id) AS rn FROM t WHERE layer <> 'landing') WHERE rn = 1)
        SELECT CAST(c_custkey AS VARCHAR) AS pipeline_id, c_name AS pipeline_name,
          c_acctbal > 0 AS is_active, src.table_id AS source_table_id,
          src.storage_path AS source_path, src.file_format AS source_format,
          tgt.table_id AS target_table_id, tgt.layer AS target_layer,
          tgt.storage_path AS target_path, tgt.write_mode
        FROM customer LEFT JOIN src ON CAST(c_custkey AS VARCHAR) = src.pipeline_id
        LEFT JOIN tgt ON CAST(c_custkey AS VARCHAR) = tgt.pipeline_id""",
    "active_rules": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_suppkey) AS rule_id,
        CAST(l_partkey AS VARCHAR) AS table_id,
        CASE l_returnflag WHEN 'R' THEN 'RANGE' ELSE 'NOT_NULL' END AS rule_type,
        p_brand AS pipeline_id
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_discount > 0.03""",
    "watermark_state": f"WITH {_WATERMARKS} SELECT * FROM state",
    "latest_runs": f"WITH {_RUNS} SELECT run_id, pipeline_id, execution_start, execution_end, "
    "watermark_end, CASE WHEN status <> 'RUNNING' THEN records_read END AS records_read, status "
    "FROM runs",
    "last_success": f"""WITH {_RUNS} SELECT pipeline_id, run_id, execution_start, watermark_end
        FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id
              ORDER BY execution_start DESC, run_id DESC) AS rn FROM runs WHERE status = 'SUCCESS')
        WHERE rn = 1""",
    "sla_breaches": f"""WITH {_RUNS}, aged AS (SELECT *, CASE WHEN status = 'FAILED' THEN 'FAILED'
            WHEN status = 'RUNNING' AND date_sub('second', execution_start, TIMESTAMP '2000-01-01')
              > 86400 * 365 THEN 'OVERDUE' END AS breach FROM runs)
        SELECT run_id, pipeline_id, status, breach, CASE WHEN breach = 'OVERDUE'
          THEN date_sub('second', execution_start, TIMESTAMP '2000-01-01') END AS open_seconds
        FROM aged WHERE breach IS NOT NULL""",
    "dependency_ready": f"""WITH {_RUNS}, latest AS (SELECT * FROM (SELECT pipeline_id, status,
            row_number() OVER (PARTITION BY pipeline_id ORDER BY execution_start DESC, run_id DESC)
              AS rn FROM runs) WHERE rn = 1),
        deps AS (SELECT CAST(l_orderkey AS VARCHAR) AS pipeline_id,
            CAST(l_suppkey AS VARCHAR) AS parent FROM lineitem WHERE l_returnflag <> 'R')
        SELECT deps.pipeline_id, bool_and(coalesce(status = 'SUCCESS', FALSE)) AS is_ready,
          count(*) AS n_parents,
          count(CASE WHEN coalesce(status <> 'SUCCESS', TRUE) THEN 1 END) AS n_waiting
        FROM deps LEFT JOIN latest ON deps.parent = latest.pipeline_id GROUP BY 1""",
    "step_profile": f"""WITH {_STEPS},
        d AS (SELECT *, date_sub('second', start_time, end_time) AS spent FROM steps)
        SELECT step_name, count(*) AS n_steps,
          count(CASE WHEN status = 'FAILED' THEN 1 END) AS n_failed,
          CAST(sum(spent) AS BIGINT) AS total_seconds, avg(spent) AS avg_seconds,
          max(spent) AS max_seconds, quantile_disc(spent, 0.5) AS p50_seconds,
          quantile_disc(spent, 0.95) AS p95_seconds,
          CAST(sum(records_processed) AS BIGINT) AS records_processed
        FROM d GROUP BY step_name""",
    "reconcile": f"WITH {_RECON} SELECT * FROM recon",
    "discrepancies": f"""WITH {_RECON} SELECT pipeline_id, source_count, discrepancy_count
        FROM recon WHERE reconciliation_status = 'DISCREPANCY'""",
    "reconciliation_totals": f"""WITH {_RECON} SELECT c_mktsegment AS pipeline_id,
        count(*) AS n_runs, CAST(sum(source_count) AS BIGINT) AS source_count,
        CAST(sum(target_inserted_count) AS BIGINT) AS target_inserted_count,
        CAST(sum(target_updated_count) AS BIGINT) AS target_updated_count,
        CAST(sum(quarantine_count) AS BIGINT) AS quarantine_count
        FROM counts JOIN customer ON counts.pipeline_id = CAST(c_custkey AS VARCHAR) GROUP BY 1""",
    "run_report": f"""WITH {_RUNS}, {_STEPS}, {_RECON},
        ps AS (SELECT run_id, count(*) AS n_steps,
            CAST(sum(date_sub('second', start_time, end_time)) AS BIGINT) AS step_seconds
          FROM steps GROUP BY 1),
        failed AS (SELECT run_id, step_name AS failed_step FROM (SELECT run_id, step_name,
            row_number() OVER (PARTITION BY run_id ORDER BY start_time DESC, step_name DESC) AS rn
            FROM steps WHERE status = 'FAILED') WHERE rn = 1),
        ended AS (SELECT run_id, step_name AS last_step FROM (SELECT run_id, step_name,
            row_number() OVER (PARTITION BY run_id ORDER BY end_time DESC, step_name DESC) AS rn
            FROM steps) WHERE rn = 1),
        pq AS (SELECT CAST(l_orderkey AS VARCHAR) AS run_id,
            count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_failed_rules,
            CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
              AS BIGINT) AS failed_records FROM lineitem GROUP BY 1)
        SELECT r.run_id, r.pipeline_id, r.status, r.execution_start, n_steps, step_seconds,
          failed_step, last_step, source_count, discrepancy_count, n_failed_rules, failed_records
        FROM runs r LEFT JOIN ps USING (run_id) LEFT JOIN failed USING (run_id)
        LEFT JOIN ended USING (run_id) LEFT JOIN recon ON recon.pipeline_id = r.run_id
        LEFT JOIN pq ON pq.run_id = r.run_id""",
    "steps_in_order": f"WITH {_STEPS} SELECT * FROM steps ORDER BY start_time, end_time, step_run_id",
    "trace_batch": f"""WITH {_LANDED} SELECT *,
        CASE WHEN event_type = 'error' THEN 'typed' END AS failed_rule
        FROM batches WHERE batch_id = '2024-01-15'""",
    "trace_file": f"""WITH {_LANDED} SELECT *, 'error.json' AS source_file_name,
        'typed' AS failed_rule FROM batches WHERE event_type = 'error'""",
    "ingest_latency": """WITH l AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_id,
            date_sub('second', ts, date_trunc('day', ts) + INTERVAL 1 DAY) AS s FROM events)
        SELECT batch_id, count(*) AS n_rows, min(s) AS min_seconds, max(s) AS max_seconds,
          avg(s) AS avg_seconds, quantile_disc(s, 0.95) AS p95_seconds FROM l GROUP BY 1""",
    "two_loads": f"""WITH {_EVENT_TAGGED} SELECT event_id, ts, user_id, event_type, value,
        CASE WHEN ts <= TIMESTAMP '2024-01-15' THEN 'run-1' ELSE 'run-2' END AS batch_id
        FROM good WHERE ok AND ts <= TIMESTAMP '2024-02-01'""",
    "load_audit": f"""WITH {_EVENT_TAGGED},
        m1 AS (SELECT max(ts) AS t FROM good WHERE ok AND ts <= TIMESTAMP '2024-01-15'),
        m2 AS (SELECT max(ts) AS t FROM good
               WHERE ok AND ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-08'),
        m3 AS (SELECT max(ts) AS t FROM good WHERE ok AND ts <= TIMESTAMP '2024-02-01'),
        win AS (
          SELECT 'run-1' AS run_id, CAST(NULL AS TIMESTAMP) AS a, TIMESTAMP '2024-01-15' AS b,
                 (SELECT t FROM m1) AS m, FALSE AS again
          UNION ALL SELECT 'run-2', TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-08',
                 (SELECT t FROM m2), TRUE
          UNION ALL SELECT 'run-3', (SELECT t FROM m1), TIMESTAMP '2024-02-01',
                 (SELECT t FROM m3), FALSE)
        SELECT run_id, 'SUCCESS' AS status, a AS watermark_start, m AS watermark_end,
          count(*) AS records_read, count(CASE WHEN ok THEN 1 END) AS records_written,
          count(CASE WHEN ok AND NOT again THEN 1 END) AS target_inserted_count,
          count(CASE WHEN ok AND again THEN 1 END) AS target_updated_count,
          count(CASE WHEN NOT ok THEN 1 END) AS quarantine_count,
          CAST(0 AS BIGINT) AS discrepancy_count
        FROM win JOIN good ON (a IS NULL OR ts > a) AND ts <= b GROUP BY run_id, a, m""",
    "stream_load": f"""WITH {_EVENT_TAGGED} SELECT event_id, ts, user_id, event_type, value,
        'events-stream-0' AS batch_id FROM good WHERE ok""",
    "stream_restart": f"""WITH {_EVENT_TAGGED}, twice AS (SELECT unnest([1, 2]) AS k)
        SELECT event_id, ts, user_id, event_type, value, 'events-stream-0' AS batch_id
        FROM good, twice WHERE ok""",
    "append_two_pipelines": """SELECT event_id, ts, user_id, event_type, value,
        CASE WHEN event_type IN ('view', 'click') THEN 'run-1' ELSE 'run-2' END AS batch_id
        FROM events WHERE ts <= TIMESTAMP '2024-02-01'""",
    "time_renderings": """SELECT event_id, CASE event_id % 8
        WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
        WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN ts WHEN 4 THEN date_trunc('day', ts)
        WHEN 5 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE END::TIMESTAMP AS moment FROM events""",
    "schema_enforced_load": """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey,
        CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CAST(l_quantity AS DOUBLE) + CASE WHEN l_linenumber % 3 = 0 THEN 0.5 ELSE 0 END AS l_quantity,
        l_linenumber % 3 = 0 AS held FROM lineitem""",
    "halted_run": """WITH t AS (SELECT *, coalesce(event_type IN ('view', 'click', 'purchase'), false) AS known
          FROM events WHERE ts <= TIMESTAMP '2024-02-01')
        SELECT 'run-1' AS run_id, 'a_type' AS rule_id, count(*) FILTER (NOT known) AS failed_records,
          CASE WHEN count(*) FILTER (NOT known) > 0 THEN 'FAILED_QUARANTINED' ELSE 'PASSED' END AS status FROM t
        UNION ALL SELECT 'run-1', 'b_value', count(*) FILTER (known AND NOT coalesce(value < 90, false)),
          'FAILED_HALTED' FROM t""",
    "silver_layer": f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
        l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY {_PAIR}
          ORDER BY l_shipdate DESC, CAST(l_suppkey AS VARCHAR) DESC, l_returnflag DESC) AS rn
        FROM lineitem) WHERE rn = 1""",
    "gold_layer": """SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
        count(DISTINCT l_orderkey) AS n_orders,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY 1, 2""",
    "incremental_slice": f"""WITH {_TARGET},
        win AS (SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders
          WHERE o_orderdate > TIMESTAMP '1997-07-01' AND o_orderdate <= TIMESTAMP '2001-01-01'
            AND o_totalprice + 1 > 1000 AND regexp_matches(o_orderpriority, '^[1-4]-')),
        src AS (SELECT {_ORDER.replace("o_totalprice", "o_totalprice + 1 AS o_totalprice")}
          FROM win WHERE n = 1) {_MERGED}""",
}
