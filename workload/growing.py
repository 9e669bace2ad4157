"""Queries on stores that grow by runs: swaps, buckets, counts, summaries, and what follows them."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import utc_now, utc_wall_clock
from tidemark.model import Rule, WatermarkState
from tidemark.operators import graphs, reports
from tidemark.operators.summary import Measure
from tidemark.plans import lineage
from tidemark.plans.layers import rollup
from tidemark.plans.load import write_table
from tidemark.plans.runner import LoadOptions, run_incremental
from tidemark.plans.summaries import Summary, step_profiles
from tidemark.scratch import Scratch
from tidemark.sources import storage
from tidemark.sources.tables import VersionedTable
from tidemark.streaming import windows
from workload import data, oracle
from workload.data import table
from workload.queries import EVENT, EVENT_RULES, QUERIES, _store

STRANGE = " a:b%c/d+é"  # what folder names have to encode


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        oracle.SQL[fn.__name__] = sql
        return fn

    return register


@query(
    f"""WITH {oracle._EVENT_TAGGED}, e AS (SELECT event_id, ts, user_id, value,
          event_type || '{STRANGE}' AS event_type FROM good WHERE ok AND ts <= TIMESTAMP '2024-02-01'),
        top AS (SELECT max(ts) AS t FROM e WHERE ts <= TIMESTAMP '2024-01-15')
        SELECT event_id, ts, user_id, event_type, value,
          CASE WHEN ts > (SELECT t FROM top) - INTERVAL 3 DAY THEN 'run-2' ELSE 'run-1' END AS batch_id FROM e"""
)
def merge_partitions_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs merge events into partitions with strange names, the second one reads three days again."""
    target = {"merge_keys": ["event_id"], "partition_cols": ["event_type"]}
    rules = [EVENT_RULES[0], Rule("type_known", "event_type", "REGEX", "^(view|click|purchase|signup) a"), EVENT_RULES[2]]
    store, events = _store(spark, sf_dir, "merge", target, rules)
    begun = datetime(2024, 1, 1)
    store.put_watermark(WatermarkState("w", "events", "tgt", "ts", None, 3 * 24 * 60), begun)
    options = LoadOptions(transform=lambda df: df.withColumn("event_type", F.concat("event_type", F.lit(STRANGE))))
    for run_id, now in (("run-1", datetime(2024, 1, 15)), ("run-2", datetime(2024, 2, 1))):
        run_incremental(spark, store, "events", now=now, run_id=run_id, options=options)
    return events.read().select(*EVENT)


@query(
    f"""SELECT event_id, ts, user_id, value, nullif(event_type, 'view') || '{STRANGE}' AS event_type FROM events
        WHERE event_type NOT IN ('view', 'purchase')
        UNION ALL SELECT event_id, ts, user_id, value + 1, nullif(event_type, 'view') || '{STRANGE}' FROM events
        WHERE event_type IN ('view', 'purchase') AND value < 50"""
)
def partition_overwrite_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partitions are replaced, one with a strange name and that of the nulls."""
    named = F.concat(F.when(F.col("event_type") != "view", F.col("event_type")), F.lit(STRANGE))
    events = table(spark, sf_dir, "events")
    path = f"{Scratch(spark).path}/events at 1 %41"
    columns = ["event_id", "ts", "user_id", "value", named.alias("event_type")]
    write_table(events.select(*columns), path, "overwrite", batch_id="at 10:00", partition_cols=["event_type"])
    redone = events.filter(F.col("event_type").isin("view", "purchase") & (F.col("value") < 50))
    redone = redone.withColumn("value", F.col("value") + 1).select(*columns)
    return write_table(redone, path, "replace_partitions", batch_id="at 11:00%3A").read()


@query(f"WITH {oracle._TARGET}, {oracle._SOURCE} {oracle._MERGED}")
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without partitions, in buckets of its key: a merge replaces only buckets of its rows."""
    path = f"{Scratch(spark).path}/orders"
    layout = {"merge_keys": ["o_orderkey"], "partition_cols": ["bucket(32)"]}
    write_table(data.orders_target(spark, sf_dir), path, "merge", batch_id="run-1", **layout)
    return write_table(data.orders_source(spark, sf_dir), path, "merge", batch_id="run-2", **layout).read()


LINES = [
    Measure("n_lines", "count"),
    Measure("quantity", "sum", "CAST(l_quantity AS BIGINT)"),
    Measure("first_ship", "min", "l_shipdate"),
    Measure("last_ship", "max", "l_shipdate"),
    Measure("n_numbers", "distinct", "l_linenumber"),
]


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
          CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, min(l_shipdate) AS first_ship,
          max(l_shipdate) AS last_ship, count(DISTINCT l_linenumber) AS n_numbers
        FROM lineitem GROUP BY 1, 2"""
)
def gold_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of the line items that grows by three loads, one of which is repeated."""
    gold = Summary(spark, f"{Scratch(spark).path}/gold", ["l_returnflag", "l_linestatus"], LINES)
    lines = table(spark, sf_dir, "lineitem")
    for part in (0, 1, 2, 1):
        gold.add(lines.filter(F.col("l_orderkey") % 3 == part), f"load-{part}")
    return gold.read()


@query(
    """WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
        one AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
          o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_orderdate FROM o
          UNION ALL SELECT -o_orderkey, 'N', o_totalprice, o_orderdate FROM o WHERE o_orderkey % 7 = 0 AND o_orderkey > 0),
        two AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'N' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
          o_totalprice, o_orderdate FROM one)
        SELECT o_orderstatus, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18, 2)))::DOUBLE AS price,
          min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM two GROUP BY 1"""
)
def gold_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary that follows two merges which move orders between its groups, and empty one."""
    root = Scratch(spark).path
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    layout = {"merge_keys": ["o_orderkey"], "partition_cols": ["bucket(16)"]}
    base = write_table(orders, f"{root}/orders", "merge", batch_id="run-1", **layout)
    measures = [
        Measure("n_orders", "count"),
        Measure("price", "sum", "CAST(o_totalprice AS DECIMAL(18, 2))"),
        Measure("first_order", "min", "o_orderdate"),
        Measure("last_order", "max", "o_orderdate"),
    ]
    gold = Summary(spark, f"{root}/gold", ["o_orderstatus"], measures)
    gold.refresh(base)
    moved = orders.filter("o_orderkey % 5 = 0").withColumns({"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1})
    new = orders.filter("o_orderkey % 7 = 0 AND o_orderkey > 0").withColumns({"o_orderkey": -F.col("o_orderkey"), "o_orderstatus": F.lit("N")})
    write_table(moved.unionByName(new), base.path, "merge", batch_id="run-2", changes=True, **layout)
    gold.refresh(base)
    opened = new.withColumn("o_orderstatus", F.lit("O"))
    write_table(opened, base.path, "merge", batch_id="run-3", changes=True, **layout)
    gold.refresh(base)
    return gold.read().withColumn("price", F.col("price").cast("double"))


_LINE_TEXT = """'{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","event_type":"'
  || event_type || '"' || CASE WHEN event_id % 50 = 0 THEN '' ELSE '}' END"""


@query(
    f"""WITH lines AS (SELECT event_id, {_LINE_TEXT} AS line FROM events)
        SELECT CASE WHEN event_id % 50 <> 0 THEN event_id END AS event_id,
          CASE WHEN event_id % 50 = 0 THEN 'line_well_formed' END AS failed_rule,
          CASE WHEN event_id % 50 = 0 THEN line END AS line FROM lines"""
)
def corrupt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of text, each fiftieth cut short: the others are loaded, these are held as they are."""
    store, target = _store(spark, sf_dir, "append", {}, [Rule("event_known", "event_id", "NOT_NULL")])
    landing = f"{store.root}/landing"
    end = F.when(F.col("event_id") % 50 == 0, "").otherwise("}")
    line = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"ts":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('","event_type":"'), "event_type", F.lit('"'), end,
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(landing)
    store.update("table_config", "layer = 'landing'", {"storage_path": F.lit(landing), "file_format": F.lit("json")})
    options = LoadOptions(schema="event_id LONG, ts STRING, event_type STRING")
    run_incremental(spark, store, "events", now=datetime(2030, 1, 1), run_id="run-1", options=options)
    loaded = target.read().select("event_id", F.lit(None).cast("string").alias("failed_rule"), F.lit(None).cast("string").alias("line"))
    held = store.quarantine("events").read().select("event_id", "failed_rule", F.col("_corrupt_line").alias("line"))
    return loaded.unionByName(held)


@query(
    f"""WITH {oracle._STEPS}, d AS (SELECT *, date_sub('second', start_time, end_time) AS spent FROM steps)
        SELECT step_name, count(*) AS n_steps, count(CASE WHEN status = 'FAILED' THEN 1 END) AS n_failed,
          CAST(sum(spent) AS BIGINT) AS total_seconds, max(spent) AS max_seconds, TRUE AS p50_near, TRUE AS p95_near
        FROM d GROUP BY step_name"""
)
def step_profile_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the steps from states that are stored per step and day, added to by two loads. Quantiles come
    from sketches, so only whether they are near is returned: their rank is off by 0.02 at most."""
    steps = data.steps(spark, sf_dir)
    stored = step_profiles(spark, f"{Scratch(spark).path}/profiles")
    odd = F.crc32(F.col("step_run_id").cast("binary")) % 2
    for part in (0, 1):
        stored.add(steps.filter(odd == part), f"load-{part}")
    found = stored.read_by(["step_name"])
    spent = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")).cast("double")
    known = steps.select("step_name", spent.alias("spent")).join(F.broadcast(found), "step_name")
    names = ["step_name", "n_steps", "n_failed", "total_seconds", "max_seconds"]
    near = [
        ((F.avg((F.col("spent") < F.col(q)).cast("int")) <= at + 0.02) & (F.avg((F.col("spent") <= F.col(q)).cast("int")) >= at - 0.02)).alias(f"{q}_near")
        for q, at in (("p50", 0.5), ("p95", 0.95))
    ]
    return known.groupBy(*names).agg(*near)


_PARENTS = """deps AS (SELECT DISTINCT l_orderkey::VARCHAR AS c, l_suppkey::VARCHAR AS p FROM lineitem
  WHERE l_returnflag <> 'R' AND l_suppkey < l_orderkey)"""


@query(
    f"""WITH RECURSIVE {_PARENTS}, reached AS (SELECT p AS n, 0 AS level FROM deps WHERE p NOT IN (SELECT c FROM deps)
          UNION SELECT c, level + 1 FROM reached JOIN deps ON p = n)
        SELECT n AS pipeline_id, CAST(max(level) AS INTEGER) AS level FROM reached GROUP BY n"""
)
def dependency_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waves in which pipelines can run, where each order waits for its suppliers of smaller number."""
    smaller = F.col("parent_pipeline_id").cast("long") < F.col("pipeline_id").cast("long")
    return graphs.dependency_levels(data.dependencies(spark, sf_dir).filter(smaller))


@query(
    """WITH RECURSIVE deps AS (SELECT DISTINCT l_orderkey::VARCHAR AS c, l_suppkey::VARCHAR AS p FROM lineitem
          WHERE l_returnflag <> 'R'),
        inner_deps AS (SELECT c, p FROM deps WHERE c IN (SELECT p FROM deps)),
        reach AS (SELECT c AS a, p AS b FROM inner_deps UNION SELECT a, p FROM reach JOIN inner_deps ON c = b),
        both_ways AS (SELECT x.a, x.b FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a)
        SELECT a AS pipeline_id, min(b) AS cycle FROM both_ways GROUP BY a"""
)
def dependency_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines that wait for each other, where each order waits for all its suppliers."""
    return graphs.dependency_cycles(data.dependencies(spark, sf_dir))


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = data.path(sf_dir, "events")
    reader = spark.readStream.schema(data.EVENTS)
    if not storage.is_dir(spark, source):  # a stream watches a folder: narrow it to the one file
        source, reader = sf_dir, reader.option("pathGlobFilter", "events.parquet")
    return reader.parquet(source)


_TOP = "top AS (SELECT max(ts) AS t FROM events)"


@query(
    f"""WITH {_TOP}, w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type,
          count(*) AS n_events, count(DISTINCT event_type) AS n_types, max(event_id) AS last_id FROM events GROUP BY 1, 2)
        SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, n_events, n_types, last_id
        FROM w, top WHERE window_start + INTERVAL 6 HOUR <= t - INTERVAL 1 DAY"""
)
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type in windows of six hours that are a day behind the newest event."""
    measures = [Measure("n_events", "count"), Measure("n_types", "distinct", "event_type"), Measure("last_id", "max", "event_id")]
    found = windows.tumbling(_events_stream(spark, sf_dir), "ts", "6 hours", "1 day", ["event_type"], measures)
    return _streamed(spark, found)


@query(
    f"""WITH {_TOP}, e AS (SELECT user_id, ts, ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 8 HOUR AS far
          FROM events), s AS (SELECT user_id, ts, sum(CASE WHEN far THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
          ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e),
        w AS (SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 8 HOUR AS window_end, count(*) AS n_events
          FROM s GROUP BY user_id, k)
        SELECT window_start, window_end, user_id, n_events FROM w, top WHERE window_end <= t - INTERVAL 1 DAY"""
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users, whose events are less than eight hours apart."""
    found = windows.sessions(_events_stream(spark, sf_dir), "ts", "8 hours", "1 day", ["user_id"], [Measure("n_events", "count")])
    return _streamed(spark, found)


@query("SELECT DISTINCT user_id, event_type FROM events WHERE ts IS NOT NULL")
def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of user and type once, as long as it is remembered."""
    stream = _events_stream(spark, sf_dir)
    return _streamed(spark, windows.unique_within(stream, "ts", "60 days", ["user_id", "event_type"]).select("user_id", "event_type"))


def _streamed(spark: SparkSession, result: DataFrame) -> DataFrame:
    root = Scratch(spark).path
    found = windows.append_available(spark, result, f"{root}/result", f"{root}/checkpoint").read()
    times = {f.name: utc_wall_clock(F.col(f.name)) for f in found.schema.fields if f.dataType.simpleString() == "timestamp"}
    return found.withColumns(times) if times else found


@query(
    """WITH e AS (SELECT event_id, ts FROM events WHERE event_type <> 'error'), cut AS (SELECT TIMESTAMP '2024-01-15' AS t),
        last AS (SELECT TIMESTAMP '2024-02-01' AS t)
        SELECT 'gold-1' AS run_id, 0 AS steps, 'gold' AS pipeline_id,
          (SELECT count(DISTINCT event_type) FROM events WHERE ts <= (SELECT t FROM last) AND event_type <> 'error') AS n_rows, NULL AS file
        UNION ALL SELECT 'silver-1', 1, 'silver', count(*), NULL FROM e WHERE ts <= (SELECT t FROM cut)
        UNION ALL SELECT 'silver-2', 1, 'silver', count(*), NULL FROM e WHERE ts > (SELECT t FROM cut) AND ts <= (SELECT t FROM last)
        UNION ALL SELECT 'bronze-1', 2, 'events', count(*), 'events.parquet' FROM events WHERE ts <= (SELECT t FROM cut)
        UNION ALL SELECT 'bronze-2', 2, 'events', count(*), 'events.parquet' FROM events
          WHERE ts > (SELECT t FROM cut) AND ts <= (SELECT t FROM last)"""
)
def trace_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one group of a summary back through three layers to the file."""
    store, _ = _store(spark, sf_dir, "append", {}, [])
    pipeline, entry = store.read("pipeline_config").first().asDict(), store.read("table_config").filter("layer = 'bronze'").first().asDict()
    for below, layer, above in (("bronze", "silver", "events"), ("silver", "gold", "silver")):
        source = {**entry, "pipeline_id": layer, "table_id": f"{layer}-src", "layer": below, "storage_path": f"{store.root}/{below}/events"}
        target = {**source, "table_id": f"{layer}-tgt", "layer": layer, "storage_path": f"{store.root}/{layer}/events"}
        target["write_mode"] = "overwrite" if layer == "gold" else "append"
        store.append("table_config", [source, target], layer)
        store.append("pipeline_config", [{**pipeline, "pipeline_id": layer}], layer)
    store.put_watermark(WatermarkState("w2", "silver", "silver-tgt", "ts"), datetime(2024, 1, 1))
    known = LoadOptions(transform=lambda df: df.filter("event_type <> 'error'"))
    by_type = LoadOptions(transform=rollup(["event_type"], {"n": "count(*)"}), track_new=False)
    for n, now in ((1, datetime(2024, 1, 15)), (2, datetime(2024, 2, 1))):
        run_incremental(spark, store, "events", now=now, run_id=f"bronze-{n}")
        run_incremental(spark, store, "silver", now=now, run_id=f"silver-{n}", options=known)
    run_incremental(spark, store, "gold", now=now, run_id="gold-1", watermark_col="ts", options=by_type)
    group = VersionedTable(spark, f"{store.root}/gold/events").read().filter("event_type = 'click'")
    found = lineage.trace_lineage(store, group)
    file = F.regexp_extract(F.get("files", F.lit(0)), "([^/]*[.]parquet)(/[^/]*)?$", 1)
    return found.select("run_id", "steps", "pipeline_id", "n_rows", file.alias("file"))


@query(
    """SELECT o_custkey::VARCHAR AS pipeline_id, count(*) AS n_runs, max(o_orderdate) AS last_start FROM orders GROUP BY 1"""
)
def folded_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit table that took the runs in twelve loads, folded after the tenth beside the last two."""
    runs = data.runs(spark, sf_dir)
    audit = VersionedTable(spark, f"{Scratch(spark).path}/runs")
    for month in range(1, 13):
        audit.append(runs.filter(F.month("execution_start") == month), f"month-{month}", counted=False)
        if month == 10:
            time.sleep(0.1)
            assert audit.fold_segments(utc_now()) == 9
    assert audit.segment_count == 3
    return audit.read().groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("n_runs"), F.max("execution_start").alias("last_start"))


@query("SELECT event_id, ts, user_id, event_type, value, 'run-1' AS batch_id FROM events WHERE ts <= TIMESTAMP '2024-02-01' AND event_type IN ('view', 'click')")
def inactive_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two pipelines that share the events by type one is switched off: it neither loads nor leaves a trace."""
    store, target = _store(spark, sf_dir, "append", {}, [])
    more = [{**r.asDict(), "pipeline_id": "rest", "table_id": f"{r.table_id}-rest"} for r in store.read("table_config").collect()]
    store.append("table_config", more, "rest")
    pipeline = store.read("pipeline_config").first().asDict()
    store.append("pipeline_config", [{**pipeline, "pipeline_id": "rest", "is_active": False}], "rest")
    seen = F.col("event_type").isin("view", "click")
    for run_id, pipeline_id, mine in (("run-1", "events", seen), ("run-2", "rest", ~seen)):
        options = LoadOptions(transform=lambda df, mine=mine: df.filter(mine))
        run_incremental(spark, store, pipeline_id, now=datetime(2024, 2, 1), run_id=run_id, options=options)
    runs = store.read("audit_pipeline_execution").select("run_id").distinct()
    return target.read().join(runs.withColumnRenamed("run_id", "batch_id"), "batch_id").select(*EVENT)


@query(
    """WITH e AS (SELECT count(*) AS n, max(ts) AS t FROM events WHERE ts <= TIMESTAMP '2024-02-01')
        SELECT 'run-1' AS run_id, 'SUCCESS' AS status, n AS records_read, n AS records_written, t AS watermark_end FROM e
        UNION ALL SELECT 'run-2', 'SUCCESS', 0, 0, t FROM e"""
)
def empty_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run finds nothing new: it succeeds, writes nothing and keeps the watermark."""
    store, _ = _store(spark, sf_dir, "append", {}, EVENT_RULES[:1])
    for run_id in ("run-1", "run-2"):
        run_incremental(spark, store, "events", now=datetime(2024, 2, 1), run_id=run_id)
    runs = reports.latest_runs(store.read("audit_pipeline_execution"))
    end = utc_wall_clock(F.col("watermark_end")).alias("watermark_end")
    return runs.select("run_id", "status", "records_read", "records_written", end)


@query("SELECT event_id, ts, user_id, event_type, value, 'run-1' AS batch_id FROM events WHERE ts <= TIMESTAMP '2024-02-01'")
def no_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without rules all rows are clean."""
    store, target = _store(spark, sf_dir, "append", {}, [])
    run_incremental(spark, store, "events", now=datetime(2024, 2, 1), run_id="run-1")
    return target.read().select(*EVENT)
