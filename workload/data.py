"""Frames the queries run on: the test tables, and control and audit frames derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layouts of the two tables that are read as configured sources.
EVENTS = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def ntz(text: str) -> Column:
    return F.lit(text).cast(T.TimestampNTZType())


def text(column: str) -> Column:
    return F.col(column).cast("string")


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders already loaded."""
    return table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < ntz("1998-01-01"))


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the next load, with corrected prices; half a year overlaps the target."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") > ntz("1997-07-01"))
    return orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def with_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_year", F.year("o_orderdate"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows: every order is a run of its customer's pipeline."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "FAILED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("SUCCESS")
    )
    start = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("run_id"),
        text("o_custkey").alias("pipeline_id"),
        start.alias("execution_start"),
        F.when(status != "RUNNING", start + F.expr("INTERVAL 1 HOUR")).alias("execution_end"),
        F.when(status == "SUCCESS", start).alias("watermark_end"),
        F.col("o_orderkey").alias("records_read"),
        status.alias("status"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log as it is appended: an opening row per run, a closing row once it has ended."""
    closed = runs(spark, sf_dir)
    opened = closed.withColumns(
        {
            "execution_end": F.lit(None).cast("timestamp_ntz"),
            "watermark_end": F.lit(None).cast("timestamp_ntz"),
            "records_read": F.lit(None).cast("long"),
            "status": F.lit("RUNNING"),
        }
    )
    return opened.unionByName(closed.filter(F.col("execution_end").isNotNull()))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a step of its order's run, lasting as many minutes as its quantity."""
    name = (
        F.when(F.col("l_returnflag") == "R", "extract")
        .when(F.col("l_returnflag") == "A", "dq_checks")
        .otherwise("target_load")
    )
    minutes = F.make_dt_interval(mins=F.col("l_quantity").cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "step_run_id"
        ),
        text("l_orderkey").alias("run_id"),
        name.alias("step_name"),
        F.col("l_shipdate").alias("start_time"),
        (F.col("l_shipdate") + minutes).alias("end_time"),
        F.when(F.col("l_linestatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("l_partkey").alias("records_processed"),
    )


def reconciliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per customer; pending orders of high value are missing from the quarantine."""
    status = F.col("o_orderstatus")
    held = (status == "P") & (F.col("o_totalprice") < 400000)
    return (
        table(spark, sf_dir, "orders")
        .groupBy(text("o_custkey").alias("pipeline_id"))
        .agg(
            F.count(F.lit(1)).alias("source_count"),
            F.count_if(status == "F").alias("target_inserted_count"),
            F.count_if(status == "O").alias("target_updated_count"),
            F.count_if(held).alias("quarantine_count"),
        )
    )


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a rule result of its order's run."""
    failed = F.col("l_discount") > 0.05
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("run_id"),
        text("l_suppkey").alias("rule_id"),
        F.when(failed, F.col("l_quantity").cast("long")).otherwise(0).alias("failed_records"),
        F.when(failed, "FAILED_QUARANTINED").otherwise("PASSED").alias("status"),
    )


def watermark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a state of its user's watermark."""
    backfill = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").select(
        text("event_id").alias("watermark_id"),
        text("user_id").alias("pipeline_id"),
        F.col("ts").alias("last_watermark_value"),
        F.when(F.col("event_type") == "view", 60).otherwise(0).cast("long").alias(
            "lookback_minutes"
        ),
        F.when(backfill, "ACTIVE").otherwise("NONE").alias("backfill_status"),
        F.when(backfill, F.col("ts") - F.expr("INTERVAL 2 DAYS")).alias("backfill_start"),
        F.when(backfill, F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("backfill_end"),
        F.col("ts").alias("updated_at"),
    )


def pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("pipeline_id"),
        F.col("c_name").alias("pipeline_name"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def config_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a table of its customer's pipeline, in the layer its priority stands for."""
    rank = F.substring("o_orderpriority", 1, 1)
    layer = (
        F.when(rank == "1", "landing")
        .when(rank == "3", "silver")
        .when(rank == "4", "gold")
        .otherwise("bronze")
    )
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("table_id"),
        text("o_custkey").alias("pipeline_id"),
        layer.alias("layer"),
        F.concat(F.lit("/data/"), text("o_orderkey")).alias("storage_path"),
        F.when(F.col("o_orderstatus") == "F", "json").otherwise("csv").alias("file_format"),
        F.when(F.col("o_orderstatus") == "P", "merge").otherwise("append").alias("write_mode"),
    )


def config_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a rule on the table its part stands for."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("rule_id"),
        text("l_partkey").alias("table_id"),
        F.when(F.col("l_returnflag") == "R", "RANGE").otherwise("NOT_NULL").alias("rule_type"),
        (F.col("l_discount") > 0.03).alias("is_active"),
    )


def rule_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        text("p_partkey").alias("table_id"), F.col("p_brand").alias("pipeline_id")
    )


def dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item makes its order wait for its supplier."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("pipeline_id"),
        text("l_suppkey").alias("parent_pipeline_id"),
        (F.col("l_returnflag") != "R").alias("is_active"),
    )
