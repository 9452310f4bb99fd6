"""Queries by name, with DuckDB SQL for the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the folder all machines share; a local session without one takes a temporary folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(root or tempfile.mkdtemp()).rstrip('/')}/tessera-{what}-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None) -> Callable:
    """Registers fn(tables) under name."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLE_SQL[name] = sql if "{CH}" not in sql and "{JOBS}" not in sql else sql.replace("{CH}", CHAPTERS_SQL).replace("{JOBS}", JOBS_SQL)
        return fn

    return add


# The test tables stand for chapters of stories and for jobs:

CHAPTERS_SQL = """chapters AS (
    SELECT o_orderkey AS id, o_custkey AS story_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS number,
           o_orderstatus = 'F' AS polished, o_orderstatus <> 'P' AS downloaded, o_totalprice AS size, o_orderdate AS at FROM orders)"""

JOBS_SQL = """jobs AS (
    SELECT o_orderkey AS job_id, o_custkey AS story_id, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'running' END AS status,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, o_orderkey % 4 AS attempts, 3 AS max_attempts, o_orderdate AS run_after,
           CASE WHEN o_orderstatus = 'P' THEN 'w1' END AS locked_by, CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS locked_at FROM orders)"""


def chapters(t: Tables) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("story_id"), number.cast("long").alias("number"), (F.col("o_orderstatus") == "F").alias("polished"), (F.col("o_orderstatus") != "P").alias("downloaded"), F.col("o_totalprice").alias("size"), F.col("o_orderdate").alias("at"))


def jobs(t: Tables) -> DataFrame:
    running = F.col("o_orderstatus") == "P"
    return t.orders.select(
        F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("story_id"), F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("running").alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), (F.col("o_orderkey") % 4).alias("attempts"), F.lit(3).alias("max_attempts"), F.col("o_orderdate").alias("run_after"),
        F.when(running, "w1").alias("locked_by"), F.when(running, F.col("o_orderdate")).alias("locked_at"),
    )
