"""Session settings for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Small enough that a table written by few tasks is still read by many.
ROW_GROUP_BYTES = 8 << 20
# Rows of terms that a bucket of documents is meant to hold.
BUCKET_ROWS = 1 << 22


def local_session(cpus: int | str = "*", name: str = "tidemark", memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.default.parallelism", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that `spark.checkpoint.dir` names.

    A cluster must name a folder that all executors see. Only a local master falls
    back to a temporary folder, because there the driver is the only machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` once to the shared folder and read it back, which cuts its lineage.

    The copy outlives any executor, and its file sizes give the planner real
    statistics for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buckets_for(rows: DataFrame) -> int:
    """Buckets for a table of so many rows, or for what they are put together to; every core has one."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // BUCKET_ROWS))


def bucketed(df: DataFrame, key: str, buckets: int, label: str = "table") -> DataFrame:
    """Write `df` once to the shared folder, in buckets by `key`, and read it back.

    A join or aggregation on the key doesn't exchange the table any more.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = df.write.option("path", path).option("parquet.block.size", ROW_GROUP_BYTES)
    rows.bucketBy(buckets, key).saveAsTable(name, format="parquet")
    return spark.table(name)


def spread(df: DataFrame) -> DataFrame:
    """Persist input that is read again and again, evenly over the cores.

    Rows are only moved when the fullest partition holds more than twice its share.
    """
    kept = df.persist()
    cores = df.sparkSession.sparkContext.defaultParallelism
    profile = kept.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).select("n")
    sizes = [row.n for row in profile.collect()]
    partitions = max(cores, len(sizes))
    if not sizes or max(sizes) <= 2 * sum(sizes) / partitions + 1:
        return kept
    even = kept.repartition(partitions).persist()
    even.count()
    kept.unpersist()
    return even
