"""Session settings, size checks for broadcasts, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: Spark's own default number of shuffle partitions.
DEFAULT_PARTITIONS = "200"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators rely on: UTC days, runtime re-planning, skew splits, a state store on disk."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set(STATE_PROVIDER, ROCKSDB_PROVIDER)
    # Rows may be whole texts: smaller batches keep the memory of Python workers and of their buffers small.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    context = spark.sparkContext
    if context.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == DEFAULT_PARTITIONS:
        # Stateful streams run one task per shuffle partition: a local session needs no more than its cores.
        spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing *and* the master is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-"))
    return context.getCheckpointDir()


_given: list[str] = []


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared work folder."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the tables that this process wrote to the work folder so far: call it once their results are written."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    while _given:
        path = hadoop.Path(_given.pop())
        path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends at files that outlive executors."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 32 << 20) -> bool:
    """Measure ``df``: reads at most ``max_rows + 1`` rows, so the check stays cheap on a large side."""
    measured = (
        df.limit(max_rows + 1)
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
        )
        .first()
    )
    return measured["n"] <= max_rows and measured["bytes"] <= max_bytes


def _row_bytes(df: DataFrame) -> Column:
    """Approximate size of a row: text and binary by length, nested values as JSON, 8 bytes for the rest."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            total = total + 8
    return total


def small_side(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 32 << 20, merge: bool = False) -> DataFrame:
    """Hint a broadcast when the measured side is small; otherwise leave the join to Spark, or with ``merge`` hint a
    shuffled one: for sides that are far larger than the files they come from."""
    if is_small(df, max_rows, max_bytes):
        return F.broadcast(df)
    return df.hint("merge") if merge else df


def salt_count(spark: SparkSession) -> int:
    """Default number of slices for one hot group: as many as the session has shuffle partitions."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scalar(df: DataFrame, value: Column) -> Column:
    """One aggregate of ``df`` as a scalar subquery, so no driver round trip is needed."""
    return df.select(value).scalar()
