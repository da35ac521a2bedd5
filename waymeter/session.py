"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that do not depend on the cluster size. Executor sizes and the number of shuffle
# partitions belong to the submit command; AQE coalesces and splits partitions at run time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    # HotSpot leaves methods above 8000 bytes of bytecode to the interpreter. A stage whose generated
    # method is larger runs several times faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows that pass between the JVM and Python at once. Texts make large batches, whose buffers the JVM keeps outside its heap.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings the results or the speed of this library depend on, which a running session can still take.
NEEDED = ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit", "spark.sql.execution.arrow.maxRecordsPerBatch")

# Bytes of a row group of an intermediate table; a writer holds one in memory.
ROW_GROUP = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the needed settings to a session that someone else built."""
    for key in NEEDED:
        spark.conf.set(key, RECOMMENDED[key])
    return spark


def build_session(app: str = "waymeter", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only on one machine, as in tests, a temporary folder is set where the session names none. On a
    cluster that is an error: executors would write to disks that the others can't read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="waymeter-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/waymeter/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a durable table: a lost executor rereads files rather than recomputing
    the shuffles, and the planner sees the table's true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
