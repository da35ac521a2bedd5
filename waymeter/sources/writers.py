"""Writers: tables, staged batches, reports and the prediction log.

Every writer is one distributed ``write``; none passes rows through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> str:
    """Write a table as Parquet, ORC, JSON or CSV with a header."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def append_trips(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Existing trips followed by a batch; columns only one side has are null on the other."""
    return existing.unionByName(batch, allowMissingColumns=True)


def append_table(batch: DataFrame, path: str) -> str:
    """Add a batch to a stored table without rewriting what is there."""
    batch.write.mode("append").parquet(path)
    return path


def stage_batch(batch: DataFrame, folder: str, name: str) -> str:
    """Put a batch into the incoming folder, one partition per batch."""
    batch.withColumn("batch", F.lit(name)).write.mode("append").partitionBy("batch").parquet(folder)
    return folder


def stage_batch_at(batch: DataFrame, folder: str, at: datetime) -> str:
    """Put a batch into a folder of its own, named after the time of its arrival, and return that folder.

    AQE sizes its files: a small batch is one, a large one as many as it has advisory partition sizes.
    """
    path = f"{folder}/batch_{at:%Y%m%d_%H%M%S}"
    batch.hint("rebalance").write.mode("error").parquet(path)
    return path


def stage_batches(rows: DataFrame, folder: str, by: str) -> str:
    """Put a batch per value of a column into the incoming folder, in one write. Rows keep that column."""
    rows.withColumn("batch", F.col(by)).write.mode("append").partitionBy("batch").parquet(folder)
    return folder


def append_predictions(scored: DataFrame, path: str) -> str:
    """Append scored trips to the prediction log, partitioned by day so that scans can prune."""
    (
        scored.withColumn("log_date", F.to_date("timestamp"))
        .write.mode("append")
        .partitionBy("log_date")
        .parquet(path)
    )
    return path


def write_report(df: DataFrame, path: str) -> str:
    """Write a one-row report as a JSON document."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path
