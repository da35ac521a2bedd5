"""Streaming twins of the batch operators.

Each job takes a streaming DataFrame and a folder on shared storage, and returns the started query.
Sinks are files; nothing is gathered on the driver. A job that writes from ``foreachBatch`` writes
into a partition named after the micro-batch and overwrites it on a retry, so a batch that runs twice
leaves one copy.

Event-time jobs assume that files land in event-time order; rows later than the watermark are
dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waymeter.functions.columns import quoted
from waymeter.operators import clean as cleaning
from waymeter.operators import drift, metrics, policy, score, validate
from waymeter.operators.registry import ModelStore
from waymeter.params import DriftRules, TripRules
from waymeter.session import materialize

WATERMARK = "10 minutes"
# Groups that the copies of one key are spread over before they meet.
SALTS = 16


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files below a path. ``path`` may be a folder or a glob."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def incoming_stream(spark: SparkSession, folder: str, schema: T.StructType, archive: str, fmt: str = "parquet", most: int = 8 << 30) -> DataFrame:
    """A stream of the batches below ``folder``; files that were taken are moved below ``archive``.

    A micro-batch takes the files that wait, up to ``most`` bytes of them. A file is moved after the micro-batch that follows the one that
    took it, so after the last one some may still lie in ``folder``; the checkpoint knows them. ``archive`` must not lie in ``folder``.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive).option("maxBytesPerTrigger", most).load(folder)


def event_time(df: DataFrame, column: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Cast the event time to a zoned timestamp, which watermarks need, and set the watermark."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


# --- sinks -----------------------------------------------------------------------------------


def append_to(df: DataFrame, folder: str) -> StreamingQuery:
    """Exactly-once append to Parquet files; processes what is there, then stops."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/data")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def write_batches(df: DataFrame, folder: str, write: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def keep_latest(df: DataFrame, folder: str) -> StreamingQuery:
    """Complete mode: each micro-batch writes the whole current aggregate as a new version.

    A version is complete once its success file is there; readers take it through :func:`latest`. The
    aggregate is written in parallel; its size is the number of groups.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/data/version={batch_id}")

    return write_batches(df, folder, write, "complete")


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version that :func:`keep_latest` has written."""
    rows = spark.read.parquet(f"{folder}/data")
    newest = rows.agg(F.max("version")).first()[0]
    return rows.where(F.col("version") == newest).drop("version")


def finish(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise what it raised."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


# --- jobs ------------------------------------------------------------------------------------


def clean_stream(raw: DataFrame, folder: str, rules: TripRules = TripRules()) -> StreamingQuery:
    """Incoming trips → ``valid`` and ``rejected`` tables, and a row of ``accounting`` for each micro-batch.

    Copies are removed within a micro-batch. Copies of a row that came in different batches are
    removed by :func:`cleaned_so_far`, which needs no unbounded state. The job that writes the valid rows
    counts what it drops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        std = cleaning.standardize(batch).persist()
        try:
            usable = cleaning.Accounted(std, rules)
            usable.rows.write.mode("overwrite").parquet(f"{folder}/valid/batch_id={batch_id}")
            usable.counts().coalesce(1).write.mode("overwrite").parquet(f"{folder}/accounting/batch_id={batch_id}")
            std.where(cleaning.rejected(std, rules)).write.mode("overwrite").parquet(
                f"{folder}/rejected/batch_id={batch_id}"
            )
        finally:
            std.unpersist()

    return write_batches(raw, folder, write)


def cleaned_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """The clean trips of all micro-batches, each once."""
    return spark.read.parquet(f"{folder}/valid").drop("batch_id").dropDuplicates()


def score_stream(requests: DataFrame, folder: str, predict: score.Predictor, *extra: str) -> StreamingQuery:
    """Validate, score and append to the prediction log; rejected requests do not pass."""
    valid, _ = validate.split_requests(requests)
    return append_to(score.log_rows(score.score_requests(valid, predict), *extra), folder)


def score_stream_following(requests: DataFrame, folder: str, store: ModelStore, *extra: str) -> StreamingQuery:
    """Score each micro-batch with the model that is the champion when it starts, and log the version beside the prediction.

    The version is written before the batch is scored, so a batch that runs again after a failure takes the same model,
    whatever was promoted meanwhile.
    """
    chosen: dict[int, score.Predictor] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        pinned = f"{folder}/versions/batch_id={batch_id}"
        row = session.read.schema("version int").json(pinned).first() if _exists(session, pinned) else None
        version = row["version"] if row else store.champion()
        if version is None:
            raise RuntimeError("no model has been promoted")
        if not row:
            session.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").json(pinned)
        if version not in chosen:
            chosen.clear()
            chosen[version] = score.model_predictor(*store.load(version))
        valid, _ = validate.split_requests(batch)
        rows = score.log_rows(score.score_requests(valid, chosen[version]), *extra).withColumn("model_version", F.lit(version))
        rows.write.mode("overwrite").parquet(f"{folder}/data/batch_id={batch_id}")

    return write_batches(requests, folder, write)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018  looks the path up
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def quarantine_stream(requests: DataFrame, folder: str) -> StreamingQuery:
    """Append the rejected requests with their reasons."""
    _, rejected = validate.split_requests(requests)
    return append_to(rejected, folder)


def count_stream(log: DataFrame, folder: str, finished_only: bool = True) -> StreamingQuery:
    """Requests per minute, status and endpoint; ``ts`` carries the watermark.

    A window is appended once the watermark has passed it, and its state is dropped, which is what a
    job that never ends needs. Without ``finished_only`` the table holds all windows after every
    micro-batch, for backfills; state and versions then grow.
    """
    table = metrics.requests_per_minute(log)
    return append_to(table, folder) if finished_only else keep_latest(table, folder)


def histogram_stream(log: DataFrame, folder: str, finished_only: bool = True) -> StreamingQuery:
    """Sliding five-minute histogram of predicted minutes; ``finished_only`` as in :func:`count_stream`."""
    table = metrics.streamed_sliding_histogram(log)
    return append_to(table, folder) if finished_only else keep_latest(table, folder)


def drop_repeats(df: DataFrame, key: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Keep the first row of each key within the watermark.

    In two steps, so that a key that floods the stream is not one task's work: first per (key, salt),
    where the salt comes from the input partition, then per key over at most ``salts`` rows of a
    micro-batch.
    """
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    return salted.dropDuplicatesWithinWatermark([*key, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(list(key))


def drop_copies(df: DataFrame, remember: str = "7 days") -> DataFrame:
    """Leave out rows that are equal to one that came before, in any micro-batch.

    The state keeps a hash of each row, keyed by it, for ``remember`` after the row arrived, so a micro-batch costs the
    same however many went before. ``df`` must not have a watermark of its own.
    """
    row = F.md5(F.to_json(F.struct(*[quoted(c) for c in df.columns])))
    arrived = df.withColumns({"_row": row, "_arrival": F.current_timestamp()}).withWatermark("_arrival", remember)
    return drop_repeats(arrived, ["_row"]).drop("_row", "_arrival")


def dedupe_stream(log: DataFrame, folder: str, key: Sequence[str] = ("event_id",)) -> StreamingQuery:
    """Drop repeated requests; the state of a key is dropped once the watermark has passed it."""
    return append_to(drop_repeats(log, key), folder)


def match_stream(predictions: DataFrame, actuals: DataFrame, folder: str, key: str = "event_id", unmatched: bool = False) -> StreamingQuery:
    """Join predictions with actual durations, repeated rows dropped on both sides.

    With ``unmatched`` a prediction for which none can come any more is appended too, without an actual duration.

    Both sides carry a watermark; the join state is bounded by the four hours within which an actual
    must arrive.
    """
    once = [drop_repeats(side, [key]) for side in (predictions, actuals)]
    return append_to(metrics.match_actuals(*once, key, unmatched=unmatched), folder)


def drift_stream(
    current: DataFrame,
    folder: str,
    baseline: DataFrame,
    columns: Sequence[str],
    baseline_rmse: DataFrame | None = None,
    errors: Callable[[DataFrame], DataFrame] | None = None,
    method: str = "series",
    rules: DriftRules = DriftRules(),
    once: bool = False,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Drift of each micro-batch against a stored baseline, and the decision that follows.

    The baseline is reduced to its value counts once, before the stream starts; a micro-batch adds its
    own. Writes the feature records, the summary and, where an error measure is given, the decision,
    each in a partition per micro-batch.

    ``once``: a row of ``current`` that came before, in the same or an earlier micro-batch, is left out; see
    :func:`drop_copies`. ``derive`` is applied to what is left, before counting; give it where copies can only be told
    on the whole rows.
    """
    known = drift.value_counts(baseline.withColumn(drift.SIDE, F.lit(False)), columns)
    known = materialize(known, "baseline-counts")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = (derive(batch) if derive is not None else batch).persist()
        if batch.isEmpty():
            batch.unpersist()
            return
        try:
            new = drift.value_counts(batch.withColumn(drift.SIDE, F.lit(True)), columns)
            table = drift.ks_from_counts(drift.merge_counts(known, new), columns)
            out = f"{folder}/features/batch_id={batch_id}"
            drift.feature_records(table, method, rules).write.mode("overwrite").parquet(out)
            summary = drift.drift_summary(batch.sparkSession.read.parquet(out), rules)
            summary.write.mode("overwrite").parquet(f"{folder}/summary/batch_id={batch_id}")
            if errors is not None and baseline_rmse is not None:
                decision = policy.retrain_decision(baseline_rmse, errors(batch), summary, rules)
                decision.write.mode("overwrite").parquet(f"{folder}/decision/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write_batches(drop_copies(current) if once else current, folder, write)
