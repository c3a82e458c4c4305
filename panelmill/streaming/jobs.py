"""Incremental reads, de-duplication, versioned state, source health.

Business rules stay in the batch operators; a stream feeds them through
``foreachBatch``. Every batch writes a folder named by its id, so a replayed
batch overwrites its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.maintain import apply_versions, next_rows
from ..operators.pick import earliest

OVERLAP = "2 minutes"
LOOK_BACK = "7 days"
DENIED = (401, 403)


def high_water(df: DataFrame, now, ts: str = "published_at", basis: str | None = None) -> Column:
    """Start of the next incremental read, as a scalar subquery.

    Two minutes before the newest stored record, but never more than seven
    days before ``now``.
    """
    now = F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    floor = now - F.expr(f"interval {LOOK_BACK}")
    rows = df if basis is None else df.where(F.col("basis") == basis)
    newest = rows.agg(F.max(F.col(ts).cast("timestamp"))).scalar()
    return F.greatest(floor, F.coalesce(newest - F.expr(f"interval {OVERLAP}"), floor))


def incremental_slice(incoming: DataFrame, stored: DataFrame, now, ts: str = "published_at") -> DataFrame:
    """Incoming records from the high-water mark of what is stored."""
    return incoming.where(F.col(ts).cast("timestamp") >= high_water(stored, now, ts))


def dedupe(records: DataFrame, keys: Sequence[str], ts: str, *tie_break: str) -> DataFrame:
    """Batch form of :func:`dedupe_stream`: the earliest delivery of a record."""
    return earliest(records, keys, ts, *tie_break)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = LOOK_BACK) -> DataFrame:
    """Drop re-delivered records of a stream within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet table (a folder, or one file in a folder) as a file stream."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getFileStatus(location).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", location.getName()).parquet(str(location.getParent()))


def run_to_end(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything available through ``write``, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def first_seen_state(stream: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Earliest instant per key; works on streams (update mode) and batches."""
    return stream.groupBy(*keys).agg(F.min(ts).alias("first_seen"))


def first_seen_job(stream: DataFrame, keys: Sequence[str], ts: str, folder: str) -> DataFrame:
    """Run :func:`first_seen_state` to the end of its input and read the result."""
    out = f"{folder}/first_seen"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_to_end(first_seen_state(stream, keys, ts), write, f"{folder}/checkpoint", "update")
    spark = stream.sparkSession
    return spark.read.parquet(out).groupBy(*keys).agg(F.min("first_seen").alias("first_seen"))


def dedupe_job(stream: DataFrame, keys: Sequence[str], ts: str, folder: str) -> DataFrame:
    """Run :func:`dedupe_stream` to the end of its input and read the result."""
    out = f"{folder}/records"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_to_end(dedupe_stream(stream, keys, ts), write, f"{folder}/checkpoint")
    return stream.sparkSession.read.parquet(out).drop("batch")


def stream_apply(
    stream: DataFrame,
    initial: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    hash_col: str,
    compare: Sequence[str],
    folder: str,
    gate: Callable[[DataFrame], bool] | None = None,
) -> DataFrame:
    """Versioned facts fed by a stream; returns the final table.

    ``prepare`` turns a micro-batch into one incoming row per key. Batch n reads
    table version n and writes version n + 1. If ``gate`` refuses a batch (all
    its sources failed for the moment), the table is carried over unchanged. A
    later call on the same folder goes on from its newest version; ``initial``
    is only written by the first.
    """
    spark = stream.sparkSession
    table = lambda n: f"{folder}/table/v={n}"

    def written(n: int) -> bool:
        try:
            spark.read.parquet(table(n))
        except AnalysisException:
            return False
        return True

    if not written(0):
        initial.write.mode("overwrite").parquet(table(0))

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        current = session.read.parquet(table(batch_id))
        if gate is not None and not gate(batch):
            result = current
        else:
            applied = apply_versions(current, prepare(batch), keys, hash_col, compare)
            result = next_rows(applied).drop("restated")
        result.write.mode("overwrite").parquet(table(batch_id + 1))

    run_to_end(stream, write, f"{folder}/checkpoint")
    newest = 0
    while written(newest + 1):
        newest += 1
    return spark.read.parquet(table(newest))


def poll_outcome(fetches: DataFrame) -> DataFrame:
    """Outcome per source from its fetch attempts.

    ``fetches`` has (source, status, ok, transient, fallback_on_denied). Any
    success is ``ok``. If every attempt was denied and the source allows it,
    it is ``unavailable``; if every failure is transient, ``deferred``; else
    ``error``.
    """
    denied = F.coalesce(F.col("status").isin(*DENIED), F.lit(False))
    folded = fetches.groupBy("source").agg(
        F.bool_or("ok").alias("_ok"),
        F.bool_and(denied & F.col("fallback_on_denied")).alias("_denied"),
        F.bool_and("transient").alias("_transient"),
        F.count("*").alias("attempts"),
    )
    outcome = (
        F.when(F.col("_ok"), "ok")
        .when(F.col("_denied"), "unavailable")
        .when(F.col("_transient"), "deferred")
        .otherwise("error")
    )
    return folded.select("source", "attempts", outcome.alias("outcome"))


def gate_outcome(outcomes: DataFrame) -> DataFrame:
    """One row for a poll: deferred if every source is, error if none worked."""
    return outcomes.agg(
        F.count("*").alias("sources"),
        F.when(F.bool_and(F.col("outcome") == "deferred"), "deferred")
        .when(F.bool_or(F.col("outcome") == "ok"), "ok")
        .otherwise("error")
        .alias("decision"),
    )


def source_health(attempts: DataFrame) -> DataFrame:
    """Latest state per source: last attempt, last success, standing error.

    ``attempts`` has (source, at, ok, message). A success clears the error.
    Runs on batches and, in update mode, on streams.
    """
    last = F.max_by(F.struct("ok", "message"), F.struct("at", "attempt_id"))
    return attempts.groupBy("source").agg(
        F.max("at").alias("last_attempt_at"),
        F.max(F.when(F.col("ok"), F.col("at"))).alias("last_success_at"),
        last.alias("_last"),
    ).select(
        "source",
        "last_attempt_at",
        "last_success_at",
        F.when(~F.col("_last.ok"), F.col("_last.message")).alias("standing_error"),
    )
