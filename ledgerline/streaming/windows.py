"""Totals of an event stream by time window and by session, from files as they arrive.

A stream reads new Parquet files of a folder, keeps its windows in Spark's state store under a watermark, and hands every
micro-batch to `BatchSink`, which writes it to a folder of its own, named by the batch's number. A batch that is repeated
after a failure overwrites itself, so rows come out once however often a run is broken off and started again. Runs take
what has arrived and end (available-now trigger).

Windows come in update mode: a batch holds the windows it changed, with their new totals, and the last batch that holds a
window is right (`latest`). Sessions come in append mode, once they cannot grow any more: `run_to_the_end` closes those that
are open by rows at the end of time, which come out nowhere. A NULL key is a key like others.

Rows later than the watermark are left out by Spark; `run` returns how many, so that a caller can refuse a result or choose
a longer delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.model import flat_schema
from ledgerline.sources.files import exists

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
END_OF_TIME = "2999-01-01 00:00:00"
DELAY = "3 HOURS"  # how late a row may come
CENTS = "CAST(rint(value * 100) AS BIGINT)"
WINDOW_ROWS = flat_schema("window_start timestamp_ntz, event_type string, event_count long, total_cents long")
SESSION_ROWS = flat_schema(
    "user_id long, session_start timestamp_ntz, session_end timestamp_ntz, event_count long, total_cents long")


def read_stream(spark: SparkSession, folder: str, files_each: int = 1, schema: T.StructType = EVENTS) -> DataFrame:
    """New files of `folder` in the order of their arrival, `files_each` of them a micro-batch.

    Watermarks need zoned times, so `ts` is read as one of the session's zone (UTC, as `build_session` sets it).
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _totals() -> list:
    return [F.count(F.lit(1)).alias("event_count"), F.sum(F.expr(CENTS)).alias("total_cents")]


def window_totals(events: DataFrame, length: str = "1 HOUR", delay: str = DELAY) -> DataFrame:
    """(window_start, event_type, event_count, total_cents); for update mode."""
    held = events.withWatermark("ts", delay).groupBy(F.window("ts", length).alias("span"), "event_type").agg(*_totals())
    return held.where(F.col("span.start") < F.lit(END_OF_TIME).cast("timestamp")).select(
        F.col("span.start").cast("timestamp_ntz").alias("window_start"), "event_type", "event_count", "total_cents")


def session_totals(events: DataFrame, gap: str = "6 HOURS", delay: str = DELAY) -> DataFrame:
    """(user_id, session_start, session_end, event_count, total_cents); for append mode. Two events as far apart as the gap
    are in different sessions."""
    span = F.session_window("ts", gap).alias("span")
    held = events.withWatermark("ts", delay).groupBy(span, "user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), *_totals())
    # On an aggregate, so that the closing rows are not filtered out before they have moved the watermark.
    return held.where(F.col("first") < F.lit(END_OF_TIME).cast("timestamp")).select(
        "user_id", F.col("first").cast("timestamp_ntz").alias("session_start"),
        F.col("last").cast("timestamp_ntz").alias("session_end"), "event_count", "total_cents")


class BatchSink:
    """Writes every micro-batch to `folder/batch=<number>`, over what an earlier try of it left."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def __call__(self, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch={number}")


def run(totals: DataFrame, sink: BatchSink, progress: str, mode: str) -> int:
    """Take all that has arrived, from where the last run with the same `progress` folder ended; returns the number of
    rows (after each task's own aggregation) that came too late."""
    query = totals.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", progress).trigger(
        availableNow=True).start()
    query.awaitTermination()
    return sum(state.get("numRowsDroppedByWatermark", 0) for step in query.recentProgress for state in step["stateOperators"])


def run_to_the_end(spark: SparkSession, folder: str, totals: DataFrame, sink: BatchSink, progress: str, files_each: int = 1) -> int:
    """Take all that has arrived in `folder` and close every session: nothing may arrive after this. A closing row moves the
    watermark, which holds from the next batch of the same run on; so there are more of them than a batch takes."""
    for _ in range(files_each + 1):
        close_stream(spark, folder)
    return run(totals, sink, progress, "append")


def close_stream(spark: SparkSession, folder: str, schema: T.StructType = EVENTS) -> None:
    """Add a file with a row at the end of time."""
    empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields if field.name != "ts"]
    last = spark.range(1).select(F.lit(END_OF_TIME).cast("timestamp_ntz").alias("ts"), *empty)
    last.select(schema.names).coalesce(1).write.mode("append").parquet(folder)


def written(spark: SparkSession, sink: BatchSink, schema: T.StructType) -> DataFrame:
    """All rows of all batches, with the number of their `batch`."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not exists(spark, sink.folder):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(sink.folder)


def latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of the rows of each key those of the last batch that has it."""
    others = [name for name in rows.columns if name not in (*key, "batch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), "batch").alias("_last")).select(*key, "_last.*")


def deal_arrivals(events: DataFrame, folder: str, parts: int, disorder: str = "1 HOUR", files: int = 1) -> None:
    """Write events as files that arrive one after the other, each row up to `disorder` after later ones. Rows without a
    moment never arrive."""
    late = F.expr(f"CAST(INTERVAL {disorder} AS INTERVAL SECOND)")
    arrival = F.when(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0, F.col("ts") + late).otherwise(F.col("ts"))
    known = events.select(EVENTS.names).withColumn("_arrival", arrival)
    edges = known.agg(F.min("_arrival").alias("a"), F.max("_arrival").alias("b")).first()
    if edges.a is None:
        known.drop("_arrival").write.mode("append").parquet(folder)
        return
    step = (edges.b - edges.a) / parts
    for part in range(parts):
        rows = known
        if part > 0:
            rows = rows.where(F.col("_arrival") >= F.lit(edges.a + step * part).cast("timestamp_ntz"))
        if part < parts - 1:
            rows = rows.where(F.col("_arrival") < F.lit(edges.a + step * (part + 1)).cast("timestamp_ntz"))
        rows.drop("_arrival").repartition(files).write.mode("append").parquet(folder)
