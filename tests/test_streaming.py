"""Streams of files against the batch result: in one run, in several, after failures, and with rows that come too late."""

from __future__ import annotations

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import windows
from ledgerline.streaming.windows import BatchSink
from tests.conftest import SMALL


def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet")


def hourly(rows):
    held = rows.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(F.expr(windows.CENTS)).alias("total_cents"))
    return Counter(map(tuple, held.collect()))


def streamed(spark, sink):
    found = windows.latest(windows.written(spark, sink, windows.WINDOW_ROWS), ["window_start", "event_type"])
    return Counter(map(tuple, found.select(windows.WINDOW_ROWS.names).collect()))


def test_windows_after_a_restart_and_a_broken_batch(spark, folder):
    """Two files are taken, then the run ends; the next one breaks after it has written a batch; the third finishes."""
    source, progress, sink = f"{folder}/in", f"{folder}/progress", BatchSink(f"{folder}/out")
    first = events(spark).where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    rest = events(spark).where("ts >= TIMESTAMP_NTZ '2024-01-15 00:00:00'")

    def take(into):
        return windows.run(windows.window_totals(windows.read_stream(spark, source)), into, progress, "update")

    windows.deal_arrivals(first, source, 2)
    assert take(sink) == 0 and streamed(spark, sink) == hourly(first)
    windows.deal_arrivals(rest, source, 2)
    tried = []

    def breaks(rows, number):
        sink(rows.limit(3), number)  # half of the batch is out when the run is lost
        tried.append(number)
        raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        take(breaks)
    assert take(sink) == 0 and streamed(spark, sink) == hourly(events(spark))
    batches = sorted(int(path.rsplit("=", 1)[1]) for path in glob.glob(f"{folder}/out/batch=*"))
    assert batches == list(range(len(batches))) and tried[0] in batches


def test_sessions_come_out_once(spark, folder):
    source, sink = f"{folder}/in", BatchSink(f"{folder}/out")
    windows.deal_arrivals(events(spark), source, 3, files=2)
    late = windows.run_to_the_end(
        spark, source, windows.session_totals(windows.read_stream(spark, source, 2)), sink, f"{folder}/progress", 2)
    rows = windows.written(spark, sink, windows.SESSION_ROWS).collect()
    assert late == 0 and len({(row.user_id, row.session_start) for row in rows}) == len(rows)
    assert sum(row.event_count for row in rows) == events(spark).count()
    by_user = sorted((row.user_id, row.session_start, row.session_end) for row in rows)
    assert all(a[0] != b[0] or (b[1] - a[2]).total_seconds() >= 6 * 3600 for a, b in zip(by_user, by_user[1:]))


def test_rows_beyond_the_watermark_are_reported(spark, folder):
    source, sink = f"{folder}/in", BatchSink(f"{folder}/out")
    early = events(spark).where("ts < TIMESTAMP_NTZ '2024-01-02 00:00:00'")
    later = events(spark).where("ts >= TIMESTAMP_NTZ '2024-01-02 00:00:00'")
    last = F.lit("2024-01-30 22:00:00").cast("timestamp_ntz")
    # Spark leaves out what is later than the watermark of the batch before, so the early rows come in the third one.
    for part in (later.where(F.col("ts") < last), later.where(F.col("ts") >= last), early):
        part.coalesce(1).write.mode("append").parquet(source)
    late = windows.run(windows.window_totals(windows.read_stream(spark, source)), sink, f"{folder}/progress", "update")
    assert late > 0 and streamed(spark, sink) == hourly(later)


def test_no_files_and_no_batches(spark, folder):
    sink = BatchSink(f"{folder}/none")
    assert windows.written(spark, sink, windows.SESSION_ROWS).count() == 0
    windows.deal_arrivals(events(spark).limit(0), f"{folder}/in", 2)
    assert windows.run(windows.window_totals(windows.read_stream(spark, f"{folder}/in")), sink, f"{folder}/progress", "update") == 0
