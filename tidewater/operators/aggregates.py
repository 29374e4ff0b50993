"""Counts and throughput aggregates.

All are hash aggregates with a map-side partial step (count, sum, max_by), so
a hot vessel or a busy minute is pre-combined per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordering
from .route import has_mmsi

RATE_EVERY = 10_000
FLUSH_INTERVAL = "250 milliseconds"


def reports_per_mmsi(reports: DataFrame, mmsi: str = "MetaData.MMSI") -> DataFrame:
    """A-01: reports per vessel (F-03 applied: NULL and 0 dropped)."""
    return (has_mmsi(reports, mmsi).groupBy(F.col(mmsi).alias("MMSI"))
            .agg(F.count(F.lit(1)).alias("n_reports")))


def reports_by_mmsi(reports: DataFrame, mmsi: str = "MetaData.MMSI") -> DataFrame:
    """A-02: ``MMSI, ReportCount``; NULL key dropped, 0 kept, ordered by key."""
    return (reports.where(F.col(mmsi).isNotNull())
            .groupBy(F.col(mmsi).alias("MMSI"))
            .agg(F.count(F.lit(1)).alias("ReportCount"))
            .orderBy("MMSI"))


def total_count(reports: DataFrame) -> DataFrame:
    """A-03: all rows, NULL MMSI included."""
    return reports.agg(F.count(F.lit(1)).alias("n_reports"))


def rate_per_window(raw: DataFrame, seconds: int = 60, ts: str = "timestamp") -> DataFrame:
    """A-04 / A-05: messages and kilobytes (bytes/1024, 2 dp half-even) per
    clock-aligned tumbling window of arrival time."""
    return (raw.groupBy(F.window(ts, f"{seconds} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.sum(F.octet_length("value")).alias("bytes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "messages", F.bround(F.col("bytes") / F.lit(1024.0), 2).alias("kilobytes")))


def metric_series(raw: DataFrame, seconds: int = 60, ts: str = "timestamp") -> DataFrame:
    """A-08: messages/s and bytes/s sampled per window, in time order."""
    return (raw.groupBy(F.window(ts, f"{seconds} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.sum(F.octet_length("value")).alias("bytes"))
            .select(F.col("w.start").alias("window_start"),
                    (F.col("messages") / F.lit(float(seconds))).alias("messages_per_s"),
                    (F.col("bytes") / F.lit(float(seconds))).alias("bytes_per_s"))
            .orderBy("window_start"))


def _seconds_between(later, earlier):
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def cumulative_rate(raw: DataFrame, every: int = RATE_EVERY, ts: str = "timestamp",
                    order: list[str] | None = None, offset: int = 0, start=None) -> DataFrame:
    """A-06: at every ``every``-th message in arrival order, the count and
    the rate since the first arrival (NULL when no time has passed).

    Counting instead of a global sort: messages are counted per segment of
    the order (see ``ordering``), and rows are put in order only inside the
    segments that hold a multiple of ``every``. ``offset`` (messages counted
    before this input) and ``start`` (first arrival) let a stream continue
    the count.
    """
    order = order or [ts, "offset", "partition"]
    rows = ordering.segmented(raw.select(*dict.fromkeys(order + [ts])), [], order)
    segs = ordering.before_segments(rows, [], F.count(F.lit(1)))
    first = F.coalesce("_before", F.lit(0)) + F.lit(offset)
    hits = segs.select(ordering.SEG, first.alias("_first"), (first + F.col("_own")).alias("_end")) \
        .where(F.floor(F.col("_end") / every) > F.floor(F.col("_first") / every))
    here = Window.partitionBy(ordering.SEG).orderBy(*order)
    ranked = rows.join(hits, ordering.SEG).withColumn("n", F.col("_first") + F.row_number().over(here))
    start = raw.select(F.min(ts)).scalar() if start is None else F.lit(start)
    elapsed = _seconds_between(F.col(ts), start)
    return (ranked.where(F.col("n") % every == 0)
            .select("n", F.col(ts).alias("arrival_ts"), elapsed.alias("elapsed_s"))
            .withColumn("rate", F.when(F.col("elapsed_s") > 0, F.col("n") / F.col("elapsed_s"))))


def flush_counts(raw: DataFrame, flush: str = FLUSH_INTERVAL, ts: str = "timestamp") -> DataFrame:
    """Messages per ``flush`` window of arrival time: count, first arrival and
    bytes. All three add up, so rows of one window may come in parts."""
    return (raw.groupBy(F.window(ts, flush).alias("f"))
            .agg(F.count(F.lit(1)).alias("flush_count"), F.min(ts).alias("first_ts"),
                 F.sum(F.octet_length("value")).alias("bytes"))
            .select(F.col("f.start").alias("flush_start"), F.col("f.end").alias("flush_end"),
                    "flush_count", "first_ts", "bytes"))


def interval_stats(raw: DataFrame, seconds: int = 60, flush: str = FLUSH_INTERVAL,
                   ts: str = "timestamp") -> DataFrame:
    """A-07: per interval, messages and bytes, running total, overall rate since the
    first arrival, size of the interval's last flush and that flush's rate
    up to the interval end (0 when the denominator is not positive).

    Flushes are pre-aggregated per ``flush`` window, then rolled up per
    interval. One read: the running total and the first arrival come from a
    window over the interval table, one row a minute.
    """
    return stats_of_flushes(flush_counts(raw, flush, ts), seconds)


def stats_of_flushes(flushes: DataFrame, seconds: int = 60) -> DataFrame:
    """A-07 from ``flush_counts``."""
    intervals = (flushes.groupBy(F.window("flush_start", f"{seconds} seconds").alias("w"))
                 .agg(F.sum("flush_count").alias("messages"), F.min("first_ts").alias("first_ts"), F.sum("bytes").alias("bytes"),
                      F.max_by(F.struct("flush_end", "flush_count"), "flush_end").alias("last"))
                 .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         "messages", "first_ts", "bytes", F.col("last.flush_count").alias("last_flush_count"),
                         F.col("last.flush_end").alias("last_flush_end")))
    so_far = Window.partitionBy().orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    run = intervals.withColumns({"total_messages": F.sum("messages").over(so_far),
                                 "_start": F.min("first_ts").over(so_far)})
    since_start = _seconds_between(F.col("window_end"), F.col("_start"))
    since_flush = _seconds_between(F.col("window_end"), F.col("last_flush_end"))
    return run.select(
        "window_start", "window_end", "messages", "bytes", "total_messages",
        F.when(since_start > 0, F.col("total_messages") / since_start).otherwise(F.lit(0.0))
        .alias("overall_rate"),
        "last_flush_count",
        F.when(since_flush > 0, F.col("last_flush_count") / since_flush).otherwise(F.lit(0.0))
        .alias("last_flush_rate"))
