"""Filters and routing of reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decode import TOPIC_COLUMNS, parsed, report_texts

FRESH_SECONDS = 30


def keep_type(df: DataFrame, message_type: str, col: str = "MessageType") -> DataFrame:
    """F-01: keep one message type, compared case-insensitively."""
    return df.where(F.lower(F.col(col)) == F.lit(message_type.lower()))


def is_valid_position(lat: Column, lng: Column) -> Column:
    """F-02 predicate: both coordinates are real numbers (not NULL, not text
    that fails to parse, not NaN)."""
    la, ln = lat.try_cast("double"), lng.try_cast("double")
    return F.coalesce(la.isNotNull() & ln.isNotNull() & ~F.isnan(la) & ~F.isnan(ln),
                      F.lit(False))


def valid_positions(df: DataFrame, lat: str = "Lat", lng: str = "Lng") -> DataFrame:
    """F-02."""
    return df.where(is_valid_position(F.col(lat), F.col(lng)))


def has_mmsi(df: DataFrame, col: str = "MetaData.MMSI") -> DataFrame:
    """F-03: MMSI present and truthy (drops NULL and 0)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != 0))


def fresh(df: DataFrame, now: datetime | Column | None = None,
          seconds: int = FRESH_SECONDS, col: str = "arrival_ts") -> DataFrame:
    """F-04: reports that arrived at most ``seconds`` before ``now``
    (inclusive). ``now`` defaults to the latest arrival in the frame, taken
    as a scalar subquery (one partial max per task, no shuffle of rows)."""
    if now is None:
        now_col = df.select(F.max(col)).scalar()
    elif isinstance(now, Column):
        now_col = now
    else:
        now_col = F.lit(now)
    return df.where(F.col(col) >= now_col - F.make_dt_interval(secs=F.lit(seconds)))


def latest_arrival(raw: DataFrame) -> Column:
    """F-04's ``now`` in a batch: the latest arrival of the raw topic rows, a
    scalar subquery that parses nothing."""
    return raw.select(F.max("timestamp")).scalar()


def fresh_listing(raw: DataFrame, now: datetime | Column | None = None,
                  seconds: int = FRESH_SECONDS) -> DataFrame:
    """F-04: the fresh topic rows in arrival order."""
    now = latest_arrival(raw) if now is None else now
    return fresh(raw, now, seconds, "timestamp").orderBy("timestamp", "offset", "partition")


def route_topic(message_type: Column, prefix: str = "ais_") -> Column:
    """F-05: destination topic ``prefix + lower(MessageType)``."""
    return F.concat(F.lit(prefix), F.lower(message_type))


def with_route(df: DataFrame, prefix: str = "ais_", name: str = "out_topic") -> DataFrame:
    """F-05: one pass computes every report's destination; a single write
    (Kafka ``topic`` column or ``partitionBy``) fans out, no per-type scan."""
    return df.withColumn(name, route_topic(F.col("MessageType"), prefix))


def categorize(raw: DataFrame) -> DataFrame:
    """F-06: per batch (topic value) and type, the reports of that type in
    order (their JSON texts) and their count; types with no report do not
    appear. Row-wise: a batch is one row, so nothing is shuffled and each
    list is bounded by its envelope."""
    pairs = F.arrays_zip(F.transform(parsed("value"), lambda r: r["MessageType"]).alias("t"), report_texts().alias("report"))
    batches = raw.select(*TOPIC_COLUMNS, pairs.alias("_p")).select(
        *TOPIC_COLUMNS, "_p", F.explode(F.array_distinct(F.transform("_p", lambda p: p["t"]))).alias("MessageType"))
    items = F.expr("transform(filter(_p, p -> p.t <=> MessageType), p -> p.report)")
    return batches.select(*TOPIC_COLUMNS, "MessageType", items.alias("items")) \
        .withColumn("n_reports", F.size("items").cast("long"))
