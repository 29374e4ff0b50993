"""Identity, time and position standardisation of decoded reports.

Row-wise Column expressions only (JVM side, inside whole-stage codegen), so
the same functions serve batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import (epoch_seconds, iso_text, parse_time_utc,
                                 time_utc_text)


def report_uuid(*parts: str) -> Column:
    """P-01: deterministic UUID from the report's position in the log.

    Hex of SHA-256 over ``topic|partition|offset|pos`` cut to the 8-4-4-4-12
    shape: a retried task gives the same id, so downstream can dedupe.
    """
    cols = parts or ("topic", "partition", "offset", "pos")
    h = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.substring(h, 13, 4), F.substring(h, 17, 4),
                       F.substring(h, 21, 12))


def with_uuid(df: DataFrame, name: str = "UUID", random: bool = False) -> DataFrame:
    """P-01. ``random=True`` gives Spark's ``uuid()`` like the reference."""
    return df.withColumn(name, F.expr("uuid()") if random else report_uuid())


def standardize_time(df: DataFrame, source: str = "MetaData.time_utc") -> DataFrame:
    """P-02..P-04 (and P-21): ``event_ts`` instant, ``TimestampIso`` text and
    ``Timestamp`` epoch seconds from the provider's ``time_utc`` text."""
    ts = parse_time_utc(F.col(source))
    return (df.withColumn("event_ts", ts)
              .withColumn("TimestampIso", iso_text(F.col("event_ts")))
              .withColumn("Timestamp", epoch_seconds(F.col("event_ts"))))


def mmsi_text(col: Column, pad: bool = False) -> Column:
    """P-06: MMSI as text; ``pad`` restores leading zeros to 9 digits."""
    text = col.cast("string")
    return F.lpad(text, 9, "0") if pad else text


def strip_text(col: Column) -> Column:
    """P-07: strip whitespace at both ends (Python ``str.strip``)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def standardize_metadata(df: DataFrame, pad_mmsi: bool = False) -> DataFrame:
    """P-06..P-08: ``MMSI`` text, stripped ``ShipName``, ``Lat``/``Lng``
    promoted to the top level, ``MetaData`` dropped."""
    return (df.withColumn("MMSI", mmsi_text(F.col("MetaData.MMSI"), pad_mmsi))
              .withColumn("ShipName", strip_text(F.col("MetaData.ShipName")))
              .withColumn("Lat", F.col("MetaData.latitude"))
              .withColumn("Lng", F.col("MetaData.longitude"))
              .drop("MetaData"))


def enrich_metadata(df: DataFrame, pad_mmsi: bool = False) -> DataFrame:
    """UUID + time + metadata standardisation as one projection chain."""
    return standardize_metadata(standardize_time(with_uuid(df)), pad_mmsi)


def hoist_metadata(df: DataFrame) -> DataFrame:
    """P-09: move every ``MetaData`` field to the top; on a name collision
    the ``MetaData`` field wins."""
    inner = df.schema["MetaData"].dataType.fieldNames()
    keep = [c for c in df.columns if c != "MetaData" and c not in inner]
    return df.select(*keep, *[F.col(f"MetaData.{n}").alias(n) for n in inner])


def six_columns(df: DataFrame) -> DataFrame:
    """P-10: the notebook's flat table; missing keys give NULL."""
    return df.select(F.col("MetaData.MMSI").alias("MMSI"),
                     F.col("MetaData.ShipName").alias("ShipName"),
                     F.col("MetaData.latitude").alias("Latitude"),
                     F.col("MetaData.longitude").alias("Longitude"),
                     F.col("MetaData.time_utc").alias("Timestamp"),
                     F.col("MessageType"))


def display_label(mmsi: Column, name: Column) -> Column:
    """P-19: ``<mmsi>: <name>``; an empty or missing name shows as
    ``Unknown Ship``."""
    return F.concat(mmsi.cast("string"), F.lit(": "),
                    F.coalesce(F.nullif(name, F.lit("")), F.lit("Unknown Ship")))


def keep_reported(df: DataFrame, lat: str = "Lat", lng: str = "Lng") -> DataFrame:
    """P-20: keep the reported coordinates beside the snapped ones."""
    return df.withColumn("LatReported", F.col(lat)).withColumn("LngReported", F.col(lng))


def epoch_to_text(df: DataFrame, epoch: str = "Timestamp", name: str = "time_utc_text") -> DataFrame:
    """P-05: epoch seconds back to ``yyyy-MM-dd HH:mm:ss.ffffff +0000 UTC``."""
    return df.withColumn(name, time_utc_text(F.col(epoch)))
