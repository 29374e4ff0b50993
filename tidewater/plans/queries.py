"""Registered queries: one per operator of the inventory, each with the
DuckDB SQL that computes the same answer on the driver's tables.

Every query reads ``events`` from ``sf_dir`` (through the fixture
derivation) and runs over the whole table. Time columns are returned as
UTC wall-clock ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import utc_wallclock
from ..operators import (aggregates, decode, features, route, standardize,
                         stateful)
from ..schemas import MESSAGE_TYPES
from ..sources import fixture
from .oracle import POSITION_TYPES_SQL, SAR, WRITTEN_SQL, with_envelopes, with_reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def wc(name: str, alias: str | None = None):
    return utc_wallclock(F.col(name)).alias(alias or name.split(".")[-1])


def raw(spark, sf):
    return fixture.raw_topic(spark, sf)


def env(spark, sf):
    return fixture.envelope_topic(spark, sf)


def reports(spark, sf):
    return decode.decode_reports(raw(spark, sf))


def std_reports(spark, sf):
    """Decoded + enriched metadata (UUID, times, MMSI text, Lat/Lng)."""
    return standardize.enrich_metadata(reports(spark, sf))


KEY = ["partition", "offset"]
KEY_SQL = '"partition", "offset"'

# ---------------------------------------------------------------- decode --


@register("d01_decode_reports", with_reports(
    'SELECT topic, "partition", "offset", pos, arrival_ts, MessageType, MMSI, ShipName, '
    "latitude, longitude, time_utc FROM reports"))
def d01(spark, sf):
    return reports(spark, sf).select(
        "topic", *KEY, "pos", wc("arrival_ts"), "MessageType",
        F.col("MetaData.MMSI").alias("MMSI"), F.col("MetaData.ShipName").alias("ShipName"),
        F.col("MetaData.latitude").alias("latitude"), F.col("MetaData.longitude").alias("longitude"),
        F.col("MetaData.time_utc").alias("time_utc"))


@register("d02_strict_decode", with_envelopes(
    f'SELECT CAST((event_id // {fixture.ENVELOPE_SIZE}) % 3 AS INTEGER) AS "partition", '
    f'(event_id // {fixture.ENVELOPE_SIZE}) // 3 AS "offset", '
    f"CAST(event_id % {fixture.ENVELOPE_SIZE} AS INTEGER) AS pos, mtype AS MessageType, "
    "mmsi AS MMSI FROM fx5"))
def d02(spark, sf):
    return decode.strict_decode(env(spark, sf)).select(
        *KEY, "pos", "MessageType", F.col("MetaData.MMSI").alias("MMSI"))


@register("d03_quarantine", with_reports(
    f"SELECT {KEY_SQL}, value, 'undecodable JSON' AS reason FROM raw_topic "
    "WHERE NOT json_valid(value)"))
def d03(spark, sf):
    _, bad = decode.split_quarantine(raw(spark, sf))
    return bad.select(*KEY, "value", "reason")


@register("d04_envelope_sizes", with_envelopes(
    f"SELECT {KEY_SQL}, CAST(json_array_length(value) AS INTEGER) AS n_reports FROM env_topic"))
def d04(spark, sf):
    return decode.envelope_sizes(env(spark, sf)).select(*KEY, "n_reports")


_TYPES_SQL = ", ".join(f"'{t}'" for t in MESSAGE_TYPES)


@register("d05_known_types", with_reports(
    f"SELECT {KEY_SQL}, MessageType FROM reports WHERE MessageType IN ({_TYPES_SQL})"))
def d05(spark, sf):
    return decode.known_types(reports(spark, sf)).select(*KEY, "MessageType")


# ----------------------------------------------------------- standardize --

_UUID_SQL = ("substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' "
             "|| substr(h, 17, 4) || '-' || substr(h, 21, 12)")


@register("p01_uuid", with_reports(
    f"SELECT {KEY_SQL}, pos, {_UUID_SQL} AS UUID FROM (SELECT *, sha256(topic || '|' || "
    "CAST(\"partition\" AS VARCHAR) || '|' || CAST(\"offset\" AS VARCHAR) || '|' || "
    "CAST(pos AS VARCHAR)) AS h FROM reports)"))
def p01(spark, sf):
    return standardize.with_uuid(reports(spark, sf)).select(*KEY, "pos", "UUID")


_PARSED_TS = (
    "(CAST(substr(time_utc, 1, 26) AS TIMESTAMP) - "
    "(CASE WHEN substr(split_part(time_utc, ' ', 3), 1, 1) = '-' THEN -1 ELSE 1 END) * "
    "(CAST(substr(split_part(time_utc, ' ', 3), 2, 2) AS INTEGER) * 60 + "
    "CAST(substr(split_part(time_utc, ' ', 3), 4, 2) AS INTEGER)) * INTERVAL 1 MINUTE)")

_TIMES_CTE = f"times AS (SELECT *, {_PARSED_TS} AS event_ts FROM reports)"


@register("p02_p04_time", with_reports(
    f"SELECT {KEY_SQL}, event_ts, "
    "CASE WHEN epoch_us(event_ts) % 1000000 = 0 "
    "THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' "
    "ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS TimestampIso, "
    "epoch_us(event_ts) / 1000000.0 AS Timestamp FROM times", _TIMES_CTE))
def p02(spark, sf):
    df = standardize.standardize_time(reports(spark, sf))
    return df.select(*KEY, wc("event_ts"), "TimestampIso", "Timestamp")


@register("p05_epoch_text", with_reports(
    f"SELECT {KEY_SQL}, strftime(make_timestamp(CAST(round(epoch_us(event_ts) / 1000000.0 "
    "* 1000000.0) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') || ' +0000 UTC' AS time_utc_text "
    "FROM times", _TIMES_CTE))
def p05(spark, sf):
    df = standardize.epoch_to_text(standardize.standardize_time(reports(spark, sf)))
    return df.select(*KEY, "time_utc_text")


@register("p06_p08_metadata", with_reports(
    f"SELECT {KEY_SQL}, CAST(MMSI AS VARCHAR) AS MMSI, lpad(CAST(MMSI AS VARCHAR), 9, '0') "
    "AS MMSI_padded, regexp_replace(ShipName, '^\\s+|\\s+$', '', 'g') AS ShipName, "
    "latitude AS Lat, longitude AS Lng FROM reports"))
def p06(spark, sf):
    df = reports(spark, sf).withColumn(
        "MMSI_padded", standardize.mmsi_text(F.col("MetaData.MMSI"), pad=True))
    return standardize.standardize_metadata(df).select(*KEY, "MMSI", "MMSI_padded", "ShipName",
                                                      "Lat", "Lng")


@register("p09_hoist_metadata", with_reports(
    f"SELECT {KEY_SQL}, MessageType, MMSI, MMSI_String, ShipName, latitude, longitude, "
    "time_utc FROM reports"))
def p09(spark, sf):
    return standardize.hoist_metadata(reports(spark, sf)).select(
        *KEY, "MessageType", "MMSI", "MMSI_String", "ShipName", "latitude", "longitude", "time_utc")


@register("p10_six_columns", with_reports(
    "SELECT MMSI, ShipName, latitude AS Latitude, longitude AS Longitude, time_utc AS Timestamp, "
    "MessageType FROM reports"))
def p10(spark, sf):
    return standardize.six_columns(reports(spark, sf))


@register("p11_p15_features", with_reports(
    f"SELECT {KEY_SQL}, MessageType, "
    f"CASE WHEN MessageType IN {POSITION_TYPES_SQL} THEN coalesce(round_even(Cog / 10.0, 2), 3600.0) END AS CourseDegrees, "
    f"CASE WHEN MessageType IN {POSITION_TYPES_SQL} THEN coalesce(round_even(Sog / 10.0, 1), 1023.0) END AS SpeedKnots, "
    f"CASE WHEN MessageType IN {POSITION_TYPES_SQL} THEN coalesce(RateOfTurn, -128) END AS RateOfTurn, "
    f"CASE WHEN MessageType IN {POSITION_TYPES_SQL} THEN coalesce(SMI <> 0, false) END AS SpecialManoeuvre "
    "FROM reports"))
def p11(spark, sf):
    df = features.calculate_features(decode.with_body(reports(spark, sf)))
    return df.select(*KEY, "MessageType", "CourseDegrees", "SpeedKnots", "RateOfTurn",
                     "SpecialManoeuvre")


@register("p16_position_accuracy", with_reports(
    f"SELECT {KEY_SQL}, coalesce(TRY_CAST(PA AS BOOLEAN), false) AS PositionAccuracy, "
    "PA IS NOT NULL AS PositionAccuracyAnyMatch FROM reports"))
def p16(spark, sf):
    df = decode.with_body(reports(spark, sf))
    return df.select(*KEY,
                     features.position_accuracy(F.col("body.PositionAccuracy")).alias("PositionAccuracy"),
                     features.position_accuracy(F.col("body.PositionAccuracy"), any_match=True)
                     .alias("PositionAccuracyAnyMatch"))


@register("p17_track_type", with_reports(
    f"SELECT {KEY_SQL}, MessageType, CASE WHEN MessageType = '{SAR}' AND Altitude > 0 "
    "AND Altitude <> 4095 THEN 'air' ELSE 'surface' END AS TrackType FROM reports"))
def p17(spark, sf):
    df = features.with_track_type(decode.with_body(reports(spark, sf)))
    return df.select(*KEY, "MessageType", "TrackType")


@register("p19_display_label", with_reports(
    f"SELECT {KEY_SQL}, CAST(MMSI AS VARCHAR) || ': ' || coalesce(nullif(regexp_replace("
    "ShipName, '^\\s+|\\s+$', '', 'g'), ''), 'Unknown Ship') AS label FROM reports"))
def p19(spark, sf):
    df = std_reports(spark, sf)
    return df.select(*KEY, standardize.display_label(F.col("MMSI"), F.col("ShipName")).alias("label"))


# ------------------------------------------------------- filters / route --

@register("f01_keep_type", with_reports(
    f"SELECT {KEY_SQL}, MessageType FROM reports WHERE lower(MessageType) = 'positionreport'"))
def f01(spark, sf):
    return route.keep_type(reports(spark, sf), "positionreport").select(*KEY, "MessageType")


@register("f02_valid_position", with_reports(
    f"SELECT {KEY_SQL}, latitude AS Lat, longitude AS Lng FROM reports "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) "
    "AND NOT isnan(longitude)"))
def f02(spark, sf):
    return route.valid_positions(std_reports(spark, sf)).select(*KEY, "Lat", "Lng")


@register("f03_has_mmsi", with_reports(
    f"SELECT {KEY_SQL}, MMSI FROM reports WHERE MMSI IS NOT NULL AND MMSI <> 0"))
def f03(spark, sf):
    return route.has_mmsi(reports(spark, sf)).select(*KEY, F.col("MetaData.MMSI").alias("MMSI"))


@register("f04_fresh", with_reports(
    f"SELECT {KEY_SQL}, arrival_ts FROM reports WHERE arrival_ts >= "
    "(SELECT max(timestamp) FROM raw_topic) - INTERVAL 30 SECOND"))
def f04(spark, sf):
    return decode.decode_reports(route.fresh_listing(raw(spark, sf))).select(*KEY, wc("arrival_ts"))


@register("f05_route_topic", with_reports(
    f"SELECT {KEY_SQL}, 'ais_' || lower(MessageType) AS out_topic FROM reports"))
def f05(spark, sf):
    return route.with_route(reports(spark, sf)).select(*KEY, "out_topic")


@register("f06_categorize", with_envelopes(
    f'SELECT CAST((event_id // {fixture.ENVELOPE_SIZE}) % 3 AS INTEGER) AS "partition", '
    f'(event_id // {fixture.ENVELOPE_SIZE}) // 3 AS "offset", mtype AS MessageType, '
    f"count(*) AS n_reports, string_agg({WRITTEN_SQL}, ',' ORDER BY event_id) AS reports "
    "FROM fx5 GROUP BY ALL"))
def f06(spark, sf):
    return route.categorize(env(spark, sf)).select(*KEY, "MessageType", "n_reports",
                                                   F.array_join("items", ",").alias("reports"))


# ------------------------------------------------------------ aggregates --

@register("a01_reports_per_mmsi", with_reports(
    "SELECT MMSI, count(*) AS n_reports FROM reports WHERE MMSI IS NOT NULL AND MMSI <> 0 "
    "GROUP BY MMSI"))
def a01(spark, sf):
    return aggregates.reports_per_mmsi(reports(spark, sf))


@register("a02_reports_by_mmsi", with_reports(
    "SELECT MMSI, count(*) AS ReportCount FROM reports WHERE MMSI IS NOT NULL "
    "GROUP BY MMSI ORDER BY MMSI"))
def a02(spark, sf):
    return aggregates.reports_by_mmsi(reports(spark, sf))


@register("a03_total_count", with_reports("SELECT count(*) AS n_reports FROM reports"))
def a03(spark, sf):
    return aggregates.total_count(reports(spark, sf))


def _rate_sql(seconds: int) -> str:
    us = seconds * 1_000_000
    return with_reports(
        f"SELECT make_timestamp(b * {us}) AS window_start, make_timestamp((b + 1) * {us}) "
        "AS window_end, count(*) AS messages, round_even(sum(strlen(value)) / 1024.0, 2) "
        f"AS kilobytes FROM (SELECT *, epoch_us(timestamp) // {us} AS b FROM raw_topic) GROUP BY b")


def _rate(seconds: int) -> Query:
    def q(spark, sf):
        df = aggregates.rate_per_window(raw(spark, sf), seconds)
        return df.select(wc("window_start"), wc("window_end"), "messages", "kilobytes")
    return q


register("a04_rate_60s", _rate_sql(60))(_rate(60))
register("a05_rate_1s", _rate_sql(1))(_rate(1))


@register("a06_cumulative_rate", with_reports(
    "SELECT n, timestamp AS arrival_ts, elapsed_s, CASE WHEN elapsed_s > 0 THEN n / elapsed_s END "
    "AS rate FROM (SELECT row_number() OVER (ORDER BY timestamp, \"offset\", \"partition\") AS n, "
    "timestamp, (epoch_us(timestamp) - (SELECT epoch_us(min(timestamp)) FROM raw_topic)) / 1e6 "
    f"AS elapsed_s FROM raw_topic) WHERE n % {aggregates.RATE_EVERY} = 0"))
def a06(spark, sf):
    df = aggregates.cumulative_rate(raw(spark, sf))
    return df.select("n", wc("arrival_ts"), "elapsed_s", "rate")


@register("a07_interval_stats", with_reports(
    "SELECT make_timestamp(wb * 60000000) AS window_start, make_timestamp((wb + 1) * 60000000) "
    "AS window_end, messages, total_messages, "
    "CASE WHEN ((wb + 1) * 60000000 - s0) / 1e6 > 0 THEN total_messages / (((wb + 1) * 60000000 - s0) / 1e6) ELSE 0.0 END AS overall_rate, "
    "last_flush_count, CASE WHEN ((wb + 1) * 60000000 - (lfb + 1) * 250000) / 1e6 > 0 THEN "
    "last_flush_count / (((wb + 1) * 60000000 - (lfb + 1) * 250000) / 1e6) ELSE 0.0 END AS last_flush_rate "
    "FROM (SELECT *, CAST(sum(messages) OVER (ORDER BY wb ROWS UNBOUNDED PRECEDING) AS BIGINT) "
    "AS total_messages, (SELECT epoch_us(min(timestamp)) FROM raw_topic) AS s0 FROM iv)",
    "fl AS (SELECT epoch_us(timestamp) // 250000 AS fb, count(*) AS fc FROM raw_topic GROUP BY 1), "
    "iv AS (SELECT (fb * 250000) // 60000000 AS wb, CAST(sum(fc) AS BIGINT) AS messages, "
    "arg_max(fc, fb) AS last_flush_count, max(fb) AS lfb FROM fl GROUP BY 1)"))
def a07(spark, sf):
    df = aggregates.interval_stats(raw(spark, sf))
    return df.select(wc("window_start"), wc("window_end"), "messages", "total_messages",
                     "overall_rate", "last_flush_count", "last_flush_rate")


@register("a08_metric_series", with_reports(
    "SELECT make_timestamp(b * 60000000) AS window_start, count(*) / 60.0 AS messages_per_s, "
    "sum(strlen(value)) / 60.0 AS bytes_per_s FROM (SELECT *, epoch_us(timestamp) // 60000000 "
    "AS b FROM raw_topic) GROUP BY b ORDER BY b"))
def a08(spark, sf):
    df = aggregates.metric_series(raw(spark, sf))
    return df.select(wc("window_start"), "messages_per_s", "bytes_per_s")


# ------------------------------------------------------------- stateful --

_VALID_SQL = ("latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) "
              "AND NOT isnan(longitude)")


@register("w01_current_position", with_reports(
    "SELECT CAST(MMSI AS VARCHAR) AS MMSI, latitude AS Lat, longitude AS Lng, "
    "regexp_replace(ShipName, '^\\s+|\\s+$', '', 'g') AS ShipName, arrival_ts FROM "
    "(SELECT *, row_number() OVER (PARTITION BY MMSI ORDER BY arrival_ts DESC, \"offset\" DESC, "
    f"\"partition\" DESC, pos DESC) AS rk FROM reports WHERE {_VALID_SQL} AND MMSI IS NOT NULL) WHERE rk = 1"))
def w01(spark, sf):
    df = stateful.current_positions(std_reports(spark, sf), extra=["ShipName"])
    return df.select("MMSI", "Lat", "Lng", "ShipName", wc("arrival_ts"))


@register("w02_change_status", with_reports(
    f"SELECT {KEY_SQL}, CAST(MMSI AS VARCHAR) AS MMSI, CASE WHEN pl IS NULL THEN 'new' "
    "WHEN latitude <> pl OR longitude <> pg THEN 'moved' ELSE 'unchanged' END AS status FROM "
    "(SELECT *, lag(latitude) OVER w AS pl, lag(longitude) OVER w AS pg FROM reports "
    f"WHERE {_VALID_SQL} AND MMSI IS NOT NULL WINDOW w AS (PARTITION BY MMSI ORDER BY arrival_ts, \"offset\", "
    "\"partition\", pos))"))
def w02(spark, sf):
    return stateful.change_status(std_reports(spark, sf)).select(*KEY, "MMSI", "status")


@register("w03_latest_message", with_reports(
    f"SELECT {KEY_SQL}, MessageType, arrival_ts FROM reports "
    "ORDER BY arrival_ts DESC, \"offset\" DESC, \"partition\" DESC, pos DESC LIMIT 1"))
def w03(spark, sf):
    df = stateful.latest_message(reports(spark, sf), ["MessageType"], stateful.REPORT_ORDER)
    return df.select(*KEY, "MessageType", wc("arrival_ts"))


@register("w04_keyed_collect", with_envelopes(
    "SELECT 'ALL' AS key, session, (rn - 1) // 120 AS chunk, count(*) AS n_items, "
    "CAST(sum(item) AS BIGINT) AS sum_items, min(timestamp) AS first_arrival, "
    "max(timestamp) AS last_arrival FROM r GROUP BY ALL",
    "m AS (SELECT *, CAST(json_array_length(value) AS INTEGER) AS item, lag(timestamp) OVER "
    "(ORDER BY timestamp, \"offset\", \"partition\") AS prev FROM env_topic), "
    "s AS (SELECT *, CAST(sum(CASE WHEN prev IS NULL OR epoch_us(timestamp) - epoch_us(prev) "
    "> 10000000 THEN 1 ELSE 0 END) OVER (ORDER BY timestamp, \"offset\", \"partition\" ROWS "
    "UNBOUNDED PRECEDING) AS BIGINT) AS session FROM m), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY timestamp, \"offset\", "
    "\"partition\") AS rn FROM s)"))
def w04(spark, sf):
    e = env(spark, sf)
    df = stateful.keyed_collect(e, F.size(decode.parsed("value")))
    return df.select("key", "session", "chunk", "n_items",
                     F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x).alias("sum_items"),
                     wc("first_arrival"), wc("last_arrival"))


@register("w05_flush_batches", with_reports(
    "SELECT make_timestamp(fb * 250000) AS flush_start, (rn - 1) // 1000 AS chunk, "
    "CAST(count(*) AS INTEGER) AS n_items, sum(strlen(value)) + count(*) + 1 AS bytes "
    "FROM (SELECT *, epoch_us(timestamp) // 250000 AS fb, row_number() OVER (PARTITION BY "
    "epoch_us(timestamp) // 250000 ORDER BY timestamp, \"offset\", \"partition\") AS rn "
    "FROM raw_topic WHERE json_valid(value)) GROUP BY ALL"))
def w05(spark, sf):
    df = stateful.flush_batches(raw(spark, sf))
    return df.select(wc("flush_start"), "chunk", "n_items", "bytes")


@register("w04b_timed_collect", with_envelopes(
    "SELECT 'ALL' AS key, make_timestamp((epoch_us(timestamp) // 10000000) * 10000000) AS "
    "window_start, count(*) AS n_items, CAST(sum(json_array_length(value)) AS BIGINT) AS sum_items "
    "FROM env_topic GROUP BY ALL"))
def w04b(spark, sf):
    e = env(spark, sf)
    df = stateful.timed_collect(e, F.size(decode.parsed("value"))).groupBy("key", "window_start").agg(
        F.sum("n_items").alias("n_items"),
        F.sum(F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x)).alias("sum_items"))
    return df.select("key", wc("window_start"), "n_items", "sum_items")


@register("w04c_timed_lists", with_envelopes(
    "SELECT 'ALL' AS key, make_timestamp(w * 10000000) AS window_start, (rn - 1) // 120 AS chunk, "
    "count(*) AS n_items, string_agg(item, '|' ORDER BY rn) AS items FROM r GROUP BY ALL",
    "m AS (SELECT *, epoch_us(timestamp) // 10000000 AS w, \"partition\" || ':' || \"offset\" || ':' || "
    "json_array_length(value) AS item FROM env_topic), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY timestamp, \"offset\", \"partition\") AS rn FROM m)"))
def w04c(spark, sf):
    item = F.concat_ws(":", "partition", "offset", F.size(decode.parsed("value")))
    df = stateful.timed_collect(env(spark, sf), item)
    return df.select("key", wc("window_start"), "chunk", "n_items", F.array_join("items", "|").alias("items"))


W06_MAX_BYTES = 4000

_W06_CTES = (
    f"items AS (SELECT CAST((event_id // {fixture.ENVELOPE_SIZE}) % 3 AS INTEGER) AS p, "
    f"(event_id // {fixture.ENVELOPE_SIZE}) // 3 AS o, event_id % {fixture.ENVELOPE_SIZE} AS idx, "
    "strlen(obj) AS b FROM fx5), "
    "cum AS (SELECT p, o, idx, sum(b) OVER (PARTITION BY p, o ORDER BY idx ROWS UNBOUNDED "
    "PRECEDING) - b AS before FROM items UNION ALL SELECT p, o, max(idx) + 1, sum(b) FROM items "
    "GROUP BY p, o), "
    "pieces AS (WITH RECURSIVE t(p, o, path, lo, hi) AS ("
    "SELECT p, o, '', 0, max(idx) + 1 FROM items GROUP BY p, o "
    "UNION ALL SELECT t.p, t.o, t.path || x.s, CASE WHEN x.s = '0' THEN t.lo ELSE t.lo + (t.hi - t.lo) // 2 END, "
    "CASE WHEN x.s = '0' THEN t.lo + (t.hi - t.lo) // 2 ELSE t.hi END "
    "FROM t JOIN cum a ON a.p = t.p AND a.o = t.o AND a.idx = t.lo "
    "JOIN cum z ON z.p = t.p AND z.o = t.o AND z.idx = t.hi "
    "CROSS JOIN (VALUES ('0'), ('1')) x(s) "
    f"WHERE z.before - a.before + (t.hi - t.lo) + 1 > {W06_MAX_BYTES} AND t.hi - t.lo > 1) "
    "SELECT t.*, z.before - a.before + (t.hi - t.lo) + 1 AS size FROM t "
    "JOIN cum a ON a.p = t.p AND a.o = t.o AND a.idx = t.lo "
    "JOIN cum z ON z.p = t.p AND z.o = t.o AND z.idx = t.hi)")


@register("w06_split_envelopes", with_envelopes(
    f"SELECT p AS \"partition\", o AS \"offset\", path, CAST(hi - lo AS BIGINT) AS n_items, "
    f"CAST(lo AS INTEGER) AS first_idx, CAST(size AS INTEGER) AS bytes FROM pieces WHERE size <= {W06_MAX_BYTES}",
    _W06_CTES))
def w06(spark, sf):
    items = fixture.envelope_items(spark, sf)
    pieces, _ = stateful.split_envelopes(items, KEY, max_bytes=W06_MAX_BYTES,
                                         max_items=fixture.ENVELOPE_SIZE)
    return pieces.select(*KEY, "path", "n_items", "first_idx", "bytes")


@register("w07_upsert_state", with_reports(
    "SELECT 'mmsi:' || CAST(MMSI AS VARCHAR) AS key, latitude, longitude FROM "
    "(SELECT *, row_number() OVER (PARTITION BY MMSI ORDER BY arrival_ts DESC, \"offset\" DESC, "
    f"\"partition\" DESC, pos DESC) AS rk FROM reports WHERE {_VALID_SQL} AND MMSI IS NOT NULL) "
    "WHERE rk = 1"))
def w07(spark, sf):
    from ..sinks.state import upsert_positions
    return upsert_positions(None, std_reports(spark, sf)).select("key", "latitude", "longitude")


def _two_halves(spark, sf):
    """Reports that arrived before and from the middle of the topic's time."""
    rows = raw(spark, sf)
    std = std_reports(spark, sf)
    middle = rows.select(F.timestamp_micros(F.floor((F.unix_micros(F.min("timestamp"))
                                                     + F.unix_micros(F.max("timestamp"))) / 2))).scalar()
    return std.where(F.col("arrival_ts") < middle), std.where(F.col("arrival_ts") >= middle)


def _stored(spark, sf):
    """The state table after an upsert of each half, in reverse order too:
    the older arrivals of a late batch change nothing."""
    from ..sinks import state
    table = f"w07_state_{uuid.uuid4().hex[:12]}"
    early, late = _two_halves(spark, sf)
    for batch in (early, late, early):
        state.write_upsert(spark, table, batch)
    return state.read_state(spark, table)


_W07_SQL = (
    "SELECT 'mmsi:' || CAST(MMSI AS VARCHAR) AS key, latitude, longitude, arrival_ts FROM "
    "(SELECT *, row_number() OVER (PARTITION BY MMSI ORDER BY arrival_ts DESC, \"offset\" DESC, "
    f"\"partition\" DESC, pos DESC) AS rk FROM reports WHERE {_VALID_SQL} AND MMSI IS NOT NULL) "
    "WHERE rk = 1")
W07_VESSEL = "200000046"


@register("w07b_merged_state", with_reports(_W07_SQL))
def w07b(spark, sf):
    return _stored(spark, sf).select("key", "latitude", "longitude", wc("arrival_ts"))


@register("w07c_lookup", with_reports(f"{_W07_SQL} AND MMSI = {W07_VESSEL}"))
def w07c(spark, sf):
    from ..sinks.state import lookup
    return lookup(_stored(spark, sf), W07_VESSEL).select("key", "latitude", "longitude", wc("arrival_ts"))


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["QUERIES", "ORACLE", "register", "all_queries", "all_oracles"]
