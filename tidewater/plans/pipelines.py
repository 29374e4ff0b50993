"""Pipelines (compositions a user runs), registered as batch queries.

Each is one projection/aggregation chain over the decoded reports; the
streaming forms of the same chains are in ``tidewater.streaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import DUCKDB
from ..operators import (aggregates, binning, decode, features, flatten, route,
                         standardize, stateful)
from ..sinks import topics as sinks
from ..sources import fixture
from ..sources import topics as sources
from .oracle import POSITION_TYPES_SQL, WRITTEN_SQL, with_envelopes, with_reports
from .queries import KEY, KEY_SQL, raw, register, reports, wc

ALL_TOPIC = "ais_reports_enriched"
TYPE_PREFIX = "ais_"

_UUID_SQL = ("substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' "
             "|| substr(h, 17, 4) || '-' || substr(h, 21, 12)")
_HASH = ("sha256(topic || '|' || CAST(\"partition\" AS VARCHAR) || '|' || "
         "CAST(\"offset\" AS VARCHAR) || '|' || CAST(pos AS VARCHAR))")
_VALID = ("latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) "
          "AND NOT isnan(longitude)")
_STRIP = "regexp_replace(ShipName, '^\\s+|\\s+$', '', 'g')"


def enrich_all(raw_rows: DataFrame) -> DataFrame:
    """Q-01: decode -> UUID -> one topic. The message's key and every field
    of a report stay; its UUID is added to the value."""
    rep = standardize.with_uuid(decode.decode_whole(raw_rows))
    return rep.select(*KEY, "pos", "UUID", "key", sinks.with_member(F.col("report"), "UUID", F.col("UUID")).alias("value"),
                      F.lit(ALL_TOPIC).alias("topic"))


@register("q01_enrich_all", with_reports(
    f"SELECT {KEY_SQL}, {_UUID_SQL} AS UUID, {_UUID_SQL} AS value_uuid, MessageType AS value_type, "
    f"'{ALL_TOPIC}' AS topic, 'k' || \"offset\" AS key, left(value, length(value) - 1) || ',\"UUID\":\"' || {_UUID_SQL} "
    f"|| '\"}}' AS value FROM (SELECT *, {_HASH} AS h FROM reports)"))
def q01(spark, sf):
    out = enrich_all(raw(spark, sf).withColumn("key", F.concat(F.lit("k"), "offset")))
    return out.select(*KEY, "UUID", "key", "value", F.get_json_object("value", "$.UUID").alias("value_uuid"),
                      F.get_json_object("value", "$.MessageType").alias("value_type"), "topic")


def full_enrich(reports_df: DataFrame, scale: float = 10.0) -> DataFrame:
    """Q-02's rows: standardise -> bin -> features, one projection chain."""
    df = features.calculate_features(decode.with_body(reports_df), scale=scale)
    df = standardize.enrich_metadata(df)
    return binning.bin_location(df)


_Q02_COLS = ["UUID", "Timestamp", "MMSI", "ShipName", "LatReported", "LngReported", "Lat", "Lng",
             "S2", "hex_id", "WKT", "MGRS", "CourseDegrees", "SpeedKnots", "RateOfTurn",
             "SpecialManoeuvre", "MessageType"]


REJECTED_TOPIC = ALL_TOPIC + "_rejected"
_FLAT_COLS = [*KEY, "pos", "UUID", "Message"]


def _flattened(decoded: DataFrame) -> DataFrame:
    """Enriched reports with ``e``, the leaves of their Message (P-18) as JSON
    members, ``rest``, the other columns as a JSON object, and ``reason``, why
    a report has no flat form. A reason that is there stays, and its row goes
    along."""
    rep = full_enrich(decoded)
    given = F.col("reason") if "reason" in decoded.columns else F.lit(None).cast("string")
    keep = [*_FLAT_COLS, *[c for c in ("topic", "value") if c in decoded.columns], "rest"]
    cols = rep.select(*[c for c in keep if c != "rest"], given.alias("given"),
                      F.to_json(F.struct(*_Q02_COLS)).alias("rest"), flatten.message_entries(F.col("Message")).alias("e"))
    reason = F.coalesce(
        F.col("given"), F.when(F.exists("e", lambda x: x["v"].isNull()), F.lit("undecodable JSON")),
        F.when(flatten.colliding(F.col("e")), F.lit("colliding key paths")))
    return flatten.tagged(cols, keep, flatten.flat_members(F.col("e")), reason)


def _flat_value() -> Column:
    members = F.concat_ws(",", F.col("e"),
                          F.nullif(F.expr("substr(rest, 2, length(rest) - 2)"), F.lit("")))
    return F.concat(F.lit("{"), members, F.lit("}"))


def flat_topic(reports_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q-02 whole: the enriched reports flattened (P-18) for one topic, keyed
    by UUID. The enriched columns are flat by themselves; only the Message is
    taken apart. Returns ``(rows, quarantine)``; the second holds the reports
    that cannot be flattened, with a reason."""
    rep = _flattened(reports_df)
    good = rep.where(F.col("reason").isNull()).select(*KEY, "pos", F.col("UUID").alias("key"), _flat_value().alias("value"),
                                                      F.lit(ALL_TOPIC).alias("topic"))
    bad = rep.where(F.col("reason").isNotNull()).select(
        *KEY, "pos", F.col("UUID").alias("key"), _whole_value().alias("value"), "reason")
    return good, bad


def _whole_value() -> Column:
    """An unflattened report: its enriched columns and its Message as it is."""
    message = F.to_json(F.struct("Message"))
    return F.concat(F.expr("substr(rest, 1, length(rest) - 1)"), F.when(F.col("rest") == "{}", F.lit("")).otherwise(F.lit(",")),
                    message.substr(F.lit(2), F.length(message)))


def flat_or_rejected(raw_rows: DataFrame) -> DataFrame:
    """Q-02 from topic rows to topic rows, in one pass: ``key, value, topic,
    reason``. Reports go flat to the enriched topic; values that do not decode
    whole (as they came, keyed by their place in the log) and reports that
    cannot be flattened (enriched) go to the rejected topic, with the reason."""
    rep = _flattened(decode.decode_or_reject(raw_rows))
    undecoded, unflat = F.col("value").isNotNull() | F.col("pos").isNull(), F.col("reason").isNotNull()
    return rep.select(
        F.when(undecoded, F.concat_ws("|", "topic", *KEY)).otherwise(F.col("UUID")).alias("key"),
        F.when(undecoded, F.col("value")).when(unflat, _whole_value()).otherwise(_flat_value()).alias("value"),
        F.when(unflat, F.lit(REJECTED_TOPIC)).otherwise(F.lit(ALL_TOPIC)).alias("topic"), "reason")


def _q02_sql(flat: bool = False) -> str:
    stages = (geo.snap_stages(DUCKDB, "LatReported", "LngReported", "Lat", "Lng")
              + geo.s2_cell_id(DUCKDB, "Lat", "Lng", binning.S2_LEVEL, "S2", "_S2_")
              + geo.hex_stages("Lat", "Lng", "hex_q", "hex_r")
              + geo.wkt_stages(DUCKDB, "Lat", "Lng", "WKT")
              + geo.mgrs_stages(DUCKDB, "Lat", "Lng", "MGRS"))
    chain, last = geo.duckdb_chain("std", stages, "fe")
    gate = f"MessageType IN {POSITION_TYPES_SQL}"
    std = (
        f"std AS (SELECT *, {_UUID_SQL} AS UUID, epoch_us(CAST(substr(time_utc, 1, 26) AS TIMESTAMP)) "
        "/ 1000000.0 AS Timestamp, CAST(MMSI AS VARCHAR) AS MMSI_text, "
        f"{_STRIP} AS ShipName_text, latitude AS LatReported, longitude AS LngReported, "
        f"CASE WHEN {gate} THEN coalesce(round_even(Cog / 10.0, 2), 3600.0) END AS CourseDegrees, "
        f"CASE WHEN {gate} THEN coalesce(round_even(Sog / 10.0, 1), 1023.0) END AS SpeedKnots, "
        f"CASE WHEN {gate} THEN coalesce(RateOfTurn, -128) END AS RateOfTurn_f, "
        f"CASE WHEN {gate} THEN coalesce(SMI <> 0, false) END AS SpecialManoeuvre "
        f"FROM (SELECT *, {_HASH} AS h FROM reports))")
    body = ("SELECT UUID, Timestamp, MMSI_text AS MMSI, ShipName_text AS ShipName, LatReported, "
            "LngReported, Lat, Lng, S2, 'hex450:' || CAST(hex_q AS VARCHAR) || ':' || "
            "CAST(hex_r AS VARCHAR) AS hex_id, WKT, MGRS, CourseDegrees, SpeedKnots, "
            f"RateOfTurn_f AS RateOfTurn, SpecialManoeuvre, MessageType FROM {last}")
    if flat:
        body = (f"SELECT {KEY_SQL}, UUID AS key, '{ALL_TOPIC}' AS topic, UUID, MMSI_text AS MMSI, ShipName_text AS ShipName, "
                f"MGRS, S2, MessageType, Lat, Cog, SpeedKnots, 'false' AS nested FROM {last}")
    return with_reports(body, std + ",\n" + chain)


@register("q02_full_enrich", _q02_sql())
def q02(spark, sf):
    return full_enrich(reports(spark, sf)).select(*_Q02_COLS)


@register("q02b_flat_topic", _q02_sql(flat=True))
def q02b(spark, sf):
    rows, _ = flat_topic(decode.decode_reports(fixture.raw_topic(spark, sf, spread=True)))
    fields = {"UUID": "string", "MMSI": "string", "ShipName": "string", "MGRS": "string", "S2": "bigint",
              "MessageType": "string", "Lat": "double", "SpeedKnots": "double"}
    return rows.select(*KEY, "key", "topic", F.from_json("value", "map<string,string>").alias("m")).select(
        *KEY, "key", "topic", *[F.try_element_at("m", F.lit(name)).try_cast(kind).alias(name) for name, kind in fields.items()],
        F.expr("try_element_at(m, concat('Message_', m['MessageType'], '_Cog'))").cast("double").alias("Cog"),
        F.exists(F.map_values("m"), lambda v: v.startswith("{")).cast("string").alias("nested"))


def route_by_type(raw_rows: DataFrame, prefix: str = TYPE_PREFIX) -> DataFrame:
    """Q-03: decode -> known types -> key by MMSI -> topic per type."""
    rep = decode.known_types(decode.decode_whole(raw_rows))
    rep = route.with_route(rep, prefix, name="out_topic")
    return rep.select(sinks.key_by_mmsi(F.col("MetaData.MMSI")).alias("key"), F.col("report").alias("value"),
                      F.col("out_topic").alias("topic"))


@register("q03_route_by_type", with_envelopes(
    f"SELECT '{TYPE_PREFIX}' || lower(mtype) AS topic, count(*) AS messages, "
    f"count(DISTINCT CAST(mmsi AS VARCHAR)) AS keys, min({WRITTEN_SQL}) AS least, max({WRITTEN_SQL}) AS greatest FROM fx5 GROUP BY ALL"))
def q03(spark, sf):
    out = route_by_type(fixture.envelope_topic(spark, sf))
    return out.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"),
                                    F.countDistinct("key").alias("keys"),
                                    F.min("value").alias("least"), F.max("value").alias("greatest"))


def live_positions(reports_df: DataFrame) -> DataFrame:
    """Q-04: per vessel the current position (W-01), its label (P-19) and
    how many of its valid reports moved it (W-02), in one grouping of the
    classified reports."""
    moves = stateful.change_status(standardize.enrich_metadata(reports_df))
    order = F.struct(*stateful.REPORT_ORDER)
    last = F.max_by(F.struct("Lat", "Lng", "ShipName"), order)
    return (moves.groupBy("MMSI")
            .agg(last.alias("s"), F.count(F.lit(1)).alias("n_positions"),
                 F.sum(F.when(F.col("status") == "moved", 1).otherwise(0)).alias("n_moved"))
            .select("MMSI", "s.Lat", "s.Lng",
                    standardize.display_label(F.col("MMSI"), F.col("s.ShipName")).alias("label"),
                    "n_positions", "n_moved"))


def live_feed(raw_rows: DataFrame, now=None, seconds: int = route.FRESH_SECONDS) -> DataFrame:
    """Q-04 with F-04: the same over the messages that are fresh by their
    arrival; the others are left out before anything is parsed."""
    now = route.latest_arrival(raw_rows) if now is None else now
    return live_positions(decode.decode_reports(route.fresh(raw_rows, now, seconds, "timestamp")))


def _q04_sql(source: str) -> str:
    return with_reports(
        
        "SELECT c.MMSI, c.Lat, c.Lng, c.MMSI || ': ' || coalesce(nullif(c.ShipName, ''), 'Unknown Ship') "
        "AS label, m.n_positions, m.n_moved FROM "
        "(SELECT CAST(MMSI AS VARCHAR) AS MMSI, latitude AS Lat, longitude AS Lng, "
        f"{_STRIP} AS ShipName FROM (SELECT *, row_number() OVER (PARTITION BY MMSI ORDER BY "
        f"arrival_ts DESC, \"offset\" DESC, \"partition\" DESC, pos DESC) AS rk FROM {source} WHERE "
        f"{_VALID} AND MMSI IS NOT NULL) WHERE rk = 1) c JOIN "
        "(SELECT CAST(MMSI AS VARCHAR) AS MMSI, count(*) AS n_positions, CAST(sum(CASE WHEN pl IS NOT "
        "NULL AND (latitude <> pl OR longitude <> pg) THEN 1 ELSE 0 END) AS BIGINT) AS n_moved FROM "
        f"(SELECT *, lag(latitude) OVER w AS pl, lag(longitude) OVER w AS pg FROM {source} WHERE "
        f"{_VALID} AND MMSI IS NOT NULL WINDOW w AS (PARTITION BY MMSI ORDER BY arrival_ts, \"offset\", \"partition\", pos)) "
        "GROUP BY ALL) m ON c.MMSI = m.MMSI")


@register("q04_live_positions", _q04_sql("reports"))
def q04(spark, sf):
    return live_positions(reports(spark, sf))


LIVE_SECONDS = 3600


@register("q04b_live_feed", _q04_sql(
    f"(SELECT * FROM reports WHERE arrival_ts >= (SELECT max(timestamp) FROM raw_topic) - INTERVAL {LIVE_SECONDS} SECOND)"))
def q04b(spark, sf):
    return live_feed(raw(spark, sf), seconds=LIVE_SECONDS)


BATCH_REPORT_N = 100


def batch_report(raw_rows: DataFrame, n: int = BATCH_REPORT_N) -> DataFrame:
    """Q-05: first ``n`` good messages -> six-column table -> reports per
    vessel (NULL dropped, ordered by MMSI)."""
    first = sources.bounded_read(raw_rows, n)
    six = standardize.six_columns(decode.decode_reports(first))
    return (six.where(F.col("MMSI").isNotNull()).groupBy("MMSI")
            .agg(F.count(F.lit(1)).alias("ReportCount")).orderBy("MMSI"))


@register("q05_batch_report", with_reports(
    "SELECT MMSI, count(*) AS ReportCount FROM (SELECT r.MMSI FROM reports r JOIN (SELECT "
    "\"partition\", \"offset\" FROM raw_topic WHERE json_valid(value) ORDER BY timestamp, "
    f"\"offset\", \"partition\" LIMIT {BATCH_REPORT_N}) f USING (\"partition\", \"offset\")) "
    "WHERE MMSI IS NOT NULL GROUP BY MMSI ORDER BY MMSI"))
def q05(spark, sf):
    return batch_report(raw(spark, sf))


def throughput_monitor(raw_rows: DataFrame, seconds: int = 60) -> DataFrame:
    """Q-06: per window count and kilobytes (A-04), rates per second (A-08)
    and the running totals and last flush (A-07), from one read."""
    stats = aggregates.interval_stats(raw_rows, seconds)
    return stats.select("window_start", "messages",
                        F.bround(F.col("bytes") / F.lit(1024.0), 2).alias("kilobytes"),
                        (F.col("messages") / F.lit(float(seconds))).alias("messages_per_s"),
                        (F.col("bytes") / F.lit(float(seconds))).alias("bytes_per_s"),
                        "total_messages", "overall_rate", "last_flush_count", "last_flush_rate")


@register("q06_throughput_monitor", with_reports(
    "SELECT make_timestamp(wb * 60000000) AS window_start, messages, round_even(bytes / 1024.0, 2) AS kilobytes, "
    "messages / 60.0 AS messages_per_s, bytes / 60.0 AS bytes_per_s, total_messages, "
    "total_messages / (((wb + 1) * 60000000 - s0) / 1e6) AS overall_rate, last_flush_count, "
    "CASE WHEN (wb + 1) * 60000000 > (lfb + 1) * 250000 THEN "
    "last_flush_count / (((wb + 1) * 60000000 - (lfb + 1) * 250000) / 1e6) ELSE 0.0 END AS last_flush_rate "
    "FROM (SELECT *, CAST(sum(messages) OVER (ORDER BY wb ROWS UNBOUNDED PRECEDING) AS BIGINT) "
    "AS total_messages, (SELECT epoch_us(min(timestamp)) FROM raw_topic) AS s0 FROM iv)",
    "fl AS (SELECT epoch_us(timestamp) // 250000 AS fb, count(*) AS fc, sum(strlen(value)) AS fbytes FROM raw_topic GROUP BY 1), "
    "iv AS (SELECT (fb * 250000) // 60000000 AS wb, CAST(sum(fc) AS BIGINT) AS messages, sum(fbytes) AS bytes, "
    "arg_max(fc, fb) AS last_flush_count, max(fb) AS lfb FROM fl GROUP BY 1)"))
def q06(spark, sf):
    df = throughput_monitor(raw(spark, sf))
    return df.select(wc("window_start"), *df.columns[1:])


def reenvelope(raw_rows: DataFrame,
               max_bytes: int = stateful.MAX_ENVELOPE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Q-07: flush batches (W-05) -> byte-bounded split (W-06) -> key each
    envelope with a deterministic UUID (K-04 form) of its window and the
    topic place of its first item, so no two envelopes share one.

    Returns ``(envelopes, rejected)``; rejected holds ``item`` and
    ``reason`` of every message that is in no envelope: no value, no JSON,
    or larger than ``max_bytes`` by itself."""
    batches = stateful.flush_batches(raw_rows)
    pieces, large = stateful.split_envelopes(batches, ["flush_start", "chunk", "first_item"], max_bytes=max_bytes,
                                             max_items=stateful.FLUSH_MAX_ITEMS)
    h = F.sha2(F.concat_ws("|", F.unix_micros("flush_start").cast("string"), F.col("chunk").cast("string"),
                           F.col("path"), F.col("first_item")), 256)
    key = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                      F.substring(h, 17, 4), F.substring(h, 21, 12))
    rejected = stateful.flush_rejects(raw_rows).select(F.col("value").alias("item"), "reason") \
        .unionByName(large.select("item", F.lit("too large").alias("reason")))
    return pieces.withColumn("key", key).drop("first_item"), rejected


# low enough that envelopes of two messages split and single large ones go
Q07_MAX_BYTES = 450

_Q07_CTES = (
    "queued AS (SELECT *, epoch_us(timestamp) // 250000 AS fb, row_number() OVER (PARTITION BY "
    "epoch_us(timestamp) // 250000 ORDER BY timestamp, \"offset\", \"partition\") AS rn "
    "FROM raw_topic WHERE json_valid(value)),\n"
    "halves(fb, chunk, first_item, path, idx, items) AS ("
    "SELECT fb, (rn - 1) // 1000, arg_min(topic || '|' || \"partition\" || '|' || \"offset\", rn), '', 0, "
    "list(value ORDER BY rn) FROM queued GROUP BY fb, (rn - 1) // 1000 "
    "UNION ALL SELECT fb, chunk, first_item, path || s.bit, idx + s.skip, s.part FROM (SELECT *, len(items) // 2 AS h FROM halves "
    f"WHERE strlen(array_to_string(items, ',')) + 2 > {Q07_MAX_BYTES} AND len(items) > 1) p, "
    "LATERAL (SELECT unnest([{'bit': '0', 'skip': 0, 'part': items[:h]}, "
    "{'bit': '1', 'skip': h, 'part': items[h + 1:]}], recursive := true)) s)")


def _q07_sql(body: str) -> str:
    return with_reports(body, _Q07_CTES).replace("WITH ", "WITH RECURSIVE ", 1)


@register("q07_reenvelope", _q07_sql(
    "SELECT make_timestamp(fb * 250000) AS flush_start, chunk, path, n_items, bytes, value, "
    "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) "
    "|| '-' || substr(h, 21, 12) AS key FROM (SELECT *, len(items) AS n_items, "
    "'[' || array_to_string(items, ',') || ']' AS value, CAST(strlen(array_to_string(items, ',')) + 2 AS INTEGER) AS bytes, "
    "sha256((fb * 250000) || '|' || chunk || '|' || path || '|' || first_item) AS h FROM halves) "
    f"WHERE bytes <= {Q07_MAX_BYTES}"))
def q07(spark, sf):
    out, _ = reenvelope(raw(spark, sf), Q07_MAX_BYTES)
    return out.select(wc("flush_start"), "chunk", "path", "n_items", "bytes", "value", "key")


@register("q07b_rejects", _q07_sql(
    "SELECT value AS item, 'undecodable JSON' AS reason FROM raw_topic WHERE NOT json_valid(value) "
    f"UNION ALL SELECT items[1], 'too large' FROM halves WHERE len(items) = 1 AND strlen(items[1]) + 2 > {Q07_MAX_BYTES}"))
def q07b(spark, sf):
    return reenvelope(raw(spark, sf), Q07_MAX_BYTES)[1]
