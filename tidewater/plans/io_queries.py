"""Registered queries for flatten (P-18), sources (S-04..S-09) and sinks
(K-01..K-04), with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decode, flatten, route, stateful
from ..sinks import topics as sinks
from ..sources import fixture
from ..sources import topics as sources
from .oracle import with_reports
from ..session import scratch_path
from .queries import KEY, KEY_SQL, ORACLE, raw, register, reports, std_reports

# ---------------------------------------------------------------- P-18 --

_FLAT_PATH = (r"regexp_replace(regexp_replace(regexp_replace(t.fullkey, '\[(\d+)\]', '.\1', 'g'), '^\$\.', ''), "
              r"'\.', '_', 'g')")
_IS_LEAF = ("(t.type NOT IN ('OBJECT', 'ARRAY') OR (t.type = 'ARRAY' AND json_array_length(t.value) = 0) "
            "OR (t.type = 'OBJECT' AND len(json_keys(t.value)) = 0))")


@register("p18_flatten", with_reports(
    f"SELECT r.\"partition\", r.\"offset\", {_FLAT_PATH} AS path, "
    "CASE WHEN t.type = 'NULL' THEN 'null' WHEN t.type = 'OBJECT' THEN 'object' "
    "WHEN t.type = 'ARRAY' THEN 'array' WHEN t.type = 'VARCHAR' THEN 'string' "
    "WHEN t.type = 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind, "
    "CASE WHEN t.type = 'VARCHAR' THEN t.value ->> '$' "
    "WHEN t.type IN ('BOOLEAN', 'OBJECT', 'ARRAY') THEN CAST(t.value AS VARCHAR) END AS text, "
    "CASE WHEN t.type IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(t.atom AS DOUBLE) END AS num "
    f"FROM raw_topic r, json_tree(r.value) t WHERE json_valid(r.value) AND t.fullkey <> '$' AND {_IS_LEAF}"))
def p18(spark, sf):
    return flatten.flatten_rows(raw(spark, sf), KEY)


# -------------------------------------------- nothing is lost silently --


def _awkward(body: str) -> str:
    return f"WITH {fixture.duckdb_awkward_cte()}\n{body}"


@register("d03b_awkward_fates", _awkward(
    f"SELECT {KEY_SQL}, CAST(CASE event_id % 10 WHEN 1 THEN 2 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 9 THEN 0 ELSE 1 END "
    "AS BIGINT) AS reports, CASE event_id % 10 WHEN 2 THEN 'undecodable JSON' WHEN 3 THEN 'undecodable JSON' "
    "WHEN 4 THEN 'mistyped field: MetaData.MMSI' WHEN 9 THEN 'mistyped field: Message.PositionReport.Cog, "
    "Message.PositionReport.RateOfTurn, Message.PositionReport.Sog' END AS reason FROM awkward_topic"))
def d03b(spark, sf):
    """Every topic row, as its reports or in quarantine, never neither."""
    good, bad = decode.split_quarantine(fixture.awkward_topic(spark, sf))
    counted = good.groupBy(*KEY).agg(F.count(F.lit(1)).alias("reports")).withColumn("reason", F.lit(None).cast("string"))
    return counted.unionByName(bad.select(*KEY, F.lit(0).cast("long").alias("reports"), "reason"))


@register("p18b_flatten_fates", _awkward(
    f"SELECT r.\"partition\", r.\"offset\", {_FLAT_PATH} AS path, regexp_replace(CAST(t.value AS VARCHAR), '^(-?\\d+)\\.0+$', '\\1') AS leaf, NULL AS reason "
    f"FROM awkward_topic r, json_tree(r.value) t WHERE event_id % 10 NOT IN (2, 3, 7) AND t.fullkey <> '$' AND {_IS_LEAF} "
    f"UNION ALL SELECT {KEY_SQL}, NULL, NULL, CASE event_id % 10 WHEN 7 THEN 'colliding key paths' "
    "ELSE 'undecodable JSON' END FROM awkward_topic WHERE event_id % 10 IN (2, 3, 7)"))
def p18b(spark, sf):
    """Every topic row, as its leaves at any depth (numbers as the engines
    write them) or in quarantine with the reason."""
    good, bad = flatten.split_flattenable(fixture.awkward_topic(spark, sf).select(*KEY, "value"))
    leaf = F.regexp_replace(F.to_json("x.v"), r"^(-?\d+)\.0+$", "$1")
    rows = good.select(*KEY, F.explode("_flat_e").alias("x")).select(
        *KEY, F.col("x.path").alias("path"), leaf.alias("leaf"), F.lit(None).cast("string").alias("reason"))
    none = F.lit(None).cast("string")
    return rows.unionByName(bad.select(*KEY, none.alias("path"), none.alias("leaf"), "reason"))


@register("w05b_queue_fates", _awkward(
    "SELECT CASE WHEN value IS NULL THEN 'no value' WHEN NOT json_valid(value) THEN 'undecodable JSON' "
    "ELSE 'queued' END AS fate, count(*) AS messages FROM awkward_topic GROUP BY ALL"))
def w05b(spark, sf):
    """Every message is in one envelope or rejected with a reason."""
    topic = fixture.awkward_topic(spark, sf)
    queued = stateful.flush_batches(topic).agg(F.sum("n_items").alias("messages")) \
        .select(F.lit("queued").alias("fate"), "messages")
    return queued.unionByName(stateful.flush_rejects(topic).groupBy(F.col("reason").alias("fate"))
                              .agg(F.count(F.lit(1)).alias("messages")))


@register("k01b_whole_messages", _awkward(
    f"SELECT {KEY_SQL}, CASE WHEN event_id % 10 = 5 THEN '{{\"Other\":{{\"a\":1}}}}' WHEN event_id % 10 = 4 THEN '{{}}' "
    "ELSE '{\"PositionReport\":{\"Cog\":\"abc\",\"Sog\":[1],\"RateOfTurn\":3000000000,\"Valid\":true}}' END AS message "
    "FROM awkward_topic WHERE event_id % 10 IN (4, 5, 9)"))
def k01b(spark, sf):
    """The sink's value keeps a body under any key and is never NULL."""
    rep = decode.decode_reports(fixture.awkward_topic(spark, sf))
    value = sinks.report_json(rep.select("Message", "MessageType", "MetaData"))
    return rep.withColumn("v", value).where(F.col("MessageType").isin("T", "PositionReport") & F.col("v").isNotNull()) \
        .where("MetaData.MMSI IS NULL AND MessageType = 'T' OR MetaData.MMSI = 1") \
        .select(*KEY, F.get_json_object("v", "$.Message").alias("message"))


# ------------------------------------------------------------- sources --

BOUNDED_N = 100


@register("s04_bounded_read", with_reports(
    f"SELECT {KEY_SQL}, timestamp FROM raw_topic WHERE json_valid(value) "
    f"ORDER BY timestamp, \"offset\", \"partition\" LIMIT {BOUNDED_N}"))
def s04(spark, sf):
    df = sources.bounded_read(raw(spark, sf), BOUNDED_N)
    return df.select(*KEY, F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


S03_REPORTS = 1000


@register("s03_json_array_files", with_reports(
    "SELECT MessageType, MMSI, ShipName, latitude, longitude, time_utc FROM (SELECT mtype AS MessageType, mmsi AS MMSI, "
    "ship AS ShipName, CAST(lat_t AS DOUBLE) AS latitude, CAST(lng_t AS DOUBLE) AS longitude, time_text AS time_utc FROM fx5)"))
def s03(spark, sf):
    """Files of one JSON array each, written from the whole table, read back
    by several tasks a file."""
    path = scratch_path(spark, "arrays")
    objs = fixture.report_objects(fixture.read_events(spark, sf))
    arrays = objs.groupBy(F.expr(f"event_id div {S03_REPORTS}").alias("g")).agg(F.collect_list("obj").alias("o"))
    arrays.select("g", F.concat(F.lit("["), F.array_join("o", ",\n "), F.lit("]")).alias("value")) \
        .write.partitionBy("g").text(path)
    reports = sources.read_json_array_split(spark, path)
    return reports.select("MessageType", "MetaData.MMSI", "MetaData.ShipName", "MetaData.latitude", "MetaData.longitude",
                          "MetaData.time_utc")


S04_ERROR = "event_id % 1009 = 700"


@register("s04b_until_error", with_reports(
    f"SELECT {KEY_SQL}, timestamp FROM raw_topic WHERE json_valid(value) AND (timestamp, \"offset\", \"partition\") < "
    f"(SELECT min((timestamp, \"offset\", \"partition\")) FROM raw_topic WHERE {S04_ERROR}) "
    "ORDER BY timestamp, \"offset\", \"partition\" LIMIT 1000"))
def s04b(spark, sf):
    """Up to 1,000 good messages, but none from the first source error on."""
    event_id = F.col("offset") * 3 + F.col("partition")      # as the fixture numbers them
    df = sources.bounded_read(raw(spark, sf), 1000, error=event_id % 1009 == 700)
    return df.select(*KEY, F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


S05_PARTITION, S05_OFFSET, S05_MAX_BYTES = 0, 1000, 100_000


@register("s05_offset_range", with_reports(
    f"SELECT {KEY_SQL}, running_bytes FROM (SELECT *, CAST(sum(strlen(value)) OVER (ORDER BY "
    "\"offset\" ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_bytes FROM raw_topic "
    f"WHERE \"partition\" = {S05_PARTITION} AND \"offset\" >= {S05_OFFSET}) "
    f"WHERE running_bytes <= {S05_MAX_BYTES}"))
def s05(spark, sf):
    df = sources.offset_range(raw(spark, sf), "raw", S05_PARTITION, S05_OFFSET, S05_MAX_BYTES)
    return df.select(*KEY, "running_bytes")


S05_BLOCK = 512


def _s05_log(spark, sf) -> str:
    path = scratch_path(spark, "topic-log")
    sources.write_log(raw(spark, sf), path, S05_BLOCK)
    return path


@register("s05b_log_range", ORACLE["s05_offset_range"])
def s05b(spark, sf):
    """S-05 from files written by ranges of offsets."""
    df = sources.log_range(spark, _s05_log(spark, sf), "raw", S05_PARTITION, S05_OFFSET, S05_MAX_BYTES, S05_BLOCK)
    return df.select(*KEY, "running_bytes")


@register("s06b_log_catalogue", with_reports(
    f"SELECT topic, \"partition\", \"offset\" // {S05_BLOCK} AS block, count(*) AS records, min(\"offset\") AS min_offset, "
    "max(\"offset\") AS max_offset, CAST(sum(strlen(value)) AS BIGINT) AS bytes FROM raw_topic GROUP BY ALL"))
def s06b(spark, sf):
    return sources.log_catalogue(spark, _s05_log(spark, sf))


@register("s06_topic_catalogue", with_reports(
    "SELECT topic, \"partition\", count(*) AS records, min(\"offset\") AS min_offset, "
    "max(\"offset\") AS max_offset FROM raw_topic GROUP BY ALL"))
def s06(spark, sf):
    return sources.topic_catalogue(raw(spark, sf))


AREA_BOXES = sources.PRODUCER_BOXES + [[[10.0, -30.0], [-20.0, 40.0]]]


def _boxes_sql() -> str:
    rows = []
    for (a_lat, a_lng), (b_lat, b_lng) in AREA_BOXES:
        rows.append(f"({min(a_lat, b_lat)!r}, {max(a_lat, b_lat)!r}, "
                    f"{min(a_lng, b_lng)!r}, {max(a_lng, b_lng)!r})")
    return "boxes AS (SELECT * FROM (VALUES " + ", ".join(rows) + \
        ") t(lat_lo, lat_hi, lng_lo, lng_hi))"


@register("s07_area_filter", with_reports(
    f"SELECT {KEY_SQL}, latitude AS Lat, longitude AS Lng FROM reports r WHERE EXISTS "
    "(SELECT 1 FROM boxes b WHERE r.latitude BETWEEN b.lat_lo AND b.lat_hi AND "
    "r.longitude BETWEEN b.lng_lo AND b.lng_hi)", _boxes_sql()))
def s07(spark, sf):
    boxes = sources.boxes_frame(spark, AREA_BOXES)
    return sources.area_filter(std_reports(spark, sf), boxes).select(*KEY, "Lat", "Lng")


SUBSCRIBED_MMSI = ["200000001", "200000007", "200000012", "200000046", "2000010"]
SUBSCRIBED_TYPES = ["PositionReport"]


@register("s08_mmsi_filter", with_reports(
    f"SELECT {KEY_SQL}, CAST(MMSI AS VARCHAR) AS MMSI FROM reports WHERE CAST(MMSI AS VARCHAR) IN ("
    + ", ".join(f"'{m}'" for m in SUBSCRIBED_MMSI) + ")"))
def s08(spark, sf):
    return sources.mmsi_filter(std_reports(spark, sf), SUBSCRIBED_MMSI).select(*KEY, "MMSI")


@register("s09_type_filter", with_reports(
    f"SELECT {KEY_SQL}, MessageType FROM reports WHERE MessageType IN ("
    + ", ".join(f"'{t}'" for t in SUBSCRIBED_TYPES) + ")"))
def s09(spark, sf):
    return sources.type_filter(reports(spark, sf), SUBSCRIBED_TYPES).select(*KEY, "MessageType")


# --------------------------------------------------------------- sinks --

@register("k01_topic_rows", with_reports(
    f"SELECT {KEY_SQL}, 'ais_reports_enriched' AS topic, MMSI AS value_mmsi, "
    "MessageType AS value_type, Cog AS value_cog, value AS whole, 'k' || \"offset\" AS key FROM reports"))
def k01(spark, sf):
    keyed = raw(spark, sf).withColumn("key", F.concat(F.lit("k"), "offset"))
    rows = decode.decode_whole(keyed).select("key", *KEY, "MessageType", F.col("report").alias("value"))
    return rows.select(
        "key", F.col("value").alias("whole"), *KEY, F.lit("ais_reports_enriched").alias("topic"),
        F.get_json_object("value", "$.MetaData.MMSI").cast("bigint").alias("value_mmsi"),
        F.get_json_object("value", "$.MessageType").alias("value_type"),
        F.expr("get_json_object(value, concat('$.Message.', MessageType, '.Cog'))")
        .cast("double").alias("value_cog"))


@register("k02_key_by_mmsi", with_reports(
    f"SELECT {KEY_SQL}, CAST(MMSI AS VARCHAR) AS key, 'ais_' || lower(MessageType) AS topic "
    "FROM reports"))
def k02(spark, sf):
    df = route.with_route(reports(spark, sf), name="topic_out")
    return df.select(*KEY, sinks.key_by_mmsi(F.col("MetaData.MMSI")).alias("key"),
                     F.col("topic_out").alias("topic"))


_UUID_SQL = ("substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' "
             "|| substr(h, 17, 4) || '-' || substr(h, 21, 12)")
_HASHED = ("(SELECT *, sha256(topic || '|' || CAST(\"partition\" AS VARCHAR) || '|' || "
           "CAST(\"offset\" AS VARCHAR) || '|' || CAST(pos AS VARCHAR)) AS h FROM reports)")


@register("k03_json_key", with_reports(
    f"SELECT {KEY_SQL}, '{{\"uuid\":\"' || {_UUID_SQL} || '\",\"timestamp\":' || "
    f"CAST(epoch_us(arrival_ts) // 1000 AS VARCHAR) || '}}' AS key FROM {_HASHED}"))
def k03(spark, sf):
    df = reports(spark, sf)
    return df.select(*KEY, sinks.json_key(sinks.uuid_key(), F.col("arrival_ts")).alias("key"))


@register("k04_uuid_key", with_reports(f"SELECT {KEY_SQL}, {_UUID_SQL} AS key FROM {_HASHED}"))
def k04(spark, sf):
    return reports(spark, sf).select(*KEY, sinks.uuid_key().alias("key"))

