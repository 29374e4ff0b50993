"""Kafka-shaped AIS report rows derived from the ``events`` table.

The driver's ``events`` table stands in for a raw report topic. Each event
becomes one report; the derivation below is written once as SQL text with a
few dialect tokens, so Spark and the DuckDB oracle build byte-identical JSON
values from the same expressions.

Fixed values of the derivation (one report per event):

* topic ``raw``; partition ``event_id % 3``; offset ``event_id div 3``;
  arrival time = ``ts`` read as a UTC instant.
* MMSI: 0 if ``user_id % 29 = 28``; null if ``event_id % 97 = 0``;
  ``2000000 + user_id`` if ``user_id % 10 = 0``; else ``200000000 + user_id``.
* MessageType by event_type: click PositionReport, view
  StandardClassBPositionReport, purchase ExtendedClassBPositionReport, signup
  ShipStaticData, error StandardSearchAndRescueAircraftReport.
* latitude: null if ``event_id % 41 = 0``; else
  ``((user_id*7919 + (k div 34)*137) % 1600000)/10000 - 79``; longitude
  ``((user_id*104729 + (k div 34)*211) % 3600000)/10000 - 180``; both written
  as exact 4-decimal text.
* ShipName: 20 blanks if ``user_id % 13 = 0``; else ``'SHIP ' || user_id``
  right-padded to 20.
* time_utc: ``ts`` with micros, then ``123 +0000 UTC``.
* Body fields (missing when the condition holds): Cog ``event_id*37 % 361``
  (``% 17``), Sog ``event_id % 103`` (``% 19``), RateOfTurn
  ``event_id % 257 - 128`` (``% 23``), SpecialManoeuvreIndicator
  ``event_id % 3`` (``% 11``), PositionAccuracy ``event_id % 2 = 0``
  (``% 5``), Altitude for SAR aircraft ``(event_id % 5) * 100`` (``% 7``).
* Form A: one object per value; the value is the text ``{bad`` when
  ``event_id % 101 = 100``. Form B: a JSON array of the 23 consecutive
  event ids sharing ``event_id div 23``, no bad values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc

ENVELOPE_SIZE = 23
BAD_EVERY = 101

_SAR = "StandardSearchAndRescueAircraftReport"
_POSITIONED = ("'PositionReport'", "'StandardClassBPositionReport'",
               "'ExtendedClassBPositionReport'", f"'{_SAR}'")

_TOKENS = {
    "spark": {
        "div": "({a} div {b})",
        "k": "CAST(get_json_object(props, '$.k') AS BIGINT)",
        "ts_text": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
        "instant": "CAST(ts AS TIMESTAMP)",
    },
    "duckdb": {
        "div": "({a} // {b})",
        "k": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
        "ts_text": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
        "instant": "ts",
    },
}


def _div(dialect: str, a: str, b: str) -> str:
    return _TOKENS[dialect]["div"].format(a=a, b=b)


def _dec4(dialect: str, x: str) -> str:
    """Exact text of ``x / 10000`` with four decimals (x integral)."""
    return (f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || "
            f"CAST({_div(dialect, f'abs({x})', '10000')} AS STRING) || '.' || "
            f"lpad(CAST(abs({x}) % 10000 AS STRING), 4, '0'))")


def stages(dialect: str) -> list[list[tuple[str, str]]]:
    """Derivation stages: lists of (alias, expression), each stage sees the
    columns of the one before plus ``event_id, ts, user_id, event_type``."""
    t = _TOKENS[dialect]
    kdiv = _div(dialect, "k", "34")
    s1 = [
        ("k", t["k"]),
        ("mmsi", "CASE WHEN user_id % 29 = 28 THEN CAST(0 AS BIGINT) "
                 "WHEN event_id % 97 = 0 THEN CAST(NULL AS BIGINT) "
                 "WHEN user_id % 10 = 0 THEN 2000000 + user_id "
                 "ELSE 200000000 + user_id END"),
        ("mtype", "CASE event_type WHEN 'click' THEN 'PositionReport' "
                  "WHEN 'view' THEN 'StandardClassBPositionReport' "
                  "WHEN 'purchase' THEN 'ExtendedClassBPositionReport' "
                  "WHEN 'signup' THEN 'ShipStaticData' "
                  f"WHEN 'error' THEN '{_SAR}' END"),
        ("mid", "CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '18' "
                "WHEN 'purchase' THEN '19' WHEN 'signup' THEN '5' "
                "WHEN 'error' THEN '9' END"),
        ("time_text", f"{t['ts_text']} || '123 +0000 UTC'"),
        ("arrival_ts", t["instant"]),
    ]
    s2 = [
        ("lat_u", f"CASE WHEN event_id % 41 = 0 THEN CAST(NULL AS BIGINT) ELSE "
                  f"(user_id * 7919 + {kdiv} * 137) % 1600000 - 790000 END"),
        ("lng_u", f"(user_id * 104729 + {kdiv} * 211) % 3600000 - 1800000"),
        ("ship", "CASE WHEN user_id % 13 = 0 THEN rpad('', 20, ' ') "
                 "ELSE rpad('SHIP ' || CAST(user_id AS STRING), 20, ' ') END"),
    ]
    s3 = [
        ("lat_t", _dec4(dialect, "lat_u")),
        ("lng_t", _dec4(dialect, "lng_u")),
    ]
    positioned = ", ".join(_POSITIONED)
    body = (
        "'{' || concat_ws(',', "
        f"CASE WHEN mtype = '{_SAR}' AND event_id % 7 <> 0 THEN "
        "'\"Altitude\":' || CAST((event_id % 5) * 100 AS STRING) END, "
        "CASE WHEN event_id % 17 <> 0 THEN "
        "'\"Cog\":' || CAST(event_id * 37 % 361 AS STRING) END, "
        f"CASE WHEN mtype IN ({positioned}) AND lat_u IS NOT NULL THEN "
        "'\"Latitude\":' || lat_t || ',\"Longitude\":' || lng_t END, "
        "'\"MessageID\":' || mid, "
        "CASE WHEN event_id % 5 <> 0 THEN '\"PositionAccuracy\":' || "
        "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END END, "
        "CASE WHEN event_id % 23 <> 0 THEN "
        "'\"RateOfTurn\":' || CAST(event_id % 257 - 128 AS STRING) END, "
        "CASE WHEN event_id % 19 <> 0 THEN "
        "'\"Sog\":' || CAST(event_id % 103 AS STRING) END, "
        "CASE WHEN event_id % 11 <> 0 THEN "
        "'\"SpecialManoeuvreIndicator\":' || CAST(event_id % 3 AS STRING) END, "
        "CASE WHEN mmsi IS NOT NULL THEN '\"UserID\":' || CAST(mmsi AS STRING) END, "
        "'\"Valid\":true') || '}'"
    )
    meta = (
        "'{' || concat_ws(',', "
        "CASE WHEN mmsi IS NOT NULL THEN '\"MMSI\":' || CAST(mmsi AS STRING) || "
        "',\"MMSI_String\":' || CAST(mmsi AS STRING) END, "
        "'\"ShipName\":\"' || ship || '\"', "
        "CASE WHEN lat_u IS NOT NULL THEN '\"latitude\":' || lat_t END, "
        "'\"longitude\":' || lng_t, "
        "'\"time_utc\":\"' || time_text || '\"') || '}'"
    )
    s4 = [("body_text", body), ("meta_text", meta)]
    s5 = [("obj", "'{\"Message\":{\"' || mtype || '\":' || body_text || "
                  "'},\"MessageType\":\"' || mtype || '\",\"MetaData\":' || "
                  "meta_text || '}'")]
    return [s1, s2, s3, s4, s5]


def form_a_columns(dialect: str) -> list[tuple[str, str]]:
    """Kafka-shaped columns of form A (one report per value)."""
    return [
        ("key", "CAST(NULL AS STRING)"),
        ("value", f"CASE WHEN event_id % {BAD_EVERY} = {BAD_EVERY - 1} "
                  "THEN '{bad' ELSE obj END"),
        ("topic", "'raw'"),
        ("partition", "CAST(event_id % 3 AS INT)"),
        ("offset", _div(dialect, "event_id", "3")),
        ("timestamp", "arrival_ts"),
    ]


#: Values that must not be lost, by ``event_id % 10``: a report, an array of
#: two, no value, no JSON, a mistyped field, a body under another key, deep
#: nesting, key paths that collide, deeper nesting, and a body of wrong types.
AWKWARD = ["obj", "'[' || obj || ',' || obj || ']'", "NULL", "'{bad'",
           """'{"Message":{},"MessageType":"T","MetaData":{"MMSI":"x","latitude":1.5}}'""",
           """'{"Message":{"Other":{"a":1}},"MessageType":"PositionReport","MetaData":{"MMSI":1}}'""",
           "'" + '{"a":' * 9 + "1" + "}" * 9 + "'", """'{"a_b":1,"a":{"b":2}}'""",
           "'" + '{"a":' * 40 + '[1,"x",{}]' + "}" * 40 + "'",
           """'{"Message":{"PositionReport":{"Cog":"abc","Sog":[1],"RateOfTurn":3000000000,"Valid":true}},"MessageType":"PositionReport","MetaData":{"MMSI":1}}'"""]


def awkward_columns(dialect: str) -> list[tuple[str, str]]:
    value = f"CASE event_id % {len(AWKWARD)} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(AWKWARD)) + " END"
    return [(a, value if a == "value" else e) for a, e in form_a_columns(dialect)]


def awkward_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic rows with awkward values, one per event. A report's text is only
    made where the value holds it."""
    held = ", ".join(str(k) for k, value in enumerate(AWKWARD) if "obj" in value)
    objs = report_objects(spread_events(spark, sf_dir), f"event_id % {len(AWKWARD)} IN ({held})")
    return objs.selectExpr(*[f"{expr} AS `{alias}`" for alias, expr in awkward_columns("spark")])


def duckdb_awkward_cte(name: str = "awkward_topic") -> str:
    cols = ", ".join(f'{expr} AS "{alias}"' for alias, expr in awkward_columns("duckdb"))
    return duckdb_objects_cte() + f",\n{name} AS (SELECT event_id, {cols} FROM fx5)"


def report_objects(events: DataFrame, wanted: str = "true") -> DataFrame:
    """Events with every derived column of the fixture (Spark); ``obj``, the
    report's text, only where it is ``wanted``, else NULL."""
    df = events.select("event_id", "ts", "user_id", "event_type", "props")
    for stage in stages("spark"):
        df = df.selectExpr("*", *[f"CASE WHEN {wanted} THEN {expr} END AS obj" if alias == "obj" else f"{expr} AS {alias}"
                                  for alias, expr in stage])
    return df


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return events.select("event_id", "ts", "user_id", "event_type", "props")


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events dealt out to the session's shuffle partitions. A file is read
    by no more tasks than it has row groups, each of which would do all the
    row-wise work on its rows; the rows are small, what is made of them is not."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_events(spark, sf_dir).repartition(n, "event_id", "ts", "user_id")


def raw_topic(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Form A topic rows: ``key, value, topic, partition, offset, timestamp``;
    with ``spread`` made by all tasks, for much work on each row."""
    objs = report_objects((spread_events if spread else read_events)(spark, sf_dir))
    return objs.selectExpr(*[f"{expr} AS `{alias}`"
                             for alias, expr in form_a_columns("spark")])


def envelope_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form B before serialisation: ``partition, offset, timestamp, items``
    with the report texts of each envelope in order.

    Grouping is on ``event_id div 23``; each group is bounded at 23 rows, so
    the collect never grows with the data.
    """
    objs = report_objects(read_events(spark, sf_dir))
    grouped = (objs.groupBy(F.expr(f"event_id div {ENVELOPE_SIZE}").alias("g"))
               .agg(F.sort_array(F.collect_list(F.struct("event_id", "obj"))).alias("_i"),
                    F.max("arrival_ts").alias("timestamp")))
    return grouped.select(
        (F.col("g") % 3).cast("int").alias("partition"),
        F.expr("g div 3").alias("offset"),
        "timestamp",
        F.transform("_i", lambda x: x["obj"]).alias("items"))


def envelope_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form B topic rows: one JSON array of 23 consecutive reports per value."""
    items = envelope_items(spark, sf_dir)
    return items.select(
        F.lit(None).cast("string").alias("key"),
        F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("value"),
        F.lit("raw").alias("topic"),
        "partition", "offset", "timestamp")


def duckdb_objects_cte(source: str = "events") -> str:
    """DuckDB CTE chain ``fx1 .. fx5`` over ``source`` (oracle side)."""
    parts = []
    prev = f"(SELECT event_id, ts, user_id, event_type, props FROM {source})"
    for i, stage in enumerate(stages("duckdb"), start=1):
        cols = ", ".join(f"{expr} AS {alias}" for alias, expr in stage)
        parts.append(f"fx{i} AS (SELECT *, {cols} FROM {prev} AS p{i})")
        prev = f"fx{i}"
    return ",\n".join(parts)


def duckdb_raw_topic_cte(name: str = "raw_topic") -> str:
    cols = ", ".join(f'{expr} AS "{alias}"'
                     for alias, expr in form_a_columns("duckdb"))
    return duckdb_objects_cte() + f",\n{name} AS (SELECT event_id, {cols} FROM fx5)"


def duckdb_envelope_topic_cte(name: str = "env_topic") -> str:
    return duckdb_objects_cte() + (
        f",\n{name} AS (SELECT CAST(NULL AS VARCHAR) AS key, "
        f"'[' || string_agg(obj, ',' ORDER BY event_id) || ']' AS value, "
        f"'raw' AS topic, CAST((event_id // {ENVELOPE_SIZE}) % 3 AS INTEGER) AS partition, "
        f"(event_id // {ENVELOPE_SIZE}) // 3 AS \"offset\", max(arrival_ts) AS timestamp "
        f"FROM fx5 GROUP BY event_id // {ENVELOPE_SIZE})")
