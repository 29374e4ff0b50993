"""Topic sinks: Kafka-shaped rows with key choices, routing, producer
profiles, console output.

With ``bootstrap`` servers the writers use ``format("kafka")`` (a ``topic``
column routes each row, so one write fans out to every type topic). Offline,
Kafka-shaped rows are written as parquet partitioned by ``topic``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.standardize import report_uuid

# Producer settings used by the reference's three producers.
PROCESSOR_PROFILE = {
    "queue.buffering.max.messages": "5000",
    "queue.buffering.max.kbytes": "212144",
    "linger.ms": "50",
    "batch.num.messages": "1000",
    "acks": "all",
    "compression.type": "lz4",
}
COLLECTOR_PROFILE = {
    "batch.size": "1048576",
    "linger.ms": "200",
    "compression.type": "snappy",
    "acks": "all",
}
ENVELOPE_PROFILE = {"compression.type": "lz4"}

# librdkafka names -> Kafka Java producer names (Spark's connector).
_JAVA_NAMES = {
    "queue.buffering.max.kbytes": "buffer.memory",
    "batch.num.messages": None,
    "queue.buffering.max.messages": None,
}


def producer_options(profile: dict[str, str]) -> dict[str, str]:
    """K-06: a producer profile as ``kafka.*`` writer options. Settings with
    no Java-producer counterpart are left out; kbytes become bytes."""
    out = {}
    for key, value in profile.items():
        name = _JAVA_NAMES.get(key, key)
        if name is None:
            continue
        if key == "queue.buffering.max.kbytes":
            value = str(int(value) * 1024)
        out[f"kafka.{name}"] = value
    return out


def report_json(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """The report as JSON text, never NULL; the body map is written back as
    an object with all its keys (``Message`` holds a JSON text per key)."""
    cols = [c for c in df.columns if c not in exclude and c != "Message"]
    rest = F.to_json(F.struct(*[F.col(c) for c in cols]))
    if "Message" not in df.columns:
        return rest
    def member(e: Column) -> Column:
        name = F.regexp_replace(e["key"], r'(["\\])', r"\\$1")
        return F.concat(F.lit('"'), name, F.lit('":'), F.coalesce(e["value"], F.lit("null")))

    message = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("Message"), member), ","), F.lit("}"))
    return F.when(F.col("Message").isNull(), rest).otherwise(
        F.concat(F.lit('{"Message":'), message, F.when(rest == "{}", F.lit("")).otherwise(F.lit(",")),
                 rest.substr(F.lit(2), F.length(rest))))


def with_member(report: Column, name: str, value: Column) -> Column:
    """A report's JSON text with one more member of text at its end; the
    rest of the text stays as it came."""
    text = F.rtrim(F.coalesce(report, F.lit("{}")))
    open_ = F.rtrim(text.substr(F.lit(1), F.length(text) - 1))
    return F.concat(open_, F.when(open_.endswith("{"), F.lit("")).otherwise(F.lit(",")),
                    F.lit(f'"{name}":"'), value, F.lit('"}'))


def to_topic_rows(df: DataFrame, key: Column | None, topic: Column | str,
                  value: Column | None = None) -> DataFrame:
    """K-01: Kafka-shaped ``key, value, topic`` rows."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    v = value if value is not None else report_json(df)
    k = key if key is not None else F.lit(None).cast("string")
    return df.select(k.cast("string").alias("key"), v.alias("value"), t.alias("topic"))


def key_by_mmsi(mmsi: Column) -> Column:
    """K-02: key = MMSI text."""
    return mmsi.cast("string")


def json_key(uuid: Column, ts: Column) -> Column:
    """K-03: key = JSON ``{"uuid": ..., "timestamp": <epoch ms>}``."""
    return F.to_json(F.struct(uuid.alias("uuid"), F.unix_millis(ts).alias("timestamp")))


def uuid_key() -> Column:
    """K-04: key = the report's deterministic UUID."""
    return report_uuid()


def write_topic(rows: DataFrame, *, bootstrap: str | None = None, path: str | None = None,
                profile: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch write of Kafka-shaped rows (``topic`` column routes them)."""
    if bootstrap:
        w = rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        for k, v in producer_options(profile or {}).items():
            w = w.option(k, v)
        w.save()
        return
    rows.write.mode(mode).partitionBy("topic").parquet(path)


def write_topic_stream(rows: DataFrame, *, checkpoint: str, bootstrap: str | None = None,
                       path: str | None = None, profile: dict[str, str] | None = None,
                       trigger: dict | None = None, query_name: str | None = None):
    """Streaming write of Kafka-shaped rows; the checkpoint folder must be on
    shared storage (see ``session.scratch_path``)."""
    w = rows.writeStream.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if bootstrap:
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        for k, v in producer_options(profile or {}).items():
            w = w.option(k, v)
        return w.start()
    return w.format("parquet").partitionBy("topic").option("path", path).start()


def console(df: DataFrame, n: int = 20, stream: bool = False, **trigger):
    """K-05: print rows (batch ``show``; stream ``format('console')``)."""
    if stream:
        w = df.writeStream.format("console").option("truncate", False)
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    df.show(n, truncate=False)
    return None
