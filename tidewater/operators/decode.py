"""Decode topic values into one row per report, and report quality.

Every operator is ``DataFrame -> DataFrame`` and row-wise, so the same code
serves batch and Structured Streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..schemas import BODY, ENVELOPE, MESSAGE_TYPES, METADATA

# Columns carried from the topic row onto every decoded report.
TOPIC_COLUMNS = ["topic", "partition", "offset"]


def parsed(value: Column | str = "value", mode: str = "PERMISSIVE") -> Column:
    """``from_json`` of a value as an array of reports (form A or B).

    ``mode=FAILFAST`` raises on malformed text (strict policy, D-02).
    """
    return F.from_json(value, ENVELOPE, {"mode": mode})


def decode_reports(raw: DataFrame, strict: bool = False) -> DataFrame:
    """D-01: parse each value once and unnest the envelope.

    Output: ``topic, partition, offset, pos, arrival_ts, Message,
    MessageType, MetaData``. ``pos`` is the report's index in its envelope
    (0 for form A), so ``(topic, partition, offset, pos)`` identifies a
    report. Malformed values yield no rows unless ``strict`` (D-02), which
    fails the job instead.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"
    df = raw.select(*TOPIC_COLUMNS, F.col("timestamp").alias("arrival_ts"),
                    F.posexplode(parsed("value", mode)).alias("pos", "r"))
    return df.select(*TOPIC_COLUMNS, "pos", "arrival_ts",
                     "r.Message", "r.MessageType", "r.MetaData")


def report_texts(value: Column | str = "value") -> Column:
    """The JSON text of each report of a value, all its fields kept. A single
    report is its value as it came; those of an array are written anew (keys
    sorted, numbers exact; as doubles where an object repeats a key)."""
    value = F.col(value) if isinstance(value, str) else value
    parts = F.try_variant_get(F.try_parse_json(value), "$", "array<variant>")
    return F.when(F.ltrim(value).startswith("["), F.coalesce(
        F.transform(parts, lambda v: F.to_json(v)), F.from_json(value, "array<string>"))).otherwise(F.array(value))


def decode_whole(raw: DataFrame) -> DataFrame:
    """D-01 with the message kept: besides the columns of ``decode_reports``
    the message's ``key`` and ``report``, the report's own JSON text with
    every field it came with, known or not."""
    both = F.arrays_zip(parsed("value").alias("r"), report_texts().alias("text"))
    df = raw.select("key", *TOPIC_COLUMNS, F.col("timestamp").alias("arrival_ts"),
                    F.posexplode(both).alias("pos", "z"))
    return df.select("key", *TOPIC_COLUMNS, "pos", "arrival_ts", F.col("z.text").alias("report"),
                     "z.r.Message", "z.r.MessageType", "z.r.MetaData")


def with_body(reports: DataFrame, name: str = "body") -> DataFrame:
    """Parse the body of each report (``Message[MessageType]``) with the
    union body schema; missing fields give NULL. Catalyst prunes the parse
    schema to the fields used downstream. A body that is there stays."""
    if name in reports.columns:
        return reports
    return reports.withColumn(
        name, F.from_json(F.try_element_at("Message", F.col("MessageType")), BODY))


def strict_decode(raw: DataFrame) -> DataFrame:
    """D-02: any undecodable value stops the job with an error."""
    return decode_reports(raw, strict=True)


# ------------------------------------------------- checked decode (D-03) --


def _as(v: Column, kind: str) -> Column:
    """A VARIANT as another type, NULL if it is not; as ``string`` a JSON
    string is its own text, any other value its JSON."""
    return F.try_variant_get(v, "$", kind)


_INT = 2**31 - 1


def _mistyped(members: Column, fields: StructType) -> Column:
    """Names of the members (``MAP<STRING,VARIANT>``) that are not of the type
    of the field of their name: by the kind of their value, or too large an
    integer. Null is of any type, and so is any value of a text field. One
    small expression whatever the number of fields, so that it is compiled."""
    wanted = F.create_map(*[F.lit(x) for f in fields if f.dataType.typeName() != "string"
                            for x in (f.name, f.dataType.typeName())])

    def looked_at(e: Column) -> Column:
        return F.struct(e["key"].alias("name"), F.try_element_at(wanted, e["key"]).alias("type"), e["value"].alias("v"),
                        F.schema_of_variant(e["value"]).alias("kind"))

    def wrong(x: Column) -> Column:
        whole = x["kind"] == "BIGINT"
        ok = (F.when(x["type"] == "double", whole | (x["kind"] == "DOUBLE") | x["kind"].startswith("DECIMAL"))
              .when(x["type"] == "boolean", x["kind"] == "BOOLEAN").when(x["type"] == "long", whole)
              .otherwise(whole & F.coalesce(_as(x["v"], "bigint").between(-_INT - 1, _INT), F.lit(False))))
        return x["type"].isNotNull() & (x["kind"] != "VOID") & ~ok

    return F.transform(F.filter(F.transform(F.map_entries(members), looked_at), wrong), lambda x: x["name"])


def decode_or_reject(raw: DataFrame) -> DataFrame:
    """D-03 in one frame: each report of each topic row, decoded whole (the
    columns of D-01 and the typed ``body``) or with a ``reason``: no JSON, no
    report (neither an object nor an array of them), or the fields of the
    envelope, the metadata or the body that are there but not of their type,
    named. With a reason comes the ``value``: the row's, as it came, or in an
    envelope the report's own JSON. An empty array has no reports.

    The value is parsed once, to VARIANT; every field is looked at by its
    kind, so nothing becomes a legitimate "not available" code. Fields
    unknown to the schemas are neither typed nor checked.
    """
    df = raw.select(*TOPIC_COLUMNS, F.col("timestamp").alias("arrival_ts"), "value", F.try_parse_json("value").alias("_v"))
    single = F.ltrim("value", F.lit(" \t\r\n")).startswith("{")
    many = F.when(F.col("_v").isNotNull(), F.when(single, F.array("_v")).otherwise(_as(F.col("_v"), "array<variant>")))
    df = df.select("*", many.isNull().alias("_none"), F.posexplode_outer(many).alias("pos", "_r")) \
        .where(F.col("_none") | F.col("pos").isNotNull())
    # types are read off the report itself, by path: to take a part out as
    # VARIANT would encode it anew
    def at(path: str | Column, kind: str) -> Column:
        return F.try_variant_get(F.col("_r"), path, kind)

    df = df.withColumns({"_type": at("$.MessageType", "string"), "_m": at("$.Message", "map<string,string>"),
                         "_d": at("$.MetaData", "map<string,variant>")})
    place = F.concat(F.lit("$.Message['"), F.col("_type"), F.lit("']"))
    plain = F.col("_type").rlike(r"^\w+$")

    def body(kind: str) -> Column:
        return F.when(plain, at(place, kind)).otherwise(
            _as(F.try_element_at(at("$.Message", "map<string,variant>"), "_type"), kind))

    df = df.withColumn("_b", body("map<string,variant>"))

    def lost(part: str, whole: Column, name: Column) -> Column:
        return F.when(F.col(part).isNull(), F.when(whole.isNotNull(), name))

    def named(prefix: Column, names: Column) -> Column:
        return F.transform(names, lambda n: F.concat(prefix, n))

    path = F.concat(F.lit("Message."), F.col("_type"))
    faults = F.concat_ws(
        ", ", F.when(at("$", "struct<MessageType:string>").isNull(), F.lit("report")),
        lost("_m", at("$.Message", "string"), F.lit("Message")), lost("_d", at("$.MetaData", "string"), F.lit("MetaData")),
        lost("_b", F.try_element_at("_m", "_type"), path), named(F.lit("MetaData."), _mistyped(F.col("_d"), METADATA)),
        named(F.concat(path, F.lit(".")), _mistyped(F.col("_b"), BODY)))
    df = df.withColumn("_f", faults)
    reason = F.when(F.col("_v").isNull(), F.lit("undecodable JSON")).when(F.col("_none"), F.lit("no report")) \
        .when(F.col("_f") != "", F.concat(F.lit("mistyped field: "), F.col("_f")))
    df = df.withColumn("_reason", reason)
    good = F.col("_reason").isNull()
    # a generator of one row: a filter on the reason must not repeat the steps above
    one = F.struct(
        F.when(good, F.col("_m")).alias("Message"), F.when(good, F.col("_type")).alias("MessageType"),
        F.when(good, at("$.MetaData", METADATA.simpleString())).alias("MetaData"),
        F.when(good, body(BODY.simpleString())).alias("body"), F.col("_reason").alias("reason"),
        F.when(~good, F.when(F.col("_none") | single, F.col("value")).otherwise(F.to_json("_r"))).alias("value"))
    return df.select(*TOPIC_COLUMNS, "pos", "arrival_ts", F.explode(F.array(one)).alias("_s")).select(
        *TOPIC_COLUMNS, "pos", "arrival_ts", "_s.*")


def split_quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D-03: lenient policy. Returns ``(reports, quarantine)`` of
    ``decode_or_reject``; the second frame holds what does not decode whole,
    with its value and a reason, and none of it is in the first."""
    rows = decode_or_reject(raw)
    good = rows.where(F.col("reason").isNull()).drop("reason", "value")
    return good, rows.where(F.col("reason").isNotNull()).select(*TOPIC_COLUMNS, "pos", "arrival_ts", "value", "reason")


def envelope_sizes(raw: DataFrame) -> DataFrame:
    """D-04: number of reports per value (NULL for undecodable values)."""
    return raw.select(*TOPIC_COLUMNS, F.col("timestamp").alias("arrival_ts"),
                      F.size(parsed("value"), ).alias("n_reports")) \
        .withColumn("n_reports", F.when(F.col("n_reports") >= 0, F.col("n_reports")))


def known_types(reports: DataFrame, message_types: list[str] | None = None) -> DataFrame:
    """D-05: keep reports whose type is one of the known names (exact case).

    The allowlist is a fixed, small set (21 names): an ``isin`` predicate is
    evaluated in the scan stage, no join or shuffle.
    """
    names = message_types if message_types is not None else MESSAGE_TYPES
    return reports.where(F.col("MessageType").isin(names))
