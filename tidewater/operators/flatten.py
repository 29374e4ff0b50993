"""P-18: flatten nested JSON of any depth into ``_``-joined key paths.

Objects contribute their keys, arrays their positions (``a_0``, ``a_1``);
empty objects/arrays and nulls are leaves. The value is parsed once to
VARIANT. One level is a higher-order ``transform`` over the current entries
(cast to ``MAP<STRING,VARIANT>`` / ``ARRAY<VARIANT>``); the levels are a fold
(``aggregate``) inside the row, over as many steps as the text has opening
brackets below the entries, so each row is taken down to its own depth and the
plan holds one level, not one for each; what is left after them cannot be a
container and is not cast to find that out. A leaf found before is flagged and
never cast again, and a row without open entries passes its remaining steps
untouched.
The whole flatten is row-wise: no explode-and-regroup, no shuffle, same code
for streams. A value that cannot be flattened whole (no JSON object or array,
or key paths that collide) costs its own row only: ``split_flattenable`` puts
it in quarantine with the reason. (Spark's own JSON parser takes 1,000 levels.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "_"


def _kind(v: Column) -> Column:
    s = F.schema_of_variant(v)
    return (F.when(F.is_variant_null(v), F.lit("null"))
            .when(s.startswith("OBJECT"), F.lit("object"))
            .when(s.startswith("ARRAY"), F.lit("array"))
            .when(s == "STRING", F.lit("string"))
            .when(s == "BOOLEAN", F.lit("boolean"))
            .otherwise(F.lit("number")))


def _entry(path: Column, v: Column, leaf: bool) -> Column:
    return F.struct(path.alias("path"), v.alias("v"), F.lit(leaf).alias("leaf"))


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _members(m: Column, prefix: Column | None = None) -> Column:
    return F.transform(F.map_entries(m), lambda e: _entry(
        e["key"] if prefix is None else F.concat(prefix, e["key"]), e["value"], False))


def _items(a: Column, prefix: Column | None = None) -> Column:
    def path(i: Column) -> Column:
        return i.cast("string") if prefix is None else F.concat(prefix, i.cast("string"))
    return F.transform(a, lambda e, i: _entry(path(i), e, False))


def _next_level(entries: Column, sep: str) -> Column:
    """One level down: non-empty containers give their children, everything
    else is a leaf from now on. Leaves are not cast again."""
    cast = F.transform(entries, lambda x: F.struct(
        x["path"].alias("path"), x["v"].alias("v"),
        F.when(~x["leaf"], _as(x["v"], "map<string,variant>")).alias("m"),
        F.when(~x["leaf"], _as(x["v"], "array<variant>")).alias("a")))

    def children(y: Column) -> Column:
        prefix = F.concat(y["path"], F.lit(sep))
        return (F.when(F.size(y["m"]) > 0, _members(y["m"], prefix))
                .when(F.size(y["a"]) > 0, _items(y["a"], prefix))
                .otherwise(F.array(_entry(y["path"], y["v"], True))))
    return F.flatten(F.transform(cast, children))


def descend(entries: Column, most: Column, sep: str = SEPARATOR) -> Column:
    """The leaves below entries, which hold containers at most ``most`` deep."""
    def state(e: Column, open_: bool) -> Column:
        return F.struct(e.alias("e"), F.lit(open_).alias("open"))

    return F.aggregate(
        F.array_repeat(F.lit(0), most), state(entries, True),
        lambda acc, _: F.when(acc["open"] & F.exists(acc["e"], lambda x: ~x["leaf"]),
                              state(_next_level(acc["e"], sep), True)).otherwise(state(acc["e"], False)),
        lambda acc: acc["e"])


def brackets(text: Column) -> Column:
    """The opening brackets of a JSON text: it nests no deeper than that."""
    return F.regexp_count(text, F.lit(r"[\[{]"))


def with_flat_entries(df: DataFrame, value: str, out: str, sep: str = SEPARATOR) -> DataFrame:
    """``out``: ``ARRAY<STRUCT<path, v VARIANT, leaf>>``, the leaves of a JSON
    object or array (``leaf``: found before the last step); NULL for any other
    value. ``_flat_v`` stays: the value."""
    root = F.col("_flat_v")
    top = F.coalesce(_members(_as(root, "map<string,variant>")), _items(_as(root, "array<variant>")))
    return df.withColumn("_flat_v", F.try_parse_json(F.col(value))) \
        .withColumn(out, descend(top, F.greatest(brackets(F.col(value)) - 1, F.lit(0)), sep))   # the first opens the value


def colliding(entries: Column) -> Column:
    paths = F.transform(entries, lambda x: x["path"])
    return F.size(F.array_distinct(paths)) < F.size(paths)


def split_flattenable(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``: rows with ``_flat_e`` (their leaf entries),
    and the rows that cannot be flattened, with a ``reason``."""
    staged = tagged(with_flat_entries(df, value, "_flat_e"), df.columns, F.col("_flat_e"), F.when(
        F.col("_flat_e").isNull(), F.when(F.col("_flat_v").isNull(), F.lit("undecodable JSON"))
        .otherwise(F.lit("no JSON object or array")))
        .when(colliding(F.col("_flat_e")), F.lit("colliding key paths")))
    good = staged.where(F.col("reason").isNull()).select(*df.columns, F.col("e").alias("_flat_e"))
    return good, staged.where(F.col("reason").isNotNull()).select(*df.columns, "reason")


def tagged(df: DataFrame, columns: list[str], entries: Column, reason: Column) -> DataFrame:
    """``columns``, entries as ``e`` and ``reason``, behind a generator of one
    row: else the optimizer would move a filter on the reason below the
    flatten, which it would then repeat."""
    one = F.array(F.struct(entries.alias("e"), reason.alias("reason")))
    return df.select(*columns, F.explode(one).alias("_s")).select(*columns, "_s.e", "_s.reason")


def leaf_columns(v: Column) -> dict[str, Column]:
    """Typed view of a leaf: ``kind``, ``text`` (strings, booleans, empty
    containers), ``num`` (numbers as DOUBLE)."""
    kind = _kind(v)
    return {
        "kind": kind,
        "text": F.when(kind == "string", F.try_variant_get(v, "$", "string"))
                 .when(kind.isin("boolean", "object", "array"), F.to_json(v)),
        "num": F.when(kind == "number", F.try_variant_get(v, "$", "double")),
    }


def flatten_map(df: DataFrame, value: str = "value", out: str = "flat") -> DataFrame:
    """One map per flattenable row: ``path -> leaf JSON text`` (strings
    unquoted). The others are in ``split_flattenable``'s quarantine."""
    good, _ = split_flattenable(df, value)
    return good.withColumn(out, F.map_from_entries(F.transform("_flat_e", lambda x: F.struct(
        x["path"], F.coalesce(F.try_variant_get(x["v"], "$", "string"), F.to_json(x["v"])))))).drop("_flat_e")


def flat_members(entries: Column) -> Column:
    """Leaf entries as the members of a JSON object, each leaf of its own type."""
    return F.array_join(F.transform(entries, lambda x: F.concat(
        F.to_json(x["path"].cast("variant")), F.lit(":"), F.coalesce(F.to_json(x["v"]), F.lit("null")))), ",")


def flat_json(entries: Column) -> Column:
    """Leaf entries as one flat JSON object."""
    return F.concat(F.lit("{"), flat_members(entries), F.lit("}"))


def flatten_rows(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """One row per leaf of a flattenable row: ``keys, path, kind, text, num``.
    The others are in ``split_flattenable``'s quarantine."""
    good, _ = split_flattenable(df.select(*keys, value), value)
    rows = good.select(*keys, F.explode("_flat_e").alias("e"))
    leaf = leaf_columns(F.col("e.v"))
    return rows.select(*keys, F.col("e.path").alias("path"),
                       *[c.alias(n) for n, c in leaf.items()])


def message_entries(message: Column, sep: str = SEPARATOR) -> Column:
    """The leaves of a report's ``Message`` (a map of JSON texts), their paths
    under ``Message``; a body that is no JSON has a NULL value."""
    bodies = F.transform(F.map_entries(message), lambda e: _entry(
        F.concat(F.lit("Message" + sep), e["key"]), F.try_parse_json(F.coalesce(e["value"], F.lit("null"))), False))
    most = F.aggregate(F.map_values(message), F.lit(0), lambda n, text: n + F.coalesce(brackets(text), F.lit(0)))
    empty = F.array(_entry(F.lit("Message"), F.try_parse_json(F.lit("{}")), True))
    return F.when(F.size(message) == 0, empty).when(message.isNotNull(), descend(bodies, most, sep))
