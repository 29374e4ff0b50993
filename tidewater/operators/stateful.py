"""Per-vessel state, change classification, collects and re-enveloping.

Batch forms here; the streaming forms (update-mode aggregates and
``foreachBatch``) live in ``tidewater.streaming``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordering
from .route import valid_positions

# Arrival order of reports: ties in arrival time break by log position.
REPORT_ORDER = ["arrival_ts", "offset", "partition", "pos"]
MESSAGE_ORDER = ["timestamp", "offset", "partition"]

COLLECT_MAX_ITEMS = 120
COLLECT_TIMEOUT_SECONDS = 10
FLUSH_MAX_ITEMS = 1000
FLUSH_INTERVAL = "250 milliseconds"
MAX_ENVELOPE_BYTES = 1_000_000


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def current_positions(df: DataFrame, key: str = "MMSI", lat: str = "Lat", lng: str = "Lng",
                      extra: list[str] | None = None,
                      order: list[str] | None = None) -> DataFrame:
    """W-01: the current position per vessel, last arrival wins. Invalid
    positions and reports without a vessel id are ignored. ``max_by`` is a
    partial aggregate: each task keeps one row per vessel before the
    shuffle."""
    order = order or REPORT_ORDER
    cols = [lat, lng] + (extra or []) + order
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), _order_struct(order)).alias("s")
    return (valid_positions(df, lat, lng).where(F.col(key).isNotNull()).groupBy(key).agg(last)
            .select(key, *[F.col(f"s.{c}").alias(c) for c in cols]))


def change_status(df: DataFrame, key: str = "MMSI", lat: str = "Lat", lng: str = "Lng",
                  order: list[str] | None = None) -> DataFrame:
    """W-02: ``new`` for a vessel's first valid position, ``moved`` when
    latitude or longitude differs from the previous one, else ``unchanged``.
    Invalid positions and reports without a vessel id are dropped and make
    no state. The lag runs on the skew-safe ordered helper, so one busy
    vessel is split across tasks."""
    order = order or REPORT_ORDER
    tracked = valid_positions(df, lat, lng).where(F.col(key).isNotNull())
    lagged = ordering.lag(tracked, [key], order, [lat, lng])
    plat, plng = F.col(f"prev_{lat}"), F.col(f"prev_{lng}")
    status = (F.when(plat.isNull() & plng.isNull(), F.lit("new"))
              .when((F.col(lat) != plat) | (F.col(lng) != plng), F.lit("moved"))
              .otherwise(F.lit("unchanged")))
    return lagged.withColumn("status", status)


def latest_message(df: DataFrame, cols: list[str], order: list[str] | None = None) -> DataFrame:
    """W-03: the newest message overall (one row; partial max per task)."""
    order = order or MESSAGE_ORDER
    s = F.max_by(F.struct(*[F.col(c) for c in cols + order]), _order_struct(order)).alias("s")
    return df.agg(s).select("s.*")


def keyed_collect(messages: DataFrame, item: Column, max_items: int = COLLECT_MAX_ITEMS,
                  timeout_seconds: int = COLLECT_TIMEOUT_SECONDS,
                  order: list[str] | None = None, ts: str = "timestamp") -> DataFrame:
    """W-04: everything under the constant key ``ALL``, collected in arrival
    order into lists that close after ``max_items`` items or when no item
    arrives for ``timeout_seconds`` (gap sessions, each cut in chunks).

    All messages of a segment (see ``ordering``) share their arrival time, so
    sessions come from the segment table alone: the gap to the segment before,
    the number of starts so far and the count at the last start, within each
    minute and then over the minutes. Messages meet only within their segment.
    """
    order = order or MESSAGE_ORDER
    rows = ordering.segmented(messages.select(*order, item.alias("_item")), [], order)
    chunked = rows.drop(ordering.SPAN).join(_sessions(rows, timeout_seconds), ordering.SEG) \
        .withColumn("_rn", F.col("_skip") + F.row_number().over(Window.partitionBy(ordering.SEG).orderBy(*order))) \
        .withColumn("chunk", F.floor((F.col("_rn") - 1) / max_items).cast("long"))
    return (chunked.groupBy(F.lit("ALL").alias("key"), "session", "chunk")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.min(ts).alias("first_arrival"), F.max(ts).alias("last_arrival"),
                 F.sort_array(F.collect_list(F.struct("_rn", "_item"))).alias("_items"))
            .withColumn("items", F.transform("_items", lambda x: x["_item"]))
            .drop("_items"))


def _sessions(rows: DataFrame, timeout_seconds: int) -> DataFrame:
    """Per segment its ``session`` (from 1) and ``_skip``, the messages of
    that session before it."""
    seg, span = ordering.SEG, ordering.SPAN
    inside = Window.partitionBy(span).orderBy(seg)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    at = F.unix_micros(F.col(f"{seg}.a"))

    def starts(prev: Column, here: Column) -> Column:
        return F.when(prev.isNull() | (here - prev > timeout_seconds * 1_000_000), 1).otherwise(0)

    segs = rows.groupBy(span, seg).agg(F.count(F.lit(1)).alias("_n")).select(
        span, seg, at.alias("_at"), F.sum("_n").over(upto).alias("_upto"), "_n",
        F.lag(at).over(inside).alias("_prev"), F.first(at).over(upto).alias("_first"),
        F.lead(seg).over(inside).alias("_next"))
    inner = F.when(F.col("_prev").isNotNull(), starts(F.col("_prev"), F.col("_at"))).otherwise(0)
    segs = segs.withColumn("_inner", inner).withColumns({
        "_starts": F.sum("_inner").over(upto),
        "_mark": F.max(F.when(F.col("_inner") == 1, F.col("_upto") - F.col("_n"))).over(upto)})
    # over the minutes: each minute's last segment holds its totals
    minutes = Window.partitionBy().orderBy("_m")
    earlier = minutes.rowsBetween(Window.unboundedPreceding, -1)
    ends = segs.where(F.col("_next").isNull()).withColumnRenamed(span, "_m").select(
        "_m", "_upto", "_starts", "_mark",
        starts(F.lag("_at").over(minutes), F.col("_first")).alias("_opens"),
        F.coalesce(F.sum("_upto").over(earlier), F.lit(0)).alias("_base"))
    mark = F.coalesce(F.col("_mark") + F.col("_base"), F.when(F.col("_opens") == 1, F.col("_base")))
    ends = ends.select(
        "_m", "_base", "_opens", F.coalesce(F.sum(F.col("_opens") + F.col("_starts")).over(earlier), F.lit(0)).alias("_opened"),
        F.max(mark).over(earlier).alias("_since"))
    since = F.coalesce(F.col("_base") + F.col("_mark"), F.when(F.col("_opens") == 1, F.col("_base")), F.col("_since"))
    return segs.join(ends.withColumnRenamed("_m", span), span).select(
        seg, (F.col("_opened") + F.col("_opens") + F.col("_starts")).alias("session"),
        (F.col("_base") + F.col("_upto") - F.col("_n") - since).alias("_skip"))


def timed_collect(messages: DataFrame, item: Column, seconds: int = COLLECT_TIMEOUT_SECONDS,
                  ts: str = "timestamp", max_items: int = COLLECT_MAX_ITEMS,
                  order: list[str] | None = None) -> DataFrame:
    """W-04, time mode: the items of each clock-aligned ``seconds`` window in
    arrival order, in lists of at most ``max_items``."""
    order = order or MESSAGE_ORDER
    win = messages.select(*order, F.window(ts, f"{seconds} seconds").start.alias("window_start"), item.alias("_item"))
    ranked = ordering.row_number(win, ["window_start"], order, out="_rn")
    chunked = ranked.withColumn("chunk", F.floor((F.col("_rn") - 1) / max_items).cast("long"))
    return (chunked.groupBy(F.lit("ALL").alias("key"), "window_start", "chunk")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.sort_array(F.collect_list(F.struct("_rn", "_item"))).alias("_items"))
            .withColumn("items", F.transform("_items", lambda x: x["_item"]))
            .drop("_items"))


def flush_batches(messages: DataFrame, interval: str = FLUSH_INTERVAL,
                  max_items: int = FLUSH_MAX_ITEMS, order: list[str] | None = None,
                  ts: str = "timestamp") -> DataFrame:
    """W-05: the collector's flush: every ``interval`` all queued messages,
    at most ``max_items`` per envelope, in arrival order. Returns one row per
    envelope with its item values (JSON texts), the envelope text and the
    topic place of its first item. Only values that are JSON are queued, so
    every envelope decodes; the others are ``flush_rejects``."""
    order = order or MESSAGE_ORDER
    messages = messages.where(queueable(F.col("value")))
    win = messages.withColumn("flush_start", F.window(ts, interval).start)
    ranked = ordering.row_number(win, ["flush_start"], order, out="_rn")
    chunked = ranked.withColumn("chunk", F.floor((F.col("_rn") - 1) / max_items).cast("long"))
    return (chunked.groupBy("flush_start", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("_rn", "value"))).alias("_items"),
                 F.min(F.struct("_rn", "topic", "partition", "offset")).alias("_first"))
            .withColumn("items", F.transform("_items", lambda x: x["value"]))
            .select("flush_start", "chunk", F.size("items").alias("n_items"),
                    (F.aggregate("items", F.lit(0).cast("long"),
                                 lambda acc, x: acc + F.octet_length(x)) + F.size("items") + 1)
                    .alias("bytes"),
                    F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("value"),
                    "items", F.concat_ws("|", "_first.topic", "_first.partition", "_first.offset").alias("first_item")))


def queueable(value: Column) -> Column:
    return F.coalesce(F.try_parse_json(value).isNotNull(), F.lit(False))


def flush_rejects(messages: DataFrame) -> DataFrame:
    """W-05: the topic rows whose value is missing or no JSON, with a reason."""
    return messages.where(~queueable(F.col("value"))).withColumn(
        "reason", F.when(F.col("value").isNull(), "no value").otherwise("undecodable JSON"))


def _halving_tree(items: Column, max_bytes: int, depth: int) -> Column:
    """Final intervals ``struct(lo, hi, path)`` of the recursive halving of
    an item array: an interval is split at ``n // 2`` while its JSON array
    bytes (``sum(len) + n + 1``) exceed ``max_bytes`` and it holds more than
    one item. ``depth`` levels are planned (enough for ``2^depth`` items)."""
    sizes = F.transform(items, lambda x: F.octet_length(x).cast("long"))

    def size(iv: Column) -> Column:
        n = iv["hi"] - iv["lo"]
        return F.aggregate(F.slice(sizes, iv["lo"] + 1, n), F.lit(0).cast("long"),
                           lambda acc, b: acc + b) + n + 1

    def node(lo: Column, hi: Column, path: Column) -> Column:
        return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), path.alias("path"))

    ivs = F.array(node(F.lit(0), F.size(items), F.lit("")))
    for _ in range(depth):
        ivs = F.flatten(F.transform(ivs, lambda iv: F.when(
            (size(iv) > max_bytes) & (iv["hi"] - iv["lo"] > 1),
            F.array(node(iv["lo"], iv["lo"] + F.floor((iv["hi"] - iv["lo"]) / 2), F.concat(iv["path"], F.lit("0"))),
                    node(iv["lo"] + F.floor((iv["hi"] - iv["lo"]) / 2), iv["hi"], F.concat(iv["path"], F.lit("1")))))
            .otherwise(F.array(iv))))
    unfinished = F.exists(ivs, lambda iv: (size(iv) > max_bytes) & (iv["hi"] - iv["lo"] > 1))
    return F.when(unfinished, F.raise_error(F.lit("envelope needs more halving levels"))) \
        .otherwise(F.transform(ivs, lambda iv: F.struct(iv["lo"].alias("lo"), iv["hi"].alias("hi"),
                                                       iv["path"].alias("path"),
                                                       size(iv).alias("bytes"))))


def split_envelopes(envelopes: DataFrame, batch_cols: list[str], items: str = "items",
                    max_bytes: int = MAX_ENVELOPE_BYTES,
                    max_items: int | None = None) -> tuple[DataFrame, DataFrame]:
    """W-06: keep every envelope within ``max_bytes``: an oversize envelope
    is halved at ``n // 2`` and each half checked again; a single report
    that alone exceeds the bound is rejected.

    Each envelope row already holds its (bounded) item array, so the whole
    halving tree is computed inside the row with higher-order functions:
    interval sizes are sums over array slices, one planned level per
    halving. No shuffle, no iteration of jobs, no lineage to cut, and the
    same expression works on a stream. ``max_items`` bounds the envelope
    size (the flush cap, 1000); when not given it is read with one scalar
    aggregate. An envelope beyond the bound fails loudly.

    Returns ``(pieces, rejected)``; pieces are in send order by ``path``.
    """
    if max_items is None:
        max_items = envelopes.select(F.max(F.size(items))).first()[0] or 0
    depth = math.ceil(math.log2(max_items)) if max_items > 1 else 0
    tree = envelopes.select(*batch_cols, items,
                            F.explode(_halving_tree(F.col(items), max_bytes, depth)).alias("iv"))
    n = F.col("iv.hi") - F.col("iv.lo")
    part = F.slice(items, F.col("iv.lo") + 1, n)
    sized = tree.select(*batch_cols, F.col("iv.path").alias("path"), n.alias("n_items"),
                        F.col("iv.lo").alias("first_idx"), F.col("iv.bytes").alias("_size"), part.alias("_part"))
    pieces = (sized.where(F.col("_size") <= max_bytes)
              .select(*batch_cols, "path", "n_items", "first_idx",
                      F.concat(F.lit("["), F.array_join("_part", ","), F.lit("]")).alias("value"))
              .withColumn("bytes", F.octet_length("value")))
    rejected = (sized.where(F.col("_size") > max_bytes)
                .select(*batch_cols, F.col("first_idx").alias("idx"),
                        F.octet_length(F.col("_part")[0]).cast("long").alias("item_bytes"),
                        F.col("_part")[0].alias("item")))
    return pieces, rejected
