"""Structured Streaming forms of the pipelines.

Row-wise chains (decode, standardise, bin, features, route, keys) run as
append-mode queries unchanged. Keyed state uses built-in aggregates in update
mode (current position per vessel, latest message) or ``foreachBatch`` where
an order inside the micro-batch matters (change classification, state
upsert). Throughput windows use a watermark on arrival time.

Checkpoints always live under the session's ``spark.checkpoint.dir`` (a
shared folder on a cluster), one sub-folder per query name, so a restarted
query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import aggregates, decode, route, standardize, stateful
from ..plans import pipelines as batch
from ..session import checkpoint_root
from ..sinks import state as state_sink
from ..sinks import topics as sinks

WATERMARK = "1 minute"


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/streams/{name}"


def _start(df: DataFrame, name: str, *, sink: str | None = None, mode: str = "append",
           path: str | None = None, trigger: dict | None = None,
           checkpoint: str | None = None) -> StreamingQuery:
    """``sink`` is asked for: ``memory`` holds all output in the driver and
    is for tests, as is ``console``; any other is a format written to ``path``."""
    if sink is None:
        raise ValueError(f"name the sink of {name}")
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, name)))
    if trigger:
        w = w.trigger(**trigger)
    if sink == "memory":
        return w.format("memory").start()
    if sink == "console":
        return w.format("console").option("truncate", False).start()
    return w.format(sink).option("path", path).start()


def enrich_all_stream(raw: DataFrame, **kw) -> StreamingQuery:
    """Q-01 as a stream: decode -> UUID -> Kafka-shaped rows."""
    out = batch.enrich_all(raw).select("key", "value", "topic")
    return _stream_rows(out, "q01_enrich_all", **kw)


def full_enrich_stream(raw: DataFrame, **kw) -> StreamingQuery:
    """Q-02 as a stream: standardise, bin, features, flatten; rows keyed by
    UUID. One query with its rejects: each value is parsed once, and what does
    not decode whole or cannot be flattened goes to the topic of the same name
    ending in ``_rejected``."""
    return _stream_rows(batch.flat_or_rejected(raw).select("key", "value", "topic"), "q02_full_enrich", **kw)


def route_stream(raw: DataFrame, **kw) -> StreamingQuery:
    """Q-03 as a stream: one write fans out to ``ais_<type>`` topics."""
    return _stream_rows(batch.route_by_type(raw), "q03_route_by_type", **kw)


def _stream_rows(rows: DataFrame, name: str, *, bootstrap: str | None = None,
                 path: str | None = None, sink: str | None = None, trigger: dict | None = None,
                 checkpoint: str | None = None, profile: dict | None = None) -> StreamingQuery:
    spark = rows.sparkSession
    ckpt = checkpoint or checkpoint_for(spark, name)
    if bootstrap or path:
        return sinks.write_topic_stream(rows, checkpoint=ckpt, bootstrap=bootstrap, path=path,
                                        profile=profile, trigger=trigger, query_name=name)
    return _start(rows, name, sink=sink, trigger=trigger, checkpoint=ckpt)


def current_positions_stream(raw: DataFrame, name: str = "w01_current_position",
                             **kw) -> StreamingQuery:
    """W-01 / Q-04 as a stream: ``max_by`` per vessel in update mode; the
    state store keeps one row per vessel."""
    std = standardize.enrich_metadata(decode.decode_reports(raw))
    cur = stateful.current_positions(std, extra=["ShipName"])
    return _start(cur, name, mode="update", **kw)


def latest_message_stream(raw: DataFrame, name: str = "w03_latest_message",
                          **kw) -> StreamingQuery:
    """W-03 as a stream: the newest report overall, updated per trigger."""
    rep = decode.decode_reports(raw)
    latest = stateful.latest_message(rep, ["MessageType", "partition", "offset"], stateful.REPORT_ORDER)
    return _start(latest, name, mode="complete", **kw)


def throughput_stream(raw: DataFrame, seconds: int = 60, name: str = "q06_throughput",
                      watermark: str | None = None, **kw) -> StreamingQuery:
    """Q-06 / A-04 as a stream: tumbling windows on arrival time. No message
    is ever late: each trigger emits the windows it changed (update mode; the
    last row of a window holds), and the state keeps one row per window.
    With a ``watermark`` a window is emitted once, after it, and what
    arrives later than that is dropped."""
    rows = raw.withWatermark("timestamp", watermark) if watermark else raw
    w = (rows.groupBy(F.window("timestamp", f"{seconds} seconds").alias("w"))
         .agg(F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("value")).alias("bytes"))
         .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "messages", F.bround(F.col("bytes") / F.lit(1024.0), 2).alias("kilobytes")))
    return _start(w, name, mode="append" if watermark else "update", **kw)


def _classify(order: list[str]):
    """The status of each report of one vessel, after its state: the last
    valid position."""
    def classify(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        lat, lng = rows["Lat"].to_numpy(), rows["Lng"].to_numpy()
        known = state.exists
        first = state.get if known else (lat[0], lng[0])
        moved = (lat != np.concatenate(([first[0]], lat[:-1]))) | (lng != np.concatenate(([first[1]], lng[:-1])))
        status = np.where(moved, "moved", "unchanged").astype(object)
        if not known:
            status[0] = "new"
        state.update((float(lat[-1]), float(lng[-1])))
        yield rows[["partition", "offset", "pos"]].assign(MMSI=key[0], Lat=lat, Lng=lng, status=status)
    return classify


def change_status_stream(raw: DataFrame, name: str = "w02_change_status", **kw) -> StreamingQuery:
    """W-02 as a stream: a report is compared with the vessel's previous valid
    position, which Spark's state store keeps: one position a vessel. Vessels
    are dealt over the tasks; a vessel's reports of a micro-batch meet in one."""
    std = route.valid_positions(standardize.enrich_metadata(decode.decode_reports(raw))).where(F.col("MMSI").isNotNull())
    order = stateful.REPORT_ORDER
    out = std.select("MMSI", *order, "Lat", "Lng").groupBy("MMSI").applyInPandasWithState(
        _classify(order), "partition int, offset bigint, pos int, MMSI string, Lat double, Lng double, status string",
        "lat double, lng double", "append", GroupStateTimeout.NoTimeout)
    return _start(out, name, **kw)


def upsert_stream(raw: DataFrame, table: str, name: str = "w07_upsert", trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """W-07 as a stream: each micro-batch's last positions are merged into the
    state table of that name; merging a micro-batch again changes nothing."""
    std = standardize.enrich_metadata(decode.decode_reports(raw))

    def process(rows: DataFrame, batch_id: int) -> None:
        state_sink.write_upsert(rows.sparkSession, table, rows)

    w = (std.writeStream.queryName(name).foreachBatch(process)
         .option("checkpointLocation", checkpoint or checkpoint_for(raw.sparkSession, name)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def reenvelope_stream(raw: DataFrame, out_path: str, name: str = "q07_reenvelope",
                      max_bytes: int = stateful.MAX_ENVELOPE_BYTES, trigger: dict | None = None,
                      checkpoint: str | None = None, rejects_path: str | None = None) -> StreamingQuery:
    """Q-07 as a stream (``foreachBatch``): each micro-batch is flushed in
    250 ms windows of at most 1000 messages (W-05), every envelope is kept
    within ``max_bytes`` (W-06) and keyed by a deterministic UUID; a
    micro-batch boundary is also a flush point. Output per batch id is
    overwritten, so a retried batch writes the same envelopes. Messages that
    are in no envelope go to ``rejects_path`` (default: beside ``out_path``,
    ending in ``-rejected``) with the reason."""
    spark = raw.sparkSession
    aside = rejects_path or out_path.rstrip("/") + "-rejected"

    def put(df: DataFrame, batch_id: int, path: str) -> None:
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    def process(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()   # read several times below
        try:
            pieces, rejected = batch.reenvelope(batch_df, max_bytes=max_bytes)
            put(pieces.select("key", "value", F.lit(batch.ALL_TOPIC).alias("topic"), "n_items", "bytes"),
                batch_id, out_path)
            put(rejected, batch_id, aside)
        finally:
            batch_df.unpersist()

    w = (raw.writeStream.queryName(name).foreachBatch(process)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, name)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _collector(max_items: int, timeout_us: int, order: list[str], wall_clock: bool):
    """The keyed collect of one key's rows of a micro-batch, after its state:
    (session, items of it in closed lists, last arrival, the open list)."""
    columns = ["key", "session", "chunk", "n_items", "first_arrival", "last_arrival", "items"]

    def lists(key: str, found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key, session, chunk, len(items), *(pd.Timestamp(t, unit="us") for t in (at[0], at[-1])), items)
                             for session, chunk, at, items in found], columns=columns)

    def collect(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session, closed, last, open_at, open_items = state.get if state.exists else (0, 0, None, [], [])
        open_at, open_items = list(open_at), list(open_items)
        if state.hasTimedOut:   # idle by the clock: the list closes, and with it the session
            state.update((session, closed + len(open_items), -1, [], []))
            if open_items:
                yield lists(key[0], [(session, closed // max_items, open_at, open_items)])
            return
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        at = rows["_us"].to_numpy()
        before = np.concatenate(([last if last is not None else 0], at[:-1]))
        starts = at - before > timeout_us
        starts[0] |= last is None or last < 0
        sessions = session + np.cumsum(starts)
        head = closed + len(open_items)                 # place of the first row, were it in the open session
        here = np.arange(len(at))
        begun = np.maximum.accumulate(np.where(starts, here, -1))
        place = np.where(begun < 0, head + here, here - begun)
        at = np.concatenate((np.array(open_at, np.int64), at))
        items = open_items + rows["_item"].tolist()
        sessions = np.concatenate((np.full(len(open_at), session), sessions))
        chunks = np.concatenate((np.full(len(open_at), closed // max_items), place // max_items))
        cuts = [0, *(np.flatnonzero((np.diff(sessions) != 0) | (np.diff(chunks) != 0)) + 1).tolist(), len(at)]
        found = [(int(sessions[i]), int(chunks[i]), at[i:j].tolist(), items[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
        session, chunk, open_at, open_items = found[-1]
        full = len(open_items) >= max_items
        state.update((session, (chunk + full) * max_items, int(at[-1]), [] if full else open_at, [] if full else open_items))
        if wall_clock and not full:
            state.setTimeoutDuration(timeout_us // 1000)
        sent = found if full else found[:-1]
        if sent:
            yield lists(key[0], sent)
    return collect


def keyed_collect_stream(raw: DataFrame, item: Column, name: str = "w04_keyed_collect",
                         max_items: int = stateful.COLLECT_MAX_ITEMS,
                         timeout_seconds: int = stateful.COLLECT_TIMEOUT_SECONDS, key: Column | None = None,
                         wall_clock: bool = False, **kw) -> StreamingQuery:
    """W-04 as a stream: lists of at most ``max_items`` items of a key (all
    under ``ALL`` unless ``key`` says otherwise) in arrival order, cut by gaps
    longer than ``timeout_seconds``. Spark's state store holds for each key
    its session, the items of it already sent, the last arrival and the open
    list of fewer than ``max_items`` items.

    A list is sent when it is full or when a later message opens a session;
    with ``wall_clock`` also when no message came for ``timeout_seconds`` of
    processing time. A message that comes in a later micro-batch than a newer
    one joins what is open then; none is dropped. One key's messages of a
    micro-batch meet in one task, as the order under one key asks: bound the
    micro-batch (``max_per_trigger``).
    """
    order = stateful.MESSAGE_ORDER
    rows = raw.select((F.lit("ALL") if key is None else key.cast("string")).alias("key"), *order,
                      F.unix_micros(order[0]).alias("_us"), item.alias("_item"))
    kind = rows.schema["_item"].dataType.simpleString()
    out = rows.groupBy("key").applyInPandasWithState(
        _collector(max_items, timeout_seconds * 1_000_000, order, wall_clock),
        f"key string, session bigint, chunk bigint, n_items bigint, first_arrival timestamp, last_arrival timestamp, items array<{kind}>",
        f"session bigint, closed bigint, last bigint, open_at array<bigint>, open_items array<{kind}>", "append",
        GroupStateTimeout.ProcessingTimeTimeout if wall_clock else GroupStateTimeout.NoTimeout)
    return _start(out, name, **kw)


def _marker(every: int, order: list[str]):
    def mark(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        count, first = state.get if state.exists else (0, int(rows["_us"].iloc[0]))
        n = count + 1 + np.arange(len(rows))
        at = np.flatnonzero(n % every == 0)
        state.update((int(n[-1]), first))
        if len(at):
            elapsed = (rows["_us"].to_numpy()[at] - first) / 1e6
            yield pd.DataFrame({"n": n[at], "arrival_ts": rows[order[0]].to_numpy()[at], "elapsed_s": elapsed,
                                "rate": np.where(elapsed > 0, n[at] / np.where(elapsed > 0, elapsed, 1), np.nan)})
    return mark


def cumulative_rate_stream(raw: DataFrame, every: int = aggregates.RATE_EVERY, name: str = "a06_cumulative_rate",
                           **kw) -> StreamingQuery:
    """A-06 as a stream: Spark's state store holds the message count and the
    first arrival; each micro-batch continues the count and reports every
    ``every``-th message with its rate since the first arrival. The places of
    a micro-batch's messages (three columns) meet in one task, as one count
    over all asks for."""
    order = stateful.MESSAGE_ORDER
    rows = raw.select(F.lit("ALL").alias("key"), *order, F.unix_micros(order[0]).alias("_us"))
    out = rows.groupBy("key").applyInPandasWithState(
        _marker(every, order), "n bigint, arrival_ts timestamp, elapsed_s double, rate double", "n bigint, first bigint",
        "append", GroupStateTimeout.NoTimeout).withColumn("rate", F.nanvl("rate", F.lit(None).cast("double")))
    return _start(out, name, **kw)


def interval_stats_stream(raw: DataFrame, path: str, flush: str = stateful.FLUSH_INTERVAL,
                          name: str = "a07_interval_stats", trigger: dict | None = None,
                          checkpoint: str | None = None) -> StreamingQuery:
    """A-07 as a stream: each micro-batch adds its messages per flush window
    to the table at ``path`` (counts, first arrivals and bytes add up); a
    micro-batch run again writes its part again. There is no watermark: a late
    message counts in its own window, and ``interval_stats_of`` restates the
    totals from there on. Nothing waits for a window to end."""
    def process(batch_df: DataFrame, batch_id: int) -> None:
        (aggregates.flush_counts(batch_df, flush).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    w = (raw.writeStream.queryName(name).foreachBatch(process)
         .option("checkpointLocation", checkpoint or checkpoint_for(raw.sparkSession, name)))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def interval_stats_of(spark: SparkSession, path: str, seconds: int = 60) -> DataFrame:
    """The interval statistics of all messages that ``interval_stats_stream``
    has seen, the last interval too."""
    parts = spark.read.parquet(path).groupBy("flush_start", "flush_end").agg(
        F.sum("flush_count").alias("flush_count"), F.min("first_ts").alias("first_ts"), F.sum("bytes").alias("bytes"))
    return aggregates.stats_of_flushes(parts, seconds)
