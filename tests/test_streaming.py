"""Streaming forms equal the batch forms over the same topic rows
(file source of Kafka-shaped parquet, ``availableNow`` trigger)."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import decode, stateful, standardize
from tidewater.plans import pipelines as batch
from tidewater.schemas import TOPIC_ROW
from tidewater.sources import fixture
from tidewater.sources import topics as sources
from tidewater.streaming import pipelines as streams

from compare import norm
from conftest import SF_SMALL

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def topic_dir(spark):
    import tempfile
    import time
    d = tempfile.mkdtemp(prefix="tw-topic-")
    raw = fixture.raw_topic(spark, SF_SMALL)
    cuts = raw.approxQuantile("offset", [0.25, 0.5, 0.75], 0)  # offsets follow arrival time
    bounds = [-1] + [int(c) for c in cuts] + [1 << 62]
    # one file per slice, written in arrival order: a topic delivers in order
    for lo, hi in zip(bounds, bounds[1:]):
        (raw.where((F.col("offset") > lo) & (F.col("offset") <= hi)).coalesce(1)
         .write.mode("append").parquet(f"{d}/raw"))
        time.sleep(1.1)
    return f"{d}/raw"


def _stream(spark, topic_dir):
    return sources.read_reports(spark, "raw", path=topic_dir, max_per_trigger=1)


def _batch(spark, topic_dir):
    return spark.read.schema(TOPIC_ROW).parquet(topic_dir)


def _rows(df, cols):
    return sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())


def test_enrich_all_stream_equals_batch(spark, topic_dir, scratch):
    q = streams.enrich_all_stream(_stream(spark, topic_dir), sink="memory", trigger=NOW,
                                  checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    got = spark.table("q01_enrich_all")
    ref = batch.enrich_all(_batch(spark, topic_dir))
    assert _rows(got, ["key", "value", "topic"]) == _rows(ref, ["key", "value", "topic"])


def test_route_stream_to_files(spark, topic_dir, scratch):
    out = f"{scratch}/routed"
    q = streams.route_stream(_stream(spark, topic_dir), path=out, trigger=NOW,
                             checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    got = spark.read.parquet(out).groupBy("topic").count()
    ref = batch.route_by_type(_batch(spark, topic_dir)).groupBy("topic").count()
    assert _rows(got, ["topic", "count"]) == _rows(ref, ["topic", "count"])


def test_current_positions_stream(spark, topic_dir, scratch):
    q = streams.current_positions_stream(_stream(spark, topic_dir), sink="memory", trigger=NOW,
                                         checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    # update mode appends every changed row: keep the last per vessel
    got = spark.table("w01_current_position")
    got = stateful.current_positions(got.withColumn("offset", F.col("offset")), extra=["ShipName"])
    ref = stateful.current_positions(standardize.enrich_metadata(
        decode.decode_reports(_batch(spark, topic_dir))), extra=["ShipName"])
    cols = ["MMSI", "Lat", "Lng", "ShipName"]
    assert _rows(got, cols) == _rows(ref, cols)


def test_throughput_stream(spark, topic_dir, scratch):
    q = streams.throughput_stream(_stream(spark, topic_dir), sink="memory", trigger=NOW,
                                  checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    got = spark.table("q06_throughput")
    ref = batch.throughput_monitor(_batch(spark, topic_dir))
    # the last row of a window, the one of most messages, holds
    got_rows = {r["window_start"]: (r["messages"], r["kilobytes"])
                for r in sorted(got.collect(), key=lambda r: r["messages"])}
    ref_rows = {r["window_start"]: (r["messages"], r["kilobytes"]) for r in ref.collect()}
    assert got_rows == ref_rows


def test_change_status_stream(spark, topic_dir, scratch):
    """Micro-batches by queries that start again from their checkpoint."""
    for part in _parts(spark, topic_dir, scratch, 4):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        streams.change_status_stream(_stream(spark, f"{scratch}/raw"), sink="parquet", path=f"{scratch}/status", trigger=NOW,
                                     checkpoint=f"{scratch}/ck").awaitTermination()
    ref = stateful.change_status(standardize.enrich_metadata(decode.decode_reports(_batch(spark, topic_dir))))
    cols = ["partition", "offset", "MMSI", "Lat", "Lng", "status"]
    assert _rows(spark.read.parquet(f"{scratch}/status"), cols) == _rows(ref, cols)
    assert ref.select("status").distinct().count() == 3


def test_upsert_stream(spark, topic_dir, scratch):
    from tidewater.sinks import state as state_sink
    streams.upsert_stream(_stream(spark, topic_dir), "w07_of_stream", trigger=NOW, checkpoint=f"{scratch}/ck").awaitTermination()
    ref = state_sink.batch_positions(standardize.enrich_metadata(decode.decode_reports(_batch(spark, topic_dir))))
    cols = ["key", "latitude", "longitude"]
    assert _rows(state_sink.read_state(spark, "w07_of_stream"), cols) == _rows(ref, cols)
    spark.sql("DROP TABLE w07_of_stream")


def test_full_enrich_stream(spark, topic_dir, scratch):
    body = '"MessageType": "PositionReport", "MetaData": {"MMSI": 1}}'
    odd = [(-5, '{"MessageType": "PositionReport", "MetaData": {"MMSI": [1]}}'), (-6, '{"Message": {"PositionReport": {"Cog": "abc"}}, ' + body),
           (-7, '{"Message": {"PositionReport": {"a_b": 1, "a": {"b": 2}}}, ' + body), (-8, None), (-9, "3"), (-10, "[]")]
    shape = _batch(spark, topic_dir)
    first = shape.limit(1).drop("value", "offset")
    odd = first.crossJoin(spark.createDataFrame(odd, "offset long, value string")).select(*shape.columns)
    whole = shape.unionByName(odd)
    whole.selectExpr([f"cast({f.name} as {f.dataType.simpleString()}) {f.name}" for f in shape.schema]).write.parquet(f"{scratch}/raw")
    streams.full_enrich_stream(_stream(spark, f"{scratch}/raw"), sink="memory", trigger=NOW, checkpoint=f"{scratch}/ck").awaitTermination()
    got = spark.table("q02_full_enrich")
    ref, _ = batch.flat_topic(decode.decode_reports(shape))
    sent = got.where(F.col("topic") == batch.ALL_TOPIC)
    assert _rows(sent, ["key", "value", "topic"]) == _rows(ref, ["key", "value", "topic"])
    assert sent.where(F.get_json_object("value", "$.MGRS").isNotNull()).count() > 0
    rejected = got.where(F.col("topic") == batch.REJECTED_TOPIC)
    good, bad = decode.split_quarantine(whole)
    unflat = batch.flat_topic(good)[1]
    assert _rows(rejected, ["value"]) == _rows(bad.select("value").unionByName(unflat.select("value")), ["value"])
    assert unflat.count() == 1 and unflat.first()["reason"] == "colliding key paths"
    reasons = {r["offset"]: r["reason"] for r in bad.where("offset < 0").collect()}
    assert reasons == {-5: "mistyped field: MetaData.MMSI", -6: "mistyped field: Message.PositionReport.Cog",
                       -8: "undecodable JSON", -9: "no report"}
    assert rejected.where("key LIKE '%|-5'").count() == 1


def test_a_sink_is_asked_for(spark, topic_dir, scratch):
    with pytest.raises(ValueError, match="sink"):
        streams.throughput_stream(_stream(spark, topic_dir), trigger=NOW, checkpoint=f"{scratch}/ck")


def test_latest_message_stream(spark, topic_dir, scratch):
    q = streams.latest_message_stream(_stream(spark, topic_dir), sink="memory", trigger=NOW,
                                      checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    got = spark.table("w03_latest_message").collect()
    ref = stateful.latest_message(decode.decode_reports(_batch(spark, topic_dir)),
                                  ["MessageType", "partition", "offset"], stateful.REPORT_ORDER).collect()
    assert (got[-1]["partition"], got[-1]["offset"]) == (ref[0]["partition"], ref[0]["offset"])


def test_reenvelope_stream(spark, topic_dir, scratch):
    out = f"{scratch}/env"
    q = streams.reenvelope_stream(_stream(spark, topic_dir), out, trigger=NOW,
                                  checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    got = spark.read.parquet(out)
    rejected = spark.read.parquet(out + "-rejected")
    assert rejected.count() > 0 and {r["reason"] for r in rejected.collect()} == {"undecodable JSON"}
    assert got.agg(F.sum("n_items")).first()[0] + rejected.count() == _batch(spark, topic_dir).count()
    assert got.where(F.from_json("value", "array<string>").isNull()).count() == 0
    assert got.select("key").distinct().count() == got.count()
    assert got.where(F.col("bytes") > 1_000_000).count() == 0


def _parts(spark, topic_dir, scratch, n):
    """The topic's rows in n folders, in the order of arrival."""
    rows = _batch(spark, topic_dir)
    cuts = [-1, *map(int, rows.approxQuantile("offset", [i / n for i in range(1, n)], 0)), 1 << 62]
    return [rows.where((F.col("offset") > lo) & (F.col("offset") <= hi)) for lo, hi in zip(cuts, cuts[1:])]


@pytest.mark.parametrize("timeout", [10, 3600])
def test_keyed_collect_stream_equals_batch(spark, topic_dir, scratch, timeout):
    """Five micro-batches, each by a query that starts again from its checkpoint."""
    item = F.coalesce(F.size(decode.parsed("value")), F.lit(0))
    for part in _parts(spark, topic_dir, scratch, 5):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        streams.keyed_collect_stream(_stream(spark, f"{scratch}/raw"), item, max_items=7, timeout_seconds=timeout, sink="parquet",
                                     path=f"{scratch}/lists", trigger=NOW, checkpoint=f"{scratch}/ck").awaitTermination()
    cols = ["session", "chunk", "n_items", "first_arrival", "last_arrival", "items"]
    got = _rows(spark.read.parquet(f"{scratch}/lists"), cols)
    ref = _rows(stateful.keyed_collect(_batch(spark, topic_dir), item, max_items=7, timeout_seconds=timeout), cols)
    missing = [r for r in ref if r not in got]       # the last list is open until it is full
    assert sorted(got + missing) == ref and len(missing) <= 1 and len(got) > 50
    assert all(float(r[2][1]) < 7 for r in missing)


def test_keyed_collect_by_vessel_and_out_of_order(spark, scratch):
    """Keys apart from one another; a message of a later micro-batch joins what is open."""
    def put(rows):
        spark.createDataFrame([(k, v, "raw", 0, i, t) for i, (k, v, t) in enumerate(rows)],
                              "key string, value string, topic string, partition int, offset long, s long") \
            .selectExpr("key", "value", "topic", "partition", "offset", "timestamp_seconds(s) AS timestamp") \
            .coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        streams.keyed_collect_stream(_stream(spark, f"{scratch}/raw"), F.col("value"), key=F.col("key"), max_items=2, sink="parquet",
                                     path=f"{scratch}/lists", trigger=NOW, checkpoint=f"{scratch}/ck").awaitTermination()
    put([("a", "1", 100), ("b", "2", 101), ("a", "3", 90)])
    put([("b", "4", 95), ("a", "5", 111)])
    put([("a", "6", 130), ("b", "7", 300), ("b", "8", 300), ("a", "9", 131)])
    got = sorted((r["key"], r["session"], r["chunk"], r["items"]) for r in spark.read.parquet(f"{scratch}/lists").collect())
    assert got == [("a", 1, 0, ["3", "1"]), ("a", 2, 0, ["5"]), ("a", 3, 0, ["6", "9"]), ("b", 1, 0, ["2", "4"]), ("b", 2, 0, ["7", "8"])]


def test_cumulative_rate_stream_equals_batch(spark, topic_dir, scratch):
    from tidewater.operators import aggregates
    for part in _parts(spark, topic_dir, scratch, 4):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        streams.cumulative_rate_stream(_stream(spark, f"{scratch}/raw"), every=37, sink="parquet", path=f"{scratch}/marks",
                                       trigger=NOW, checkpoint=f"{scratch}/ck").awaitTermination()
    cols = ["n", "arrival_ts", "elapsed_s", "rate"]
    got = _rows(spark.read.parquet(f"{scratch}/marks"), cols)
    ref = _rows(aggregates.cumulative_rate(_batch(spark, topic_dir), every=37), cols)
    assert got == ref and len(ref) > 20


def test_interval_stats_stream_with_late_messages(spark, topic_dir, scratch):
    """Micro-batches in any order give the batch's totals, the last window too."""
    from tidewater.operators import aggregates
    parts = _parts(spark, topic_dir, scratch, 4)
    for k in (2, 0, 3, 1):
        parts[k].coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        streams.interval_stats_stream(_stream(spark, f"{scratch}/raw"), f"{scratch}/flushes", trigger=NOW,
                                      checkpoint=f"{scratch}/ck").awaitTermination()
    got = streams.interval_stats_of(spark, f"{scratch}/flushes")
    ref = aggregates.interval_stats(_batch(spark, topic_dir))
    assert _rows(got, ref.columns) == _rows(ref, ref.columns) and got.count() > 10
