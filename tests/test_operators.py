"""Flatten, envelope split, sources and sinks."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import decode, flatten, stateful
from tidewater.sinks import state as state_sink
from tidewater.sinks import topics as sinks
from tidewater.sources import fixture
from tidewater.sources import topics as sources

from conftest import SF_SMALL


def test_flatten_paths(spark):
    doc = {"Message": {"DataLinkManagementMessage": {"PositionAccuracy": {"0": {"Valid": True},
                                                                          "1": {}}}},
           "a": [1, [2, {"b": None}], []], "s": "x ", "n": 0.0005}
    df = spark.createDataFrame([(1, json.dumps(doc))], "id int, value string")
    rows = {r["path"]: r for r in flatten.flatten_rows(df, ["id"]).collect()}
    assert rows["Message_DataLinkManagementMessage_PositionAccuracy_0_Valid"]["text"] == "true"
    assert rows["Message_DataLinkManagementMessage_PositionAccuracy_1"]["text"] == "{}"
    assert rows["a_0"]["num"] == 1.0 and rows["a_1_0"]["num"] == 2.0
    assert rows["a_1_1_b"]["kind"] == "null" and rows["a_2"]["text"] == "[]"
    assert rows["s"]["text"] == "x " and rows["n"]["num"] == 0.0005


def test_decode_forms_and_quarantine(spark):
    raw = fixture.raw_topic(spark, SF_SMALL)
    env = fixture.envelope_topic(spark, SF_SMALL)
    good, bad = decode.split_quarantine(raw)
    n_events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert good.count() + bad.count() == n_events
    assert decode.decode_reports(env).count() == n_events
    assert bad.where(F.col("value") != "{bad").count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=120), min_size=1, max_size=40),
       st.integers(min_value=40, max_value=400))
def test_split_pieces_concatenate_and_fit(spark, sizes, limit):
    items = [json.dumps("x" * s) for s in sizes]
    df = spark.createDataFrame([(0, items)], "b int, items array<string>")
    pieces, rejected = stateful.split_envelopes(df, ["b"], max_bytes=limit)
    got = pieces.orderBy("path").collect()
    kept = [json.loads(r["value"]) for r in got]
    rej = {r["idx"] for r in rejected.collect()}
    assert [x for p in kept for x in p] == [json.loads(x) for i, x in enumerate(items) if i not in rej]
    assert all(r["bytes"] <= limit for r in got)
    assert all(len(items[i]) + 2 > limit for i in rej)


def test_area_filter_paths_agree(spark):
    df = spark.createDataFrame([(i, (i * 7.3) % 170 - 85, (i * 13.1) % 360 - 180) for i in range(400)],
                               "id int, Lat double, Lng double")
    boxes = sources.boxes_frame(spark, [[[10, -30], [-20, 40]], [[50, 100], [60, 120]]])
    a = {r["id"] for r in sources.area_filter(df, boxes).collect()}
    b = {r["id"] for r in df.where("(Lat BETWEEN -20 AND 10 AND Lng BETWEEN -30 AND 40) OR "
                                   "(Lat BETWEEN 50 AND 60 AND Lng BETWEEN 100 AND 120)").collect()}
    assert a == b and len(a) > 0


def test_json_array_file(spark, scratch):
    env = fixture.envelope_topic(spark, SF_SMALL).orderBy("offset").limit(2).collect()
    for i, r in enumerate(env):
        with open(f"{scratch}/part{i}.json", "w") as fh:
            fh.write(r["value"])
    df = sources.read_json_array_file(spark, scratch)
    assert df.count() == sum(len(json.loads(r["value"])) for r in env)
    assert set(df.columns) == {"Message", "MessageType", "MetaData"}


def test_producer_options():
    opts = sinks.producer_options(sinks.PROCESSOR_PROFILE)
    assert opts["kafka.acks"] == "all" and opts["kafka.compression.type"] == "lz4"
    assert opts["kafka.buffer.memory"] == str(212144 * 1024)
    assert "kafka.batch.num.messages" not in opts


def test_state_upsert(spark, scratch):
    rows = [("a", 1.0, 2.0, "2024-01-01 00:00:00", 0, 0, 0),
            ("a", 3.0, 4.0, "2024-01-01 00:01:00", 1, 0, 0),
            ("b", 5.0, 6.0, "2024-01-01 00:00:30", 2, 0, 0)]
    df = spark.createDataFrame(rows, "MMSI string, Lat double, Lng double, t string, offset long, "
                                     "partition int, pos int").withColumn(
        "arrival_ts", F.to_timestamp("t"))
    table = "state_of_test"
    assert state_sink.read_state(spark, table) is None
    state_sink.write_upsert(spark, table, df.limit(0), buckets=3)
    state_sink.write_upsert(spark, table, df)
    later = spark.createDataFrame([("b", 7.0, 8.0, "2024-01-01 00:05:00", 3, 0, 0)], df.schema[:-1]) \
        .withColumn("arrival_ts", F.to_timestamp("t"))
    for batch in (later, later, df):      # a batch again, and an older one, change nothing
        before = state_sink.read_state(spark, table)
        state_sink.write_upsert(spark, table, batch)
        assert before.count() == 2        # a reader keeps what it opened
    state = state_sink.read_state(spark, table)
    assert {r["key"]: (r["latitude"], r["longitude"]) for r in state.collect()} == {"mmsi:a": (3.0, 4.0), "mmsi:b": (7.0, 8.0)}
    assert state_sink.lookup(state, "a").count() == 1
    merge = state_sink.upsert_positions(state.hint("merge"), df)._jdf.queryExecution().executedPlan().toString()
    side = merge[merge.index("SortMergeJoin"):]
    assert "FullOuter" in side and "Exchange" not in side[:side.index("FileScan")]
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__next")      # the writer was lost before the last step
    assert state_sink.read_state(spark, table).count() == 2
    many = df.limit(1).drop("MMSI").crossJoin(spark.range(60).selectExpr("CAST(id AS STRING) AS MMSI"))
    state_sink.write_upsert(spark, table, many)
    for name in ("maxPartitionBytes", "openCostInBytes"):           # each file a task of its own
        spark.conf.set(f"spark.sql.files.{name}", 1 << 20)
    state = state_sink.read_state(spark, table)
    assert state.rdd.getNumPartitions() == 3 and state_sink.lookup(state, "7").rdd.getNumPartitions() == 1
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")
    spark.sql(f"DROP TABLE {table}")


def test_topic_sink_round_trip(spark, scratch):
    from tidewater.plans import pipelines
    raw = fixture.raw_topic(spark, SF_SMALL)
    rows = pipelines.route_by_type(raw)
    path = f"{scratch}/topics"
    sinks.write_topic(rows, path=path)
    back = sources.read_topic_batch(spark, ["ais_positionreport", "ais_shipstaticdata"], path=path)
    want = rows.where(F.col("topic").isin("ais_positionreport", "ais_shipstaticdata")).count()
    assert back.count() == want
    # values written by the sink decode again as reports
    again = decode.decode_reports(back.withColumn("partition", F.lit(0))
                                  .withColumn("offset", F.lit(0).cast("long"))
                                  .withColumn("timestamp", F.current_timestamp()))
    assert again.count() == want


def test_bounded_and_offset_reads(spark):
    raw = fixture.raw_topic(spark, SF_SMALL)
    first = sources.bounded_read(raw, 10).collect()
    assert len(first) == 10 and all(r["value"] != "{bad" for r in first)
    rng = sources.offset_range(raw, "raw", 1, 10, 5000).orderBy("offset").collect()
    assert rng[0]["offset"] == 10 and rng[-1]["running_bytes"] <= 5000
    assert [r["offset"] for r in rng] == list(range(10, 10 + len(rng)))


def test_strict_decode_fails_on_bad_value(spark):
    import pytest
    raw = fixture.raw_topic(spark, SF_SMALL)
    bad_only = raw.where(F.col("value") == "{bad")
    assert bad_only.count() > 0
    with pytest.raises(Exception):
        decode.strict_decode(bad_only).collect()
    assert decode.strict_decode(raw.where(F.col("value") != "{bad")).count() == raw.count() - bad_only.count()


def test_envelope_sizes_and_known_types(spark):
    env = fixture.envelope_topic(spark, SF_SMALL)
    sizes = {r["n_reports"] for r in decode.envelope_sizes(env).collect()}
    assert sizes <= set(range(1, fixture.ENVELOPE_SIZE + 1)) and fixture.ENVELOPE_SIZE in sizes
    rep = decode.decode_reports(env)
    assert decode.known_types(rep, ["PositionReport"]).count() == \
        rep.where(F.col("MessageType") == "PositionReport").count()


def test_timed_collect_lists_items_in_arrival_order(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidewater.operators import stateful
    t0 = dt.datetime(2024, 1, 1)
    data = [(t0 + dt.timedelta(seconds=s), i, 0, f"m{i}") for i, s in enumerate([1] * 250 + [9, 10, 10, 35])]
    df = spark.createDataFrame(data, "timestamp timestamp, offset long, partition int, value string")
    got = {(r["window_start"].second, r["chunk"]): r["items"] for r in stateful.timed_collect(df, F.col("value")).collect()}
    names = [d[3] for d in data]
    assert got == {(0, 0): names[:120], (0, 1): names[120:240], (0, 2): names[240:251], (10, 0): names[251:253],
                   (30, 0): names[253:]}


def test_area_filter_of_any_size(spark):
    """Boxes of all sizes, few and many, across the antimeridian and beyond the globe's edge, against DuckDB."""
    import random

    import duckdb
    rng = random.Random(4)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1500)] + \
        [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (None, 1.0), (float("nan"), 1.0), (91.0, 10.0), (10.0, 181.0)] * 2
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)], "id int, Lat double, Lng double")
    con = duckdb.connect()
    con.execute("CREATE TABLE p (id INTEGER, Lat DOUBLE, Lng DOUBLE)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(points)])
    for n in (3, 50_000):
        boxes = []
        for i in range(n):
            h, w = (10 ** rng.uniform(-3, 1.2 if n < 10 else -0.5) for _ in range(2))
            lat, lng = rng.uniform(-90, 90), rng.uniform(-180, 180)
            boxes.append((i, lat, min(lat + h, 90.0), lng, lng + w if lng + w <= 180 else lng + w - 360))
        boxes += [(n, 0.0, 0.0, 0.0, 0.0), (n + 1, -95.0, -85.0, -180.0, 180.0), (n + 2, 40.0, 95.0, 170.0, -170.0)]
        table = spark.createDataFrame(boxes, "box_id int, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
        got = sorted(r["id"] for r in sources.area_filter(frame, table).collect())
        import pandas as pd
        con.register("b", pd.DataFrame(boxes, columns=["box_id", "lat_lo", "lat_hi", "lng_lo", "lng_hi"]))
        want = [r[0] for r in con.execute(
            "SELECT id FROM p WHERE EXISTS (SELECT 1 FROM b WHERE Lat BETWEEN lat_lo AND lat_hi AND CASE WHEN lng_lo <= lng_hi "
            "THEN Lng BETWEEN lng_lo AND lng_hi ELSE (Lng BETWEEN lng_lo AND 180) OR (Lng BETWEEN -180 AND lng_hi) END) ORDER BY id").fetchall()]
        assert got == want and 0 < len(got) < len(points)


def test_json_array_file_read_in_splits(spark, scratch):
    """One file read by many tasks, with quotes, braces and backslashes in strings, equals multiLine."""
    import random
    rng = random.Random(6)
    parts = ['"', "\\", "}", "{", "[", "]", ",", "é", "a", "\n", "\\\\", "},{", '\\"']
    reports = [{"Message": {"T": {"x": "".join(rng.choice(parts) for _ in range(rng.randrange(12))), "y": [{"z": i}, {}]}},
                "MessageType": "".join(rng.choice(parts) for _ in range(4)), "MetaData": {"MMSI": i, "ShipName": "\\"}}
               for i in range(3000)]
    for name, text in (("flat", json.dumps(reports)), ("wide", json.dumps(reports, indent=1, ensure_ascii=False)), ("none", " [ ]\n")):
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        for name in ("flat", "wide"):
            got = sources.read_json_array_split(spark, f"{scratch}/{name}.json")
            assert spark.read.option("lineSep", "}").text(f"{scratch}/{name}.json").rdd.getNumPartitions() > 10
            rows = sorted((r["number"], r["MessageType"], r["MetaData"]["MMSI"], json.loads(r["Message"]["T"])["x"]) for r in got.collect())
            assert rows == [(i, r["MessageType"], i, r["Message"]["T"]["x"]) for i, r in enumerate(reports)]
            whole = sources.read_json_array_file(spark, f"{scratch}/{name}.json")
            assert sorted(map(str, got.drop("file", "number", "Message").collect())) == sorted(map(str, whole.drop("Message").collect()))
        assert sources.read_json_array_split(spark, f"{scratch}/none.json").collect() == []
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_array_splits_are_scanned_in_order(spark, scratch):
    """Pieces are not shuffled to be put in order, only one row a split is; reports longer than a split meet."""
    reports = [{"Message": {"T": {"x": "}\\\"" * (i % 7), "y": [i, {"z": "[{" * (i % 3)}]}}, "MessageType": "\\" * (i % 4) + "\"{" * (i % 5),
                "MetaData": {"MMSI": i, "ShipName": "é}" * (i % 90)}} for i in range(50)]
    text = json.dumps(reports, ensure_ascii=False)
    for k in range(2):
        with open(f"{scratch}/{k}.json", "w") as f:
            f.write(text)
    want = sorted((i, r["MessageType"], i, r["MetaData"]["ShipName"], json.dumps(r["Message"]["T"])) for i, r in enumerate(reports))
    try:
        for size in (197, 128 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 0 if size < 1000 else 4 << 20)
            got = sources.read_json_array_split(spark, scratch)
            windows = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
            assert windows and not any("split#" in x.split("], [")[1] for x in windows)
            rows = sorted((r["file"][-6:], r["number"], r["MessageType"], r["MetaData"]["MMSI"], r["MetaData"]["ShipName"],
                           json.dumps(json.loads(r["Message"]["T"]))) for r in got.collect())
            assert rows == [(f"{k}.json", *w) for k in range(2) for w in want]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_small_file_is_worked_on_by_many_tasks(spark):
    """The rows of one file (one row group) are dealt out before reports are made of them and taken apart."""
    from tidewater.plans import io_queries, pipelines
    for query in (pipelines.q02b, io_queries.d03b):
        plan = query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        dealt = [i for i, line in enumerate(plan.splitlines()) if "RepartitionByExpression" in line]
        assert dealt and dealt[0] > [i for i, line in enumerate(plan.splitlines()) if "Generate " in line][0]
    rows = fixture.raw_topic(spark, SF_SMALL)
    assert rows.exceptAll(fixture.raw_topic(spark, SF_SMALL, spread=True)).isEmpty() and fixture.raw_topic(
        spark, SF_SMALL, spread=True).exceptAll(rows).isEmpty()


def test_awkward_reports_are_made_where_they_are_held(spark):
    made = fixture.report_objects(fixture.read_events(spark, SF_SMALL), "event_id % 10 IN (0, 1)")
    assert made.where("(obj IS NOT NULL) <> (event_id % 10 IN (0, 1))").isEmpty()
    held = fixture.awkward_topic(spark, SF_SMALL).where("offset * 3 + partition < 20").collect()
    texts = {r["event_id"]: r["obj"] for r in fixture.report_objects(fixture.read_events(spark, SF_SMALL)).where(
        "event_id < 20").collect()}
    for r in held:
        e = r["offset"] * 3 + r["partition"]
        if e % 10 < 2:
            assert r["value"] == (texts[e] if e % 10 == 0 else f"[{texts[e]},{texts[e]}]")


def test_bins_are_compiled(spark):
    """The JVM only interprets methods beyond 8,000 bytes; no chain of bins is generated as such a one."""
    import re
    from tidewater.operators import binning
    df = spark.createDataFrame([(float(i % 170 - 85), float(i % 360 - 180), i) for i in range(50)], "Lat double, Lng double, n int")
    wide = df.selectExpr("*", *[f"cast(n + {k} AS string) AS c{k}" for k in range(9)])
    binned = binning.bin_location(wide)
    code = binned._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_no_step_looks_for_containers_below_the_last_bracket(spark):
    """Nested and flat values keep all their leaves; a flat one takes no step beyond its own level."""
    texts = ['{"a":1,"b":"x[{"}', '{"a":{"b":[1,{"c":{}}]},"d":[]}', "[[[[1]],2],{}]", "{}", "[]", "5", "{bad", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    got = {r["id"]: None if r["p"] is None else sorted(r["p"]) for r in flatten.with_flat_entries(df, "value", "e").select(
        "id", F.transform("e", lambda x: x["path"]).alias("p")).collect()}
    assert got == {0: ["a", "b"], 1: ["a_b_0", "a_b_1_c", "d"], 2: ["0_0_0_0", "0_1", "1"], 3: [], 4: [], 5: None, 6: None, 7: None}
    flat = flatten.with_flat_entries(spark.createDataFrame([('{"a":1,"b":2}',)], "value string"), "value", "e")
    assert [x["leaf"] for x in flat.first()["e"]] == [False, False]
