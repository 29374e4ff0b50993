"""Golden values of the spatial codecs and time/feature rules."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions.timefmt import epoch_seconds, iso_text, parse_time_utc, time_utc_text
from tidewater.operators import binning, features

GOLDEN = [
    # reported lat, lng -> snapped lat, lng, S2 level 14 (unsigned), MGRS
    (52.71332666666667, 6.050813333333334, 52.71332, 6.05078, "5172507476251115520", "32ULD00794446"),
    (-38.050115, -57.535291666666666, -38.05009, -57.53527, "10773980218554056704", "21HVT53038849"),
]


@pytest.fixture(scope="module")
def binned(spark):
    df = spark.createDataFrame([(g[0], g[1]) for g in GOLDEN], "Lat double, Lng double")
    return binning.bin_location(df).collect()


def test_snap(binned):
    for row, g in zip(binned, GOLDEN):
        assert (row["Lat"], row["Lng"]) == (g[2], g[3])
        assert (row["LatReported"], row["LngReported"]) == (g[0], g[1])


def test_s2_level14(binned):
    for row, g in zip(binned, GOLDEN):
        assert row["S2_text"] == g[4]
        assert row["S2"] == (int(g[4]) - (1 << 64) if int(g[4]) >= 1 << 63 else int(g[4]))


def test_mgrs(binned):
    for row, g in zip(binned, GOLDEN):
        assert row["MGRS"] == g[5]


def test_wkt(binned):
    assert binned[0]["WKT"] == "POINT (6.05078 52.71332)"
    assert binned[1]["WKT"] == "POINT (-57.53527 -38.05009)"


def test_wkt_keeps_point_zero(spark):
    df = spark.createDataFrame([(53.43711333333333, 10.0)], "Lat double, Lng double")
    row = binning.with_wkt(df).collect()[0]
    assert row["WKT"] == "POINT (10.0 53.43711)"


def test_parent_of_child_is_direct(spark):
    df = spark.createDataFrame([(g[2], g[3]) for g in GOLDEN], "Lat double, Lng double")
    fine = binning.with_s2(df, level=20, out="C20")
    both = binning.with_s2(fine, level=14, out="C14").select(
        "C14", F.expr("(C20 & -4294967296) | 4294967296").alias("parent")).collect()
    for r in both:
        assert r["C14"] == r["parent"]


def test_hexagon_center_is_nearest(spark):
    pts = [(52.7, 6.05), (-38.05, -57.53), (0.001, 0.001), (60.0, -150.0)]
    df = spark.createDataFrame(pts, "Lat double, Lng double")
    rows = binning.with_hex_center(binning.with_hex(df)).collect()
    for r, (lat, lng) in zip(rows, pts):
        assert abs(r["hex_lat"] - lat) < 0.01 and abs(r["hex_lng"] - lng) < 0.01


def test_time_round_trip(spark):
    df = spark.createDataFrame([("2024-08-19 17:46:57.481183349 +0000 UTC",),
                                ("2024-08-19 17:46:57.481183256 +1000 UTC",),
                                ("2024-08-19 17:46:57 +0000 UTC",), ("not a time",)], "t string")
    out = df.select(parse_time_utc(F.col("t")).alias("ts")).select(
        iso_text(F.col("ts")).alias("iso"), epoch_seconds(F.col("ts")).alias("e"))
    out = out.select("iso", "e", time_utc_text(F.col("e")).alias("back")).collect()
    assert out[0]["iso"] == "2024-08-19T17:46:57.481183+00:00"
    assert out[1]["iso"] == "2024-08-19T07:46:57.481183+00:00"
    assert out[2]["iso"] == "2024-08-19T17:46:57+00:00"
    assert out[3]["iso"] is None
    assert out[0]["back"] == "2024-08-19 17:46:57.481183 +0000 UTC"


def test_feature_defaults_and_gate(spark):
    df = spark.createDataFrame(
        [("PositionReport", None, None, None, None),
         ("PositionReport", 1176.0, 123.0, 5, 2),
         ("ShipStaticData", 1176.0, 123.0, 5, 2)],
        "MessageType string, Cog double, Sog double, RateOfTurn int, SpecialManoeuvreIndicator int")
    df = df.select("MessageType", F.struct("Cog", "Sog", "RateOfTurn",
                                           "SpecialManoeuvreIndicator").alias("body"))
    rows = features.calculate_features(df).collect()
    assert (rows[0]["CourseDegrees"], rows[0]["SpeedKnots"], rows[0]["RateOfTurn"],
            rows[0]["SpecialManoeuvre"]) == (3600.0, 1023.0, -128, False)
    assert (rows[1]["CourseDegrees"], rows[1]["SpeedKnots"], rows[1]["RateOfTurn"],
            rows[1]["SpecialManoeuvre"]) == (117.6, 12.3, 5, True)
    assert rows[2]["CourseDegrees"] is None and rows[2]["SpecialManoeuvre"] is None


def test_position_accuracy_object_is_false(spark):
    df = spark.createDataFrame([('true',), ('{"0":{"Valid":true}}',), (None,)], "pa string")
    rows = df.select(features.position_accuracy(F.col("pa")).alias("a"),
                     features.position_accuracy(F.col("pa"), any_match=True).alias("b")).collect()
    assert [r["a"] for r in rows] == [True, False, False]
    assert [r["b"] for r in rows] == [True, True, False]
