"""Properties of the spatial codecs over random points of the whole globe:
Spark and DuckDB give identical results, the snap stays near the input,
parents agree with direct ids, special UTM zones apply."""

import math
import random

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.functions import geo
from tidewater.operators import binning

POINT = st.tuples(st.floats(min_value=-79.9, max_value=83.9, allow_nan=False),
                  st.floats(min_value=-179.999, max_value=179.999, allow_nan=False))


def _duck(points, stages, cols):
    con = duckdb.connect()
    con.execute("CREATE TABLE pts (id INTEGER, LatReported DOUBLE, LngReported DOUBLE)")
    con.executemany("INSERT INTO pts VALUES (?, ?, ?)",
                    [(i, a, b) for i, (a, b) in enumerate(points)])
    chain, last = geo.duckdb_chain("pts", stages, "t")
    return {r[0]: r[1:] for r in con.sql(f"WITH {chain} SELECT id, {cols} FROM {last}").fetchall()}


@settings(max_examples=3, deadline=None)
@given(st.lists(POINT, min_size=20, max_size=60))
def test_spark_equals_duckdb(spark, points):
    d = geo.DUCKDB
    stages = (geo.snap_stages(d, "LatReported", "LngReported", "Lat", "Lng")
              + geo.s2_cell_id(d, "Lat", "Lng", 14, "S2", "_S2_")
              + geo.mgrs_stages(d, "Lat", "Lng", "MGRS")
              + geo.hex_stages("Lat", "Lng", "hex_q", "hex_r"))
    want = _duck(points, stages, "Lat, Lng, S2, MGRS, hex_q, hex_r")
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)],
                               "id int, Lat double, Lng double")
    got = binning.with_hex(binning.with_mgrs(binning.with_s2(binning.snap(df)))).collect()
    for r in got:
        assert (r["Lat"], r["Lng"], r["S2"], r["MGRS"], r["hex_q"], r["hex_r"]) == want[r["id"]]


@settings(max_examples=3, deadline=None)
@given(st.lists(POINT, min_size=20, max_size=60))
def test_snap_near_input_and_parent_consistent(spark, points):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)],
                               "id int, Lat double, Lng double")
    out = binning.with_s2(binning.with_s2(binning.snap(df), 20, out="C20"), 14, out="C14")
    out = out.selectExpr("*", f"{geo.s2_parent(geo.SPARK, 'C20', 14)} AS P14").collect()
    for r in out:
        # a level-20 cell is under 10 m across; rounding to 5 dp adds < 1 m
        dlat = r["Lat"] - r["LatReported"]
        dlng = (r["Lng"] - r["LngReported"]) * math.cos(math.radians(r["LatReported"]))
        assert math.hypot(dlat, dlng) * 111_320 < 15
        assert r["P14"] == r["C14"]


def test_special_utm_zones(spark):
    df = spark.createDataFrame([(60.39, 5.32), (78.22, 15.65), (78.0, 8.0), (79.0, 30.0)],
                               "Lat double, Lng double")
    got = [r["MGRS"][:3] for r in binning.with_mgrs(df).collect()]
    assert got == ["32V", "33X", "31X", "35X"]


@settings(max_examples=3, deadline=None)
@given(st.lists(POINT, min_size=50, max_size=200))
def test_hexagon_is_nearest_center(spark, points):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)],
                               "id int, Lat double, Lng double")
    rows = binning.with_hex(df).collect()
    r_e, s = geo.HEX_EARTH_RADIUS, geo.HEX_EDGE_METERS

    def center(q, r):
        return s * math.sqrt(3) * (q + r / 2), s * 1.5 * r

    for row in rows:
        x = r_e * math.radians(row["Lng"])
        y = r_e * math.sin(math.radians(row["Lat"]))
        q, r = row["hex_q"], row["hex_r"]
        cx, cy = center(q, r)
        own = math.hypot(x - cx, y - cy)
        for dq, dr in [(1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]:
            nx, ny = center(q + dq, r + dr)
            assert own <= math.hypot(x - nx, y - ny) + 1e-6


def _ups(lat, lng):
    """Easting and northing by the closed formula of polar stereography."""
    e, a, k0 = math.sqrt(geo.WGS84_F * (2 - geo.WGS84_F)), geo.WGS84_A, 0.994
    phi = math.radians(abs(lat))
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
    rho = 2 * a * k0 * t / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
    return 2e6 + rho * math.sin(math.radians(lng)), 2e6 - math.copysign(1, lat) * rho * math.cos(math.radians(lng))


def test_polar_squares(spark):
    # both poles, and a worked example of the published grid manual
    golden = {(90.0, 0.0): "ZAH00000000", (-90.0, 0.0): "BAN00000000",
              (84 + 17 / 60 + 14.042 / 3600, -(132 + 14 / 60 + 52.761 / 3600)): "YTM30122677"}
    rng = random.Random(9)
    points = list(golden) + [(rng.choice([1, -1]) * rng.uniform(84.001, 89.99), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(-80.5, 10.0), (-80.0, 10.0), (83.999, 10.0), (84.0, 10.0)]
    df = spark.createDataFrame(points, "Lat double, Lng double")
    got = {(r["Lat"], r["Lng"]): r["MGRS"] for r in binning.with_mgrs(df).collect()}
    assert all(got[p] == square for p, square in golden.items())
    for lat, lng in points[3:303]:
        east, north = _ups(lat, lng)
        assert got[lat, lng][3:] == f"{int(east) % 100000 // 10:04}{int(north) % 100000 // 10:04}"
        assert got[lat, lng][0] == ("YZ" if lat > 0 else "AB")[east >= 2e6]
    assert [got[p][0] for p in points[303:]] == ["B", "3", "3", "Z"]


def test_bins_can_be_filtered(spark):
    """A filter on a bin stays above its codec, so it compiles at once."""
    df = spark.range(100).selectExpr("id", "id * 0.7 - 35 AS Lat", "id * 1.3 - 65 AS Lng")
    cell = binning.with_s2(df).collect()[40]
    assert [r["id"] for r in binning.with_s2(df).where(F.col("S2") == cell["S2"]).collect()] == [40]
    binned = binning.bin_location(df)
    found = binned.where(F.col("MGRS").isNotNull() & (F.col("hex_q") > 0) & (F.col("S2") != 5)).count()
    assert 0 < found < 100
