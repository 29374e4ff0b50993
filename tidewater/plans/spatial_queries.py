"""Spatial binning queries (G-01..G-08) and their DuckDB oracles.

The oracle runs the same codec stages (``functions.geo``) as CTE chains in
DuckDB over the fixture's report view.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import DUCKDB
from ..operators import binning, route
from .oracle import with_reports
from .queries import KEY, KEY_SQL, register, std_reports

_VALID = ("latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) "
          "AND NOT isnan(longitude)")


def _valid(spark, sf):
    return route.valid_positions(std_reports(spark, sf))


def _chain(source: str, stages, prefix: str, body: str, extra: str = "") -> str:
    ctes, last = geo.duckdb_chain(source, stages, prefix)
    base = (f"vr AS (SELECT *, latitude AS LatReported, longitude AS LngReported FROM reports "
            f"WHERE {_VALID}),\n{ctes}")
    if extra:
        base += ",\n" + extra.replace("{last}", last)
    return with_reports(body.replace("{last}", last), base)


_SNAP = geo.snap_stages(DUCKDB, "LatReported", "LngReported", "Lat", "Lng")
_BIN = (_SNAP + geo.s2_cell_id(DUCKDB, "Lat", "Lng", binning.S2_LEVEL, "S2", "_S2_")
        + geo.hex_stages("Lat", "Lng", "hex_q", "hex_r")
        + geo.wkt_stages(DUCKDB, "Lat", "Lng", "WKT")
        + geo.mgrs_stages(DUCKDB, "Lat", "Lng", "MGRS"))
_S2TXT = geo.unsigned_text(DUCKDB, "S2")
_HEX_ID = "'hex450:' || CAST(hex_q AS VARCHAR) || ':' || CAST(hex_r AS VARCHAR)"


@register("g01_snap", _chain("vr", _SNAP, "sn",
                             f"SELECT {KEY_SQL}, LatReported, LngReported, Lat, Lng FROM {{last}}"))
def g01(spark, sf):
    return binning.snap(_valid(spark, sf)).select(*KEY, "LatReported", "LngReported", "Lat", "Lng")


@register("g02_s2_density", _chain(
    "vr", _SNAP + geo.s2_cell_id(DUCKDB, "Lat", "Lng", binning.S2_LEVEL, "S2", "_S2_"), "s2",
    f"SELECT S2, {_S2TXT} AS S2_text, count(*) AS reports, count(DISTINCT MMSI) AS vessels "
    "FROM {last} GROUP BY ALL"))
def g02(spark, sf):
    b = binning.with_s2(binning.snap(_valid(spark, sf)))
    return binning.s2_density(b)


def _g03_sql() -> str:
    finest = max(binning.ROLLUP_LEVELS)
    shift = 30 - finest
    snap_chain, snap_last = geo.duckdb_chain("vr", _SNAP, "sn")
    face_chain, face_last = geo.duckdb_chain(snap_last, geo.s2_face_ij("Lat", "Lng", "_r_"), "fc")
    leaf = (f"leaf AS (SELECT _r_face AS _l_face, (_r_i >> {shift}) << {shift} AS _l_i, "
            f"(_r_j >> {shift}) << {shift} AS _l_j, MMSI, count(*) AS reports FROM {face_last} GROUP BY ALL)")
    fine_chain, fine_last = geo.duckdb_chain(
        "leaf", geo.s2_hilbert(DUCKDB, "_l_", finest)
        + [[("_cell_f", DUCKDB.s2_id("_l_face", f"_l_pos{finest}", finest))]], "hf")
    levels = ", ".join(f"({v})" for v in binning.ROLLUP_LEVELS)
    per_level = (f"pl AS (SELECT f.*, CAST(lv.level AS INTEGER) AS level FROM {fine_last} f "
                 f"CROSS JOIN (VALUES {levels}) lv(level))")
    cell_chain, cell_last = geo.duckdb_chain(
        "pl", [[("cell", geo.s2_parent(DUCKDB, "_cell_f", "level"))]]
        + geo.s2_center(DUCKDB, "_l_", None, "_c_lat", "_c_lng",
                        size_sql=geo.cell_size(DUCKDB, "level"))
        + [[("center_lat", DUCKDB.round_even("_c_lat", geo.CENTER_DIGITS)),
            ("center_lng", DUCKDB.round_even("_c_lng", geo.CENTER_DIGITS))]], "cc")
    base = (f"vr AS (SELECT *, latitude AS LatReported, longitude AS LngReported FROM reports "
            f"WHERE {_VALID}),\n" + ",\n".join([snap_chain, face_chain, leaf, fine_chain,
                                                  per_level, cell_chain]))
    body = (f"SELECT level, cell, {geo.unsigned_text(DUCKDB, 'cell')} AS cell_text, center_lat, "
            f"center_lng, CAST(sum(reports) AS BIGINT) AS reports, count(DISTINCT MMSI) AS vessels FROM {cell_last} GROUP BY ALL")
    return with_reports(body, base)


@register("g03_s2_rollup", _g03_sql())
def g03(spark, sf):
    return binning.s2_rollup(binning.snap(_valid(spark, sf)))


_HEX = _SNAP + geo.hex_stages("Lat", "Lng", "hex_q", "hex_r")


_HC_CHAIN, _HC_LAST = geo.duckdb_chain(
    "cnt", geo.hex_center_stages(DUCKDB, "hex_q", "hex_r", "hex_lat", "hex_lng"), "hc")


@register("g04_hex_density", _chain(
    "vr", _HEX, "hx", f"SELECT hex_q, hex_r, reports, hex_lat, hex_lng FROM {_HC_LAST}",
    "cnt AS (SELECT hex_q, hex_r, count(*) AS reports FROM {last} GROUP BY ALL), " + _HC_CHAIN))
def g04(spark, sf):
    b = binning.with_hex(binning.snap(_valid(spark, sf)))
    return binning.hex_density(b).select("hex_q", "hex_r", "reports", "hex_lat", "hex_lng")


@register("g05_hex_center", _chain(
    "vr", _HEX + geo.hex_center_stages(DUCKDB, "hex_q", "hex_r", "hex_lat", "hex_lng"), "hx",
    f"SELECT {KEY_SQL}, {_HEX_ID} AS hex_id, hex_lat, hex_lng FROM {{last}}"))
def g05(spark, sf):
    b = binning.with_hex_center(binning.with_hex(binning.snap(_valid(spark, sf))))
    return b.select(*KEY, "hex_id", "hex_lat", "hex_lng")


@register("g06_wkt", _chain("vr", _SNAP + geo.wkt_stages(DUCKDB, "Lat", "Lng", "WKT"), "wk",
                            f"SELECT {KEY_SQL}, WKT FROM {{last}}"))
def g06(spark, sf):
    return binning.with_wkt(binning.snap(_valid(spark, sf))).select(*KEY, "WKT")


_MG = _SNAP + geo.mgrs_stages(DUCKDB, "Lat", "Lng", "MGRS")


@register("g07_mgrs_density", _chain(
    "vr", _MG, "mg", "SELECT MGRS AS square, count(*) AS reports FROM {last} GROUP BY ALL"))
def g07(spark, sf):
    return binning.mgrs_density(binning.with_mgrs(binning.snap(_valid(spark, sf))))


@register("g07b_mgrs_100km", _chain(
    "vr", _MG, "mg", "SELECT regexp_extract(MGRS, '^[0-9]*[A-Z]+') AS square, count(*) AS reports FROM {last} GROUP BY ALL"))
def g07b(spark, sf):
    return binning.mgrs_density(binning.with_mgrs(binning.snap(_valid(spark, sf))), prefix_only=True)


# positions of the fixture moved poleward, so that a part lies beyond 84 N and 80 S
_POLEWARD = "CASE WHEN Lat > 0 THEN least(90.0, Lat + 25.0) ELSE greatest(-90.0, Lat - 25.0) END"
_MGP = _SNAP + [[("PLat", _POLEWARD)]] + geo.mgrs_stages(DUCKDB, "PLat", "Lng", "MGRS")


@register("g07c_polar_squares", _chain(
    "vr", _MGP, "mp", "SELECT substr(MGRS, 1, 3) AS square, count(*) AS reports, min(MGRS) AS least, max(MGRS) AS greatest "
    "FROM {last} WHERE regexp_matches(MGRS, '^[ABYZ]') GROUP BY ALL"))
def g07c(spark, sf):
    """Reports per polar 100 km square: a filter on the computed square."""
    moved = binning.snap(_valid(spark, sf)).withColumn("PLat", F.expr(_POLEWARD))
    squares = binning.with_mgrs(moved, lat="PLat").where(F.col("MGRS").rlike("^[ABYZ]"))
    return squares.groupBy(F.substring("MGRS", 1, 3).alias("square")).agg(
        F.count(F.lit(1)).alias("reports"), F.min("MGRS").alias("least"), F.max("MGRS").alias("greatest"))


@register("g02b_cell_reports", _chain(
    "vr", _SNAP + geo.s2_cell_id(DUCKDB, "Lat", "Lng", binning.S2_LEVEL, "S2", "_S2_"), "s2",
    f"SELECT {KEY_SQL}, S2 FROM {{last}} WHERE S2 % 3 = 0"))
def g02b(spark, sf):
    """The reports of some cells: a filter on the computed cell."""
    cells = binning.with_s2(binning.snap(_valid(spark, sf)))
    return cells.where(F.col("S2") % 3 == 0).select(*KEY, "S2")


@register("g08_binned_record", _chain(
    "vr", _BIN, "bn",
    f"SELECT {KEY_SQL}, LatReported AS lat_reported, LngReported AS lng_reported, Lat AS lat, "
    f"Lng AS lng, {_HEX_ID} AS hex, S2 AS s2, {_S2TXT} AS s2_text, WKT AS wkt, MGRS AS mgrs "
    "FROM {last}"))
def g08(spark, sf):
    b = binning.binned_record(_valid(spark, sf))
    return b.select(*KEY, F.col("binned.*"))
