"""Spatial binning jobs: snap, S2 / hexagon / MGRS cells, per-cell counts.

Row-wise codecs come from ``functions.geo`` (Column expressions in a
projection chain); the per-cell aggregates are hash aggregates with partial
(map-side) combining, so a crowded port cell is pre-counted in every task.
The multi-level S2 roll-up aggregates once at the finest level and derives
the coarser levels from that (much smaller) table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import SPARK

SNAP_LEVEL = 20
S2_LEVEL = 14
ROLLUP_LEVELS = (12, 14, 15, 20)


def settled(df: DataFrame, before: list[str], outs: list[str]) -> DataFrame:
    """``before`` and the computed ``outs``, behind a generator of one row: a
    filter on a bin then stays above the codec. Pushed below, it would repeat
    every stage of the chain in itself, growing without measure. The generated
    code of a long chain is cut in two by one half way: the JVM only interprets
    methods beyond 8,000 bytes."""
    one = F.array(F.struct(*outs))
    return df.select(*before, F.explode(one).alias("_bin")).select(*before, *[F.col(f"_bin.{c}").alias(c) for c in outs])


def snap(df: DataFrame, lat: str = "Lat", lng: str = "Lng") -> DataFrame:
    """P-20 + G-01: keep the reported coordinates as ``LatReported`` /
    ``LngReported`` and replace ``Lat`` / ``Lng`` with the centre of the
    level-20 S2 cell, rounded to 5 decimals."""
    df = df.withColumnRenamed(lat, "LatReported").withColumnRenamed(lng, "LngReported")
    return settled(geo.apply_stages(df, geo.snap_stages(SPARK, "LatReported", "LngReported", lat, lng)), df.columns, [lat, lng])


def with_s2(df: DataFrame, level: int = S2_LEVEL, lat: str = "Lat", lng: str = "Lng",
            out: str = "S2") -> DataFrame:
    """G-02 codec: S2 cell id at ``level`` as a signed 64-bit pattern
    (``out``) and as unsigned decimal text (``out + '_text'``)."""
    p = f"_{out}_"
    ij = [f"{p}face", f"{p}i", f"{p}j"]
    cells = settled(geo.apply_stages(df, geo.s2_face_ij(lat, lng, p), keep=ij), df.columns, ij)
    cells = geo.apply_stages(cells, geo.s2_hilbert(SPARK, p, level) + [[(out, SPARK.s2_id(ij[0], f"{p}pos{level}", level))]])
    return settled(cells, df.columns, [out]).withColumn(f"{out}_text", F.expr(geo.unsigned_text(SPARK, out)))


def with_hex(df: DataFrame, lat: str = "Lat", lng: str = "Lng") -> DataFrame:
    """G-04 codec: hexagon axial coordinates ``hex_q``, ``hex_r`` (450 m
    edge on the equal-area cylinder) and a text id ``hex_id``."""
    cells = geo.apply_stages(df, geo.hex_stages(lat, lng, "hex_q", "hex_r"))
    return settled(cells, df.columns, ["hex_q", "hex_r"]).withColumn("hex_id", F.concat_ws(":", F.lit("hex450"), F.col("hex_q").cast("string"),
                                               F.col("hex_r").cast("string")))


def with_hex_center(df: DataFrame, q: str = "hex_q", r: str = "hex_r") -> DataFrame:
    """G-05: centre of each hexagon."""
    return geo.apply_stages(df, geo.hex_center_stages(SPARK, q, r, "hex_lat", "hex_lng"))


def with_wkt(df: DataFrame, lat: str = "Lat", lng: str = "Lng", out: str = "WKT") -> DataFrame:
    """G-06."""
    return geo.apply_stages(df, geo.wkt_stages(SPARK, lat, lng, out))


def with_mgrs(df: DataFrame, lat: str = "Lat", lng: str = "Lng", out: str = "MGRS",
              digits: int = 4) -> DataFrame:
    """G-07 codec: MGRS squares, polar ones beyond 84 N and 80 S."""
    stages = geo.mgrs_stages(SPARK, lat, lng, out, digits=digits)
    utm = 1 + next(i for i, stage in enumerate(stages) if "_mg_utm" in [name for name, _ in stage])
    squares = settled(geo.apply_stages(df, stages[:utm], keep=["_mg_utm"]), df.columns, ["_mg_utm"])
    return settled(geo.apply_stages(squares, stages[utm:]), df.columns, [out])


def bin_location(df: DataFrame, lat: str = "Lat", lng: str = "Lng") -> DataFrame:
    """G-01, G-02, G-04, G-06, G-07 in the reference's order: snap first,
    then every bin from the snapped point."""
    out = snap(df, lat, lng)
    out = with_s2(out, S2_LEVEL, lat, lng)
    out = with_hex(out, lat, lng)
    out = with_wkt(out, lat, lng)
    return with_mgrs(out, lat, lng)


def binned_record(df: DataFrame) -> DataFrame:
    """G-08: all bins of a report as one struct column ``binned``."""
    b = bin_location(df)
    return b.withColumn("binned", F.struct(
        F.col("LatReported").alias("lat_reported"), F.col("LngReported").alias("lng_reported"),
        F.col("Lat").alias("lat"), F.col("Lng").alias("lng"), F.col("hex_id").alias("hex"),
        F.col("S2").alias("s2"), F.col("S2_text").alias("s2_text"), F.col("WKT").alias("wkt"),
        F.col("MGRS").alias("mgrs")))


def s2_density(binned: DataFrame, cell: str = "S2", vessel: str = "MMSI") -> DataFrame:
    """G-02 aggregate: reports and distinct vessels per cell."""
    return (binned.groupBy(cell, f"{cell}_text")
            .agg(F.count(F.lit(1)).alias("reports"), F.countDistinct(vessel).alias("vessels")))


def s2_rollup(snapped: DataFrame, levels: tuple[int, ...] = ROLLUP_LEVELS,
              lat: str = "Lat", lng: str = "Lng", vessel: str = "MMSI") -> DataFrame:
    """G-03: reports and distinct vessels per S2 cell at several levels, with
    each cell's centre. Rows are shuffled once, to reports per vessel and
    finest cell (by face and truncated i, j; pre-counted in every task). The
    finest cell id is computed on that (much smaller) table, and every level
    is derived from it in one pass: parent id by bit mask, centre from the
    truncated i, j; a vessel counts once in a cell of any level. No per-level
    re-scan, no union."""
    finest = max(levels)
    shift = geo.S2_MAX_LEVEL - finest
    ij = geo.apply_stages(snapped.select(lat, lng, F.col(vessel).alias("vessel")), geo.s2_face_ij(lat, lng, "_r_"),
                          keep=["_r_face", "_r_i", "_r_j"])
    leaf = (ij.groupBy(F.col("_r_face").alias("_l_face"),
                       F.shiftleft(F.shiftright("_r_i", shift), shift).alias("_l_i"),
                       F.shiftleft(F.shiftright("_r_j", shift), shift).alias("_l_j"), "vessel")
            .agg(F.count(F.lit(1)).alias("reports")))
    fine = geo.apply_stages(
        leaf, geo.s2_hilbert(SPARK, "_l_", finest)
        + [[("_cell_f", SPARK.s2_id("_l_face", f"_l_pos{finest}", finest))]],
        keep=["_l_face", "_l_i", "_l_j", "_cell_f"])
    per_level = fine.select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"))
    stages = ([[("cell", geo.s2_parent(SPARK, "_cell_f", "level"))]]
              + geo.s2_center(SPARK, "_l_", None, "_c_lat", "_c_lng",
                              size_sql=geo.cell_size(SPARK, "level"))
              + [[("center_lat", SPARK.round_even("_c_lat", geo.CENTER_DIGITS)),
                  ("center_lng", SPARK.round_even("_c_lng", geo.CENTER_DIGITS))]])
    cells = geo.apply_stages(per_level, stages)
    each = cells.groupBy("level", "cell", "center_lat", "center_lng", "vessel").agg(F.sum("reports").alias("reports"))
    return (each.groupBy("level", "cell", "center_lat", "center_lng")
            .agg(F.sum("reports").alias("reports"), F.count("vessel").alias("vessels"))
            .select("level", "cell", F.expr(geo.unsigned_text(SPARK, "cell")).alias("cell_text"),
                    "center_lat", "center_lng", "reports", "vessels"))


def hex_density(binned: DataFrame) -> DataFrame:
    """G-04 aggregate: reports per hexagon, with its centre (G-05)."""
    counts = binned.groupBy("hex_q", "hex_r").agg(F.count(F.lit(1)).alias("reports"))
    return with_hex_center(counts)


def mgrs_density(binned: DataFrame, prefix_only: bool = False) -> DataFrame:
    """G-07 aggregate: reports per 10 m square, or per 100 km square
    (zone, band and the two letters; a polar square has no zone) with
    ``prefix_only``."""
    letters = F.when(F.col("MGRS").rlike("^[0-9]"), 5).otherwise(3)
    key = F.col("MGRS").substr(F.lit(1), letters) if prefix_only else F.col("MGRS")
    return binned.groupBy(key.alias("square")).agg(F.count(F.lit(1)).alias("reports"))
