"""Spatial codecs as SQL expression stages: S2 cells, MGRS squares,
equal-area hexagons and WKT points.

Each codec is a list of stages; a stage is a list of ``(column, expression)``
pairs that may read the columns of earlier stages. Spark applies a stage as
one ``selectExpr`` projection (plain arithmetic, trig and bit operations:
JVM-side, whole-stage codegen, no Python on the row path). The DuckDB oracle
runs the very same expressions as a chain of CTEs; only a few tokens differ
between the dialects (bit shifts, exclusive or, integer division, wide
integers for the unsigned 64-bit S2 id).

Column names are prefixed so several codecs can run on one frame.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

Stage = list[tuple[str, str]]

# Fixed values of the public S2 cell hierarchy: Hilbert curve position of
# sub-cell (2*i_bit + j_bit) per orientation, and orientation change per
# position (1 = swap axes, 3 = swap and invert).
S2_IJ_TO_POS = [[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]]
S2_POS_TO_ORIENTATION = [1, 0, 0, 3]
S2_MAX_LEVEL = 30
S2_MAX_SIZE = 1 << S2_MAX_LEVEL

# Fixed values of MGRS on WGS84.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
MGRS_BANDS = "CDEFGHJKLMNPQRSTUVWX"
MGRS_COLUMN_SETS = ["ABCDEFGH", "JKLMNPQR", "STUVWXYZ"]
MGRS_ROWS = "ABCDEFGHJKLMNPQRSTUV"

# Fixed values of the polar squares of MGRS (UPS): letters of the 100 km
# columns west and east of the pole and of the rows, which leave some out;
# metres of the first column and row; scale at the pole, metres of the pole.
UPS_WEST_COLUMNS = "JKLPQRSTUXYZ"
UPS_EAST_COLUMNS = "ABCFGHJKLPQR"
UPS_ROWS = "ABCDEFGHJKLMNPQRSTUVWXYZ"
UPS_WEST_EASTING, UPS_EAST_EASTING = 800000, 2000000
UPS_SOUTH_NORTHING, UPS_NORTH_NORTHING = 800000, 1300000
UPS_K0 = 0.994
UPS_POLE = 2000000.0

# Hexagon grid: equal-area cylindrical projection of the authalic sphere.
HEX_EARTH_RADIUS = 6371007.2
HEX_EDGE_METERS = 450.0

# Cell centres are reported to 9 decimals (about 0.1 mm): trig results may
# differ in the last bit between math libraries; the rounded text does not.
CENTER_DIGITS = 9


def _packed_hilbert_table() -> int:
    """16 nibbles, index ``4*orientation + ij``: ``pos << 2 | new_orientation``."""
    packed = 0
    for orient in range(4):
        for ij in range(4):
            pos = S2_IJ_TO_POS[orient][ij]
            nxt = orient ^ S2_POS_TO_ORIENTATION[pos]
            packed |= ((pos << 2) | nxt) << (4 * (4 * orient + ij))
    return packed


HILBERT_PACKED = _packed_hilbert_table()


def _d(x: float) -> str:
    """A double literal both dialects read as DOUBLE."""
    return f"CAST({x!r} AS DOUBLE)"


class Dialect:
    def __init__(self, name: str):
        self.name = name

    def shr(self, a: str, n: int | str) -> str:
        return f"shiftright({a}, {n})" if self.name == "spark" else f"({a} >> {n})"

    def shl(self, a: str, n: int | str) -> str:
        return f"shiftleft({a}, {n})" if self.name == "spark" else f"({a} << {n})"

    def round_even(self, x: str, digits: int) -> str:
        return f"bround({x}, {digits})" if self.name == "spark" else f"round_even({x}, {digits})"

    def xor(self, a: str, b: str) -> str:
        return f"({a} ^ {b})" if self.name == "spark" else f"xor({a}, {b})"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def s2_id(self, face: str, pos: str, level: int) -> str:
        """Signed 64-bit pattern of ``face<<61 | pos<<(61-2L) | 1<<(60-2L)``."""
        if self.name == "spark":
            return (f"(shiftleft(CAST({face} AS BIGINT), 61) | shiftleft({pos}, {61 - 2 * level})"
                    f" | shiftleft(CAST(1 AS BIGINT), {60 - 2 * level}))")
        u = (f"(CAST({face} AS HUGEINT) * {1 << 61} + CAST({pos} AS HUGEINT) * {1 << (61 - 2 * level)}"
             f" + {1 << (60 - 2 * level)})")
        return f"CAST(CASE WHEN {u} >= {1 << 63} THEN {u} - {1 << 64} ELSE {u} END AS BIGINT)"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")


# ------------------------------------------------------------------- S2 --

def s2_face_ij(lat: str, lng: str, p: str) -> list[Stage]:
    """Point (degrees) -> cube face and leaf i, j (quadratic projection)."""
    def st(x):
        return (f"CASE WHEN {x} >= 0 THEN 0.5 * sqrt(1 + 3 * {x}) "
                f"ELSE 1 - 0.5 * sqrt(1 - 3 * {x}) END")

    def ij(x):
        return (f"CAST(greatest(0, least({S2_MAX_SIZE - 1}, floor({S2_MAX_SIZE} * {x}))) "
                "AS BIGINT)")

    x, y, z = f"{p}x", f"{p}y", f"{p}z"
    return [
        [(f"{p}phi", f"radians({lat})"), (f"{p}theta", f"radians({lng})")],
        [(f"{p}cphi", f"cos({p}phi)")],
        [(x, f"cos({p}theta) * {p}cphi"), (y, f"sin({p}theta) * {p}cphi"), (z, f"sin({p}phi)")],
        [(f"{p}axis", f"CASE WHEN abs({x}) > abs({y}) THEN "
                      f"(CASE WHEN abs({x}) > abs({z}) THEN 0 ELSE 2 END) "
                      f"ELSE (CASE WHEN abs({y}) > abs({z}) THEN 1 ELSE 2 END) END")],
        [(f"{p}face", f"CASE {p}axis WHEN 0 THEN (CASE WHEN {x} < 0 THEN 3 ELSE 0 END) "
                      f"WHEN 1 THEN (CASE WHEN {y} < 0 THEN 4 ELSE 1 END) "
                      f"ELSE (CASE WHEN {z} < 0 THEN 5 ELSE 2 END) END")],
        [(f"{p}u", f"CASE {p}face WHEN 0 THEN {y} / {x} WHEN 1 THEN -{x} / {y} "
                   f"WHEN 2 THEN -{x} / {z} WHEN 3 THEN {z} / {x} WHEN 4 THEN {z} / {y} "
                   f"ELSE -{y} / {z} END"),
         (f"{p}v", f"CASE {p}face WHEN 0 THEN {z} / {x} WHEN 1 THEN {z} / {y} "
                   f"WHEN 2 THEN -{y} / {z} WHEN 3 THEN {y} / {x} WHEN 4 THEN -{x} / {y} "
                   f"ELSE -{x} / {z} END")],
        [(f"{p}s", st(f"{p}u")), (f"{p}t", st(f"{p}v"))],
        [(f"{p}i", ij(f"{p}s")), (f"{p}j", ij(f"{p}t"))],
    ]


def s2_hilbert(d: Dialect, p: str, level: int) -> list[Stage]:
    """Hilbert position of the level-``level`` cell from face, i, j: one
    stage per level, each a lookup in a packed 64-bit constant."""
    stages: list[Stage] = [[(f"{p}o0", f"({p}face & 1)"), (f"{p}pos0", "CAST(0 AS BIGINT)")]]
    for k in range(level):
        bit = S2_MAX_LEVEL - 1 - k
        ij = f"(({d.shr(f'{p}i', bit)} & 1) * 2 + ({d.shr(f'{p}j', bit)} & 1))"
        nib = f"({d.shr(f'CAST({HILBERT_PACKED} AS BIGINT)', f'(({p}o{k} * 4 + {ij}) * 4)')} & 15)"
        stages.append([(f"{p}n{k + 1}", nib)])
        stages.append([(f"{p}pos{k + 1}", f"({p}pos{k} * 4 + {d.shr(f'{p}n{k + 1}', 2)})"),
                       (f"{p}o{k + 1}", f"({p}n{k + 1} & 3)")])
    return stages


def s2_cell_id(d: Dialect, lat: str, lng: str, level: int, out: str, p: str) -> list[Stage]:
    """S2 cell id (signed 64-bit pattern) of a point at ``level``."""
    stages = s2_face_ij(lat, lng, p) + s2_hilbert(d, p, level)
    stages.append([(out, d.s2_id(f"{p}face", f"{p}pos{level}", level))])
    return stages


def s2_center(d: Dialect, p: str, level: int | None, lat_out: str, lng_out: str,
              size_sql: str | None = None) -> list[Stage]:
    """Centre (degrees) of the level cell holding leaf (face, i, j); the
    cell size in leaf units is ``2^(30 - level)`` or the SQL ``size_sql``
    (for a level held in a column)."""
    size = size_sql if size_sql is not None else str(1 << (S2_MAX_LEVEL - level))
    half = _d(0.5 / S2_MAX_SIZE)
    third = _d(1.0 / 3.0)

    def uv(s):
        return (f"CASE WHEN {s} >= 0.5 THEN {third} * (4 * {s} * {s} - 1) "
                f"ELSE {third} * (1 - 4 * (1 - {s}) * (1 - {s})) END")

    f = f"{p}face"
    cu, cv = f"{p}cu", f"{p}cv"
    return [
        [(f"{p}csi", f"(2 * ({p}i - ({p}i % {size})) + {size})"),
         (f"{p}cti", f"(2 * ({p}j - ({p}j % {size})) + {size})")],
        [(f"{p}cs", f"{half} * {p}csi"), (f"{p}ct", f"{half} * {p}cti")],
        [(cu, uv(f"{p}cs")), (cv, uv(f"{p}ct"))],
        [(f"{p}cx", f"CASE {f} WHEN 0 THEN 1 WHEN 1 THEN -{cu} WHEN 2 THEN -{cu} WHEN 3 THEN -1 "
                    f"WHEN 4 THEN {cv} ELSE {cv} END"),
         (f"{p}cy", f"CASE {f} WHEN 0 THEN {cu} WHEN 1 THEN 1 WHEN 2 THEN -{cv} WHEN 3 THEN -{cv} "
                    f"WHEN 4 THEN -1 ELSE {cu} END"),
         (f"{p}cz", f"CASE {f} WHEN 0 THEN {cv} WHEN 1 THEN {cv} WHEN 2 THEN 1 WHEN 3 THEN -{cu} "
                    f"WHEN 4 THEN -{cu} ELSE -1 END")],
        [(lat_out, f"degrees(atan2({p}cz, sqrt({p}cx * {p}cx + {p}cy * {p}cy)))"),
         (lng_out, f"degrees(atan2({p}cy, {p}cx))")],
    ]


def s2_parent(d: Dialect, cell: str, level: int | str) -> str:
    """Parent id at ``level`` (a constant or a column) of a finer cell id:
    ``(id & -lsb) | lsb`` with ``lsb = 1 << 2*(30 - level)``."""
    if isinstance(level, int):
        lsb = 1 << (2 * (S2_MAX_LEVEL - level))
        if d.name == "spark":
            return f"(({cell} & {-lsb}) | {lsb})"
        return f"(({cell} & CAST({-lsb} AS BIGINT)) | CAST({lsb} AS BIGINT))"
    lsb = d.shl("CAST(1 AS BIGINT)", f"(2 * ({S2_MAX_LEVEL} - {level}))")
    return f"(({cell} & -{lsb}) | {lsb})"


def cell_size(d: Dialect, level: str) -> str:
    """Cell size in leaf units for a level held in a column."""
    return d.shl("CAST(1 AS BIGINT)", f"({S2_MAX_LEVEL} - {level})")


def unsigned_text(d: Dialect, cell: str) -> str:
    """The unsigned decimal text of a 64-bit id pattern."""
    if d.name == "spark":
        return (f"CAST(CASE WHEN {cell} < 0 THEN CAST({cell} AS DECIMAL(20,0)) + "
                f"CAST('{1 << 64}' AS DECIMAL(20,0)) ELSE CAST({cell} AS DECIMAL(20,0)) END AS STRING)")
    return (f"CAST(CASE WHEN {cell} < 0 THEN CAST({cell} AS HUGEINT) + {1 << 64} "
            f"ELSE CAST({cell} AS HUGEINT) END AS VARCHAR)")


# ----------------------------------------------------------------- snap --

def snap_stages(d: Dialect, lat: str, lng: str, lat_out: str, lng_out: str,
                level: int = 20, digits: int = 5, p: str = "_sn_") -> list[Stage]:
    """G-01: centre of the level-20 cell of the point, rounded half-even."""
    rnd = "bround" if d.name == "spark" else "round_even"
    return (s2_face_ij(lat, lng, p)
            + s2_center(d, p, level, f"{p}clat", f"{p}clng")
            + [[(lat_out, f"{rnd}({p}clat, {digits})"), (lng_out, f"{rnd}({p}clng, {digits})")]])


# ----------------------------------------------------------------- MGRS --

def _krueger():
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = [
        n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180,
        13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
        61 * n ** 3 / 240 - 103 * n ** 4 / 140,
        49561 * n ** 4 / 161280,
    ]
    e2n = 2 * math.sqrt(n) / (1 + n)
    return big_a, alpha, e2n


def mgrs_stages(d: Dialect, lat: str, lng: str, out: str, p: str = "_mg_",
                digits: int = 4) -> list[Stage]:
    """G-07: MGRS reference with ``digits`` easting and northing digits
    (4 = 10 m squares), truncated. Beyond the UTM latitudes (84 N, 80 S) the
    square is of the polar stereographic grid, which has no zone: A and B in
    the south, Y and Z in the north, west and east of Greenwich."""
    big_a, alpha, e2n = _krueger()
    ka = _d(UTM_K0 * big_a)
    zone = (f"CASE WHEN {lat} >= 56 AND {lat} < 64 AND {lng} >= 3 AND {lng} < 12 THEN 32 "
            f"WHEN {lat} >= 72 AND {lat} < 84 AND {lng} >= 0 AND {lng} < 9 THEN 31 "
            f"WHEN {lat} >= 72 AND {lat} < 84 AND {lng} >= 9 AND {lng} < 21 THEN 33 "
            f"WHEN {lat} >= 72 AND {lat} < 84 AND {lng} >= 21 AND {lng} < 33 THEN 35 "
            f"WHEN {lat} >= 72 AND {lat} < 84 AND {lng} >= 33 AND {lng} < 42 THEN 37 "
            f"ELSE CAST(least(floor(({lng} + 180) / 6) + 1, 60) AS INTEGER) END")
    east = " + ".join(f"{_d(a)} * cos({2 * (k + 1)} * {p}xi) * sinh({2 * (k + 1)} * {p}eta)"
                      for k, a in enumerate(alpha))
    north = " + ".join(f"{_d(a)} * sin({2 * (k + 1)} * {p}xi) * cosh({2 * (k + 1)} * {p}eta)"
                       for k, a in enumerate(alpha))
    cols = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(MGRS_COLUMN_SETS))
    scale = 10 ** (5 - digits)
    return [
        [(f"{p}zone", zone),
         (f"{p}band", f"CASE WHEN {lat} >= -80 AND {lat} < 84 THEN substr('{MGRS_BANDS}', "
                      f"CAST(least(floor(({lat} + 80) / 8), 19) AS INTEGER) + 1, 1) END")],
        [(f"{p}phi", f"radians({lat})"),
         (f"{p}dl", f"radians({lng} - ({p}zone * 6 - 183))")],
        [(f"{p}t", f"sinh(atanh(sin({p}phi)) - {_d(e2n)} * atanh({_d(e2n)} * sin({p}phi)))")],
        [(f"{p}xi", f"atan2({p}t, cos({p}dl))"),
         (f"{p}eta", f"atanh(sin({p}dl) / sqrt(1 + {p}t * {p}t))")],
        [(f"{p}e", f"{_d(UTM_FALSE_EASTING)} + {ka} * ({p}eta + {east})"),
         (f"{p}n", f"CASE WHEN {lat} < 0 THEN {_d(UTM_FALSE_NORTHING_SOUTH)} ELSE 0.0 END"
                   f" + {ka} * ({p}xi + {north})")],
        [(f"{p}ei", f"CAST(floor({p}e) AS BIGINT)"), (f"{p}ni", f"CAST(floor({p}n) AS BIGINT)")],
        [(f"{p}col", f"substr(CASE ({p}zone - 1) % 3 {cols} END, "
                     f"CAST({d.div(f'{p}ei', '100000')} AS INTEGER), 1)"),
         (f"{p}row", f"substr('{MGRS_ROWS}', CAST(({d.div(f'{p}ni', '100000')} + "
                     f"CASE WHEN {p}zone % 2 = 0 THEN 5 ELSE 0 END) % 20 AS INTEGER) + 1, 1)"),
         (f"{p}ed", f"lpad(CAST({d.div(f'{p}ei % 100000', str(scale))} AS STRING), {digits}, '0')"),
         (f"{p}nd", f"lpad(CAST({d.div(f'{p}ni % 100000', str(scale))} AS STRING), {digits}, '0')")],
        [(f"{p}utm", f"CASE WHEN {p}band IS NOT NULL THEN lpad(CAST({p}zone AS STRING), 2, '0') || "
                     f"{p}band || {p}col || {p}row || {p}ed || {p}nd END")],
    ] + _polar_stages(d, lat, lng, f"{p}polar", f"{p}p", digits) + [
        [(out, f"coalesce({p}utm, {p}polar)")],
    ]


def _polar_stages(d: Dialect, lat: str, lng: str, out: str, p: str, digits: int) -> list[Stage]:
    """The polar square of a point beyond the UTM latitudes, else NULL. The
    distance from the pole is ``2 a k0 t / sqrt((1+e)^(1+e) (1-e)^(1-e))``,
    t being the tangent of half the conformal colatitude."""
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    reach = 2 * WGS84_A * UPS_K0 / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
    scale = 10 ** (5 - digits)
    # sine of the absolute latitude, kept off 1, where the logarithm ends; the pole is set apart
    sin = f"least(sin(radians(abs({lat}))), {_d(1 - 2.0 ** -53)})"
    first = f"CASE WHEN {p}w THEN {UPS_WEST_EASTING} ELSE {UPS_EAST_EASTING} END"
    low = f"CASE WHEN {lat} >= 0 THEN {UPS_NORTH_NORTHING} ELSE {UPS_SOUTH_NORTHING} END"
    return [
        [(f"{p}on", f"({lat} >= 84 AND {lat} <= 90) OR ({lat} < -80 AND {lat} >= -90)"), (f"{p}s", sin),
         (f"{p}l", f"radians({lng})")],
        [(f"{p}r", f"CASE WHEN abs({lat}) >= 90 THEN 0.0 ELSE {_d(reach)} * "
                   f"exp({_d(e)} * atanh({_d(e)} * {p}s) - atanh({p}s)) END")],
        [(f"{p}e", f"CAST(floor({_d(UPS_POLE)} + {p}r * sin({p}l)) AS BIGINT)"),
         (f"{p}n", f"CAST(floor({_d(UPS_POLE)} + CASE WHEN {lat} >= 0 THEN -1 ELSE 1 END * {p}r * cos({p}l)) AS BIGINT)")],
        [(f"{p}w", f"{p}e < {UPS_EAST_EASTING}")],
        [(f"{p}c", d.div(f"({p}e - {first})", "100000")), (f"{p}k", d.div(f"({p}n - {low})", "100000"))],
        [(out, f"CASE WHEN {p}on THEN CASE WHEN {lat} >= 0 THEN CASE WHEN {p}w THEN 'Y' ELSE 'Z' END "
               f"ELSE CASE WHEN {p}w THEN 'A' ELSE 'B' END END || "
               f"substr(CASE WHEN {p}w THEN '{UPS_WEST_COLUMNS}' ELSE '{UPS_EAST_COLUMNS}' END, CAST({p}c AS INTEGER) + 1, 1) || "
               f"substr('{UPS_ROWS}', CAST({p}k AS INTEGER) + 1, 1) || "
               f"lpad(CAST({d.div(f'({p}e % 100000)', str(scale))} AS STRING), {digits}, '0') || "
               f"lpad(CAST({d.div(f'({p}n % 100000)', str(scale))} AS STRING), {digits}, '0') END")],
    ]




# -------------------------------------------------------------- hexagons --

def hex_stages(lat: str, lng: str, q_out: str, r_out: str, p: str = "_hx_",
               edge: float = HEX_EDGE_METERS) -> list[Stage]:
    """G-04: pointy-top hexagon (axial q, r) of a point, after projecting to
    the equal-area cylinder ``x = R*lambda, y = R*sin(phi)``; cube rounding
    fixes the component with the largest rounding error."""
    s3 = _d(math.sqrt(3) / 3)
    return [
        [(f"{p}x", f"{_d(HEX_EARTH_RADIUS)} * radians({lng})"),
         (f"{p}y", f"{_d(HEX_EARTH_RADIUS)} * sin(radians({lat}))")],
        [(f"{p}fq", f"({s3} * {p}x - {p}y / 3) / {_d(edge)}"),
         (f"{p}fr", f"({_d(2.0 / 3.0)} * {p}y) / {_d(edge)}")],
        [(f"{p}fs", f"-{p}fq - {p}fr")],
        [(f"{p}rq", f"round({p}fq)"), (f"{p}rr", f"round({p}fr)"), (f"{p}rs", f"round({p}fs)")],
        [(f"{p}dq", f"abs({p}rq - {p}fq)"), (f"{p}dr", f"abs({p}rr - {p}fr)"),
         (f"{p}ds", f"abs({p}rs - {p}fs)")],
        [(q_out, f"CAST(CASE WHEN {p}dq > {p}dr AND {p}dq > {p}ds THEN -{p}rr - {p}rs "
                 f"ELSE {p}rq END AS BIGINT)"),
         (r_out, f"CAST(CASE WHEN {p}dq > {p}dr AND {p}dq > {p}ds THEN {p}rr "
                 f"WHEN {p}dr > {p}ds THEN -{p}rq - {p}rs ELSE {p}rr END AS BIGINT)")],
    ]


def hex_center_stages(d: Dialect, q: str, r: str, lat_out: str, lng_out: str, p: str = "_hc_",
                      edge: float = HEX_EDGE_METERS) -> list[Stage]:
    """G-05: centre (degrees, ``CENTER_DIGITS`` decimals) of hexagon (q, r)."""
    return [
        [(f"{p}x", f"{_d(edge * math.sqrt(3))} * ({q} + {r} / 2.0)"),
         (f"{p}y", f"{_d(edge * 1.5)} * {r}")],
        [(f"{p}lat", f"degrees(asin(least(1.0, greatest(-1.0, {p}y / {_d(HEX_EARTH_RADIUS)}))))"),
         (f"{p}lng", f"degrees({p}x / {_d(HEX_EARTH_RADIUS)})")],
        [(lat_out, d.round_even(f"{p}lat", CENTER_DIGITS)),
         (lng_out, d.round_even(f"{p}lng", CENTER_DIGITS))],
    ]


# ------------------------------------------------------------------ WKT --

def wkt_stages(d: Dialect, lat: str, lng: str, out: str, p: str = "_wk_") -> list[Stage]:
    """G-06: ``POINT (lng lat)`` with Python's shortest text of 5-decimal
    numbers: fixed 5 decimals, trailing zeros cut, ``.0`` kept."""
    def txt(x):
        return (f"regexp_replace(regexp_replace(CAST(CAST({x} AS DECIMAL(9,5)) AS STRING), "
                "'0+$', ''), '[.]$', '.0')")
    return [[(f"{p}lng", txt(lng)), (f"{p}lat", txt(lat))],
            [(out, f"'POINT (' || {p}lng || ' ' || {p}lat || ')'")]]


# -------------------------------------------------------------- running --

STAGES_PER_STATEMENT = 24


def apply_stages(df: DataFrame, stages: list[Stage], keep: list[str] | None = None) -> DataFrame:
    """Run stages as a projection chain on a Spark frame; temporary columns
    (prefix ``_``) are dropped unless listed in ``keep``.

    Stages are applied as SQL statements of nested projections over the
    frame (passed as a parameter, no temporary view), up to
    ``STAGES_PER_STATEMENT`` per statement: the plan is analysed once per
    statement instead of once per stage, and each statement stays within
    the analyzer's iteration limit (one pass per nesting level)."""
    before = set(df.columns)
    out = df
    for start in range(0, len(stages), STAGES_PER_STATEMENT):
        sql = "SELECT * FROM {df}"
        for stage in stages[start:start + STAGES_PER_STATEMENT]:
            cols = ", ".join(f"{expr} AS `{name}`" for name, expr in stage)
            sql = f"SELECT *, {cols} FROM ({sql})"
        out = out.sparkSession.sql(sql, df=out)
    keep = set(keep or [])
    drop = [c for c in out.columns if c not in before and c.startswith("_") and c not in keep]
    return out.drop(*drop)


def duckdb_chain(source: str, stages: list[Stage], prefix: str) -> tuple[str, str]:
    """CTE text for the stages over ``source``; returns (ctes, last name)."""
    parts, prev = [], source
    for i, stage in enumerate(stages):
        name = f"{prefix}{i}"
        cols = ", ".join(f'{expr} AS "{n}"' for n, expr in stage)
        parts.append(f"{name} AS (SELECT *, {cols} FROM {prev})")
        prev = name
    return ",\n".join(parts), prev
