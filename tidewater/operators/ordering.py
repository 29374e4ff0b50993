"""Skew-safe ordered computations: row numbers, lags and running totals.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key in one
task; with no key at all (a global order) everything lands in one task. The
helpers here cut the order twice by plain arithmetic on the order columns:

* a segment holds one value of the leading order column and one block of
  65,536 values of the next one, so rows that tie on a time are split by
  their offset. (An order of one column is cut into blocks of its values.)
* a span holds the segments of one minute (65,536 values of a number).

Rows meet only within their (key, segment). What earlier segments contribute
(row counts, last row, running total) is added up over the segment table
within each (key, span), then over the span table, which has one row a minute.

Segments are a pure function of the row, so the two reads of the input (the
rows and their segment table) always agree, also when a stage is recomputed
after an executor loss, and no job runs before the query's own action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = "_seg"
SPAN = "_span"
BLOCK = 65_536
SPAN_SECONDS = 60

_FOLDS = {"sum": F.sum, "max": F.max, "last": F.last}


def _cols(order: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _block(c: Column, dtype: str, seconds: int = 1) -> Column:
    """A column of the order cut into ranges; NULL stays NULL, the first."""
    if dtype.startswith("timestamp"):
        return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
    if dtype == "date":
        return F.unix_date(c).cast("long")
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return F.floor(c / F.lit(BLOCK)).cast("long")
    return F.lit(0).cast("long")


def segmented(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Tag each row with its (key, segment) and (key, span), as structs: they
    compare like their fields, a NULL key equal to itself."""
    cols = _cols(order)
    types = [f.dataType.simpleString() for f in df.select(*[c.alias(f"o{i}") for i, c in enumerate(cols)]).schema]
    key = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    if len(cols) > 1:
        lead, cut = cols[0], [cols[0].alias("a"), _block(cols[1], types[1]).alias("b")]
        span = _block(lead, types[0], SPAN_SECONDS)
    else:
        block = _block(cols[0], types[0])
        cut = [block.alias("a")]
        span = F.floor(block / F.lit(BLOCK)).cast("long")
    return df.withColumns({SEG: F.struct(*key, *cut), SPAN: F.struct(*key, span.alias("s"))})


def _join_folds(how: str, earlier: Column, later: Column) -> Column:
    if how == "sum":     # NULLs add nothing; NULL only until the first value
        return F.coalesce(earlier + later, later, earlier)
    return F.greatest(earlier, later) if how == "max" else F.coalesce(later, earlier)


def before_segments(rows: DataFrame, keys: list[str], value: Column, how: str = "sum") -> DataFrame:
    """One row per segment of ``segmented`` rows: ``_own``, the aggregate
    ``value`` over its rows, and ``_before``, the fold of ``_own`` over the
    earlier segments of its key (NULL for the first)."""
    fold = _FOLDS[how]
    inside = Window.partitionBy(SPAN).orderBy(SEG)
    segs = rows.groupBy(SPAN, SEG).agg(value.alias("_own")) \
        .withColumn("_upto", fold("_own").over(inside.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumns({"_in": F.lag("_upto").over(inside), "_next": F.lead(SEG).over(inside)})
    # the last segment of a span holds the span's total: the same exchange again
    ends = segs.where(F.col("_next").isNull()).select(
        F.col(SPAN).alias("_at"), F.col("_upto"), *[F.col(f"{SPAN}.k{i}").alias(f"_k{i}") for i in range(len(keys))])
    across = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_at") \
        .rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_at", fold("_upto").over(across).alias("_start"))
    return segs.join(starts, segs[SPAN] == starts["_at"]).select(
        SEG, "_own", _join_folds(how, F.col("_start"), F.col("_in")).alias("_before"))


def _with_before(rows: DataFrame, segs: DataFrame) -> DataFrame:
    """Rows with what comes before their segment."""
    return rows.drop(SPAN).join(segs.drop("_own"), SEG)


def row_number(df: DataFrame, keys: list[str], order: list, out: str = "rn") -> DataFrame:
    """1-based row number of each row within its key (or globally when
    ``keys`` is empty) in ``order``; ``order`` must be a total order."""
    rows = segmented(df, keys, order)
    here = Window.partitionBy(SEG).orderBy(*_cols(order))
    return _with_before(rows, before_segments(rows, keys, F.count(F.lit(1)))) \
        .withColumn(out, F.coalesce("_before", F.lit(0)) + F.row_number().over(here)).drop(SEG, "_before")


def lag(df: DataFrame, keys: list[str], order: list, cols: list[str], prefix: str = "prev_") -> DataFrame:
    """Previous row's ``cols`` within the key (or globally) in ``order``;
    NULL for the first row. The first row of a segment takes the last row of
    the key's nearest earlier segment."""
    rows = segmented(df, keys, order)
    row = F.struct(*cols)
    segs = before_segments(rows, keys, F.max_by(row, F.struct(*_cols(order))), "last")
    here = Window.partitionBy(SEG).orderBy(*_cols(order))
    joined = _with_before(rows, segs).withColumn("_prev", F.coalesce(F.lag(row).over(here), F.col("_before")))
    return joined.withColumns({f"{prefix}{c}": F.col(f"_prev.{c}") for c in cols}).drop(SEG, "_before", "_prev")


def running(df: DataFrame, keys: list[str], order: list, value: Column | str, out: str,
            how: str = "sum", at_most: Column | None = None) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` up to and including each row,
    within the key (or globally) in ``order``. With ``at_most`` only rows
    whose result is at most that (of a sum that never falls): segments that
    start beyond it are left out before their rows are put in order."""
    v = F.col(value) if isinstance(value, str) else value
    rows = segmented(df.withColumn("_v", v), keys, order)
    segs = before_segments(rows, keys, _FOLDS[how]("_v"), how)
    if at_most is not None:
        segs = segs.where(F.col("_before").isNull() | (F.col("_before") <= at_most))
    here = Window.partitionBy(SEG).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    done = _with_before(rows, segs).withColumn(
        out, _join_folds(how, F.col("_before"), _FOLDS[how]("_v").over(here))).drop(SEG, "_v", "_before")
    return done if at_most is None else done.where(F.col(out) <= at_most)
