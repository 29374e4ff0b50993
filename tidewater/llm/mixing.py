"""Mixing sources to target weights by capped water-filling, in DataFrame
functions only.

Water-filling: every open source gets its weight's share of what the clamped
ones leave; a source whose share exceeds its cap (``max_epochs`` times its
size) is clamped there, and the rest is shared again, until no share exceeds
its cap. Sources are rows of a table; each round sends two sums to the
driver, never a source.

Sampling: a source's target is so many whole repetitions of all its
documents and a fraction of one. The fraction is a seeded sample: the
documents in the order of a seeded hash, as long as their running size, up to
the document's middle, stays within the rest of the target. The order is cut
into buckets by the hash: what lies before a bucket is summed over bucket
sizes, and the running size of single documents inside their bucket, so no
task ever holds a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut, pick

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the hash that name a bucket: 4,096 buckets a source.
BUCKET_DIGITS = 3


def seeded_hash(seed: int, *columns: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """Adds ``target`` to sources (size, weight): shares of the total size by
    weight, none above ``max_epochs`` times its size. All sizes zero: zero."""
    sources = sources.withColumn("cap", F.col("size") * F.lit(max_epochs))
    total = sources.agg(F.sum("size").alias("s")).first()["s"] or 0
    level, clamped = 0.0, -1
    while True:   # the level only rises, so a clamped source stays clamped
        closed = F.col("cap") <= F.col("weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(closed, F.col("cap")).otherwise(0.0)).alias("caps"),
                          F.sum(F.when(closed, 0).otherwise(F.col("weight"))).alias("open"),
                          F.count_if(closed).alias("n")).first()
        if not row["open"] or row["n"] == clamped:
            break
        clamped, level = row["n"], (total - row["caps"]) / row["open"]
    return sources.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.lit(float(level))))


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: float = 3.0, seed: int = 7) -> DataFrame:
    """(doc_id, source, row_hash, size, source_size, target, copies, taken)
    for every row of documents: size in words between ASCII white space, the
    size and target of its source, how often the mix takes the document, and
    the words it takes.

    Sources are ordered by code point, null last, and weigh ``weights``,
    repeating. A null text has size 0. Documents of size 0 are taken as their
    source's fraction falls. Repeated rows are documents of their own; where
    their hashes tie, any one of them is taken first, which is the same
    result. All texts empty: targets and takes are 0. An empty table gives an
    empty result; other columns are ignored. Reruns agree.
    """
    rows = cut(pick(docs, doc_id="long", source="string", text="string").select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("row_hash"),
        seeded_hash(seed, "doc_id").alias("order")))
    rows = rows.withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))

    # one row a source; they are put in order once, for their weights
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(int(w)) for w in weights])
    buckets = cut(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")))
    sources = cut(buckets.groupBy("source").agg(F.sum("size").alias("size"))
                  .withColumn("weight", F.element_at(listed, F.pmod(number, F.lit(len(weights))) + 1)))
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0))
    sources = water_fill(sources, max_epochs) \
        .withColumn("whole", F.least(F.floor(ratio), F.lit(int(max_epochs))).cast("long")) \
        .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("size"), F.lit(0.0)))
    sources = cut(sources.select(F.col("source").alias("s"), F.col("size").alias("source_size"),
                                 "target", "whole", "rest"))

    # of each source: what lies before each of its buckets
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("bucket")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cut(buckets.withColumn("before", before).join(sources, F.col("source").eqNullSafe(F.col("s")))
                 .select("s", F.col("bucket").alias("b"), "before", "source_size", "target", "whole", "rest"))

    dealt = rows.join(placed, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    order = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size", "row_hash")
    running = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    extra = (F.col("rest") > 0) & (running - F.col("size") / 2 <= F.col("rest"))
    out = dealt.withColumn("copies", F.col("whole") + F.when(extra, 1).otherwise(0))
    return out.select("doc_id", "source", "row_hash", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


#: The contract's columns in DuckDB, for the production parameters.
ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, source, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         CAST(sum(size) AS DOUBLE) * 3.0 AS cap
  FROM sized GROUP BY source),
fill(step, level, n) AS (
  SELECT 0, CAST(0 AS DOUBLE), -1
  UNION ALL
  SELECT step + 1, (SELECT CASE WHEN sum(CASE WHEN cap <= weight * level THEN 0 ELSE weight END) = 0 THEN level ELSE
                    ((SELECT sum(source_size) FROM src) - sum(CASE WHEN cap <= weight * level THEN cap ELSE 0.0 END))
                    / sum(CASE WHEN cap <= weight * level THEN 0 ELSE weight END) END FROM src),
         (SELECT CAST(count(*) FILTER (cap <= weight * level) AS INTEGER) FROM src)
  FROM fill WHERE step = 0 OR n < (SELECT count(*) FILTER (cap <= weight * level) FROM src)),
tgt AS (
  SELECT s.*, least(cap, weight * (SELECT level FROM fill ORDER BY step DESC LIMIT 1)) AS target FROM src s),
rep AS (
  SELECT *, least(CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END, 3) AS whole FROM tgt),
run AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, greatest(r.target - r.whole * r.source_size, 0.0) AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id ROWS UNBOUNDED PRECEDING) AS running
  FROM sized d JOIN rep r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN rest > 0 AND running - size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS taken
FROM run"""
