"""Connected components of a link table, by alternating stars.

Every round hangs each node's larger neighbours on the smallest node it
knows (large star), then joins its smaller neighbours to their minimum
(small star), until the links no longer change; they are then stars around
the smallest node of each component. A minimum is taken with partial
aggregation and joined back from a checkpointed table, so that a node with
very many links stays in no single task: both inputs of the join come
straight from exchanges, which adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """links: distinct (a, b) with a > b."""
    if large:
        pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = cut(pairs.groupBy("u").agg(F.min("v").alias("m"))
                .select(F.col("u").alias("k"), F.least("u", "m").alias("m")))
    joined = pairs.join(least, F.col("u") == F.col("k"))
    if large:  # larger neighbours hang on the minimum
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:      # the node and its other smaller neighbours hang on the minimum
        out = joined.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return cut(out.filter("a <> b").distinct())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link to another node;
    component is the smallest node reachable. Null ends and loops link
    nothing; repeated links count once; no links give an empty table."""
    links = cut(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                .filter("a <> b").distinct())
    state = _state(links)
    while state[0]:
        links = _stars(_stars(links, large=True), large=False)
        last, state = state, _state(links)
        if state == last:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cut(links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots))
