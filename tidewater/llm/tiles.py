"""Comparison inside blocks, whatever their size.

A block is a set of members that share a key (an index posting, a tree
leaf). A block of more than ``tile_rows`` members is cut into tiles by a
hash, and each pair of tiles is a group of its own, so that a group never
holds more than about two tiles and a hot block is compared by many tasks.
Groups arrive sorted in Arrow batches; no group is ever split by a batch
border, as the last one is carried over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_schema, cut, spread

TILE_ROWS = 1024


def tiled(members: DataFrame, key: str, item: str, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Members dealt out by (key, ta, tb), sorted; ``side`` is 0 for tile ta
    and 1 for tile tb (always 0 when the two are the same). Adds the columns
    ``ta``, ``tb``, ``side``."""
    hot = cut(members.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > tile_rows)
              .select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / tile_rows).cast("int").alias("_tiles")))
    rows = members.join(hot, F.col(key) == F.col("_hot"), "left") \
        .withColumn("_tiles", F.coalesce("_tiles", F.lit(1))) \
        .withColumn("_own", F.pmod(F.xxhash64(item), F.col("_tiles")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    rows = rows.select(*members.columns, F.least("_own", "_other").alias("ta"),
                       F.greatest("_own", "_other").alias("tb"),
                       (F.col("_own") > F.col("_other")).cast("int").alias("side"))
    return spread(rows, key, "ta", "tb").sortWithinPartitions(key, "ta", "tb", "side", item)


def by_group(rows: DataFrame, key: str, compare: Callable[[pa.RecordBatch, np.ndarray], list],
             ddl: str) -> DataFrame:
    """``compare(batch, starts)`` gets whole groups: a batch and the first
    row of each group; it returns the output columns."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            out = compare(batch, _starts(batch, key))
            if len(out[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _starts(batch, key)
            first = _key(batch, 0, key)
            if held and first != last:
                yield from whole(held)
                held = []
            border = int(starts[-1])
            if len(starts) > 1:   # what precedes the last group is whole now
                held.append(batch.slice(0, border))
                yield from whole(held)
                held = []
            held.append(batch.slice(border))
            last = _key(batch, batch.num_rows - 1, key)
        yield from whole(held)

    return rows.mapInArrow(run, ddl)


def _key(batch: pa.RecordBatch, at: int, key: str) -> tuple:
    return tuple(batch.column(c)[at].as_py() for c in (key, "ta", "tb"))


def _starts(batch: pa.RecordBatch, key: str) -> np.ndarray:
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for c in (key, "ta", "tb"):
        v = batch.column(c).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a symmetric link matrix: (member, root) for each
    member that is not a root, one row fewer than a component has members."""
    left = np.ones(len(linked), dtype=bool)
    child, root = [], []
    for start in range(len(linked)):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            found = np.flatnonzero(linked[todo].any(axis=0) & left)
            left[found] = False
            child.append(found)
            root.append(np.full(len(found), start))
            todo = found.tolist()
    return (np.concatenate(child), np.concatenate(root)) if child else (np.zeros(0, int), np.zeros(0, int))
