"""Embedding near-duplicates by a random-projection tree forest.

Fit: on a bounded sample of vectors, every tree splits the vectors of a
label recursively by their projections on a random direction. Vectors within
a margin of the border go to both sides. The margin is ``spill`` times what
projections of a pair at the threshold differ by (one standard deviation),
so close pairs seldom part, however crowded a place is. Of a few random
directions and borders the one with the smallest halves is taken. A node is
split while it is estimated to hold more than ``leaf_rows`` of all vectors;
a crowd that no split makes smaller is a leaf.

Index: every vector is sent down every tree to its leaves. Within a leaf all
vectors are compared by cosine; a leaf of any size is compared tile by tile
(see ``tiles``), none is capped. Each vector carries its leaves: a pair that
meets in several is counted in the first of them alone, so links are
counted without listing pairs, and each tile yields only a spanning forest
of its links for the components.
"""

from __future__ import annotations

import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_schema, cut, pick
from tidewater.llm.components import components
from tidewater.llm.tiles import by_group, forest, tiled

#: Rows of the sample that trees are fitted on, at most.
FIT_ROWS = 20_000
LEAF_ROWS = 256
#: A node of fewer sampled rows is not split, as its middle would be a guess.
LEAST_SAMPLE = 16
#: Random directions tried for a split.
TRIES = 3


class Node(NamedTuple):
    direction: np.ndarray | None    # None: a leaf
    low: float
    high: float
    left: "Node | None"
    right: "Node | None"
    leaf: int


LEAF = Node(None, 0.0, 0.0, None, None, 0)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_tree(sample: np.ndarray, rows: float, leaf_rows: int, margin: float, rng: np.random.Generator,
             path: int = 1) -> Node:
    """rows: how many of all vectors the sample is estimated to stand for."""
    if rows <= leaf_rows or len(sample) < LEAST_SAMPLE or path >= 1 << 40:
        return LEAF._replace(leaf=path)
    best, least = None, 0.9 * len(sample) ** 2     # pairs that a split leaves to compare
    for _ in range(TRIES):
        direction = unit(rng.standard_normal((1, sample.shape[1])))[0]
        p = sample @ direction
        for border in np.quantile(p, [0.5, 0.35, 0.65, 0.2, 0.8]):
            left, right = p <= border + margin, p >= border - margin
            pairs = int(left.sum()) ** 2 + int(right.sum()) ** 2
            if pairs < least:
                best, least = (direction, border, left, right), pairs
    if best is None:
        return LEAF._replace(leaf=path)
    direction, border, *sides = best
    left, right = (fit_tree(sample[side], rows * side.sum() / len(sample), leaf_rows, margin, rng, 2 * path + k)
                   for k, side in enumerate(sides))
    return Node(direction, float(border - margin), float(border + margin), left, right, path)


def leaves(node: Node, x: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(rows, leaf) of every leaf that rows of x reach."""
    out, todo = [], [(node, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node.direction is None:
            out.append((at, node.leaf))
            continue
        p = x[at] @ node.direction
        todo += [(node.left, at[p <= node.high]), (node.right, at[p >= node.low])]
    return out


def near_duplicates(vectors: DataFrame, least_cosine: float = 0.93, trees: int = 6, spill: float = 0.5,
                    leaf_rows: int = LEAF_ROWS, fit_rows: int = FIT_ROWS, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: the number of
    other rows it links to directly (equal non-null label, cosine at least
    ``least_cosine`` in double precision), the smallest vec_id reachable by
    links, itself included, and whether that is its own.

    Vectors that are null, zero, or hold a null or non-finite component, and
    those with a null label or vec_id, link with nothing: n_links 0, their
    own component. Vectors of unequal length are never compared. Equal
    vectors of a label are one node that counts as many; repeated rows are
    rows of their own. An empty table gives an empty result; other columns
    are ignored. Links above the threshold may be missed (recall is tested
    against brute force); none below it is made.
    """
    rows = pick(vectors, vec_id="long", embedding="array<double>", label="string")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite \
        & F.exists("embedding", lambda x: x != 0)
    # a copy of +0.0 and one of -0.0 are the same vector
    vector = F.transform("embedding", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("able", F.coalesce(able, F.lit(False))) \
        .withColumn("embedding", F.when(F.col("able"), vector)) \
        .withColumn("class", F.when(F.col("able"), F.sha2(F.concat(
            F.col("label"), F.lit("\n"), F.to_json("embedding")).cast("binary"), 256)))
    classes = cut(rows.filter("able").groupBy("class").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding"), F.size(F.first("embedding")).alias("dim")))
    total = classes.count()

    # the sample: the smallest of the hashes that classes are named by
    sample = classes.orderBy("class").limit(fit_rows).select("label", "dim", "embedding").toArrow()
    by_label: dict[tuple, list] = {}
    for at, key in enumerate(zip(sample["label"].to_pylist(), sample["dim"].to_pylist(), strict=True)):
        by_label.setdefault(key, []).append(at)
    share = total / max(1, sample.num_rows)
    model = {}
    for (label, dim), found in sorted(by_label.items()):
        x = unit(np.array(sample["embedding"].take(pa.array(found)).to_pylist(), dtype=np.float64))
        margin = spill * math.sqrt(max(0.0, 2 - 2 * least_cosine) / max(1, dim))
        model[label, dim] = [fit_tree(x, len(x) * share, leaf_rows, margin, np.random.default_rng(
            [seed, t, zlib.crc32(label.encode()), dim])) for t in range(trees)]
    shared = vectors.sparkSession.sparkContext.broadcast(model)   # at most fit_rows / LEAST_SAMPLE * 2 nodes a tree
    lone = [LEAF._replace(leaf=1)]                                # of labels not sampled: one block

    ddl = "node bigint, n bigint, label string, vec binary, codes array<bigint>, leaf bigint"
    schema = arrow_schema(ddl)

    def index(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            dims = batch.column("dim").to_numpy()
            vecs = batch.column("embedding")
            codes: list[list[int]] = [[] for _ in range(n)]
            packed: list[bytes] = [b""] * n
            for label, dim in {*zip(labels, dims.tolist(), strict=True)}:
                at = np.flatnonzero((labels == label) & (dims == dim))
                raw = np.array(vecs.take(pa.array(at)).to_pylist(), dtype=np.float64)
                x = unit(raw)
                for i, row in zip(at, raw, strict=True):
                    packed[i] = _pack(row)
                block = zlib.crc32(f"{label}\n{dim}".encode())
                for t, tree in enumerate(shared.value.get((label, dim), lone)):
                    for members, leaf in leaves(tree, x):
                        # a hashed name; should two clash, compare() tells labels apart
                        code = _code(block, t, leaf)
                        for i in at[members]:
                            codes[i].append(code)
            size = np.array([len(c) for c in codes])
            order = np.repeat(np.arange(n), size)
            columns = [batch.column("node"), batch.column("n"),
                       pa.array([f"{k}\n{d}" for k, d in zip(labels, dims, strict=True)], pa.string()),
                       pa.array(packed, pa.binary()), pa.array([sorted(c) for c in codes], pa.list_(pa.int64()))]
            flat = columns[-1].flatten()
            for lo in range(0, len(order), 8192):
                part = pa.array(order[lo:lo + 8192])
                yield pa.RecordBatch.from_arrays([*(c.take(part) for c in columns), flat.slice(lo, 8192)], schema=schema)

    members = cut(classes.select("node", "n", "label", "dim", "embedding").mapInArrow(index, ddl))

    def compare(batch: pa.RecordBatch, starts: np.ndarray) -> list:
        node, many = batch.column("node").to_numpy(), batch.column("n").to_numpy()
        side, leaf = batch.column("side").to_numpy(), batch.column("leaf").to_numpy()
        cross = batch.column("ta").to_numpy() != batch.column("tb").to_numpy()
        a, b, counts = [], [], []
        for lo, hi in zip(starts, [*starts[1:], len(node)], strict=True):
            labels = np.array(batch.column("label").slice(lo, hi - lo).to_pylist(), dtype=object)
            for at in [np.arange(lo, hi)] if (labels == labels[0]).all() else \
                    [lo + np.flatnonzero(labels == k) for k in sorted(set(labels))]:
                if len(at) < 2:
                    continue
                dim = int(labels[at[0] - lo].rpartition("\n")[2])
                x = unit(_unpack(batch.column("vec").take(pa.array(at)).to_pylist(), dim))
                near = x @ x.T >= least_cosine
                np.fill_diagonal(near, False)
                if cross[lo]:
                    near &= side[at][:, None] != side[at][None, :]
                if not near.any():
                    continue
                i, j = np.nonzero(np.triu(near))
                first = _first_meeting(batch.column("codes").take(pa.array(at)).to_pylist(), leaf[lo], i, j)
                i, j, n = i[first], j[first], many[at]
                child, root = forest(near)
                a += [node[at], node[at][child]]
                b += [node[at], node[at][root]]
                counts += [(np.bincount(i, n[j], len(at)) + np.bincount(j, n[i], len(at))).astype(np.int64),
                           np.zeros(len(child), dtype=np.int64)]
        return [np.concatenate(v) for v in (a, b, counts)] if a else [[], [], []]

    # links of a node to itself carry the counts
    found = cut(by_group(tiled(members, "leaf", "node", 512), "leaf", compare, "a bigint, b bigint, links bigint"))
    counts = found.filter("a = b").groupBy("a").agg(F.sum("links").alias("others"))
    parts = components(found.filter("a <> b").select("a", "b"))
    classes = classes.select("class", "node", "n") \
        .join(counts, F.col("node") == F.col("a"), "left").drop("a") \
        .join(parts.withColumnRenamed("node", "c"), F.col("node") == F.col("c"), "left")
    classes = cut(classes.select(F.col("class").alias("_class"), "node", "component",
                                 (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links")))
    out = rows.select("vec_id", "class").join(classes, F.col("class") == F.col("_class"), "left")
    component = F.coalesce("component", "node", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _pack(row: np.ndarray) -> bytes:
    """In single precision where that loses nothing."""
    single = row.astype("<f4")
    return single.tobytes() if (single == row).all() else row.astype("<f8").tobytes()


def _unpack(rows: list[bytes], dim: int) -> np.ndarray:
    if all(len(r) == 4 * dim for r in rows):
        return np.frombuffer(b"".join(rows), dtype="<f4").reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(r, dtype="<f4" if len(r) == 4 * dim else "<f8").astype(np.float64) for r in rows])


def _code(block: int, tree: int, leaf: int) -> int:
    """A 63-bit name of a leaf."""
    x = (block * 0x9E3779B97F4A7C15 + tree * 0xC2B2AE3D27D4EB4F + leaf * 0x165667B19E3779F9) & (1 << 64) - 1
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    return (x ^ x >> 32) & (1 << 63) - 1


def _first_meeting(codes: list[list[int]], leaf: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the pairs (i, j), which don't meet in a leaf of a smaller code."""
    earlier = [[c for c in own if c < leaf] for own in codes]
    width = max(map(len, earlier))
    if not width:
        return np.ones(len(i), dtype=bool)
    table = np.full((len(codes), width), -1, dtype=np.int64)
    for r, own in enumerate(earlier):
        table[r, :len(own)] = own
    out = np.ones(len(i), dtype=bool)
    for at in range(0, len(i), 65_536):
        left, right = table[i[at:at + 65_536]], table[j[at:at + 65_536]]
        for k in range(width):
            out[at:at + 65_536] &= ~((left[:, k:k + 1] == right) & (left[:, k:k + 1] >= 0)).any(axis=1)
    return out
