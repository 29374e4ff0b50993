"""Exact top-k search by inner product, in tiles.

Queries are dealt into blocks and candidates into shards by a hash, both of
bounded size; a tile is one block against one shard. Every tile is one
matrix product with a partial selection of each query's k best; the partial
lists are then merged per query up a tree of shards, ``fan_in`` lists at a
time, so that no task holds more than a few lists of a query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, pick

QUERY_ROWS = 4096
SHARD_ROWS = 4096


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ids ascend.
    Scores of minus infinity take no part."""
    k = min(k, int((scores > -np.inf).sum()))
    if not k:
        return np.zeros(0, dtype=int)
    border = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > border)
    level = np.flatnonzero(scores == border)[:k - len(above)]
    places = np.concatenate([above, level])
    return places[np.lexsort((ids[places], -scores[places]))]


def _matrix(column: pd.Series, scale: float) -> np.ndarray:
    return np.floor(scale * np.stack([np.asarray(x, dtype=np.float64) for x in column]))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0,
          query_rows: int = QUERY_ROWS, shard_rows: int = SHARD_ROWS, fan_in: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible
    by ``every``, the k rows of another vec_id with the highest inner product
    of components turned into floor(scale * x).

    Ties go to the smaller vec_id. Fewer candidates give fewer rows. Vectors
    that are null or hold a null or non-finite component, and rows with a
    null vec_id, take no part; only vectors of equal length are compared.
    Each of repeated rows is a candidate (a vec_id then takes several ranks)
    of every query but those of its own vec_id; as queries they are one. Unlike
    vectors of one vec_id are each a query and a candidate. An empty table gives an empty result; other columns are
    ignored. Scores are exact below 2**53.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = cut(pick(vectors, vec_id="long", embedding="array<double>")
               .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
               .groupBy("vec_id", "embedding").agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
               .withColumn("dim", F.size("embedding")).withColumn("h", F.xxhash64("vec_id", "embedding")))
    asked = F.pmod("vec_id", F.lit(every)) == 0
    n, q = rows.agg(F.count("*"), F.count_if(asked)).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(q / query_rows))
    all_shards, all_blocks = (F.explode(F.sequence(F.lit(0), F.lit(x - 1))) for x in (shards, blocks))
    queries = rows.filter(asked).withColumn("block", F.pmod("h", F.lit(blocks)).cast("int")) \
        .withColumn("shard", all_shards)
    candidates = rows.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int")) \
        .withColumn("block", all_blocks)

    def tile(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame(columns=["query_id", "h", "shard", "found"], dtype=object)
        candidates = candidates.sort_values("c_id", kind="stable")
        ids, copies = candidates["c_id"].to_numpy(), candidates["c_copies"].to_numpy()
        matrix = _matrix(candidates["c_vec"], scale)
        asked = _matrix(queries["q_vec"], scale)
        out = []
        for at in range(0, len(queries), 512):
            scores = asked[at:at + 512] @ matrix.T
            for row, (query, h) in zip(scores, queries[["q_id", "h"]].to_numpy()[at:at + 512], strict=True):
                row[np.searchsorted(ids, query, "left"):np.searchsorted(ids, query, "right")] = -np.inf
                places = best(row, ids, k)
                found = [{"s": -int(row[p]), "i": int(ids[p])} for p in places for _ in range(copies[p])]
                out.append((query, h, found[:k]))
        frame = pd.DataFrame(out, columns=["query_id", "h", "found"])
        frame["shard"] = int(candidates["c_shard"].iloc[0])
        return frame[["query_id", "h", "shard", "found"]]

    def named(df: DataFrame, side: str) -> DataFrame:   # the two sides share no column
        return df.select(*[F.col(c).alias(f"{side}_{n}") for c, n in (
            ("dim", "dim"), ("block", "block"), ("shard", "shard"), ("vec_id", "id"), ("embedding", "vec"))],
            F.col("h").alias("h") if side == "q" else F.col("copies").alias("c_copies"))

    lists = named(queries, "q").groupBy("q_dim", "q_block", "q_shard").cogroup(
        named(candidates, "c").groupBy("c_dim", "c_block", "c_shard")).applyInPandas(
        tile, "query_id bigint, h bigint, shard int, found array<struct<s:bigint,i:bigint>>")
    while True:
        shards = math.ceil(shards / fan_in)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in)).groupBy("query_id", "h", "shard").agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
        if shards == 1:
            break
    return lists.select("query_id", F.posexplode("found").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"),
        (-F.col("x.s")).alias("score"))


#: The contract in DuckDB.
ORACLE_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e AS query, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""
