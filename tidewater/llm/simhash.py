"""SimHash near-duplicates by a byte-position inverted index.

Fingerprint: each shingle of words is hashed to 64 bits; a bit of the
fingerprint is set if it is set in more than half of the hashes. Two
fingerprints link if they differ in at most ``max_bits`` bits.

Index: a fingerprint is eight bytes, each at its position. A pair that
differs in at most d bits differs in at most d bytes, so it shares at least
8 - d of the eight (position, byte) postings: the guaranteed minimum.
Single-byte postings would each hold 1/256 of the corpus, so the postings
are kept for sets of ``group_bytes`` positions, chosen so that whichever
8 - d positions a pair shares, one of the sets lies within them. A pair that
meets in a posting tallies its shared positional bytes; pairs that reach the
minimum are verified by their differing bits. Candidates are complete: no
pair within the distance is missed, no posting is capped. A large posting
is compared tile by tile (see ``tiles``) and yields only a spanning forest
of its links, not its pairs.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, map_lists, pick
from tidewater.llm.components import components
from tidewater.llm.tiles import by_group, forest, tiled

SEED = 42
#: Hashes whose bits are counted at a time, to bound memory on long texts.
HASH_BLOCK = 1 << 15


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    raw = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return raw.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Of lower-cased (A-Z) words between ASCII white space. A text of fewer
    words than a shingle is one shingle; without words it is zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:   # over half of one hash: the hash itself
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    counts, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for at in range(0, n, HASH_BLOCK):
        part = words[at:at + HASH_BLOCK + shingle - 1]
        joined = map(b" ".join, zip(*[part[i:] for i in range(shingle)]))
        counts += _bits(np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), dtype=np.uint64))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def make():
        def apply(ids, texts):
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            return [ids, fps]
        return apply
    return map_lists(pick(docs, doc_id="long", text="string"), make, "doc_id bigint, fp bigint")


def position_sets(max_bits: int, group_bytes: int) -> list[tuple[int, ...]]:
    """Sets of ``group_bytes`` of the eight byte positions such that every
    8 - max_bits positions hold one of them whole: greedily, the set that
    covers most of what is not yet covered."""
    kept = 8 - max_bits
    if not 1 <= group_bytes <= kept:
        raise ValueError(f"group_bytes must be 1 to {kept} for {max_bits} bits")
    sets = list(combinations(range(8), group_bytes))
    open_ = [set(x) for x in combinations(range(8), kept)]
    out = []
    while open_:
        best = max(sets, key=lambda s: sum(x.issuperset(s) for x in open_))
        out.append(best)
        open_ = [x for x in open_ if not x.issuperset(best)]
    return out


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """Tally of the byte positions in which the two sides of an XOR agree."""
    return (np.ascontiguousarray(x).view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=-1)


def _linked(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then verification, of XORs of fingerprints."""
    out = _shared_bytes(x) >= 8 - max_bits
    out[out] = np.bitwise_count(x[out]) <= max_bits
    return out


def links(prints: DataFrame, max_bits: int = 3, group_bytes: int = 3) -> DataFrame:
    """Distinct (a, b) that connect all fingerprints within the distance
    through chains of links. prints: distinct (fp, node)."""
    postings = []
    for k, places in enumerate(position_sets(max_bits, group_bytes)):
        value = F.lit(k).cast("long")
        for p in places:
            value = value * 256 + F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
        postings.append(value)
    # group_bytes <= 6, so a set's number and its bytes fit in 63 bits
    rows = prints.select("fp", "node", F.explode(F.array(*postings)).alias("posting"))

    def compare(batch: pa.RecordBatch, starts: np.ndarray) -> list:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        node, side = batch.column("node").to_numpy(), batch.column("side").to_numpy()
        cross = batch.column("ta").to_numpy() != batch.column("tb").to_numpy()
        ends = np.append(starts[1:], len(fp))
        size = ends - starts
        group = np.repeat(np.arange(len(starts)), size)
        small = (size[group] <= 4) & ~cross
        a, b = [], []
        for step in (1, 2, 3):   # the few pairs of small groups, all groups at once
            i = np.flatnonzero(small[:-step] & (group[:-step] == group[step:])) if len(fp) > step else []
            if len(i):
                i = i[_linked(fp[i] ^ fp[i + step], max_bits)]
                a.append(node[i])
                b.append(node[i + step])
        for g in np.flatnonzero((size > 4) | cross[starts]):
            s = slice(starts[g], ends[g])
            near = np.zeros((size[g],) * 2, dtype=bool)
            for at in range(0, size[g], 256):
                near[at:at + 256] = _linked(fp[s][at:at + 256, None] ^ fp[s][None, :], max_bits)
            if cross[starts[g]]:
                near &= side[s][:, None] != side[s][None, :]
            child, root = forest(near)
            a.append(node[s][child])
            b.append(node[s][root])
        return [np.concatenate(a), np.concatenate(b)] if a else [[], []]

    return by_group(tiled(rows, "posting", "fp"), "posting", compare, "a bigint, b bigint")


def _classes(prints: DataFrame, max_bits: int, group_bytes: int) -> DataFrame:
    """(_fp, part, component_id) of every fingerprint: part names its class,
    component_id is the smallest doc_id of it, null where it has none."""
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # one doc_id may stand in rows of unlike texts, and a row may have none;
    # so the graph's nodes are fingerprints and doc_ids join them after
    joined = components(links(nodes.select("fp", F.col("fp").alias("node")), max_bits, group_bytes))
    classes = cut(nodes.join(joined, nodes["fp"] == joined["node"], "left")
                  .select(nodes["fp"], "least", F.coalesce("component", nodes["fp"]).alias("part")))
    least = cut(classes.groupBy("part").agg(F.min("least").alias("component_id")))
    return cut(classes.join(least, "part").select(F.col("fp").alias("_fp"), "part", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, group_bytes: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of documents:
    the fingerprint as 16 lowercase hex digits, the smallest doc_id reachable
    by links.

    Null, empty and blank texts have fingerprint zero and link like any
    other. Equal fingerprints are one node, so copies are never expanded into
    pairs. Repeated rows each give a row. A row with a null doc_id links like
    any other; where its class has no doc_id the component is null. An empty
    table gives an empty result; other columns are ignored.
    """
    prints = cut(fingerprints(docs, shingle))
    return prints.join(_classes(prints, max_bits, group_bytes), F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, columns: list[str], shingle: int = 3, max_bits: int = 3,
                group_bytes: int = 3) -> DataFrame:
    """One row of each class, in the given columns (doc_id and text among
    them): the smallest by doc_id, nulls last, then by a hash of the row.
    Rows are known by two hashes of all their columns, so neither rows that
    share a doc_id nor rows without one are confused."""
    flagged = [x for c in columns for x in (F.col(c), F.col(c).isNull())]   # hashes skip nulls
    rows = docs.select(*columns, F.xxhash64(*flagged).alias("_h1"), F.xxhash64(F.lit(1), *flagged).alias("_h2"))

    def make():
        return lambda ids, texts, h1, h2: [
            ids, np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64), h1, h2]

    prints = cut(map_lists(rows.select("doc_id", "text", "_h1", "_h2"), make,
                           "doc_id bigint, fp bigint, _h1 bigint, _h2 bigint"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_h1", "_h2")
    # least by fingerprint, then by class: both are partial aggregates
    least = prints.groupBy("fp").agg(F.min(place).alias("row"))
    kept = least.join(_classes(prints, max_bits, group_bytes), F.col("fp") == F.col("_fp")) \
        .groupBy("part").agg(F.min("row").alias("row")).select("row._h1", "row._h2")
    return rows.dropDuplicates(["_h1", "_h2"]).join(kept, ["_h1", "_h2"], "left_semi").select(*columns)
