"""Cross-tokenizer alignment: which tokens of one tokenizer cover the same
text as which tokens of another.

Sparse matrices in compressed rows, built by hand, over the texts of a block:

* tokens x bytes for either tokenizer (A, B). The row products of A Bᵀ are
  the *overlap links*: pairs of tokens with bytes in common. Where a link
  differs from the one before it in both tokens, both tokens ended at the same
  byte, so the links also cut the text into *groups*.
* (text, A id) x groups and groups x B ids. Their row products are the
  *shared-group links* by text and pair of ids, with how often they occur; no
  pair of occurrences is ever listed.

How many texts of the corpus hold an id pair linked is a count over all of
them. A block (a bounded stretch of texts, in one row) keeps its products as a
compressed matrix of texts x its distinct pairs. The pairs are counted over
all blocks, and each block is sent the counts of its own pairs once, whichever
of its texts hold them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SLICE_ROWS, arrow_schema, pick, written

#: A block ends with the text that reaches one of these.
BLOCK_BYTES, BLOCK_TEXTS = 8 << 20, 8192
#: Products expanded at a time, unless one row alone has more.
EXPANDED = 1 << 22
#: Characters of chunks whose ids a task keeps.
KEPT_CHARS = 2 << 20
# Fixed value: the pattern of byte-level pre-tokenization.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of which libraries may know different Unicode versions.
_RARE = re.compile("[^\\x00-\u052f]")
_CUT = re.compile(r"(?<=\S)(?= [\s\S])")
#: An id pair is one number: A's id above these bits, B's id in them.
ID_BITS = 31


# sparse matrices

@dataclass
class Rows:
    """A matrix in compressed rows: row i has ``data`` at the columns
    ``indices``, both from indptr[i] to indptr[i + 1]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Rows:
        """Ones at the given places; places named again add up."""
        key, data = np.unique(row * columns + column, return_counts=True)
        indptr = np.zeros(rows + 1, np.int64)
        np.cumsum(np.bincount(key // max(columns, 1), minlength=rows), out=indptr[1:])
        return cls(indptr, key % max(columns, 1), data)

    @property
    def row(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def _stretches(size: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of consecutive rows that add up to ``most``, or of one row."""
    total = np.cumsum(size)
    at, done = 0, 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield slice(at, end)
        at, done = end, int(total[end - 1])


def row_products(a: Rows, b: Rows, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries (row, column, value) of a times b, by rows and columns: for
    each entry of a row of a, that row of b times it, equal columns summed."""
    size = np.diff(b.indptr)[a.indices]                    # what each entry of a expands to
    by_row = np.add.reduceat(np.append(size, 0), a.indptr[:-1]) * (np.diff(a.indptr) > 0) if len(a.indptr) > 1 else size[:0]
    out = []
    for part in _stretches(by_row, EXPANDED):
        entry = slice(a.indptr[part.start], a.indptr[part.stop])
        n = size[entry]
        shift = np.repeat(b.indptr[a.indices[entry]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else n
        take = np.arange(n.sum()) + shift
        row = np.repeat(np.arange(part.start, part.stop), by_row[part])
        key = row * columns + b.indices[take]
        value = np.repeat(a.data[entry], n) * b.data[take]
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
        out.append((key[first] // columns, key[first] % columns, np.add.reduceat(value, first) if len(first) else value))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, none)


# tokens

def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the character of its number if
    that is printable and not a blank; the others as 256, 257 and so on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, for one task: ids of texts and the bytes of ids.

    A text with a space before it is cut into chunks, each of which begins
    with a space that follows no blank and is not the last character. Neither tokenizer has a token across
    such a place (A's pattern takes no blank after anything else; in B's
    pieces nothing comes before a blank but blanks), so the ids of a text are
    those of its chunks, and each chunk is encoded once while it is kept. With
    files of which that is not known, a text is one chunk.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True             # their strings in a text are plain text
        self._a.no_truncation()
        self._a.no_padding()
        self._b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_alphabet()
        self.bytes_a = [b""] * (1 + max(self._a.get_vocab().values()))
        for entry, at in self._a.get_vocab().items():
            if all(c in letters for c in entry):
                self.bytes_a[at] = bytes(letters[c] for c in entry)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # an id with what may follow it, for the digest: 3 * id + (0 ',', 1 '|', 2 ';')
        self.written = [f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in ",|;"]
        split = json.loads(self._a.to_str())
        apart = split["normalizer"] is None and split["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self._cuts = apart and not any("▁" in p.lstrip("▁") for p in pieces)
        self._ranked = self._by_rank(split) if self._cuts else None
        self._known: dict[str, tuple[bytes, bytes] | None] = {}
        self._old: dict[str, tuple[bytes, bytes] | None] = {}
        self._chars = 0

    def _by_rank(self, file: dict):
        """A as an encoder by rank, several times faster, if the file lists
        its merges in the order of the ids they make; else None."""
        import tiktoken

        ids = file["model"]["vocab"]
        made = [ids["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in file["model"]["merges"]]
        special = {t["id"] for t in file["added_tokens"]}
        ranks = {b: i for i, b in enumerate(self.bytes_a) if b and i not in special}
        if made != sorted(made) or len(ranks) != 256 + len(made) or min(made) != 256:
            return None
        return tiktoken.Encoding("ranked", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _apart(self, chunks: list[str]) -> None:
        """Learn chunks one by one."""
        ids_a = [e.ids for e in self._a.encode_batch(chunks, add_special_tokens=False)]
        ids_b = self._b.encode([c[1:] for c in chunks], num_threads=1)
        for chunk, a, b in zip(chunks, ids_a, ids_b, strict=True):
            same = b"".join(map(self.bytes_a.__getitem__, a)) == chunk.encode() == b"".join(map(self.bytes_b.__getitem__, b))
            self._known[chunk] = (array("i", a).tobytes(), array("i", b).tobytes()) if same else None

    def _together(self, chunks: list[str]) -> bool:
        """Learn common chunks as one text; False if their bytes do not come
        back or a token stands across two of them."""
        text = "".join(chunks)
        raw, sides = text.encode(), []
        stops = np.cumsum([len(c.encode()) for c in chunks])
        for ids, table, size in ((self._ranked(text), self.bytes_a, self.size_a),
                                 (self._b.encode(text[1:]), self.bytes_b, self.size_b)):
            if b"".join(map(table.__getitem__, ids)) != raw:
                return False
            ids = np.array(ids, np.int32)
            ends = np.cumsum(size[ids])
            at = np.searchsorted(ends, stops)
            if (ends[at] != stops).any():
                return False
            cuts = (4 * np.concatenate(([0], at + 1))).tolist()
            held = ids.tobytes()
            sides.append([held[x:y] for x, y in zip(cuts, cuts[1:], strict=False)])
        self._known.update(zip(chunks, zip(*sides, strict=True), strict=True))
        return True

    def _learn(self, chunks: list[str]) -> None:
        common = [c for c in chunks if not _RARE.search(c)] if self._ranked else []
        if common and not self._together(common):
            common = []
        if len(common) < len(chunks):
            self._apart([c for c in chunks if c not in self._known])
        self._chars += sum(map(len, chunks))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B for each text; none where there is no text or the
        bytes of either differ from a space and the text."""
        if self._chars > KEPT_CHARS:   # what is asked for again comes back from the old ones
            self._old, self._known, self._chars = self._known, {}, 0
        cut = [(_CUT.split(" " + t) if self._cuts else [" " + t]) if t else [] for t in texts]
        new = {c for chunks in cut for c in chunks} - self._known.keys()
        again = new & self._old.keys()
        for c in again:
            self._known[c] = self._old[c]
            self._chars += len(c)
        if len(new) > len(again):
            self._learn(sorted(new - again))
        out = []
        for chunks in cut:
            found = [self._known[c] for c in chunks]
            if None in found:
                found = []
            out.append(tuple(np.frombuffer(b"".join(x), np.int32).astype(np.int64)
                             for x in (zip(*found, strict=True) if found else ((), ()))))
        return out


def align(tokens: list[tuple[np.ndarray, np.ndarray]], pair: Pair) -> dict:
    """The alignment of some texts: per text n_a, n_b, n_overlaps, n_groups,
    n_links and the digest of its groups; (text, id pair, occurrences) of its
    links, by text and pair."""
    n = len(tokens)
    n_a = np.array([len(a) for a, _ in tokens], np.int64)
    n_b = np.array([len(b) for _, b in tokens], np.int64)
    ids_a, ids_b = (np.concatenate([t[k] for t in tokens] or [[]]).astype(np.int64) for k in (0, 1))
    text_a, text_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)

    # all texts of the list follow one another; both sides of a text have the same bytes
    size_a, size_b = pair.size_a[ids_a], pair.size_b[ids_b]
    bytes_, ones = int(size_a.sum()), np.ones(int(size_a.sum()), np.int64)
    a_bytes = Rows(np.concatenate(([0], np.cumsum(size_a))), np.arange(bytes_), ones)
    bytes_b = Rows(np.arange(bytes_ + 1), np.repeat(np.arange(len(ids_b)), size_b), ones)
    one, other, _ = row_products(a_bytes, bytes_b, max(len(ids_b), 1))

    # both tokens of a link are others than those of the link before: a group begins
    begins = np.append(True, (one[1:] != one[:-1]) & (other[1:] != other[:-1]))[:len(one)]
    group = np.cumsum(begins) - 1
    group_a, group_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    group_a[one], group_b[other] = group, group
    groups = int(begins.sum())
    group_text = text_a[one[begins]]

    # (text, A id) x groups, groups x B ids
    key, row = np.unique(text_a * (1 << ID_BITS) + ids_a, return_inverse=True)
    wide = len(pair.bytes_b)
    held = Rows.of(row, group_a, len(key), max(groups, 1))
    holds = Rows.of(group_b, ids_b, groups, wide)
    entry, id_b, times = row_products(held, holds, wide)
    text = key[entry] >> ID_BITS
    id_pair = ((key[entry] & ((1 << ID_BITS) - 1)) << ID_BITS) | id_b

    in_a, in_b = (np.bincount(g, minlength=groups) for g in (group_a, group_b))
    return {"n_a": n_a, "n_b": n_b, "n_overlaps": np.bincount(text_a[one], minlength=n),
            "n_groups": np.bincount(group_text, minlength=n),
            "n_links": np.bincount(group_text, weights=in_a * in_b, minlength=n).astype(np.int64),
            "groups_sha256": _digests(pair, n_a + n_b, ids_a, ids_b, group_a, group_b, in_a, in_b),
            "text": text, "pair": id_pair, "times": times}


def _digests(pair: Pair, size: np.ndarray, ids_a, ids_b, group_a, group_b, in_a, in_b) -> list[str]:
    """SHA-256 of the written groups of each text, '' without tokens."""
    before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    last = lambda g: np.append(g[1:] != g[:-1], True)[:len(g)]   # noqa: E731  the last token of its group and side
    marks = np.empty(len(ids_a) + len(ids_b), np.int64)
    marks[np.arange(len(ids_a)) + before_b[group_a]] = 3 * ids_a + last(group_a)
    marks[np.arange(len(ids_b)) + (before_a + in_a)[group_b]] = 3 * ids_b + 2 * last(group_b)
    out, at = [], 0
    for n in size.tolist():
        text = "".join(map(pair.written.__getitem__, marks[at:at + n].tolist()))
        out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if n else "")
        at += n
    return out


# blocks

def _packed(numbers: np.ndarray) -> bytes:
    """Integers of at least 0, small in most places: their four or eight byte
    planes, compressed."""
    wide = "<u4" if not len(numbers) or numbers.max() < 1 << 32 else "<u8"
    planes = numbers.astype(wide).view(np.uint8).reshape(-1, int(wide[2])).T
    return wide[2].encode() + len(numbers).to_bytes(8, "little") + \
        pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    width, n = int(raw[:1]), int.from_bytes(raw[1:9], "little")
    planes = pa.Codec("zstd").decompress(raw[9:], decompressed_size=n * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(f"<u{width}")[:, 0].astype(np.int64)


_PER_TEXT = ("n_a", "n_b", "n_overlaps", "n_groups", "n_links")
_BLOCK = "block bigint, doc_id array<bigint>, " + "".join(f"{c} array<bigint>, " for c in _PER_TEXT) + \
    "groups_sha256 array<string>, pairs array<bigint>, texts array<bigint>, entries binary, times binary"
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_overlaps bigint, n_groups bigint, n_links bigint, " \
    "n_best bigint, count_sum bigint, groups_sha256 string"


def _blocks(path_a: str, path_b: str):
    schema = arrow_schema(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b)
        task = TaskContext.get().partitionId() << 32   # stored with the block, so only unlike within this frame
        parts: list[dict] = []
        ids: list[int | None] = []
        size = made = 0

        def block() -> pa.RecordBatch:
            shift = np.cumsum([0] + [len(p["n_a"]) for p in parts])
            text = np.concatenate([p["text"] + s for p, s in zip(parts, shift, strict=False)])
            pairs, place, texts = np.unique(np.concatenate([p["pair"] for p in parts]), return_inverse=True, return_counts=True)
            key = text * len(pairs) + place   # rising: by text, then pair
            columns = [[task + made], [ids], *[[np.concatenate([p[c] for p in parts])] for c in _PER_TEXT],
                       [sum((p["groups_sha256"] for p in parts), [])], [pairs], [texts],
                       [_packed(np.diff(key, prepend=0))], [_packed(np.concatenate([p["times"] for p in parts]))]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = part.column("text").to_pylist()
                parts.append(align(pair.encode(texts), pair))
                ids += part.column("doc_id").to_pylist()
                size += sum(len(t) for t in texts if t)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_TEXTS:
                    yield block()
                    parts, ids, size, made = [], [], 0, made + 1
        if ids:
            yield block()
    return run


def _scored(block: pa.Table, counts: pa.Table, schema: pa.Schema) -> pa.Table:
    """The rows of a block's texts, given the counts of all its pairs."""
    out = []
    order = np.argsort(counts.column("pair").to_numpy())
    docs = counts.column("docs").to_numpy()[order]
    best = counts.column("best").to_numpy()[order].astype(np.int64)
    for row in block.to_batches():
        for i in range(row.num_rows):
            one = row.slice(i, 1)
            at = {c: one.column(c) for c in one.schema.names}
            n = len(at["doc_id"].flatten())
            key, times = np.cumsum(_unpacked(at["entries"][0].as_py())), _unpacked(at["times"][0].as_py())
            text, place = (key // len(docs), key % len(docs)) if len(docs) else (key, key)

            def add(values, text=text, n=n):   # whole numbers, whatever their size
                total = np.zeros(n, np.int64)
                np.add.at(total, text, values)
                return total
            out.append(pa.Table.from_arrays(
                [at["doc_id"].flatten(), *[at[c].flatten() for c in _PER_TEXT], pa.array(add(times * best[place])),
                 pa.array(add(times * docs[place])), at["groups_sha256"].flatten()],
                schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many texts each linked id pair stands, and
    whether that is the highest of its A id."""
    pairs = blocks.select(F.explode(F.arrays_zip("pairs", "texts")).alias("x")) \
        .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.texts").alias("docs")) \
        .withColumn("id_a", F.shiftright("pair", ID_BITS))
    highest = pairs.groupBy("id_a").agg(F.max("docs").alias("highest"))
    return pairs.join(highest, "id_a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_overlaps, n_groups, n_links, n_best, count_sum,
    groups_sha256) for every row of documents: a space and the text in the
    byte-level tokenizer of ``path_a``, the text in the SentencePiece model of
    ``path_b``, which puts the space itself. Both files are on every executor.

    Byte offsets at which tokens of both end cut the text into groups; every A
    token of a group is linked to every B token of it. An id pair counts in how
    many rows it is linked; n_best are the links whose pair has the highest
    count of its A id (ties included), count_sum is the sum of all links'
    counts. groups_sha256 is the SHA-256 of the ids, ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and those that either tokenizer does not give back
    (normalised characters), have no tokens: zeros, and '' for the digest.
    Strings of special tokens are plain text. Repeated rows and rows of one or
    no doc_id each count and give a row. An empty table gives an empty result;
    other columns are ignored.
    """
    blocks = written(pick(docs, doc_id="long", text="string").mapInArrow(_blocks(path_a, path_b), _BLOCK), "alignment")
    asked = blocks.select(F.col("block").alias("asking"), F.explode("pairs").alias("pair"))
    answers = asked.join(pair_counts(blocks), "pair").select("asking", "pair", "docs", "best")
    schema = arrow_schema(_RESULT)
    return blocks.drop("pairs", "texts").groupBy("block").cogroup(answers.groupBy("asking")) \
        .applyInArrow(lambda block, counts: _scored(block, counts, schema), _RESULT)
