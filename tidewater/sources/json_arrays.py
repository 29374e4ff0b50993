"""Scans of JSON array text within a task, for ``topics.read_json_array_split``.

The rows are pieces of text, each up to and with a closing brace, those of one
``(file, split)`` together and in order. Only quotes and brackets are looked
at: a byte is in a string if an odd number of quotes stands before it, and a
report ends at a closing brace after which one bracket, the array's, is open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text looked at together, unless one piece is longer.
CHUNK_BYTES = 4 << 20

_STEP = np.zeros(256, np.int64)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_MARK = _STEP != 0
_MARK[ord('"')] = True

PROFILE = "file string, split long, quotes long, deeper array<long>, levels array<array<long>>, ends array<array<long>>"
REPORTS = "file string, number long, split long, value string, ended boolean, whole boolean"
_REPORTS = pa.schema([("file", pa.string()), ("number", pa.int64()), ("split", pa.int64()), ("value", pa.string()),
                      ("ended", pa.bool_()), ("whole", pa.bool_())])
_PROFILE = pa.schema([("file", pa.string()), ("split", pa.int64()), ("quotes", pa.int64()), ("deeper", pa.list_(pa.int64())),
                      ("levels", pa.list_(pa.list_(pa.int64()))), ("ends", pa.list_(pa.list_(pa.int64())))])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, np.ndarray]]:
    """``(place, rows, bytes)``: rows of one file and split, their text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split, value = batch.column("file"), batch.column("split"), batch.column("value")
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(split[1:], split[:-1]))
        starts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        at = np.frombuffer(value.buffers()[1], np.int32)[value.offset:value.offset + len(value) + 1]
        text = np.frombuffer(value.buffers()[2], np.uint8) if value.buffers()[2] else np.empty(0, np.uint8)
        for begin, end in zip(starts, starts[1:]):
            while begin < end:
                upto = max(begin + 1, min(end, int(np.searchsorted(at, at[begin] + CHUNK_BYTES, "right")) - 1))
                yield (file[begin].as_py(), split[begin].as_py()), batch.slice(begin, upto - begin), text[at[begin]:at[upto]]
                begin = upto


def _marks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and bytes of the quotes that are not escaped and the brackets,
    and how many quotes stand up to each."""
    at = np.flatnonzero(_MARK[text])
    byte = text[at]
    slash = text == ord("\\")
    if slash.any():
        other = np.maximum.accumulate(np.where(slash, -1, np.arange(len(text))))   # the last byte that is no backslash
        run = np.where(at > 0, at - 1 - other[at - 1], 0)
        kept = (byte != ord('"')) | (run % 2 == 0)
        at, byte = at[kept], byte[kept]
    return at, byte, np.cumsum(byte == ord('"'))


def _depths(byte: np.ndarray, quotes: np.ndarray, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Brackets open after each mark, and where a brace closes outside strings."""
    out = (quotes + inside) % 2 == 0
    return depth + np.cumsum(np.where(out, _STEP[byte], 0)), out & (byte == ord("}"))


def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its quotes and, if it begins outside a string and if
    inside one, the brackets it leaves open and how many braces close at each
    level, counted from where the split begins."""
    place, quotes, depth, closed = None, 0, [0, 0], ({}, {})

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{
            "file": place[0], "split": place[1], "quotes": quotes, "deeper": depth,
            "levels": [list(c) for c in closed], "ends": [list(c.values()) for c in closed]}], schema=_PROFILE)

    for here, _, text in _chunks(batches):
        if here != place:
            if place is not None:
                yield row()
            place, quotes, depth, closed = here, 0, [0, 0], ({}, {})
        _, byte, count = _marks(text)
        if len(byte):
            for side in (0, 1):
                after, close = _depths(byte, count, (quotes + side) % 2, depth[side])
                for level, n in zip(*np.unique(after[close], return_counts=True)):
                    closed[side][int(level)] = closed[side].get(int(level), 0) + int(n)
                depth[side] = int(after[-1])
            quotes += int(count[-1])
    if place is not None:
        yield row()


def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each report, or the part of it that its split holds: with
    its number in the file, whether it ends here and whether it is whole.
    ``quotes``, ``depth`` and ``number`` say how the split begins."""
    place, inside, depth, number, begun, rest = None, 0, 0, 0, True, []

    def rows(texts: pa.Array, ended: bool) -> pa.RecordBatch:
        n = len(texts)
        whole = np.full(n, ended)
        whole[:1] &= begun
        return pa.RecordBatch.from_arrays(
            [pa.array([place[0]]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.arange(number, number + n)),
             pa.array(np.full(n, place[1])), texts, pa.array(np.full(n, ended)), pa.array(whole)], schema=_REPORTS)

    def left() -> Iterator[pa.RecordBatch]:
        if rest:
            yield rows(pa.array([b"".join(rest)], pa.binary()).view(pa.string()), False)

    for here, chunk, text in _chunks(batches):
        if here != place:
            yield from left()
            place, rest = here, []
            inside, depth, number = (chunk.column(c)[0].as_py() for c in ("quotes", "depth", "number"))
            begun = here[1] == 0 or (depth == 1 and inside % 2 == 0)
        at, byte, count = _marks(text)
        if not len(at):
            rest.append(text.tobytes())
            continue
        after, close = _depths(byte, count, inside % 2, depth)
        ends = at[close & (after == 1)] + 1
        inside, depth = (inside + int(count[-1])) % 2, int(after[-1])
        if len(ends):
            head = b"".join(rest)
            data = head + text[:ends[-1]].tobytes()
            places = np.concatenate([[0], ends + len(head)]).astype(np.int32)
            yield rows(pa.StringArray.from_buffers(len(ends), pa.py_buffer(places), pa.py_buffer(data)), True)
            number, begun, rest = number + len(ends), True, []
            text = text[ends[-1]:]
        if len(text):
            rest.append(text.tobytes())
    yield from left()
