"""Fill-in-middle transformation: a text is cut in prefix, middle and suffix
at two seeded places and written as prefix-suffix-middle (psm) or
suffix-prefix-middle (spm), or left as it is (plain).

Places are counted in code points and texts are UTF-8, so a place has to be
turned into a byte. That is done for a slice of texts at once in 64-bit words,
eight bytes each: the bytes that end a code point are marked arithmetically,
the marks of a word counted with ``bitwise_count``, the counts added up; a
place is searched in the cumulative counts, which gives its word, and selected
among the eight marks of that word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SLICE_ROWS, arrow_schema, pick

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_HIGH = np.uint64(0x8080808080808080)
_EACH = np.uint64(0x0101010101010101)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Units:
    """Ranks and places of code points in a buffer of UTF-8 texts."""

    def __init__(self, raw: bytes | np.ndarray):
        size = len(raw)
        padded = np.zeros((size // 8 + 1) * 8, np.uint8)   # at least one byte of padding, which starts a unit
        padded[:size] = np.frombuffer(raw, np.uint8)
        words = padded.view("<u8")
        starts = ~words | (words << np.uint64(1))          # high bit: not 10xxxxxx
        starts &= _HIGH
        following = np.append(starts[1:], _HIGH)
        self.ends = (starts >> np.uint64(8)) | (following << np.uint64(56))
        self.before = np.zeros(len(words) + 1, np.int64)   # units ended before each word
        np.cumsum(np.bitwise_count(self.ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end before the byte offsets ``at``."""
        word, byte = at // 8, (at % 8).astype(np.uint64)
        low = ~(_FULL << (byte * np.uint64(8)))
        return self.before[word] + np.bitwise_count(self.ends[word] & low)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The byte offsets behind the ``ranks``-th units (from 1; 0: offset 0)."""
        word = np.searchsorted(self.before, np.maximum(ranks, 1), side="left") - 1
        within = (np.maximum(ranks, 1) - self.before[word]).astype(np.uint64)
        running = (self.ends[word] >> np.uint64(7)) * _EACH        # byte k: marks in bytes 0 to k
        reached = ((running | _HIGH) - within * _EACH) & _HIGH     # bytes by which that many marks are met
        return np.where(ranks > 0, word * 8 + 9 - np.bitwise_count(reached), 0)


def _transform(schema: pa.Schema, plain_percent: int, spm_percent: int):
    first, last, centre = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

    def rows(part: pa.RecordBatch) -> list[list]:
        texts = pc.fill_null(part.column("text"), "").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = memoryview(data)[offsets[0]:offsets[-1]] if data is not None else memoryview(b"")
        offsets = offsets - offsets[0]
        units = Units(raw)
        ranks = units.rank(offsets)
        n, h = np.diff(ranks), [part.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
        cuts = np.stack([h[0] % (n + 1), h[1] % (n + 1)])
        low, high = cuts.min(axis=0), cuts.max(axis=0)
        at = units.select(ranks[:-1] + low), units.select(ranks[:-1] + high)
        out: list[list] = [[] for _ in range(5)]
        for i in range(len(n)):
            begin, end = int(offsets[i]), int(offsets[i + 1])
            text = bytes(raw[begin:end])
            if not text or first in text or last in text or centre in text or h[2][i] % 100 >= 100 - plain_percent:
                row = [int(n[i]), "plain", None, None, text]
            else:   # a place at rank 0 of the slice is its first byte, any other the end of a unit
                one, two = int(at[0][i]) - begin, int(at[1][i]) - begin
                prefix, middle, suffix = text[:one], text[one:two], text[two:]
                spm = h[3][i] % 100 < spm_percent
                row = [int(n[i]), "spm" if spm else "psm", int(low[i]), int(high[i] - low[i]),
                       b"".join([last, suffix, first, prefix, centre, middle] if spm else
                                [first, prefix, last, suffix, centre, middle])]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                n, form, prefix, middle, output = rows(part)
                columns = [part.column("doc_id"), n, form, prefix, middle, pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema)
    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row.

    n is the text's length in code points. The SHA-256 of ``seed:doc_id``
    gives four numbers: two for the places of the cut, one that leaves
    ``plain_percent`` of the texts plain, one that makes ``spm_percent`` of
    the others spm. Empty texts and texts with a marker in them are plain;
    their prefix_chars and middle_chars are null. Either part may be empty.

    A null text is empty; a null doc_id is written as nothing (``seed:``).
    Repeated rows give the same row again. An empty table gives an empty
    result; other columns are ignored. Reruns agree: nothing depends on the
    order or partition of rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    ddl = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return pick(docs, doc_id="long", text="string").select("doc_id", "text", *numbers) \
        .mapInArrow(_transform(arrow_schema(ddl), plain_percent, spm_percent), ddl)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output of the given form was made of. Every marker
    stands once in an output that is not plain."""
    def behind(marker: str, until: str) -> Column:
        rest = F.split_part(F.col(output), F.lit(marker), F.lit(2))
        return F.split_part(rest, F.lit(until), F.lit(1))

    middle = F.split_part(F.col(output), F.lit(MIDDLE), F.lit(2))
    return F.when(F.col(form) == "psm", F.concat(behind(PREFIX, SUFFIX), middle, behind(SUFFIX, MIDDLE))) \
        .when(F.col(form) == "spm", F.concat(behind(PREFIX, MIDDLE), middle, behind(SUFFIX, PREFIX))) \
        .otherwise(F.col(output))


def digest(made: DataFrame) -> DataFrame:
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


#: The contract's columns in DuckDB, for the production parameters.
ORACLE_SQL = """
WITH hashed AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(CAST(doc_id AS BIGINT) AS VARCHAR), '')) AS h
  FROM documents),
cut AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed),
parts AS (
  SELECT *, substr(text, 1, least(a, b)) AS p, substr(text, least(a, b) + 1, abs(a - b)) AS m,
         substr(text, greatest(a, b) + 1) AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
