"""Alignment of two tokenizers against lists of tokens and loops."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from test_brute_force import AWKWARD

from tidewater.llm import align
from tidewater.llm import queries as q

SF = "/root/testdata/sf0.001"
MORE = ["<|endoftext|> plain <s> </s> <unk> <0x41>", "漢字 かな 😀😀 é \x00 \x07", "▁ is a mark", "ﬁ ligature", "a b",
        "  two  blanks  ", "tab\tand\nline\r\n", "=" * 3000, "0123456789" * 50, "ĠĠ Ċ ¡", "the the the the", "zz the",
        "supercalifragilisticexpialidocious", "ありがとう" * 30, "x" * 20000, "  　 wide"]


@pytest.fixture(scope="module")
def paths():
    return [q.vocabulary_path(p) for p in q.ALIGNED]


def byte_letters():
    from tokenizers import pre_tokenizers
    letters = sorted(pre_tokenizers.ByteLevel.alphabet(), key=ord)   # printable ones stand for themselves
    plain = [c for c in letters if ord(c) < 256]
    rest = [b for b in range(256) if chr(b) not in plain]
    return {c: ord(c) for c in plain} | dict(zip([c for c in letters if ord(c) >= 256], rest, strict=True))


def brute(paths, texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=paths[1])
    letters = byte_letters()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if p.startswith("<0x") else p.replace("▁", " ").encode()

    found, holders = [], defaultdict(set)
    for at, text in enumerate(texts):
        groups = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            parts = ([bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]])
            if b"".join(parts[0]) == b"".join(parts[1]) == (" " + text).encode():
                ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
                both = set(ends[0]) & set(ends[1])
                for k in (0, 1):
                    at_group, group = 0, []
                    for i, e in zip(ids[k], ends[k], strict=True):
                        group.append(i)
                        if e in both:
                            if k == 0:
                                groups.append((group, []))
                            else:
                                groups[at_group][1].extend(group)
                            at_group, group = at_group + 1, []
        for x, y in groups:
            for i in set(x):
                for j in set(y):
                    holders[i, j].add(at)
        found.append(groups)
    highest = defaultdict(int)
    for (i, _), h in holders.items():
        highest[i] = max(highest[i], len(h))
    out = []
    for groups in found:
        links = [(i, j) for x, y in groups for i in x for j in y]
        counts = [len(holders[p]) for p in links]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(c == highest[i] for c, (i, _) in zip(counts, links, strict=True)), sum(counts),
                    hashlib.sha256(written.encode()).hexdigest() if written else ""))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def result(df):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in df.collect()), key=key)


def test_query(spark, paths):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = [(d, *row) for (d, _), row in zip(docs, brute(paths, [t for _, t in docs]), strict=True)]
    assert result(q.op12_align(spark, SF)) == sorted(want)


def test_awkward_rows_in_small_blocks(spark, paths, monkeypatch):
    texts = AWKWARD + MORE + AWKWARD[5:9]
    data = [(None if i % 7 == 3 else i % 20, t, "clash", 5) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, "doc_id long, text string, block string, pairs int").repartition(3)
    want = [(d[0], *row) for d, row in zip(data, brute(paths, texts), strict=True)]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert result(align.align_tokenizers(frame, *paths)) == sorted(want, key=key)
    assert any(w[1] == 0 for w in want) and any(w[6] for w in want)
    assert align.align_tokenizers(frame.limit(0), *paths).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert result(align.align_tokenizers(blank, *paths)) == [(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2)]


def test_row_products(monkeypatch):
    rng = np.random.default_rng(5)
    for most in (1, 7, 1 << 22):
        monkeypatch.setattr(align, "EXPANDED", most)
        for _ in range(30):
            x, y = (rng.integers(0, 3, s) * rng.integers(0, 2, s) for s in ((6, 5), (5, 7)))
            def rows(m):
                return align.Rows.of(*(np.repeat(i, m[m > 0]) for i in np.nonzero(m)), *m.shape)
            row, column, value = align.row_products(rows(x), rows(y), 7)
            got = np.zeros((6, 7), int)
            got[row, column] = value
            assert (got == x @ y).all() and (value > 0).all()
            assert (np.diff(row * 7 + column) > 0).all()


def test_blocks_of_any_size(paths, monkeypatch):
    """Cut in blocks of few texts, the same tokens give the same entries."""
    pair = align.Pair(*paths)
    rng = random.Random(2)
    texts = ["".join(rng.choice(["the ", "x", "é", " 漢", "ing"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    whole = align.align(pair.encode(texts), pair)
    parts = [align.align(pair.encode(texts[i:i + 9]), pair) for i in range(0, 40, 9)]
    for column in ("n_a", "n_overlaps", "n_groups", "n_links", "pair", "times"):
        assert whole[column].tolist() == np.concatenate([p[column] for p in parts]).tolist()
    assert align._unpacked(align._packed(np.array([], np.int64))).tolist() == []
    for numbers in ([0, 5, 2 ** 31], [2 ** 40, 0, 1]):
        assert align._unpacked(align._packed(np.array(numbers, np.int64))).tolist() == numbers


def test_chunks_have_the_ids_of_whole_texts(paths):
    pair = align.Pair(*paths)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "the", "'s", "'", " '", "1", "23", "é", "漢", "😀", "\xa0", "\x1c", "\x85", "́",
             "-", "=", "<s>", "▁", "ing", "\r\n", "ﬁ", "​", "\x00"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        want = pair._a.encode(" " + text, add_special_tokens=False).ids, pair._b.encode(text)
        raw = [b"".join(table[i] for i in ids) for table, ids in zip((pair.bytes_a, pair.bytes_b), want, strict=True)]
        want = want if raw == [(" " + text).encode()] * 2 else ([], [])
        a, b = pair.encode([text])[0]
        assert (a.tolist(), b.tolist()) == tuple(want), repr(text)
