"""Fill-in-middle against code point arithmetic on Python strings."""

import hashlib
import random

import numpy as np
from test_brute_force import AWKWARD

from tidewater.llm import fim

DDL = "doc_id long, text string, form string, output string, n string"
MORE = ["<P>", "a<S>b", "<M", "<<P", "ends with <", "S>", "é", "漢字かな交じり文" * 400, "😀" * 9, "é" * 50, "a" * 8, "b" * 16,
        "\x00" * 9, "x\x80y"] + [f"text {i} {'é' * (i % 9)}" for i in range(600)]


def brute(doc_id, text, seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return (doc_id, n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}")


def test_against_strings(spark):
    data = [(i * 7, t, "clash", "clash", "clash") for i, t in enumerate(AWKWARD + MORE)]
    data += data[:30] + [(None, "without an id", "", "", ""), (None, None, None, None, None)]
    got = fim.fill_in_middle(spark.createDataFrame(data, DDL).repartition(3))
    rows = [tuple(r) for r in got.collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(rows, key=key) == sorted((brute(d[0], d[1]) for d in data), key=key)
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}
    texts = {(d[0], d[1] or "") for d in data}
    back = got.select("doc_id", fim.restored().alias("text")).collect()
    assert {tuple(r) for r in back} == texts and len(back) == len(data)
    assert fim.fill_in_middle(spark.createDataFrame([], DDL)).collect() == []


def test_ranks_and_places():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("aé漢😀\x00") for _ in range(rng.randrange(40)))
        units = fim.Units(text.encode())
        places = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
        ranks = np.arange(len(text) + 1)
        assert (units.rank(places) == ranks).all() and (units.select(ranks) == places).all()
