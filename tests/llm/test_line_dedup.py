"""Line dedup against sets of documents per line."""

from collections import defaultdict

import pytest
from test_brute_force import AWKWARD

from tidewater.llm import line_dedup as ld

DDL = "doc_id long, text string, line string, holder int, batch int"
LONG = "this line is long enough, surely"


def brute(data, least_chars=20, least_docs=3):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    at = lambda d: -1 << 63 if d is None else d
    held = defaultdict(set)
    for doc, text in data:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(at(doc))
    out = []
    for doc, text in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < least_docs or at(doc) == max(held[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def awkward():
    texts = AWKWARD + [f"{LONG}\n{i}\n  {LONG.upper()}\t\n" for i in range(9)]
    texts += ["É" + LONG, "é" + LONG] * 3 + [f"\x0b{LONG} two \f\n\n{'x' * 19}\n{'é' * 20}\n{LONG} two\r" for _ in range(5)]
    texts += ["\n".join([LONG, "own %d" % i, LONG + " %d" % (i % 2)] * 50) for i in range(8)] + ["x" * 19] * 4
    data = [(i * 7 % 31, t) for i, t in enumerate(texts)]              # some doc_ids have several rows
    data += data[:4] + [(None, f"{LONG}\n{'n' * 30}"), (None, "n" * 30), (1, "n" * 30), (None, f"{LONG}\n{'n' * 30}"),
                        (100, "pair of two documents only"), (101, "pair of two documents only")]
    return data


@pytest.mark.parametrize(("batches", "fan"), [(1, 2), (4, 2), (7, 3)])
def test_against_sets(spark, batches, fan):
    data = awkward()
    docs = spark.createDataFrame([(d, t, "clash", 1, 2) for d, t in data], DDL).repartition(3)
    assert result(ld.drop_repeated_lines(docs, batches=batches, fan=fan)) == brute(data)


def test_other_bounds_and_no_rows(spark):
    data = awkward()
    docs = spark.createDataFrame([(d, t, "clash", 1, 2) for d, t in data], DDL)
    assert result(ld.drop_repeated_lines(docs, least_chars=3, least_docs=2)) == brute(data, 3, 2)
    assert ld.drop_repeated_lines(docs.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "\n")], "doc_id long, text string")
    assert result(ld.drop_repeated_lines(blank)) == [(1, 1, 0, ""), (2, 1, 0, ""), (3, 2, 0, "\n")]


def test_runs_are_levelled_and_joined_without_exchange(spark, capsys):
    runs = ld.LineRuns(spark, fan=2)
    for batch in range(6, 0, -1):
        rows = [(bytes([k]), batch) for k in range(batch, 7)]
        runs.add(spark.createDataFrame(rows, "line binary, doc long"))
    assert [len(level) for level in runs.levels] == [2, 0, 1]
    kept = [r["line"] for run in runs.runs() for r in run.collect()]
    assert sorted(kept) == [bytes([k]) for k in range(1, 7)]            # every line in one run
    got = {r["line"][0]: r["holder"] for r in runs.repeated(3).collect()}
    assert got == {k: k for k in range(3, 7)}
    new = spark.table(runs.levels[0][0])
    for run in runs.runs():
        new = new.join(run.hint("merge"), "line", "left_anti")
    new.explain()
    assert "Exchange" not in capsys.readouterr().out
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]
