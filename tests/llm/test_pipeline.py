"""The corpus pipeline against brute force, and operators on empty tables."""

import random
from collections import Counter


import corpus_pipeline as cp
from test_brute_force import AWKWARD, group_brute, pii_brute, simhash_brute

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = spark.createDataFrame([(9000 + i, t, None, None, 1) for i, t in enumerate(AWKWARD)] * 2, docs.schema)
    docs = docs.unionByName(own)
    steps = {}
    for name, stage in cp.STAGES:
        before, after = docs, cp.written(stage(spark, docs, SF), "test")
        steps[name] = rows(before), rows(after)
        docs = after

    was, now = steps["language ID"]
    letters = [r["doc_id"] for r in was if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(r["doc_id"] for r in now) == sorted(letters) and all(r["lang"] for r in now)

    was, now = steps["SimHash near-dedup"]
    classes = group_brute([(r["doc_id"], simhash_brute(r["text"])) for r in was])
    assert sorted(r["doc_id"] for r in now) == sorted({d for d, _, low in classes if d == low})

    was, now = steps["PII"]
    texts = {r["doc_id"]: r["text"] for r in was}
    for r in now:
        assert not pii_brute(r["text"]) if pii_brute(texts[r["doc_id"]]) else True
        if r["text"] != texts[r["doc_id"]]:
            assert r["n_chars"] == len(r["text"])
        else:
            assert not pii_brute(r["text"])

    was, now = steps["mixing"]
    size = lambda r: len((r["text"] or "").encode().split())
    took, had = Counter(), Counter()
    for r in was:
        had[r["source"]] += size(r)
    for r in now:
        took[r["source"]] += size(r)
    assert max(Counter(r["doc_id"] for r in now).values()) <= 3
    order = sorted(had, key=lambda s: (s is None, s))
    weight, level, total = {s: 1 + i % 3 for i, s in enumerate(order)}, 0.0, sum(had.values())
    for _ in order:
        full = [s for s in order if 3 * had[s] <= weight[s] * level]
        rest = sum(weight[s] for s in order if s not in full)
        level = (total - sum(3 * had[s] for s in full)) / rest if rest else level
    longest = max(size(r) for r in was)
    assert all(abs(took[s] - min(3 * had[s], weight[s] * level)) <= longest for s in order)

    was, now = steps["BPE"]
    assert Counter(r["doc_id"] for r in was) == Counter(r["doc_id"] for r in now)
    assert all(len(r["ids"]) == r["n_tokens"] for r in now)


def test_near_dedup_keeps_rows_not_ids(spark):
    text = {c: " ".join(f"{c}{i * i % 97}" for i in range(60)) for c in "abcdef"}
    given = [(7, text["a"]), (7, text["b"]), (3, text["b"]),      # one id, unlike texts; one of them a copy of a smaller id
             (None, text["c"]), (None, text["c"]), (None, text["d"]), (None, text["b"]),
             (9, text["e"]), (9, text["e"]), (8, text["f"]), (8, None), (None, "")]
    docs = spark.createDataFrame([(d, t, "en", s, 1) for s in ("s", None) for d, t in given],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in rows(cp.keep_one_of_each(spark, docs, SF))), key=str)
    assert got == sorted([(7, text["a"]), (3, text["b"]), (None, text["c"]), (None, text["d"]), (9, text["e"]),
                          (8, text["f"]), (8, None)], key=str)


def test_near_copies_without_ids_link(spark, monkeypatch):
    """Unnamed rows near one another, and near a named one, are one class."""
    from tidewater.llm import simhash
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: docs.select("doc_id", "text").selectExpr(
        "doc_id", "cast(text as bigint) AS fp"))
    docs = spark.createDataFrame([(None, "1"), (None, "3"), (4, "15"), (None, "1023"), (None, "1022"), (5, "255000000")],
                                 "doc_id long, text string")
    got = sorted((r["fingerprint"][-3:], r["component_id"]) for r in rows(simhash.near_duplicates(docs, max_bits=2)))
    assert [c for f, c in got if f in ("001", "003", "00f")] == [4, 4, 4]
    assert [c for f, c in got if f in ("3ff", "3fe")] == [None, None]


def test_empty_tables(spark):
    from tidewater.llm import bpe, chat, langid, license, mixing, pii, queries, rp_forest, simhash
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").limit(0)
    turns = spark.read.parquet(f"{SF}/conversations.parquet").limit(0)
    for df in (license.scan_licenses(docs), simhash.near_duplicates(docs), pii.find_personal_data(docs),
               chat.format_conversations(turns), bpe.encode_documents(docs, queries.vocabulary_path()),
               mixing.mix(docs), rp_forest.near_duplicates(vectors), langid.identify_languages(docs)):
        assert rows(df) == []


def test_chat_round_trips(spark):
    from tidewater.llm import chat
    texts = ["", "[INST]", r"[\INST] <\\s>", "</s><s>[/INST]", "[[/INST]", "a\\", "[ROLE]x[/ROLE]", None, "[/INST"]
    data = [(i % 3, i // 3, role, t, 7) for i, t in enumerate(texts) for role in ("user", "assistant", "[ROLE]</s>", None)]
    got = rows(chat.format_conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted int")))
    assert len(got) == 3 and all(r["identical"] for r in got) and sum(r["n_turns"] for r in got) == len(data)


def test_mix_reruns_agree(spark):
    from tidewater.llm import queries as q
    one, two = (sorted(map(str, rows(q.op7_mixing(spark, SF)))) for _ in range(2))
    assert one == two


def test_stages_on_no_rows_and_clashing_columns(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, copies int, fp long, part long, row_hash long"
    given = [(1, "ein kleiner Satz mit Worten " * 4, "de", "s", 1, "x", 9, 9, 9, 9), (2, None, None, None, None, None, None, None, None, None),
             (None, "another sentence of some words " * 4, "en", None, 1, "x", 9, 9, 9, 9)]
    for data in ([], given):
        docs = spark.createDataFrame(data, shape)
        for name, stage in cp.STAGES:
            out = rows(stage(spark, docs, SF))
            assert (len(out) == 0) == (not data), name
            if out and name != cp.STAGES[-1][0]:
                assert set(out[0]) == set(cp.COLUMNS), name


def test_a_sure_prediction_takes_the_place_of_lang(spark):
    rng = random.Random(3)
    words = {"aa": ["ka", "pa", "ta", "ma"], "oo": ["xo", "zo", "vo", "wo"]}
    data = [(i, " ".join(rng.choice(words[k]) for _ in range(80)), k, "s", 1) for i, k in enumerate(["aa", "oo"] * 60)]
    data += [(1000, data[0][1], "oo", "s", 1), (1001, data[1][1], None, "s", 1), (1002, "12 34", "aa", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["lang"] for r in rows(cp.keep_known_languages(spark, docs, SF))}
    assert got == {d: ("aa" if "a" in t else "oo") for d, t, *_ in data if d != 1002}


def test_mixing_without_ids(spark):
    from tidewater.llm import mixing
    data = [(None, " ".join(["w"] * (1 + i % 7)), "a" if i % 3 else None, 5) for i in range(400)] + [(7, "x y", "a", 5)] * 3
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    got = rows(mixing.mix(docs))
    again = rows(mixing.mix(docs.repartition(5)))
    key = lambda r: (r["source"] or "", r["size"], r["row_hash"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(data)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    for source in ("a", None):
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 7
