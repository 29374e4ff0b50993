"""Licence scans by a positional rare-token index.

Templates are short licence passages of plain words. The index posts every
template word with the templates and the positions in which it stands. Over
all documents it counts in how many each licence word occurs; the rarer, the
higher its IDF. A template whose passage must agree in at least m of its T
words is looked up by its T - m + 1 highest-IDF words: one of them must
stand in its place in any passage that agrees in m (by the pigeonhole
principle), so the lookup of a file's rare licence words misses nothing.
Each hit proposes where the template starts in the file; the postings of the
other words are intersected with that place by relative position, which
gives the share of words that agree. Then the template's mandatory key
phrases must stand word for word inside the aligned passage.

A base phrase is a template that must agree in all words and is its own key
phrase, so it is looked up by its single rarest word.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_lists, pick

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
        "mit license": "mit"}

#: The method's own templates: label, passage, share of words that must
#: agree, and mandatory key phrases. Well-known opening sentences.
TEMPLATES = [
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without "
     "restriction", 0.8, ["hereby granted free of charge", "without restriction"]),
    ("apache-2.0", "licensed under the apache license version 2 0", 0.8, ["apache license", "2 0"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", 0.8,
     ["gnu general public license", "version 3"]),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms "
     "of the gnu general public license as published by the free software foundation", 0.8,
     ["free software", "general public license"]),
    ("lgpl", "gnu lesser general public license", 1.0, ["lesser general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met", 0.8, ["source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", 0.8,
     ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", 0.8, ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", 0.8, ["cc by sa"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", 0.8,
     ["public domain"]),
]

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Template(NamedTuple):
    label: str
    words: tuple[str, ...]
    least: int                      # words that must agree
    keys: tuple[tuple[str, ...], ...]
    base: bool


def templates() -> list[Template]:
    out = [Template(label, tuple(p.split()), len(p.split()), (tuple(p.split()),), True)
           for p, label in BASE.items()]
    for label, passage, share, keys in TEMPLATES:
        words = tuple(passage.split())
        out.append(Template(label, words, math.ceil(share * len(words)),
                            tuple(tuple(k.split()) for k in keys), False))
    return out


def words_of(text: str | None) -> list[str]:
    """Words of the text with A-Z lower-cased; null is empty."""
    # of bytes, lower() changes A-Z alone
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if text else []


def document_frequencies(docs: DataFrame, known: list[Template]) -> tuple[int, dict[str, int]]:
    """The number of all documents, and of those that hold each licence word
    (partly counted by task; as many rows as templates have words)."""
    vocabulary = frozenset(w for t in known for w in t.words)

    def make():
        def apply(texts):
            held = [sorted(vocabulary.intersection(words_of(t))) for t in texts]
            return [held]
        return apply

    held = map_lists(pick(docs, text="string"), make, "words array<string>")
    counts = {r["word"]: r["n"] for r in
              held.select(F.explode_outer("words").alias("word")).groupBy("word")
              .agg(F.count("*").alias("n")).collect()}
    total = pick(docs, doc_id="long").count()
    counts.pop(None, None)
    return total, counts


class Index(NamedTuple):
    known: list[Template]
    vocabulary: frozenset
    rare: dict[str, list[tuple[int, int]]]    # word -> (template, position), rare words only
    idf: dict[str, float]


def build_index(known: list[Template], total: int, counts: dict[str, int]) -> Index:
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for t in known for w in t.words}
    rare: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(known):
        order = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], t.words[i], i))
        for i in order[:len(t.words) - t.least + 1]:
            rare.setdefault(t.words[i], []).append((k, i))
    return Index(known, frozenset(idf), rare, idf)


def _phrase_in(words: list[str], phrase: tuple[str, ...], lo: int, hi: int) -> bool:
    return any(tuple(words[i:i + len(phrase)]) == phrase for i in range(lo, hi - len(phrase) + 1))


def scan(words: list[str], index: Index) -> list[tuple[int, int, float]]:
    """(template, start word, share of words that agree) of each verified
    passage; all places, the best share of a place kept."""
    places = {i: w for i, w in enumerate(words) if w in index.vocabulary}
    tried, out = set(), []
    for i, w in places.items():
        for k, at in index.rare.get(w, ()):
            start, t = i - at, index.known[k]
            if start < 0 or (k, start) in tried:
                continue
            tried.add((k, start))
            agree = sum(places.get(start + j) == x for j, x in enumerate(t.words))
            lo, hi = start, min(len(words), start + len(t.words))
            if agree >= t.least and all(_phrase_in(words, p, lo, hi) for p in t.keys):
                out.append((k, start, agree / len(t.words)))
    return sorted(out)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, passages) for every row: n_base counts all places of base phrases,
    first_word and last_word are their smallest and largest start (null if
    none); labels are distinct, sorted and comma-joined; score is the largest
    share of template words that agree, 0 without a passage; passages lists
    ``label:start``.

    Null and empty texts have no words and no labels. A passage that begins
    before the text does is none. Repeated rows and null doc_ids each give a
    row. An empty table gives an empty result; other columns are ignored.
    """
    known = templates()
    total, counts = document_frequencies(docs, known)

    def make():
        index = build_index(known, total, counts)

        def apply(ids, texts):
            cols: list[list] = [[] for _ in range(9)]
            for doc, text in zip(ids, texts, strict=True):
                words = words_of(text)
                hits = scan(words, index)
                base = [s for k, s, _ in hits if known[k].base]
                label = lambda pick: ",".join(sorted({known[k].label for k, _, _ in hits if pick(known[k])}))
                row = [doc, len(words), len(base), min(base, default=None), max(base, default=None),
                       label(lambda t: t.base), label(lambda t: True),
                       max((x for _, _, x in hits), default=0.0),
                       [f"{known[k].label}:{s}" for k, s, _ in hits]]
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            return cols
        return apply

    return map_lists(pick(docs, doc_id="long", text="string"), make,
                     "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                     "base_labels string, labels string, score double, passages array<string>")
