"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered, 0 the worst. One weight vector over hashed text features
is shared by all grades; ordered thresholds cut its score into grades::

    P(grade <= k) = sigmoid(threshold_k - weights . features)

which gives the expected grade and the tail probability of a grade or
better, by which documents are selected. Features of a chunk between white
space are its lower-cased letters and digits, and its shape (runs of
capitals, small letters, digits and other characters); counts are damped by
a logarithm and scaled to one length. One more feature is the share of chunks
that repeat the one before. Trained here in numpy.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import islice
from operator import eq
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Kept, map_lists, pick

BITS = 18
#: The place of the share of repeated chunks, after the hashed features.
REPEATED = 1 << BITS
#: Length of a document's vector of hashed features.
SCALE = 3.0
#: Features that fewer of the fitted documents have get no weight; of few
#: documents one more than a twentieth has to do.
LEAST_DOCS = 10
SHAPE_CHARS = 64
#: Rated documents that the classifier is fitted on, at most.
FIT_DOCS = 12_000
#: Chunks whose features a task keeps.
KEPT_CHUNKS = 400_000
_CORE = re.compile(r"[^\W_]+")
_SHAPES = [(re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() else "a"), (re.compile(r"\d+"), lambda m: "0")]
_REPEAT = re.compile(r"(.)\1+")


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray    # ascending


def features_of(chunk: str) -> tuple[int, ...]:
    """Hashed features of one chunk: a shape for each 64 characters of it,
    and its words."""
    out = []
    for at in range(0, len(chunk), SHAPE_CHARS):
        shape = chunk[at:at + SHAPE_CHARS]
        for pattern, mark in _SHAPES:
            shape = pattern.sub(mark, shape)
        out.append("s:" + _REPEAT.sub(r"\1", shape))
    out += ["w:" + w for w in _CORE.findall(chunk.lower())]
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) >> 32 - BITS for x in out)


def vector(text: str | None, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a whole text's features; none for an empty one."""
    chunks = text.split() if text else []
    tally: Counter = Counter()
    for chunk, n in Counter(chunks).items():
        for f in known[chunk]:
            tally[f] += n
    at = np.fromiter(tally.keys(), dtype=np.int64, count=len(tally))
    x = np.log1p(np.fromiter(tally.values(), dtype=np.float64, count=len(tally)))
    x *= SCALE / max(1e-12, float(np.sqrt(x @ x)))
    if chunks:   # the share of chunks that repeat the one before, damped
        again = sum(map(eq, chunks, islice(chunks, 1, None))) / len(chunks)
        at, x = np.append(at, REPEATED), np.append(x, np.sqrt(again))
    return at, x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def tails(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ...; (scores, grades - 1)."""
    return _sigmoid(scores[:, None] - thresholds[None, :])


def train(vectors: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, epochs: int = 15,
          rate: float = 0.6, decay: float = 3e-4, batch: int = 64, seed: int = 3) -> Model:
    """AdaGrad on the mean negative log likelihood. The thresholds are the
    first and the exponentials of the gaps after it, so they stay ordered."""
    rng = np.random.default_rng(seed)
    size = REPEATED + 1
    w, seen_w = np.zeros(size), np.full(size, 1e-6)
    common = np.bincount(np.concatenate([at for at, _ in vectors]), minlength=size) >= min(LEAST_DOCS, 1 + len(vectors) // 20)
    vectors = [(at[common[at]], x[common[at]]) for at, x in vectors]
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades)) / len(grades), 0.01, 0.99)[:-1]
    start = np.log(share / (1 - share))
    scale = np.bincount(grades, minlength=n_grades) / len(grades)
    scale = np.sqrt(1 / np.maximum(scale, 1e-3) / n_grades)      # rare grades weigh more
    cuts = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    seen_c = np.full(len(cuts), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(grades))
        for part in np.array_split(order, -(-len(order) // batch)):
            gaps = np.exp(cuts[1:])
            theta = np.concatenate([[-np.inf], cuts[0] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
            score = np.array([w[vectors[i][0]] @ vectors[i][1] for i in part])
            y = grades[part]
            hi, lo = _sigmoid(theta[y + 1] - score), _sigmoid(theta[y] - score)
            mass = np.maximum(hi - lo, 1e-9)
            d_hi, d_lo = -hi * (1 - hi) / mass, lo * (1 - lo) / mass     # of the loss, by the two thresholds
            d_hi, d_lo = d_hi * scale[y], d_lo * scale[y]
            d_score = -(d_hi + d_lo)
            d_theta = np.zeros(n_grades + 1)
            np.add.at(d_theta, y + 1, d_hi)
            np.add.at(d_theta, y, d_lo)
            d_theta = d_theta[1:-1] / len(part)
            at = np.concatenate([vectors[i][0] for i in part])
            g = np.concatenate([vectors[i][1] * d for i, d in zip(part, d_score, strict=True)]) / len(part)
            places, back = np.unique(at, return_inverse=True)
            g = np.bincount(back, g, len(places)) + decay * w[places]
            seen_w[places] += g * g
            w[places] -= rate * g / np.sqrt(seen_w[places])
            later = np.cumsum(d_theta[::-1])[::-1]      # a gap moves all thresholds after it
            d_cuts = np.concatenate([later[:1], later[1:] * gaps])
            seen_c += d_cuts * d_cuts
            cuts -= 0.3 * rate * d_cuts / np.sqrt(seen_c)
    return Model(w, cuts[0] + np.concatenate([[0], np.cumsum(np.exp(cuts[1:]))]))


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of rated documents: 0 toxic, 1 of low quality, 2 of
    high quality. A null toxic counts as not toxic, a null quality as low;
    with both null a row rates nothing. Of several ratings the lowest holds."""
    rated = pick(labels, doc_id="long", quality="int", toxic="int") \
        .filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    grade = F.when(F.coalesce("toxic", F.lit(0)) != 0, 0).when(F.coalesce("quality", F.lit(0)) == 0, 1).otherwise(2)
    return rated.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, graded: DataFrame, n_grades: int = 3, fit_docs: int = FIT_DOCS) -> Model | None:
    """Fitted on the ``fit_docs`` rated documents that come first by a hash;
    only their features reach the driver. Ratings of documents that are not
    there take no place among them. None without a rated text."""
    there = pick(docs, doc_id="long").withColumnRenamed("doc_id", "d")
    drawn = graded.join(there, F.col("doc_id") == F.col("d"), "left_semi") \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
    rows = pick(docs, doc_id="long", text="string").join(
        drawn.withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d")).select("grade", "text")

    def make():
        known = Kept(features_of, KEPT_CHUNKS)

        def apply(grades, texts):
            vectors = [vector(t, known) for t in texts]
            return [grades, [v[0].astype(np.int32).tobytes() for v in vectors], [v[1].astype(np.float32).tobytes() for v in vectors]]
        return apply

    found = map_lists(rows, make, "grade int, places binary, amounts binary").toPandas()
    if not len(found):
        return None
    # in one order, whatever the partitions
    found = found.assign(key=[bytes(p) for p in found["places"]]).sort_values(["grade", "key"], kind="stable")
    vectors = [(np.frombuffer(p, dtype=np.int32).astype(np.int64), np.frombuffer(x, dtype=np.float32).astype(np.float64))
               for p, x in zip(found["places"], found["amounts"], strict=True)]
    return train(vectors, found["grade"].to_numpy(), n_grades)


def classify(docs: DataFrame, graded: DataFrame, n_grades: int = 3, keep_grade: int = 2, least_tail: float = 0.5,
             fit_docs: int = FIT_DOCS) -> DataFrame:
    """(doc_id, expected_grade, tail_prob, kept) for every row: the expected
    grade, the probability of ``keep_grade`` or better, and whether that is
    at least ``least_tail``.

    Null, empty and blank texts have no features, so their score is zero.
    Repeated rows and null doc_ids each give a row. Without any rated text
    the three results are null. An empty table gives an empty result; other
    columns are ignored.
    """
    model = fit(docs, graded, n_grades, fit_docs)
    rows = pick(docs, doc_id="long", text="string")
    if model is None:
        return rows.select("doc_id", F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("double").alias("tail_prob"), F.lit(None).cast("boolean").alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)    # 2 MB at any input

    def make():
        weights, thresholds = shared.value
        known = Kept(features_of, KEPT_CHUNKS)

        def apply(ids, texts):
            scores = np.array([weights[at] @ x for at, x in (vector(t, known) for t in texts)])
            p = tails(scores, thresholds)
            tail = p[:, keep_grade - 1]
            return [ids, p.sum(axis=1), tail, tail >= least_tail]
        return apply

    return map_lists(rows, make, "doc_id bigint, expected_grade double, tail_prob double, kept boolean")
