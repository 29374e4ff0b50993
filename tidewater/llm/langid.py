"""Language identification by a bidirectional gated recurrent network over
bytes, trained here in numpy by backpropagation through time.

The network reads the UTF-8 bytes of the whole lower-cased text, whatever
they encode, forwards and backwards; at every byte it labels the position
with a probability for each language, from both states there. A document's
probabilities are the mean over all its bytes. Texts are read in windows: of
each the ``OWN`` bytes in the middle are labelled, and ``CONTEXT`` bytes on
either side let the states settle first, so every byte is labelled once.
Training reads windows of the same kind.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_lists, pick

UNKNOWN = "und"
#: Bounds of the training sample: documents a language (in expectation), and
#: distinct windows, shared out equally among the languages, one each at least.
FIT_DOCS = 300
FIT_WINDOWS = 800
#: The most bytes a window labels, and those it only reads on either side.
OWN, CONTEXT = 512, 32
#: Windows are filled up to a multiple of STEP bytes with one that UTF-8 has not.
STEP, PAD = 32, 0xFF
#: Windows labelled at a time; fewer where there are very many languages.
ROWS = 512
LETTER = re.compile(r"[^\W\d_]")


def coded(text: str | None) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass") if text else b""


class Windows(NamedTuple):
    """Of several texts: the text each belongs to, its first byte and size
    there, and the labelled part of it."""
    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    first: np.ndarray
    last: np.ndarray


def windows(sizes: np.ndarray) -> Windows:
    """Of texts of so many bytes, each in parts as equal as can be; a text
    without a byte has none."""
    count = -(-sizes // OWN)
    text = np.repeat(np.arange(len(sizes)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    own, stop = k * sizes[text] // count[text], (k + 1) * sizes[text] // count[text]
    start = np.maximum(own - CONTEXT, 0)
    end = np.minimum(stop + CONTEXT, sizes[text])
    return Windows(text, start, end - start, own - start, stop - start)


def pieces(text: str | None) -> list[bytes]:
    """The windows of a text, to train on."""
    data = coded(text)
    w = windows(np.array([len(data)]))
    return [data[a:a + n] for a, n in zip(w.start.tolist(), w.size.tolist(), strict=True)]


def filled(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows as rows of bytes, and each one's filled length."""
    length = -(-size // STEP) * STEP
    t = np.arange(length.max())
    x = data[np.minimum(at[:, None] + t, len(data) - 1)]
    x[t >= size[:, None]] = PAD
    return x, length


class Network(NamedTuple):
    """First axis: direction. Gates in the order update, reset, candidate."""
    inputs: np.ndarray     # (2, 256, 3h): a row a byte
    states: np.ndarray     # (2, h, 3h)
    out: np.ndarray        # (2h, languages)
    bias: np.ndarray       # (languages,)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


def _sweep(net: Network, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States of both directions at each position, (2, length, rows, h), each
    in the order of the text. x: bytes, (rows, length)."""
    rows, length = x.shape
    h = net.states.shape[1]
    state = np.zeros((2, rows, h), dtype=np.float32)
    out = np.empty((2, length, rows, h), dtype=np.float32)
    kept = []
    for t in range(length):
        read = np.stack([net.inputs[0][x[:, t]], net.inputs[1][x[:, length - 1 - t]]])
        rec = state @ net.states
        gates = _sigmoid(read[..., :2 * h] + rec[..., :2 * h])
        z, r = gates[..., :h], gates[..., h:]
        c = np.tanh(read[..., 2 * h:] + r * rec[..., 2 * h:])
        new = c + z * (state - c)
        if keep:
            kept.append((state, z, r, c, rec[..., 2 * h:]))
        state = new
        out[0, t], out[1, length - 1 - t] = new[0], new[1]
    return out, kept


def position_probabilities(net: Network, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """(length, rows, languages), the states, and what training needs."""
    states, kept = _sweep(net, x, True)
    both = np.concatenate([states[0], states[1]], axis=-1)
    scores = both @ net.out + net.bias
    scores -= scores.max(axis=-1, keepdims=True)
    p = np.exp(scores)
    return p / p.sum(axis=-1, keepdims=True), both, kept


def window_sums(net: Network, x: np.ndarray, length: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the position probabilities of each window's labelled part,
    (rows, languages). Rows come longest first; each is read to its own
    length, so a step works on the rows that still have bytes. Update, reset and candidate have arrays of their own,
    as slices are slow, and tanh and the sigmoid are taken from exp."""
    rows, longest = x.shape
    h, languages = net.states.shape[1], len(net.bias)
    one, two = np.float32(1), np.float32(2)
    # sigmoid(a) = 1 / (1 + exp(-a)), tanh(a) = 1 - 2 / (1 + exp(2a))
    factors = (-one, -one, two)
    inputs = [np.ascontiguousarray(net.inputs[..., k * h:(k + 1) * h]) * f for k, f in enumerate(factors)]
    states = [np.ascontiguousarray(net.states[..., k * h:(k + 1) * h]) * f for k, f in enumerate(factors)]
    out = net.out.reshape(2, h, languages)
    ahead, behind = (np.zeros((longest, languages, rows), dtype=np.float32) for _ in range(2))
    state = np.zeros((2, rows, h), dtype=np.float32)
    buffers = [np.empty_like(state) for _ in range(4)]
    byte = [np.ascontiguousarray(v.T).astype(np.intp) for v in (
        x, np.take_along_axis(x, np.maximum(length[:, None] - 1 - np.arange(longest), 0), axis=1))]
    left = np.searchsorted(-length, -np.arange(longest), side="left")   # rows longer than t
    with np.errstate(over="ignore"):   # exp may be infinite, its inverse is 0 then
        for t, m in enumerate(left.tolist()):
            now = state[:, :m]
            z, r, c, read = parts = [v[:, :m] for v in buffers]
            for k in range(3):
                np.matmul(now, states[k], out=parts[k])
                if k == 2:
                    c *= r
                for d in range(2):
                    np.take(inputs[k][d], byte[d][t, :m], axis=0, out=read[d], mode="clip")
                parts[k] += read
                np.exp(parts[k], out=parts[k])
                parts[k] += one
                np.reciprocal(parts[k], out=parts[k])
            c *= -two
            c += one
            now -= c
            now *= z
            now += c
            said = np.matmul(now, out)
            ahead[t, :, :m], behind[t, :, :m] = said[0].T, said[1].T
    for n in np.unique(length):
        same = slice(*np.searchsorted(-length, [-n, 1 - n]))
        ahead[:n, :, same] += behind[n - 1::-1, :, same]
    ahead += net.bias[:, None]
    ahead -= ahead.max(axis=1, keepdims=True)
    np.exp(ahead, out=ahead)
    t = np.arange(longest)[:, None]
    ahead *= (((t >= first) & (t < last)) / ahead.sum(axis=1)).astype(np.float32)[:, None]
    return ahead.sum(axis=0).T


def gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, Network]:
    """Loss (weighted mean cross entropy of all positions but those filled
    up) and its gradient by backpropagation through time."""
    p, both, kept = position_probabilities(net, x)
    rows, length = x.shape
    h = net.states.shape[1]
    scale = (x != PAD).T * weight
    scale = (scale / scale.sum()).astype(np.float32)
    loss = -float((np.log(p[:, np.arange(rows), y] + 1e-9) * scale).sum())
    d = p.copy()
    d[:, np.arange(rows), y] -= 1
    d *= scale[..., None]
    g_out = np.einsum("trh,trl->hl", both, d, optimize=True)
    g_bias = d.sum(axis=(0, 1))
    back = d @ net.out.T
    g_in, g_st = np.zeros_like(net.inputs), np.zeros_like(net.states)
    d_read = np.empty((2, length, rows, 3 * h), dtype=np.float32)   # in the order of the text
    carry = np.zeros((2, rows, h), dtype=np.float32)
    for t in range(length - 1, -1, -1):
        state, z, r, c, rec = kept[t]
        carry = carry + np.stack([back[t, :, :h], back[length - 1 - t, :, h:]])
        d_c = carry * (1 - z) * (1 - c * c)
        d_z = carry * (state - c) * z * (1 - z)
        d_r = d_c * rec * r * (1 - r)
        d_gates = np.concatenate([d_z, d_r, d_c * r], axis=-1)
        g_st += state.transpose(0, 2, 1) @ d_gates
        d_read[0, t], d_read[1, length - 1 - t] = np.concatenate([d_z, d_r, d_c], axis=-1)
        carry = carry * z + d_gates @ net.states.transpose(0, 2, 1)
    byte = x.T.ravel()
    order = np.argsort(byte, kind="stable")
    seen, starts = np.unique(byte[order], return_index=True)
    for k in range(2):
        g_in[k][seen] = np.add.reduceat(d_read[k].reshape(-1, 3 * h)[order], starts, axis=0)
    return loss, Network(g_in, g_st, g_out, g_bias)


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, languages: int, hidden: int = 16,
          epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 11) -> Network:
    """Adam over batches of windows of like length; few windows are read more
    often, for about 150 steps."""
    epochs = max(epochs, -(-150 * batch // len(texts)))
    rng = np.random.default_rng(seed)
    init = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    net = Network(init(2, 256, 3 * hidden, scale=0.3), init(2, hidden, 3 * hidden, scale=0.25),
                  init(2 * hidden, languages, scale=0.2), np.zeros(languages, dtype=np.float32))
    first, second = ([np.zeros_like(v) for v in net] for _ in range(2))
    data, size = np.frombuffer(b"".join(texts), dtype=np.uint8), np.array([len(v) for v in texts])
    at, step = np.cumsum(size) - size, 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        order = order[np.argsort(size[order], kind="stable")]   # like with like, otherwise drawn anew
        drawn = np.array_split(order, -(-len(order) // batch))
        for i in rng.permutation(len(drawn)):
            k = drawn[i]
            x, _ = filled(data, at[k], size[k])
            _, grad = gradients(net, x, labels[k], weights[k])
            step += 1
            lr = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for v, g, m, s in zip(net, grad, first, second, strict=True):
                m += np.float32(0.1) * (g - m)
                s += np.float32(0.001) * (g * g - s)
                v -= np.float32(lr) * m / (np.sqrt(s) + np.float32(1e-8))
    return net


class Labeller:
    """Pooled probabilities of whole texts, for one task."""

    def __init__(self, net: Network, languages: list[str]):
        self.net, self.languages = net, languages

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Sums of the probabilities of all bytes, (texts, languages)."""
        data = [coded(t) for t in texts]
        size = np.array([len(v) for v in data], dtype=np.int64)
        base, buffer = np.cumsum(size) - size, np.frombuffer(b"".join(data), dtype=np.uint8)
        w, out = windows(size), np.zeros((len(texts), len(self.languages)))
        rows = max(16, min(ROWS, 8 * ROWS // len(self.languages)))
        order = np.argsort(-w.size, kind="stable")
        for lo in range(0, len(order), rows):
            k = order[lo:lo + rows]
            x, length = filled(buffer, base[w.text[k]] + w.start[k], w.size[k])
            np.add.at(out, w.text[k], window_sums(self.net, x, length, w.first[k], w.last[k]))
        return out

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.languages else []
        if known:
            pooled = self.pooled([texts[i] for i in known])
            best = pooled.argmax(axis=1)
            mean = pooled[np.arange(len(known)), best] / pooled.sum(axis=1)
            for i, k, p in zip(known, best.tolist(), mean.tolist(), strict=True):
                names[i], scores[i] = self.languages[k], min(1.0, p)
        return names, scores


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS) -> tuple[Network | None, list[str]]:
    """Learn from text and lang of documents that are not held out and have
    a lang. All such documents are counted by language; of each language
    about ``fit_docs`` are drawn by a hash, and of their distinct windows its
    share of ``fit_windows``, at least one, again by a hash, with how often
    they occur: so many windows and one count a language reach the driver. A
    language is learned however rare it is. Languages weigh the same."""
    rows = pick(docs, doc_id="long", lang="string", text="string").filter(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None, []
    rate = F.element_at(F.create_map(*[F.lit(v) for k, n in sorted(counts.items())
                                       for v in (k, min(1.0, fit_docs / n))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30) < rate

    def make():
        return lambda langs, texts: [langs, [pieces(t) for t in texts]]

    found = map_lists(rows.filter(drawn).select("lang", "text"), make, "lang string, pieces array<binary>") \
        .select("lang", F.explode("pieces").alias("piece")).groupBy("lang", "piece").agg(F.count("*").alias("n")) \
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("lang", "piece"), "piece"))) \
        .where(F.col("place") <= max(1, fit_windows // len(counts))).orderBy("lang", "place").collect()
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return None, []
    number = {k: i for i, k in enumerate(languages)}
    labels = np.array([number[r["lang"]] for r in found])
    weights = np.sqrt(np.array([r["n"] for r in found], dtype=np.float64))
    total = np.bincount(labels, weights * [len(r["piece"]) for r in found])   # every position of a window weighs
    weights *= total.sum() / (total[labels] * len(languages))
    return train([bytes(r["piece"]) for r in found], labels, weights.astype(np.float32), len(languages)), languages


def identify_languages(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row: the language whose
    mean probability over all bytes of the whole text is highest (ties:
    the first by name), and that mean.

    Null and empty texts, and those without a letter, are ``und`` with score
    0. So are all texts if no document has a lang to learn from. Repeated
    rows and null doc_ids each give a row. An empty table gives an empty
    result; other columns are ignored. lang is read in training alone.
    """
    rows = pick(docs, doc_id="long", text="string").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return _labelled(docs, rows, "doc_id bigint, held_out boolean, ", False, fit_docs, fit_windows)


def with_languages(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS) -> DataFrame:
    """The columns of documents (doc_id, lang, source, n_chars, text), with
    lang_pred and score as ``identify_languages`` gives them."""
    rows = pick(docs, doc_id="long", lang="string", source="string", n_chars="long", text="string")
    return _labelled(docs, rows, "doc_id bigint, lang string, source string, n_chars bigint, ", True, fit_docs, fit_windows)


def _labelled(docs: DataFrame, rows: DataFrame, ddl: str, with_text: bool, fit_docs: int, fit_windows: int) -> DataFrame:
    """rows, whose last column is the text, with the two predicted columns."""
    net, languages = fit(docs, fit_docs, fit_windows)
    shared = docs.sparkSession.sparkContext.broadcast((net, languages))   # some 100 KB at any input

    def make():
        label = Labeller(*shared.value)
        return lambda *columns: [*(columns if with_text else columns[:-1]), *label(columns[-1])]

    return map_lists(rows, make, ddl + ("text string, " if with_text else "") + "lang_pred string, score double")
