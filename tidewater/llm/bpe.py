"""BPE encoding by per-prefix dynamic programming, and decoding.

Of a word's byte prefixes, each has one exact encoding, so one last token.
Tokens that end at a prefix are the automaton's matches there (an
Aho-Corasick automaton over the whole vocabulary, whose matches at a place
are all vocabulary suffixes of the prefix). A match is the last token if it
and the last token of the prefix before it are compatible: merged together,
the two would stay as they are. There is exactly one such match, and it is
stored; the tokens of the word come from following the stored ones back.

Compatibility of a pair is decided from the merge order alone: the symbols
that come to stand at either side of the border are the right spine of the
one token and the left spine of the other; the border holds if no two of
them that stand there at the same time merge before either is merged
inward. Word ends are symbols of their own, as the vocabulary has them.

Words repeat, so their encodings are kept in a bounded table by task.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from typing import NamedTuple

import ahocorasick
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidewater.llm.common import Kept, map_lists, pick

#: Encoded words, and chunks between white space, kept by a task.
KEPT_WORDS = 300_000
KEPT_CHUNKS = 600_000
_NEVER = 1 << 60
_END = "\x00"   # stands for the word-end mark inside the automaton's keys


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each
    byte: printable Latin-1 stands for itself, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Spine(NamedTuple):
    """Symbols along one edge of a token's merge tree, from the byte up, and
    the merge rank at which each is merged into the next."""
    symbols: tuple[int, ...]
    gone: tuple[int, ...]


class Vocabulary:
    """A tokenizers JSON file of a byte-level BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        ids = self.ids
        self.ranks: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = ids[left], ids[right]
            self.ranks[a, b] = rank
            whole = ids[left + right]
            self.parts.setdefault(whole, (a, b, rank))
        self._right: dict[int, Spine] = {}
        self._left: dict[int, Spine] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if not self.reproduced(i):
                continue
            key = token.removesuffix(self.end) + _END if self.end and token.endswith(self.end) else token
            self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        self.symbol = byte_symbols()

    def _spine(self, token: int, side: int) -> Spine:
        known = self._right if side else self._left
        if token not in known:
            symbols, gone, at, rank = [], [], token, _NEVER
            while True:
                symbols.append(at)
                gone.append(rank)
                if at not in self.parts:
                    break
                *children, rank = self.parts[at]
                at = children[side]
            known[token] = Spine(tuple(reversed(symbols)), tuple(reversed(gone)))
        return known[token]

    def _border_holds(self, a: int, b: int, until: int = _NEVER) -> bool:
        """Whether tokens a and b, side by side, are never merged across
        their border by a merge of lower rank than ``until``."""
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            rank = self.ranks.get((left.symbols[i], right.symbols[j]), _NEVER)
            gone_i, gone_j = left.gone[i], right.gone[j]
            # among equal ranks the leftmost merge comes first
            if rank < until and rank < gone_i and rank <= gone_j:
                return False
            if gone_i == _NEVER and gone_j == _NEVER:
                return True
            if gone_i <= gone_j:
                i += 1
            else:
                j += 1

    def reproduced(self, token: int) -> bool:
        """Whether the token's own string is encoded as the token."""
        if token not in self._whole:
            if token in self.parts:
                a, b, rank = self.parts[token]
                self._whole[token] = self.reproduced(a) and self.reproduced(b) and self._border_holds(a, b, rank)
            else:
                self._whole[token] = len(self.tokens[token].removesuffix(self.end)) == 1
        return self._whole[token]

    def compatible(self, a: int, b: int) -> bool:
        key = a, b
        if key not in self._pairs:
            if len(self._pairs) > 2 * KEPT_WORDS:
                self._pairs.clear()
            self._pairs[key] = self._border_holds(a, b)
        return self._pairs[key]

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one pre-token."""
        return self.encode_symbols(word if word.isalnum() and word.isascii() else
                                   "".join(map(self.symbol.__getitem__, word.encode("utf-8"))))

    def encode_symbols(self, symbols: str) -> list[int]:
        """Token ids of one pre-token's byte symbols, by the table of last
        tokens."""
        n = len(symbols)
        last, size = [-1] * (n + 2), [0] * (n + 2)   # n + 1: the whole with its end mark
        pairs = self._pairs
        for at, (token, length) in self.automaton.iter(symbols + _END):
            end = at + 1
            if last[end] >= 0:
                continue
            if length < end:
                before = last[end - length]
                if before < 0:
                    continue
                holds = pairs.get((before, token))
                if not (self.compatible(before, token) if holds is None else holds):
                    continue
            last[end], size[end] = token, length
        whole = n + 1 if self.end else n
        out, at = [], whole
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out


#: Fixed value: the pre-token pattern of the vocabulary file.
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Beyond these characters Unicode versions differ between libraries.
_RARE = regex.compile(r"[^\x00-\u052F]")
#: Python splits at these, the vocabulary's pattern does not.
_NO_SPACE = regex.compile(r"[\x1C-\x1F]")


def lowered(text: str) -> str:
    """NFC, then each character lower-cased by itself, for common characters."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()   # a capital sigma never becomes a final one


class Encoder:
    """Whole texts to ids and back, for one task.

    No pre-token holds white space, so a text is cut there first; the ids of
    a chunk between white space are kept in a bounded table, and those of a
    word in another. Chunks with rare characters are normalised and cut by
    the tokenizers library, whose Unicode version the ids must follow.
    """

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self._library = Tokenizer.from_file(path)
        self._chunks = Kept(self._chunk, KEPT_CHUNKS)
        self._rare_chunks = Kept(self._rare_chunk, KEPT_CHUNKS // 4)
        self._words = Kept(self._word, KEPT_WORDS)
        special = self.vocabulary.special
        self._split = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None

    def _word(self, word: str) -> bytes:
        return array("I", self.vocabulary.encode_word(word)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._words.__getitem__, _PRETOKEN.findall(chunk)))

    def _rare_chunk(self, chunk: str) -> bytes:
        cut = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(chunk))
        return b"".join(array("I", self.vocabulary.encode_symbols(w)).tobytes() for w, _ in cut)

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and _RARE.search(text):
            chunks = [text] if _NO_SPACE.search(text) else text.split()
            return b"".join(map(self._rare_chunks.__getitem__, chunks))
        text = lowered(text)
        if _NO_SPACE.search(text):
            return b"".join(map(self._words.__getitem__, _PRETOKEN.findall(text)))
        return b"".join(map(self._chunks.__getitem__, text.split()))

    def encode(self, text: str | None) -> array:
        """Token ids; special tokens' strings are their tokens."""
        text = text or ""
        if not (self._split and "<" in text and self._split.search(text)):
            return array("I", self._plain(text))
        special = self.vocabulary.special
        return array("I", b"".join(
            array("I", [special[piece]]).tobytes() if piece in special else self._plain(piece)
            for piece in self._split.split(text)))

    def decode(self, ids: array) -> str:
        """The tokens' strings, joined by spaces: the file names no decoder."""
        return " ".join(map(self.vocabulary.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) for every row: the
    ids of the whole text, their SHA-256 as little-endian unsigned 32-bit
    integers, and that of the text decoded from them. ``path`` names the
    vocabulary file, which every executor has.

    Null and empty texts have no tokens. Repeated rows and null doc_ids each
    give a row. An empty table gives an empty result; other columns are
    ignored. ``with_ids`` false leaves the column ids out.
    """
    def make():
        encoder = Encoder(path)

        def apply(ids, texts):
            cols: list[list] = [[] for _ in range(5)]
            for doc, text in zip(ids, texts, strict=True):
                tokens = encoder.encode(text)
                raw = tokens if array("I", [1]).tobytes()[0] == 1 else array("I", tokens).byteswap()
                row = [doc, len(tokens), tokens.tolist() if with_ids else None,
                       hashlib.sha256(raw).hexdigest(),
                       hashlib.sha256(encoder.decode(tokens).encode("utf-8")).hexdigest()]
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            return cols if with_ids else cols[:2] + cols[3:]
        return apply

    ids = "ids array<int>, " if with_ids else ""
    return map_lists(pick(docs, doc_id="long", text="string"), make,
                     f"doc_id bigint, n_tokens bigint, {ids}ids_sha256 string, decoded_sha256 string")
