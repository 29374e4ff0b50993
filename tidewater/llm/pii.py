"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs,
address schemes, plus signs, digits and identifier cues. From each anchor a
small deterministic parser walks outwards over the characters its kind
allows, fixes the boundaries, and validates what it found. A parser never
reads a region twice: each kind keeps the place up to which it has read.

Base kinds are email, ip, card and phone. The method adds ``url`` (an
address with a scheme whose authority names a user, as in
``ftp://ann:pw@host``) and ``account`` (after a cue such as IBAN: a bank
account number whose check digits hold; after an SSN cue: a grouped social
security number). Between a cue and its identifier may stand words such as
"number", "no" or "is", punctuation and white space.
"""

from __future__ import annotations

from itertools import product

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_lists, pick

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]

_DIGITS = frozenset("0123456789")
_ALNUM = _DIGITS | frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_NOT_URL = frozenset(" \t\n\r\x0b\x0c<>\"'`|\\^{}")
_SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "mailto:")
_CUES = ("iban", "ssn", "social security")
#: Words that may stand between a cue and its identifier, in any case, as may
#: all that is neither letter nor digit.
_GAP_WORDS = frozenset(("number", "numbers", "num", "no", "nr", "is", "code", "s"))


def _anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    for s in _SCHEMES:
        for form in (s, s.upper(), s.capitalize()):
            a.add_word(form, ("url", len(s)))
    for c in _CUES:
        for words in product(*[(w, w.upper(), w.capitalize()) for w in c.split(" ")]):
            a.add_word(" ".join(words), ("account", len(c)))
    a.make_automaton()
    return a


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that starts at ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _email(text: str, sign: int, floor: int) -> tuple[int, int] | None:
    """Around an at-sign; the local part starts at ``floor`` at the earliest."""
    start = sign
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, sign + 1, _LABEL)
    if start == sign or end == sign + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _run(text, end + 1, _LABEL)
        dots += 1
    return (start, end) if dots else None


def _digit_groups(text: str, at: int, separators: str) -> tuple[list[tuple[int, int]], int]:
    """Runs of digits from ``at`` on, joined by single separators."""
    groups = []
    while True:
        end = _run(text, at, _DIGITS)
        groups.append((at, end))
        if end + 1 < len(text) and text[end] in separators and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            return groups, end


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    """At most 255, however many zeros lead."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _phone(text: str, plus: int) -> tuple[tuple[int, int] | None, int]:
    """From a plus sign; also how far it read."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None, plus + 1
    reach = end = _run(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= plus + 3 or text[end - 1] not in _DIGITS:   # needs a character between its first and last digit
        return None, reach
    digits = sum(c in _DIGITS for c in text[plus:end])
    return ((plus, end) if 9 <= digits <= 15 else None), reach


def _url(text: str, start: int, host: int) -> tuple[tuple[int, int] | None, int]:
    """From a scheme whose authority starts at ``host``; also how far it read."""
    reach = host
    while reach < len(text) and text[reach] not in _NOT_URL:
        reach += 1
    end = reach
    while end > host and text[end - 1] in ".,;:!?)]":
        end -= 1
    authority = text[host:end].split("/")[0]
    user, sign, name = authority.rpartition("@")
    return ((start, end) if sign and user and name else None), reach


def _after_gap(text: str, at: int) -> int:
    """Past gap words and whatever is neither letter nor digit."""
    n, longest = len(text), max(map(len, _GAP_WORDS))
    while at < n:
        end = at
        while end < n and end <= at + longest and text[end].isalnum():
            end += 1
        if end > at and text[at:end].lower() not in _GAP_WORDS:
            break
        at = max(end, at + 1)
    return at


def _account(text: str, cue_end: int, cue: str) -> tuple[int, int] | None:
    at = _after_gap(text, cue_end)
    if cue == "iban":
        taken, end = [], at
        while end < len(text) and len(taken) < 34:
            if text[end] in _ALNUM:
                taken.append(end)
            elif text[end] != " " or not (end + 1 < len(text) and text[end + 1] in _ALNUM):
                break
            end += 1
        for k in range(len(taken), 14, -1):   # the longest that checks
            number = "".join(text[i] for i in taken[:k]).upper()
            if number[:2].isalpha() and number[2:4].isdigit() and \
                    int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
                return taken[0], taken[k - 1] + 1
        return None
    if at < len(text) and text[at] in _DIGITS:
        groups = _digit_groups(text, at, " -")[0][:3]   # more digits may follow: a house number
        if [e - s for s, e in groups] == [3, 2, 4]:
            return at, groups[2][1]
    return None


def spans(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start, in code points, ends exclusive.
    Within a kind spans don't overlap, the leftmost first; spans of different
    kinds may. Null and empty texts have none."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_floor = phone_floor = ip_floor = card_floor = url_floor = account_floor = 0
    for last, (kind, size) in automaton.iter(text) if text else ():
        if kind == "digit":
            if last >= ip_floor:
                groups, ip_floor = _digit_groups(text, last, ".")
                for k in range(0, len(groups) - 3, 4):
                    if all(_small(text[s:e]) for s, e in groups[k:k + 4]):
                        found["ip"].append((groups[k][0], groups[k + 3][1]))
            if last >= card_floor:
                groups, card_floor = _digit_groups(text, last, " -")
                if 13 <= sum(e - s for s, e in groups) <= 19 and \
                        _luhn("".join(text[s:e] for s, e in groups)):
                    found["card"].append((last, card_floor))
        elif kind == "email":
            if hit := _email(text, last, email_floor):
                found["email"].append(hit)
                email_floor = hit[1]
        elif kind == "phone":
            if last >= phone_floor:
                hit, phone_floor = _phone(text, last)
                if hit:
                    found["phone"].append(hit)
        elif kind == "url":
            start = last + 1 - size
            if start >= url_floor:
                hit, url_floor = _url(text, start, last + 1)
                if hit:
                    found["url"].append(hit)
        elif last >= account_floor:
            cue = text[last + 1 - size:last + 1].lower()
            if (hit := _account(text, last + 1, cue)) and hit[0] >= account_floor:
                found["account"].append(hit)
                account_floor = hit[1]
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def redacted(text: str, hits: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the
    kind of its longest span, as in ``<EMAIL>``."""
    out, at, order = [], 0, sorted(hits, key=lambda h: (h[1], h[1] - h[2]))
    k = 0
    while k < len(order):
        name, start, end = best = order[k]
        while k < len(order) and order[k][1] < end:
            if order[k][2] - order[k][1] > best[2] - best[1]:
                best = order[k]
            end = max(end, order[k][2])
            k += 1
        out += [text[at:start], f"<{best[0].upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def _joined(hits: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in hits)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans, clean_text)
    for every row: spans as ``kind:start:end``, comma-joined; clean_text is
    the text with all spans replaced.

    Null texts have no spans and stay null; empty texts have none. Repeated
    rows and null doc_ids each give a row. An empty table gives an empty
    result; other columns are ignored.
    """
    def make():
        automaton = _anchors()

        def apply(ids, texts):
            cols: list[list] = [[] for _ in range(8)]
            for doc, text in zip(ids, texts, strict=True):
                hits = spans(text, automaton)
                counts = [sum(h[0] == k for h in hits) for k in BASE_KINDS]
                base = [h for h in hits if h[0] in BASE_KINDS]
                row = [doc, *counts, _joined(base), _joined(hits), redacted(text, hits) if hits else text]
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
            return cols
        return apply

    return map_lists(pick(docs, doc_id="long", text="string"), make,
                     "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                     "base_spans string, spans string, clean_text string")


def with_clean_texts(docs: DataFrame) -> DataFrame:
    """The columns of documents, with every span of the text replaced by its
    kind and n_chars the length of the new text; unchanged rows otherwise."""
    def make():
        automaton = _anchors()

        def apply(ids, texts, langs, sources, sizes):
            found = [spans(t, automaton) for t in texts]
            clean = [redacted(t, hits) if hits else t for t, hits in zip(texts, found, strict=True)]
            sizes = [len(c) if hits else n for n, c, hits in zip(sizes, clean, found, strict=True)]
            return [ids, clean, langs, sources, sizes]
        return apply

    rows = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    return map_lists(rows, make, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the operator's result."""
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
