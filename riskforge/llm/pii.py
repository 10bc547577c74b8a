"""Personal data by anchor expansion (operator 9).

One Aho-Corasick automaton runs over the whole text and reports anchors:
at-signs, pairs of digits (next to each other, or with a dot, space or hyphen
between), plus signs before a digit, URL schemes and cue words of identifiers.
At each anchor a local parser finds the boundaries and checks the match:

* email, ip, card, phone: the contract's base patterns, leftmost and without
  overlap within a kind. An at-sign's local part is the run of its signs to the
  left (not into the match before), its domain the labels to the right. A chain
  of digits and dots gives one address for each four parts in a row. A card is
  a longest chain of digits with single separators, 16 to 19 digits, Luhn. A
  phone goes from the plus sign to the last digit of its run, 8 to 15 digits.
* url: a scheme and what follows up to white space or a quote, trailing
  punctuation left out; it needs a host with a dot or a port.
* account: a cue word, then optional ``=`` or ``:`` and quotes, then an
  identifier of 8 or more letters, digits and hyphens with a digit in it.

Edge cases: null text is empty and has no spans; texts of any length are read
whole, in time proportional to their length; repeated rows get the same
spans; null doc_ids are ordinary rows; an empty table gives an empty result.
``find_spans`` replaces a column named ``spans``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.llm.common import spread

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "iban", "ssn", "passport", "password", "secret", "token", "api_key", "apikey")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s\"'<>]+")
_HOST = re.compile(r"(?:[^/?#@\s\"'<>]*@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+|:[0-9])")
_ACCOUNT = re.compile(r"(?:\s?[A-Za-z]{2,6})?\s?[=:]?\s?[\"']?([A-Za-z0-9](?:-?[A-Za-z0-9]){7,})")


@cache
def anchors():
    """The automaton: pattern -> (kind, where the anchor lies in the pattern)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    for a in _DIGITS:
        found.add_word(f"+{a}", ("phone", 2))
        for b in _DIGITS:
            found.add_word(a + b, ("card", 2))
            found.add_word(f"{a} {b}", ("card", 3))
            found.add_word(f"{a}-{b}", ("card", 3))
            found.add_word(f"{a}.{b}", ("ip", 3))
    for word in SCHEMES:
        for form in {word, word.upper(), word.capitalize()}:
            found.add_word(form, ("url", len(word)))
    for word in CUES:
        for form in {word, word.upper(), word.capitalize()}:
            found.add_word(form, ("account", len(word)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _email(text: str, at: int, past: int) -> tuple[int, int, bool] | None:
    low = at
    while low > past and text[low - 1] in _LOCAL:
        low -= 1
    m = _DOMAIN.match(text, at + 1) if low < at else None
    return (low, m.end(), True) if m else None


def _ip(text: str, at: int, past: int) -> tuple[int, int, bool] | None:
    low = at  # a digit before the dot
    while low > past and text[low - 1] in _DIGITS:
        low -= 1
    m = _IP.match(text, low)
    if not m:
        return None
    return low, m.end(), all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups())


def _card(text: str, at: int, past: int) -> tuple[int, int, bool]:
    end = _CARD.match(text, at).end()
    digits = text[at:end].replace(" ", "").replace("-", "")
    return at, end, 16 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, past: int) -> tuple[int, int, bool] | None:
    m = _PHONE.match(text, at)
    return (at, m.end(), 8 <= sum(c in _DIGITS for c in m.group()) <= 15) if m else None


def _url(text: str, at: int, past: int) -> tuple[int, int, bool] | None:
    scheme = text.index("://", at) + 3
    if not _HOST.match(text, scheme):  # before the rest is taken, which may be long
        return None
    m = _URL.match(text, scheme)
    return at, scheme + len(m.group().rstrip(".,;:!?)]}")), True


def _account(text: str, at: int, past: int) -> tuple[int, int, bool] | None:
    start = at
    while text[start : start + 1].isalpha() or text[start : start + 1] == "_":
        start += 1
    m = _ACCOUNT.match(text, start)
    if not m or not any(c in _DIGITS for c in m.group(1)):
        return None
    return m.start(1), m.end(1), True


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "account": _account}


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    past = dict.fromkeys(KINDS, 0)
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for last, (kind, width) in anchors().iter(text):
        at = last - width + 1
        if at < past[kind]:
            continue
        span = _PARSERS[kind](text, at, past[kind])
        if span is None:
            continue
        low, end, valid = span
        past[kind] = end
        if valid:
            found[kind].append((low, end))
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; of spans that overlap,
    the first (at one place the longer) names the stretch."""
    out, past = [], 0
    for kind, low, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if low >= past:
            out += [text[past:low], f"[{kind.upper()}]"]
        past = max(past, end)
    return "".join([*out, text[past:]])


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with spans, an array of (kind, start, end)."""
    own = docs.select([c for c in docs.columns if c != "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in spans_of(t or "")] for t in batch.column("text").to_pylist()]
            out = {f.name: batch.column(f.name) for f in batch.schema}
            yield pa.RecordBatch.from_pydict(out | {"spans": pa.array(spans, _ARROW)})

    return spread(own).mapInArrow(run, T.StructType([*own.schema.fields, T.StructField("spans", _SPANS)]))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the texts replaced by its kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and redact(t, spans_of(t)) for t in batch.column("text").to_pylist()]
            out = {f.name: batch.column(f.name) for f in batch.schema}
            yield pa.RecordBatch.from_pydict(out | {"text": pa.array(texts, pa.string())})

    return spread(docs).mapInArrow(run, docs.schema)


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    found = find_spans(docs.select("doc_id", "text"))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = {f"n_{k}": counted(k) for k in KINDS} | {"n_spans": F.size("spans").cast("long")}
    return found.withColumns(
        {**counts, "base_sha256": F.sha2(joined(base).cast("binary"), 256), "spans": joined(F.col("spans"))}
    ).select("doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "n_url", "n_account", "n_spans")
