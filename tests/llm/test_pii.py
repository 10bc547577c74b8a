import hashlib
import random
import re
import time

import pytest

import __spark_entry__ as E
from riskforge.llm import pii
from tests.llm import cases

# the contract's base patterns
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


def test_base_spans_on_random_text():
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice("0123456789012..--  ++@@()aB%é.") for _ in range(rng.randint(0, 40)))
        assert [s for s in pii.spans_of(text) if s[0] in BASE] == brute(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("see https://a.example.com/x?y=1, or", "url", ["https://a.example.com/x?y=1"]),
        ("http://localhost:8080/ and http://nothing", "url", ["http://localhost:8080/"]),
        ('token = "9f86d081884c7d65" end', "account", ["9f86d081884c7d65"]),
        ("IBAN: DE89-3704-0044-0532", "account", ["DE89-3704-0044-0532"]),
        ("account holders are welcome", "account", []),
        ("a@b and x.y+z@mail-1.example.com.", "email", ["x.y+z@mail-1.example.com"]),
        ("1.2.3.4.5.6.7.8 and 256.1.1.1", "ip", ["1.2.3.4", "5.6.7.8"]),
    ],
)
def test_spans(text, kind, found):
    assert [text[a:b] for k, a, b in pii.spans_of(text) if k == kind] == found


def test_redact():
    text = "mail a@b.de or +49 (30) 123-4567, 4111 1111 1111 1111"
    assert pii.redact(text, pii.spans_of(text)) == "mail [EMAIL] or [PHONE], [CARD]"


def check(rows, texts):
    assert len(rows) == len(texts)
    for r, text in zip(rows, texts):
        spans = brute(text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in BASE)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in pii.spans_of(text or ""))


def test_registered_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{cases.SF}/documents.parquet").collect()}
    rows = E.queries()["op9_pii"](spark, cases.SF).collect()
    check(rows, [docs[r.doc_id] for r in rows])
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)


def test_hard_rows(spark):
    docs = cases.documents(spark).coalesce(1)
    by_id = {(r.doc_id, r.text) for r in docs.collect()}
    assert pii.digest(docs).count() == docs.count() and len(by_id) < docs.count()
    found = pii.find_spans(docs)
    assert found.columns == [c for c in docs.columns if c != "spans"] + ["spans"] and found.count() == docs.count()
    assert pii.redacted(docs).columns == docs.columns
    nulls = [r for r in pii.redacted(docs).collect() if r.doc_id == 2000]
    assert nulls[0].text is None
    assert pii.digest(cases.none(spark)).collect() == []


def test_runs_of_schemes_take_linear_time():
    start = time.perf_counter()
    assert not [s for s in pii.spans_of("http://" * 40_000) if s[0] == "url"]
    assert len([s for s in pii.spans_of("http://a.example/x " * 20_000) if s[0] == "url"]) == 20_000
    assert time.perf_counter() - start < 5


def test_hosts_with_user_and_port():
    for text, found in [("see http://me:pw@host.example/a, ok", (4, 31)), ("http://host:80", (0, 14)), ("http://a b@c.d", None), ("http://'x'", None)]:
        got = [s[1:] for s in pii.spans_of(text) if s[0] == "url"]
        assert got == ([found] if found else [])
