import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
from riskforge.llm import blocks as B
from riskforge.llm import substring_dedup as S
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[k : k + length]) for w in words for k in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), kept))
    return out


def hard_rows(spark, seed=4):
    """Documents with shared passages at odd places, inside one text and across."""
    rng = random.Random(seed)
    prose = lambda n: cases.prose(rng, n, "lo ra mi ten dus é 漢").split()
    shared = prose(60)
    rows = [(i, " ".join(prose(rng.randint(0, 30)) + shared[rng.randint(0, 20) : rng.randint(40, 60)] + prose(rng.randint(0, 90)))) for i in range(80)]
    rows += [(100, "\t\n ".join(shared + prose(5) + shared)), (101, "x " * 200), (102, "x  x\n" * 20 + "y"), (103, None), (104, ""), (105, "  \n")]
    rows += [(106, "a\x00 " + "b " * 40), (107, "w " * 34), (108, "w " * 34), (None, rows[3][1]), (5, rows[5][1])]
    extra = spark.createDataFrame(rows, "doc_id bigint, text string")
    return cases.documents(spark).select("doc_id", "text", "block", "spans", "size").unionByName(extra, allowMissingColumns=True)


@pytest.mark.parametrize("length", [35, 7, 1])
def test_words_under_repeated_windows_go(spark, length):
    docs = hard_rows(spark)
    rows = docs.select("doc_id", "text").collect()
    want = sorted(zip([r.doc_id if r.doc_id is not None else -1 for r in rows], expected([r.text for r in rows], length)))
    got = S.remove_repeats(docs, length).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, (r.n_words, r.n_removed, r.text)) for r in got) == want
    for r in got:
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed


def test_sections_and_narrow_sketches_change_nothing(spark, monkeypatch):
    docs = hard_rows(spark).repartition(6)
    key = lambda df: sorted(map(str, df.select("doc_id", "n_words", "n_removed", "text").collect()))
    whole = key(S.remove_repeats(docs))
    monkeypatch.setattr(B, "SECTION", 100_000)
    monkeypatch.setattr(B, "STRIPE", 20_000)
    assert key(S.remove_repeats(docs)) == whole
    assert key(S.remove_repeats(docs, cells=8)) == whole  # estimates far too high lose nothing


def test_estimates_are_never_too_low():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 300, 2000).astype(np.uint64)
    exact = Counter(hashes.tolist())
    for cells in (16, 256, 1 << 16):
        found = S._estimated(hashes, np.ones(len(hashes)), cells)
        assert all(f >= exact[h] for f, h in zip(found.tolist(), hashes.tolist()))


def test_empty_table_and_query(spark):
    assert S.remove_repeats(cases.none(spark)).count() == 0
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in E.queries()["op12_substring_dedup"](spark, cases.SF).collect()}
    for r, (n, gone, kept) in zip(docs, expected([r.text for r in docs], 35)):
        own = got[r.doc_id]
        assert (own.n_words, own.n_removed, own.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
