import hashlib
import random

import numpy as np
import pyarrow as pa

from riskforge.llm import decontamination as D
from riskforge.llm.fm_index import FMIndex
from riskforge.llm.words import buffer, find
from tests.llm import cases


def brute(docs, items):
    """The contract word by word."""
    windows = []
    for item, text in items:
        w = cases.words(text)
        n = min(13, len(w))
        windows += [(str(item), tuple(w[k : k + n])) for k in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w = cases.words(text)
        hit, names = set(), set()
        for item, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    names.add(item)
        joined = ",".join(sorted(names))
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def small(spark):
    rng = random.Random(2)
    items = [(k, cases.prose(rng, 30, "a b c de")) for k in range(8)] + [(20, "a b"), (21, None), (22, "?!"), (3, "c c de"), (10, "Zz É")]
    docs = [(None, "a B, a b"), (1, None), (2, ""), (3, "zz é"), (4, "a " * 500), (4, "a " * 500)]
    for k in range(30):
        text = cases.prose(rng, 200, "a b c de")
        if k % 3 == 0:
            text += " " + items[k % 8][1].upper()
        docs.append((100 + k, text))
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    docs, items, d, i = small(spark)
    assert sorted(map(tuple, D.digest(d, i).collect()), key=str) == brute(docs, items)


def test_items_in_several_blocks(spark):
    docs, items, d, i = small(spark)
    found = D.measures(D.annotate(d, i, block_bytes=200)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)


def test_pieces_and_shards(monkeypatch):
    """Documents longer than a piece, and many shards, find the same words."""
    rng = random.Random(4)
    texts = [cases.prose(rng, n, "a b c") for n in (0, 5, 400, 3, 90, 1000)]
    windows = D._windows(["x", "y"], [cases.prose(rng, 16, "a b c"), "a b"])
    data = find(*buffer(pa.array(texts)))
    whole = D.search(data[0], data[3], windows)
    monkeypatch.setattr(D, "PIECE", 50)
    monkeypatch.setattr(D, "SHARD_WORDS", 70)
    cut = D.search(data[0], data[3], windows)
    assert whole[0].tolist() == cut[0].tolist() and whole[1] == cut[1] and whole[0].any()


def test_fm_index_against_scan():
    rng = np.random.default_rng(0)
    lengths = np.array([0, 1, 200, 40, 0, 300])
    symbols = rng.integers(0, 3, lengths.sum())
    symbols[-300:-100] = symbols[1:201]  # a long repeat
    index = FMIndex(symbols, lengths, 3, every=4)
    texts = np.split(symbols, np.cumsum(lengths)[:-1])
    for n in (1, 2, 5, 9):
        patterns = np.unique(rng.integers(0, 3, (40, n)), axis=0)
        who, low, high = index.search(patterns)
        found = set()
        for p, a, b in zip(who, low, high):
            for place in index.locate(np.arange(a, b)).tolist():
                t = int(np.searchsorted(index.starts, place, "right") - 1)
                found.add((int(p), t, place - int(index.starts[t])))
        scan = {(p, t, k) for p, x in enumerate(patterns) for t, y in enumerate(texts) for k in range(len(y) - n + 1) if (y[k : k + n] == x).all()}
        assert found == scan


def test_clean_and_cut(spark):
    docs, items, d, i = small(spark)
    bad = {r.doc_id for r in D.digest(d, i).collect() if r.contaminated}
    wide = cases.documents(spark)
    kept = D.clean(wide, i)
    assert kept.columns == wide.columns and kept.count() == wide.count()
    assert {r.doc_id for r in D.clean(d, i).collect()} == {x for x, _ in docs} - bad
    again = D.digest(D.cut_spans(d.filter("doc_id is null"), i), i).first()
    assert again.n_hit == 0 and again.n_words == 0


def test_empty(spark):
    _, _, d, i = small(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.digest(d.limit(0), i).collect() == []
    assert not any(r.contaminated or r.n_items for r in D.digest(d, none).collect())
