import random

import numpy as np
import pyarrow as pa

import __spark_entry__ as E
from riskforge.llm import near_dedup as N
from riskforge.llm.components import components
from riskforge.llm.dart_minhash import BANDS, K, bands, odd_sketches, shingles, signatures, similarity
from riskforge.llm.words import buffer
from tests.llm import cases


def signed(texts, k=K):
    values, begin = shingles(*buffer(pa.array(texts)))
    return values, begin, signatures(values, begin, k)


def test_shingles_are_the_words_shingles():
    texts = ["", "one", "One TWO", "a b c d e", "a b c d e f a b c d e", None, "x" * 50 + " é ü"]
    values, begin, _ = signed(texts)
    for k, t in enumerate(texts):
        own = values[begin[k] : begin[k + 1]]
        assert sorted(np.unique(own, return_counts=True)[1]) == sorted(cases.shingles(t).values())
    a, b, _ = signed(["One, two!", "one two"])
    assert a[0] == a[1]


def test_signature_estimates_weighted_similarity():
    rng = random.Random(3)
    line = cases.prose(rng, 12, "a b c d")
    base = cases.prose(rng, 300, "lo ra mi ten").split()
    texts = [" ".join(base)]
    for n in (5, 20, 60):
        w = list(base)
        for k in rng.sample(range(300), n):
            w[k] = "z"
        texts.append(" ".join(w))
    texts += [" ".join([line] * 40), " ".join([line] * 25), "a b c d e f g", " ".join(base * 3)]
    values, begin, s = signed(texts, 2000)
    own = [values[begin[i] : begin[i + 1]] for i in range(len(texts))]
    for i in range(len(texts)):
        for j in range(i):
            a, b = cases.shingles(texts[i]), cases.shingles(texts[j])
            exact = sum((a & b).values()) / sum((a | b).values())
            assert abs(similarity(own[i], own[j]) - exact) < 1e-12
            assert abs((s[i] == s[j]).mean() - exact) < 0.05
    assert np.isfinite(s).all()


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f g h", "one", "w " * 3000, "p q r s t u v"]
    together = bands(signed(texts)[2])
    for k, t in enumerate(texts):
        assert (bands(signed([t])[2])[0] == together[k]).all()
    assert together.shape == (4, BANDS)


def test_odd_sketches_bound_the_unshared_shingles():
    rng = random.Random(6)
    base = cases.prose(rng, 150, "lo ra mi ten").split()
    texts = [" ".join(w if rng.random() > p else "z" for w in base) for p in (0, 0.01, 0.05, 0.3)] + [" ".join(base * 2), "a b", ""]
    values, begin = shingles(*buffer(pa.array(texts)))
    words, first = odd_sketches(values, begin)
    own = [words[first[i] : first[i + 1]] for i in range(len(texts))]
    for i in range(len(texts)):
        for j in range(i):
            x, y = own[i], own[j]
            while len(x) != len(y):
                x, y = (x[: len(x) // 2] ^ x[len(x) // 2 :], y) if len(x) > len(y) else (x, y[: len(y) // 2] ^ y[len(y) // 2 :])
            a, b = cases.shingles(texts[i]), cases.shingles(texts[j])
            unshared = sum(((a | b) - (a & b)).values())
            assert np.bitwise_count(x ^ y).sum() <= unshared
            assert np.bitwise_count(x ^ y).sum() >= 0.6 * unshared or len(own[i]) != len(own[j])


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + k, 301 + k) for k in range(40)] + [(500, k) for k in range(600, 700)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    out = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.id: r.label for r in out} == {x: find(x) for x in linked} and len(out) == len(linked)


def expected(rows):
    """doc_id, text -> class_id by all pairs."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    cls = dict(zip(texts, cases.near_classes(texts)))
    least = {}
    for i, t in rows:
        c = cls[t or ""]
        least[c] = None if i is None or (c in least and least[c] is None) else min(i, least.get(c, i))
    return {(i, t): least[cls[t or ""]] for i, t in rows}


def test_against_brute_force(spark):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    got = N.classes(docs).collect()
    by_t = {__import__("hashlib").md5((t or "").encode()).hexdigest(): t for _, t in rows}
    assert len(got) == len(rows)
    for r in got:
        text = by_t[r.t]
        key = (r.doc_id, text) if (r.doc_id, text) in want else (r.doc_id, None)
        assert r.class_id == want[key], r


def test_registered_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(docs)
    got = E.queries()["op6_near_dedup"](spark, cases.SF).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: c for (i, _), c in want.items()}
    assert sum(r.kept for r in got) == len(set(want.values()))


def test_wide_buckets(spark, monkeypatch):
    """Many texts of similarity just below and above the threshold share buckets;
    finer buckets find the same classes."""
    rng = random.Random(8)
    base = cases.prose(rng, 150, "lo ra mi ten dus ke").split()
    rows = []
    for k in range(60):
        w = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 3, 4])):
            w[at] = f"z{k}q{at}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: c for (i, _), c in expected(rows).items()}
    assert len(set(want.values())) > 1
    monkeypatch.setattr(N, "WIDE", 5)
    assert {r.doc_id: r.class_id for r in N.digest(docs).collect()} == want


def test_wide_buckets_keep_pairs_that_share_one_band(spark, monkeypatch):
    """All texts meet in one band and share no other: a bucket above WIDE still
    gives the classes of all pairs, with bitmaps of two sizes and a large label."""
    rng = random.Random(9)
    rows = []
    for words, copies in ((150, 40), (131, 30), (60, 12)):
        base = cases.prose(rng, words, "lo ra mi ten dus ke").split()
        for k in range(copies):
            w = list(base)
            for at in rng.sample(range(words), rng.choice([1, 2, 3, 4])):
                w[at] = f"z{words}q{k}q{at}"
            rows.append((len(rows), " ".join(w[: words - rng.randrange(5)])))
    rows += [(len(rows) + k, cases.prose(rng, 100 + k, "sch ung ket zwi")) for k in range(20)]
    real = N._sign

    def one_band(batches):
        for batch in real(batches):
            keys = batch.column("bands").flatten().to_numpy().reshape(-1, BANDS).copy()
            own = np.array([int(t[:14], 16) for t in batch.column("t").to_pylist()], np.int64)
            keys[:, 0], keys[:, 1:] = 7, own[:, None] + np.arange(1, BANDS)
            at = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
            columns = [batch.column("t"), batch.column("n"), pa.ListArray.from_arrays(at, pa.array(keys.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, ["t", "n", "bands"])

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: c for (i, _), c in expected(rows).items()}
    assert 20 < len(set(want.values())) < len(rows)
    monkeypatch.setattr(N, "_sign", one_band)
    monkeypatch.setattr(N, "WIDE", 7)
    assert {r.doc_id: r.class_id for r in N.digest(docs).collect()} == want


def test_deduplicate_keeps_rows_as_they_are(spark):
    docs = cases.documents(spark)
    out = N.deduplicate(docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(set(got)) == len({c if c is not None else ("null", t) for (i, t), c in want.items()})
    assert all(want[g] == g[0] for g in got)


def test_empty(spark):
    assert N.digest(cases.none(spark)).collect() == []
    assert N.deduplicate(cases.none(spark)).collect() == []
