"""Language ID, quality, HTML extraction, neighbours: accuracy, brute force,
hard rows."""

import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

import __spark_entry__ as E
from riskforge.llm import ann, html_extraction, labelled_pages, language_id, quality
from riskforge.llm.dom import SILENT, read
from tests.llm import cases

SF = "/root/testdata/sf0.01"


# language ID


def phrases(text, symbols):
    """Longest phrases that occur in ``text``, by plain search."""
    n, i = 0, 0
    while i < len(symbols):
        k = i + 1
        while k < len(symbols) and symbols[i : k + 1] in text:
            k += 1
        n, i = n + 1, k
    return n


def test_phrases_are_longest_matches():
    rng = random.Random(1)
    texts = {"aa": cases.prose(rng, 300, "lo ra mi ten"), "bb": cases.prose(rng, 300, "sch öb ung ket"), "cc": "z" * 40}
    model = language_id.Model(texts)
    docs = [cases.prose(rng, n, "lo ra mi ten sch öb x") for n in (1, 5, 60)] + ["", "123 !", "ÖB, Lo!  ra", "漢字"]
    found = model.phrases(docs)
    for doc, row in zip(docs, found):
        symbols = "".join(chr(c) for c in language_id._stream(doc.lower()))
        for k, lang in enumerate(model.languages):
            assert not symbols or row[k] == phrases(texts[lang], symbols), (doc, lang)
        assert row[-1] == sum(c.isalpha() for c in doc)


def test_long_texts_are_cut_alike(monkeypatch):
    model = language_id.Model({"aa": "lo ra mi ten", "bb": "sch ung ket"})
    text = cases.prose(random.Random(2), 3000, "lo ra mi ten")
    monkeypatch.setattr(language_id, "STRETCH", 100)
    symbols = "".join(chr(c) for c in language_id._stream(text))
    want = sum(phrases("lo ra mi ten", symbols[k : k + 100]) for k in range(0, len(symbols), 100))
    assert model.phrases([text])[0][0] == want
    assert model.predict([text, "1 2", ""])[0] == ["aa", "und", "und"]


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in E.queries()["op7_language_id"](spark, SF).collect() if r.held_out]
    assert np.mean([docs[r.doc_id] == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_on_hard_rows(spark):
    docs = cases.documents(spark)
    rows = language_id.digest(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for i in (2000, 2001, 2002):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert {r.lang_pred for r in rows} == {"aa", "bb", "und"}
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and not {2000, 2001, 2002, 2003} & {r.doc_id for r in kept.collect()}
    assert {r.lang_pred for r in language_id.digest(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.digest(cases.none(spark)).collect() == []


# quality


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in E.queries()["op3_quality"](spark, SF).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert len(bad) > 3 and auc > 0.95
    assert np.mean([r.predicted for r in rows if labels[r.doc_id] == 1]) > 0.97


def test_quality_vectors_by_hand():
    model = quality.Model()
    from riskforge.llm.words import buffer

    import pyarrow as pa

    data, at = buffer(pa.array(["a b a b c d a b", "e f"]))
    h, shape, first = quality._tokens(data, at)
    assert first.tolist() == [0, 8, 10]
    assert (shape == quality._REPEATED).tolist() == [False, False, True, True, False, False, False, False, False, False]
    model.fit_vectors(data, at)
    assert len(model.words) == 2 and model.vectors.shape == (quality._SHAPES + 2, quality.DIM)


def test_quality_on_hard_rows(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(7, None), (8, 5), (None, 1)], "doc_id long, quality int")
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, quality.digest(docs, labels).collect()))
    assert quality.digest(cases.none(spark), labels).collect() == []
    alone = quality.digest(docs, labels.filter("quality = 1")).collect()
    assert {r.score for r in alone} == {1.0}
    assert {r.score for r in quality.digest(docs, labels.limit(0)).collect()} == {0.5}
    own = quality.score_documents(docs, quality.Model())
    assert own.columns == [c for c in docs.columns if c != "score"] + ["score"]


# HTML


def test_blocks_of_unseen_layouts():
    model = html_extraction.trained()
    wrong = total = 0
    for page, labels in labelled_pages.pages(200, seed=99):
        blocks = read(page)
        for block, y, p in zip(blocks[1:], labels, model.marginals(blocks)[1:]):
            if block.runs and block.tag not in SILENT:
                total += 1
                wrong += (p > 0.5) != y
    assert wrong < 0.06 * total


def test_marginals_are_the_sums_over_all_labellings():
    from itertools import product
    from math import exp

    model = html_extraction.trained()
    blocks = read('<body><nav><a href="/">x</a></nav><div><h1>T</h1><p>text of it</p></div><aside>y</aside></body>')
    marginals = model.marginals(blocks)
    total, content = 0.0, [0.0] * len(blocks)
    for labels in product((0, 1), repeat=len(blocks)):
        if labels[0]:
            continue
        log_p = sum(model.potential(b)[y] for b, y in zip(blocks[1:], labels[1:]))
        log_p += sum(model.pair[blocks[b.parent].tag in html_extraction.FRAME, labels[b.parent]][y] for b, y in zip(blocks[1:], labels[1:]))
        total += exp(log_p)
        for k, y in enumerate(labels):
            content[k] += y * exp(log_p)
    assert marginals[1:] == pytest.approx([c / total for c in content[1:]])


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body>", ""),
        ("<article><h1>A &amp; B</h1><p>one\n two<br>three <b>bold</b>er</p><script>var x='</p>';</script></article>", "A & B\none two three bolder"),
        ("<nav><ul><li><a href='/'>x</a></li></ul></nav><article><p><b>T<br><p>unclosed", "T\nunclosed"),
        ("<article><p>a<!-- <p>no</p> -->b</p><style>p{}</style></article><footer>&copy; f</footer>", "ab"),
        ("<article><p>kept</p><div class='comments'><p>reader says</p></div></article>", "kept"),
    ],
)
def test_pages(page, text):
    assert html_extraction.trained().text(page) == text


def test_article_pages(spark):
    """The text of the pages' article element, read by a regular expression."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = E.queries()["op2_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x.replace("<b>", ""))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_html_on_hard_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<p>" * 3000 + "deep", "x"), (2, "u", "<article><p>" + "w " * 200_000, "x")]
    web = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_extraction.extract(web)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    found = out.collect()
    assert sorted(r.n_chars for r in found)[:2] == [0, 0] and max(r.n_chars for r in found) == 399_999
    assert html_extraction.digest(web.limit(0)).collect() == []
    deep = "<div>" * 5000 + "x"
    assert isinstance(html_extraction.trained().text(deep), str)


# neighbours


def exact(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    d[ids == ids[q]] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), float(d[i])) for i in order if np.isfinite(d[i])]


def test_recall_and_scores(spark):
    own = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in own]), np.array([r.embedding for r in own], np.float64)
    found = {}
    for r in E.queries()["op1_ann"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = 0
    queries = np.flatnonzero(ids % 100 == 0)
    assert sorted(found) == sorted(ids[queries].tolist())
    for q in queries:
        rows = sorted(found[ids[q]])
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (r[1], r[0]))
        want = dict(exact(ids, x, q))
        hit += sum(r[1] in want for r in rows)
        for _, v, score in rows:
            assert score == np.sqrt(((x[q] - x[np.flatnonzero(ids == v)[0]]) ** 2).sum())
    assert hit >= 0.9 * 10 * len(queries)


def test_ann_on_hard_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(120)]  # one common vector
    rows += [(5, rows[5][1]), (700, [0.0] * 4), (800, None), (900, [1.0, None, 2.0, 3.0]), (901, [float("nan")] * 4), (902, [1.0]), (None, [1.0] * 4)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "embedding", "1 as leaf", "2 as part")
    got = {}
    for r in ann.digest(vectors).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    sound = [(i, v) for i, v in rows if i is not None and v and len(v) == 4 and None not in v and np.isfinite(v).all() and any(v)]
    sound = list(dict.fromkeys((i, tuple(v)) for i, v in sound))
    ids, x = np.array([i for i, _ in sound]), np.array([v for _, v in sound])
    assert sorted(got) == [0, 100, 200, 1000, 1100]
    for q in got:
        want = exact(ids, x, int(np.flatnonzero(ids == q)[0]))
        assert [(v, pytest.approx(s)) for _, v, s in sorted(got[q])] == want
    few = vectors.filter("vec_id in (0, 1, 2, 3)")
    assert [r["rank"] for r in ann.digest(few).collect()] == [1, 2, 3]
    assert ann.digest(vectors.limit(0)).collect() == []


def test_blocks_of_items_and_queries(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 7)
    monkeypatch.setattr(ann, "QUERIES", 1)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(250)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    for r in ann.digest(vectors).collect():
        assert (r.vec_id, r.score) == exact(ids, x, r.query_id)[r["rank"] - 1]


def recall(spark, x, queries=100):
    """Mean share of the true ten nearest that are found, over every 1/queries-th row."""
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    step = len(x) // queries
    found = {}
    for r in ann.nearest(vectors, vectors.filter(F.col("vec_id") % step == 0)).collect():
        found.setdefault(r.query_id, set()).add((r.vec_id, r.score))
    ids = np.arange(len(x))
    return {q: len(found[q] & set(exact(ids, x, q))) / 10 for q in range(0, len(x), step)}


def test_recall_with_a_third_of_rows_equal(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12_000, 64))
    common = rng.permutation(len(x))[:4_000]
    x[common] = x[common[0]]
    got = recall(spark, x)
    assert all(got[q] == 1 for q in got if q in set(common.tolist()))
    assert np.mean([got[q] for q in got if q not in set(common.tolist())]) >= 0.9


@pytest.mark.parametrize("n, clusters", [(500, 0), (2_000, 0), (9_000, 0), (9_000, 50)])
def test_recall_at_the_production_share(spark, n, clusters):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 64))
    if clusters:
        x = 0.25 * x + rng.normal(size=(clusters, 64))[rng.integers(0, clusters, len(x))]
    assert np.mean(list(recall(spark, x).values())) >= 0.9


def test_an_id_with_two_vectors_asks_with_the_least(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)] + [(0, [5.0, 5.0, 5.0]), (0, [-9.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in ann.digest(vectors).orderBy("query_id", "rank").collect()]
    assert got == [(r["rank"], r.vec_id, r.score) for r in ann.digest(vectors.repartition(3)).orderBy("query_id", "rank").collect()]
    least = np.array(min(v for i, v in rows if i == 0))
    d = sorted((float(np.sqrt(((np.array(v) - least) ** 2).sum())), i) for i, v in rows if i != 0)
    assert [(v, pytest.approx(s)) for _, v, s in got] == [(i, x) for x, i in d[:10]]


def test_quality_learns_from_whole_texts(spark):
    """The last words of a very long text teach too, and the tasks' sums equal those in memory."""
    long = "lorem ipsum " * 30_000 + "zebra quagga zebra quagga"
    rows = [(i, "good words here " * (i % 5 + 1)) for i in range(40)] + [(99, long), (99, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    texts = quality.training_texts(docs, labels).collect()
    assert max(len(r.text) for r in texts) == len(long)
    assert len(texts) == len({i for i, _ in rows if zlib.crc32(str(i).encode()) % 5})
    model, plain = quality.learn(docs, labels), quality.Model()
    plain.fit_vectors(*quality.buffer(pa.array([r.text for r in texts], pa.large_string())))
    assert (model.words == plain.words).all() and (model.vectors == plain.vectors).all()


def test_language_sample_is_of_different_texts_and_many_labels(spark):
    """Copies don't fill the sample; a stretch may begin anywhere; 300 labels stay within the bound."""
    rows = [("aa", f"lo ra mi ten {i}" + "b" * i) for i in range(30)] + [("aa", "copy of one text")] * 500
    model = language_id.learn(spark.createDataFrame(rows, "lang string, text string"), train_docs=20, train_chars=4_000)
    assert model.phrases(["lo ra mi ten"])[0, 0] <= 2
    head = [("aa", "x " * 5_000 + "lorami " * 60_000), ("bb", "y " * 5_000 + "schung " * 60_000)]
    late = language_id.learn(spark.createDataFrame(head, "lang string, text string"))
    assert late.predict(["lorami lorami", "schung schung"])[0] == ["aa", "bb"]
    many = [(f"l{j:03}", " ".join(chr(97 + (j * 7 + i * i) % 26) * 2 + chr(97 + (j + i) % 26) for i in range(200))) for j in range(300)]
    wide = language_id.learn(spark.createDataFrame(many, "lang string, text string"))
    assert len(wide.languages) == 300 and len(wide.table) <= 2 * (language_id.TRAIN_CHARS + 300) * wide.width


def test_quality_sends_the_driver_no_sums_of_each_task(spark, monkeypatch):
    """What is collected doesn't grow with the number of tasks, and the model is the same."""
    rows = [(i, f"word{i % 9} and word{i % 7} near word{i % 5}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    collect, sizes = DataFrame.collect, []

    def seen(self):
        out = collect(self)
        sizes.append(len(pickle.dumps([tuple(r) for r in out])))
        return out

    monkeypatch.setattr(DataFrame, "collect", seen)
    found = []
    for tasks in (2, 40):
        monkeypatch.setattr(quality, "TRAIN_TASKS", tasks)
        model = quality.learn(docs, labels)
        found.append((model.words, model.vectors, sum(sizes)))
        sizes.clear()
    assert (found[0][0] == found[1][0]).all() and (found[0][1] == found[1][1]).all()
    assert found[1][2] <= 1.1 * found[0][2]
