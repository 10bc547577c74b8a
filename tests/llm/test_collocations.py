import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
from riskforge.llm import collocations as C
from tests.llm import cases

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD = re.compile(r"[^\x20\x09]+")


def expected(rows, least, top):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(cases.LOWER)):
            w = WORD.findall(piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(zip(*[w[i:] for i in range(k)]))
    for lang, c in f.items():
        dropped = {q for p, a in c.items() if a >= least and len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        found = []
        for p, a in c.items():
            if a >= least and len(p) > 1 and p not in dropped:
                score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def hard_rows(spark):
    rng = random.Random(2)
    words = [cases.prose(rng, 1, "lo ra mi ten dus é 漢") for _ in range(60)]
    rows = []
    for i in range(400):
        w = [rng.choice(words[: rng.randint(1, 60)]) for _ in range(rng.randint(1, 40))]
        rows.append((i, rng.choice(["aa", "aa", "bb", None, "und"]), "".join(x + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "! "]) for x in w)))
    rows += [(900, "aa", "x x x x x x x x x x x x x x"), (901, "aa", None), (902, "", "ONE two"), (903, "cc", "."), (904, None, "rare pair " * 3)]
    extra = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    return cases.documents(spark).select("doc_id", "lang", "text", "n", "score", "block").unionByName(extra, allowMissingColumns=True)


@pytest.mark.parametrize("share,bits", [(8, 1 << 16), (1_000_000, 1 << 16), (8, 64)])
def test_counts_are_exact_whatever_the_sample_proposes(spark, share, bits):
    """Also no proposals (every phrase is a border failure), and a full filter."""
    docs = hard_rows(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    got = C.collocations(docs, least=3, top=50, share=share, bits=bits).collect()
    assert sorted(map(tuple, got)) == expected(rows, 3, 50)


def test_every_frequent_phrase_is_counted_once(spark):
    found = C.mine(hard_rows(spark), least=3, share=1_000_000, bits=1 << 16).filter("w1 is not null")
    assert found.count() == found.select("w1", "w2", "w3").distinct().count()
    assert found.filter("n < 3").count() == 0


def test_empty_table_and_query(spark):
    assert C.collocations(cases.none(spark)).count() == 0
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, E.queries()["op11_collocations"](spark, cases.SF).collect())) == expected(rows, 10, 2000)


def test_texts_reach_tasks_in_bounded_batches(spark, monkeypatch):
    key, kept, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", C.stored, []
    before = spark.conf.get(key)

    def rows_of(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    def stored(df, name):
        seen.append(max(r.n for r in spark.range(2500).coalesce(1).mapInArrow(rows_of, "n bigint").collect()))
        return kept(df, name)

    monkeypatch.setattr(C, "stored", stored)
    docs = spark.createDataFrame([(i, "one two three", "en") for i in range(20)], "doc_id bigint, text string, lang string")
    assert C.mine(docs, least=10).count() == 7  # three words, two pairs, a triple, the total
    assert seen and max(seen) <= C.TEXTS and spark.conf.get(key) == before
