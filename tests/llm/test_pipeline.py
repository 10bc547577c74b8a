"""The pipeline against a brute-force version, and its stages on hard rows."""

from collections import Counter

import duckdb
import pyarrow as pa

import corpus_pipeline as P
from oracle.compare import norm
from riskforge.llm.sql import MIXING, SHARDING
from tests.llm import cases
from tests.llm.test_decontamination import brute


def by_sql(rows: list[tuple], sql: str) -> list[dict]:
    con = duckdb.connect()
    names = ("doc_id", "text", "source")
    documents = pa.table({n: [r[k] for r in rows] for k, n in enumerate(names)})  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM documents")
    found = con.execute(sql)
    return [dict(zip([d[0] for d in found.description], r)) for r in found.fetchall()]


def test_run_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d in docs if any(c.isalpha() for c in d[1])]
    texts = list(dict.fromkeys(d[1] for d in docs))
    cls = dict(zip(texts, cases.near_classes(texts)))
    first = {}
    for d in sorted(docs):
        first.setdefault(cls[d[1]], d)
    docs = list(first.values())
    bad = {r[0] for r in brute([(d[0], d[1]) for d in docs], items) if r[5]}
    docs = [d for d in docs if d[0] not in bad]
    assert bad and len(first) < len(texts)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in by_sql(docs, MIXING) if r["size"]}
    mixed = [d for d in docs for _ in range(taken.get(d[0], 0))]
    want = Counter(tuple(norm(v) for v in r.values()) for r in by_sql(mixed, SHARDING))
    out = P.run(spark, cases.SF)
    got = Counter(tuple(norm(v) for v in r) for r in out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect())
    # copies of a document are alike, so they may change places
    assert got == want


def test_stages_take_hard_rows(spark):
    for make in (cases.documents, cases.none):
        docs = make(spark)
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, cases.SF)
            assert [c for c in out.columns] == docs.columns, name
            assert out.count() <= docs.count() * (2 if name == "mixing" else 1)
        assert P.STAGES[-1][1](spark, docs, cases.SF).count() == docs.count()
