"""Mixing and sharding: SQL, laws, hard rows."""

import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
from oracle.compare import compare, connect
from riskforge.llm import mixing, sharding
from tests.llm import cases


@pytest.mark.parametrize("name", ["op4_decontamination", "op5_mixing", "op10_sharding"])
def test_sql(spark, name):
    ok, why = compare(E.queries()[name](spark, cases.SF), connect(cases.SF), E.oracle_sql()[name])
    assert ok, why


@pytest.mark.parametrize("module", [mixing, sharding])
def test_no_python_in_the_plan(spark, module):
    plan = module.digest(cases.documents(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))


def test_sharding_laws(spark):
    docs = cases.documents(spark)
    rows = sharding.digest(docs).collect()
    source = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert [tuple(r) for r in sharding.digest(docs).orderBy("shard", "slot").collect()] == sorted(
        map(tuple, rows), key=lambda r: (r[4], r[5])
    )


def test_shards_match_the_mixture(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'x' as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    placed = sharding.shard_documents(docs, 8, keep=("source",))
    share = {r.source: r["count"] / 4000 for r in docs.groupBy("source").count().collect()}
    for r in placed.groupBy("shard", "source").count().collect():
        assert abs(r["count"] - share[r.source] * 500) <= 2


def test_sources_of_one_row(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "'x' as text", "cast(id as string) as source")
    counts = [r["count"] for r in sharding.shard_documents(docs).groupBy("shard").count().collect()]
    assert counts == [25] * 8


def targets_by_rounds(sizes: list[int]) -> list[float]:
    """Sources in order: share, stop at twice the size, share the excess again."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    left, target = 1.5 * sum(sizes), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > 2 * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = 2.0 * sizes[i]
            left -= target[i]
            free.remove(i)
    return target


def test_mixing_targets_and_draws(spark):
    docs = cases.documents(spark, rows=400)
    rows = mixing.digest(docs).collect()
    assert len(rows) == docs.count()
    size, taken, target, total = Counter(), Counter(), {}, {}
    joined = mixing.mix_documents(docs.select("doc_id", "text", "source", docs.source.alias("src")), keep=("src",)).collect()
    for r in joined:
        assert r.taken in (0, r["size"], 2 * r["size"]) and len(r.draws) == (r.taken // r["size"] if r["size"] else 0)
        size[r.src] += r["size"]
        taken[r.src] += r.taken
        target[r.src], total[r.src] = r.target, r.source_size
    order = sorted(size, key=lambda s: (s is None, s))
    assert dict(size) == total
    assert [target[s] for s in order] == pytest.approx(targets_by_rounds([size[s] for s in order]))
    for s in order:  # 40,000 words of source s0 are one document
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 120 if s != "s0" else 20_000)
    assert sorted(map(str, mixing.digest(docs).collect())) == sorted(map(str, rows))


def test_splitting_tree_is_exact(spark):
    quotas = spark.createDataFrame([("a", 100), ("b", 37), ("c", 1)], "s_key string, blocks int")
    rows = mixing.block_shards(quotas, 8, "seed").collect()
    assert Counter((r.s_key, r.block) for r in rows) == Counter((s, k) for s, n in (("a", 100), ("b", 37), ("c", 1)) for k in range(n))
    sizes = Counter(r["shard"] for r in rows)
    assert sum(sizes.values()) == 138 and max(sizes.values()) - min(sizes.values()) <= 2


def test_mixed_rows_keep_columns(spark):
    docs = cases.documents(spark)
    out = mixing.mixed_rows(docs)
    assert out.columns == [c for c in docs.columns if c not in ("shard", "block")] + ["shard", "block", "mix_key"]
    taken = {}
    for r in mixing.mix_documents(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.draws)
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in taken.items() if v})


def test_empty(spark):
    assert sharding.digest(cases.none(spark)).collect() == []
    assert mixing.digest(cases.none(spark)).collect() == []
    assert mixing.mixed_rows(cases.none(spark)).collect() == []
