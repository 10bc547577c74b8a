"""Stored layouts: bucketed loan tables, counts from footers, clustered drill, carried periods."""

import uuid

import pytest
from pyspark.sql import functions as F

from riskforge.operators import drill, marts, reports
from riskforge.operators.period_state import PERIOD, PeriodStore, carry
from riskforge.plans.build import Build
from riskforge.session import warehouse_path
from riskforge.sources.bucketed import bucketed, even
from riskforge.sources.footers import stored_count
from tests.conftest import SMALL


@pytest.fixture
def base(spark):
    return warehouse_path(spark, f"layouts/{uuid.uuid4().hex}")


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df) -> int:
    """Rows that the scan of an executed plan without exchanges handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_loan_joins_have_no_exchange(spark, build, base, no_broadcast):
    b = build.on_loan_key(base, 8)
    assert "hashpartitioning(loan_id" in physical(build.credit_risk_enriched)
    for model in ("credit_risk_enriched", "ccar_stress_test"):
        plan = physical(getattr(b, model))
        assert "hashpartitioning(loan_id" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert same(b.credit_risk_enriched, build.credit_risk_enriched)


def test_a_hot_key_is_stored_without_buckets(spark, base):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"), "id")
    assert even(rows, "k", 16) and not even(rows, "k", 16, bucket_rows=100)
    hot = bucketed(rows, base, "hot", "k", 16, bucket_rows=100)
    assert "Bucketed: true" not in physical(hot) and same(hot, rows)
    kept = bucketed(rows, base, "kept", "k", 16)
    assert same(kept, rows) and kept.columns == ["k", "id"]
    assert bucketed(rows.limit(0), base, "none", "k", 4, bucket_rows=0).count() == 0


def test_counts_come_from_footers(spark, build, base):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("d"), F.lit("x").alias("row_count"))
    rows.write.partitionBy("d").parquet(f"{base}/parts")
    rows.limit(0).write.parquet(f"{base}/none")
    counted = stored_count(spark, f"{base}/parts", rows.schema)
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().toString() and counted.first()[0] == 1000
    assert stored_count(spark, f"{base}/none", rows.schema).first()[0] == 0
    models = [("credit", "a", rows), ("capital", "b", rows), ("liquidity", "c", rows.limit(7))]
    table = reports.row_counts(models, stored={"a": f"{base}/parts", "b": f"{base}/none"})
    assert {r.table_name: r.row_count for r in table.collect()} == {"A": 1000, "B": 0, "C": 7}
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_a_drill_reads_its_row_groups(spark, base):
    letter = lambda n: F.concat(F.lit("v"), (F.col("id") % n).cast("string"))
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("loan_id"), F.to_date(F.lit("2001-09-30")).alias("reporting_date"),
        letter(4).alias("asset_class"), F.when(F.col("id") % 3 > 0, letter(5)).alias("rating_bucket"), letter(7).alias("internal_rating"),
        F.lit("IRB").alias("approach"), letter(3).alias("currency"), F.lit(None).cast("string").alias("region"))
    drill.store_clustered(rows, f"{base}/t", row_group_bytes=64 << 10)
    wanted = rows.filter("loan_id = '33'").select(*marts.RWA_SEGMENT_KEYS).first().asDict()
    assert wanted["rating_bucket"] is None and wanted["region"] is None
    found = drill.drill_segment(spark, f"{base}/t", rows.schema, wanted)
    expected = rows.filter("cast(loan_id as int) % 84 = 33")
    assert same(found, expected) and found.columns == rows.columns
    assert scanned(found) < 30_000
    assert drill.drill_segment(spark, f"{base}/t", rows.schema, wanted | {"currency": "none"}).isEmpty()
    assert drill.drill_segment(spark, f"{base}/t", rows.schema, wanted | {"currency": None}).isEmpty()
    drill.store_clustered(rows.limit(0), f"{base}/none")
    assert drill.drill_segment(spark, f"{base}/none", rows.schema, wanted).count() == 0


def capital_rows(spark, build, kept):
    return build.stg_capital_components.filter(F.pmod(F.xxhash64("entity_id", PERIOD), F.lit(10)) < kept)


def test_carried_periods_equal_the_full_history(spark, build, base):
    capital = capital_rows(spark, build, 7)  # entities skip periods
    store = PeriodStore(spark, base, capital.schema)
    store.append(capital)
    periods = sorted(r[0] for r in capital.select(PERIOD).distinct().collect())
    store.start(periods[3])
    for before, period in zip(periods[3:6], periods[4:7]):
        for mart in (marts.capital_adequacy, marts.liquidity_coverage):
            built = store.build(lambda c, m=mart: m(c, audit=False), period, before)
            assert same(built, mart(capital, audit=False).filter(F.col(PERIOD) == period))
        store.advance(period, before)
    plan = physical(store.build(lambda c: marts.capital_adequacy(c, audit=False), periods[6], periods[5]))
    assert f"reporting_period = {periods[6]}" in plan.replace("`", "") or f"= {periods[6]}" in plan
    files = store.rows(periods[6]).inputFiles()
    assert store.rows(periods[6]).select(PERIOD).distinct().count() == 1 and files
    assert plan.count("PartitionFilters: [isnotnull(") == 2
    assert carry(store.state(periods[5]), capital.limit(0)).count() == store.state(periods[5]).count()
    assert carry(None, capital.limit(0)).count() == 0
