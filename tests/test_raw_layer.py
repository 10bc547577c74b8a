"""What a query makes of the raw layer: the tables that it reads, each written once."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from riskforge.operators import marts
from riskforge.plans import queries
from riskforge.plans.build import Build
from riskforge.session import warehouse_path
from riskforge.sources.raw import load
from riskforge.sources.testdata import raw_tables
from tests.conftest import SMALL


@pytest.fixture
def base(spark):
    return warehouse_path(spark, f"raw_layer_test/{uuid.uuid4().hex}")


@pytest.fixture
def recorded(spark, base):
    """A store that writes, and the columns of what it wrote by name."""
    written = {}

    def stored(name, df):
        assert name not in written
        written[name] = df.columns
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    return stored, written


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_only_tables_that_are_read_are_derived(spark, recorded):
    stored, written = recorded
    raw = raw_tables(spark, SMALL, stored)
    assert not written and len(raw) == 5
    raw["capital_components"]
    assert list(written) == ["capital_components"]
    loans = raw["loan_portfolio"]  # the stored keyed loans, not a copy of them
    assert list(written) == ["capital_components", "_loans_keyed"]
    assert same(loans, raw_tables(spark, SMALL)["loan_portfolio"])
    assert dict(raw).keys() == raw.keys() and len(written) == 5


def test_only_joined_loan_tables_are_bucketed(spark, build, base):
    b = build.on_loan_key(base, 4)
    assert same(b.credit_risk_enriched, build.credit_risk_enriched)
    assert sorted(f.rsplit("_", 1)[0] for f in os.listdir(base.removeprefix("file:"))) == ["loan_portfolio", "rwa_components"]
    assert same(b.ccar_stress_test, build.ccar_stress_test)
    assert len(os.listdir(base.removeprefix("file:"))) == 3


def test_the_rwa_mart_stores_the_columns_it_reads(spark, build, recorded):
    stored, written = recorded
    mart = Build(build.raw, audit=False, store=stored).basel3_rwa_report
    assert {k: tuple(v) for k, v in written.items()} == {"int_rwa_mart_loans": marts.RWA_MART_COLUMNS}
    assert same(mart, marts.basel3_rwa_report(build.credit_risk_enriched, audit=False))
    written.clear()
    whole = Build(build.raw, audit=False, store=lambda name, df: stored(f"whole_{name}", df))
    whole.enriched_table
    assert same(whole.basel3_rwa_report, mart) and list(written) == ["whole_int_credit_risk_enriched"]


def test_csv_files_are_of_bounded_rows(spark, base, monkeypatch):
    monkeypatch.setattr(queries, "CSV_ROWS", 10)
    rows = spark.range(95).coalesce(1).select(F.concat(F.lit('a "b"\n'), "id").alias("loan_id"))
    queries._write_csv(rows, f"{base}/csv")
    files = [f for f in os.listdir(f"{base}/csv".removeprefix("file:")) if f.endswith(".csv")]
    assert len(files) == 10
    assert same(load(spark, "loan_portfolio", f"{base}/csv", "csv").select("loan_id"), rows)
