"""Table rebuilds, CSV quoting, NaN in the gate, settings."""

import datetime as dt
import json
import os

import pyarrow.parquet as pq
import pytest

from riskforge import __main__ as cli
from riskforge.operators import quality
from riskforge.plans import runner
from riskforge.plans.build import Build
from riskforge.session import ensure_checkpoint_dir
from riskforge.sources.raw import load
from riskforge.sources.sinks import materialize_table, register_table

D1, D2 = dt.date(2024, 3, 31), dt.date(2024, 6, 30)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "loan_id string, reporting_date date")


def dates(df):
    return sorted(r.reporting_date for r in df.collect())


def test_a_rebuild_drops_what_the_source_no_longer_has(spark, tmp_path):
    base = str(tmp_path)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    materialize_table(frame(spark, ("a", D1), ("b", D2)), base, "s", "t")
    assert dates(materialize_table(frame(spark, ("a", D1)), base, "s", "t")) == [D1]
    materialize_table(frame(spark, ("a", D1)), base, "rebuild_test", "t")
    empty = materialize_table(frame(spark), base, "rebuild_test", "t")
    assert empty.count() == 0 and empty.columns == ["loan_id", "reporting_date"]
    register_table(empty, base, "rebuild_test", "t")
    assert spark.table("rebuild_test.t").columns == ["loan_id", "reporting_date"]
    assert materialize_table(frame(spark), base, "s", "fresh").count() == 0
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_a_scoped_run_leaves_other_dates_alone(spark, tmp_path):
    base = str(tmp_path)
    materialize_table(frame(spark, ("a", D1), ("b", D2)), base, "s", "t")
    out = materialize_table(frame(spark, ("c", D2), ("d", D2)), base, "s", "t", reporting_date="2024-06-30")
    assert dates(out) == [D1, D2, D2]
    out = materialize_table(frame(spark), base, "s", "t", reporting_date="2024-06-30")
    assert dates(out) == [D1]


def test_csv_quotes(spark, tmp_path):
    path = tmp_path / "counterparties.csv"
    path.write_text(
        'counterparty_id,counterparty_name,kyc_status,credit_limit\n'
        'C1,"A ""B"" Corp, Ltd",Verified,10\nC2,"two\nlines",Pending,\n'
    )
    rows = load(spark, "counterparties", str(path)).orderBy("counterparty_id").collect()
    assert [(r.counterparty_name, r.kyc_status) for r in rows] == [('A "B" Corp, Ltd', "Verified"), ("two\nlines", "Pending")]
    assert rows[0].credit_limit == 10 and rows[1].credit_limit is None


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (0.5, 2.0), (None, 3.0)], "x double, y double")
    checks = [quality.not_null("x"), quality.between("x", 0, 1), quality.positive("x"), quality.a_less_than_b("x", "y")]
    rows = quality.run_suite("s", df, checks).orderBy("check_no").collect()
    assert [r.status for r in rows] == ["FAIL", "PASS", "PASS", "PASS"]
    assert "66.67" in rows[0].detail and "0.00" in rows[1].detail
    text = spark.createDataFrame([("NaN",), ("2",), ("x",)], "x string")
    row = quality.run_suite("s", text, [quality.between("x", 0, 1)]).first()
    assert "33.33" in row.detail


def test_unique_counts_null_as_one_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "k string")
    row = quality.run_suite("s", df, [quality.not_null("k"), quality.unique("k")]).filter("check_no = 2").first()
    assert row.detail == "Duplicate count: 3"
    none = quality.run_suite("s", df.limit(0), [quality.not_null("k"), quality.unique("k")]).filter("check_no = 2").first()
    assert none.detail == "Duplicate count: 0"


def test_row_count_bounds_can_be_set():
    suites = quality.with_row_counts({"loan_portfolio": (1, 10**9)})
    assert suites["loan_portfolio"][0].args == (1, 10**9)
    assert suites["counterparties"] == quality.SUITES["counterparties"]
    assert suites["loan_portfolio"][1:] == quality.SUITES["loan_portfolio"][1:]


def test_config_file(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({
        "thresholds": {"cet1_minimum_ratio": 5.25}, "stress": {"scenario_order": [["Mild", 1]]}, "row_counts": {"rwa_components": [1, 5]},
    }))
    options, suites = cli._settings(spark, f"file://{path}")
    assert str(options["thresholds"].cet1_minimum_ratio) == "5.25" and options["stress"].scenario_order == (("Mild", 1),)
    assert suites["rwa_components"][0].args == (1, 5)
    assert cli._exists(spark, f"file://{path}") and not cli._exists(spark, f"{path}x")


def test_several_snapshots_need_a_scope(spark, build, tmp_path):
    raw = dict(build.raw)
    later = raw["loan_portfolio"].withColumn("reporting_date", raw["loan_portfolio"]["reporting_date"] + 90)
    raw["loan_portfolio"] = raw["loan_portfolio"].unionByName(later)
    with pytest.raises(ValueError, match="several reporting dates"):
        runner.run(spark, Build(raw), str(tmp_path), enforce_gate=False)


def test_no_shared_folder_is_an_error_on_a_cluster():
    class Conf:
        def get(self, *a):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Fake())


def test_changed_input_files_are_read_again(spark, tmp_path):
    import shutil

    from riskforge.sources.testdata import TPCH_TABLES

    for t in TPCH_TABLES:
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    first = Build.from_testdata(spark, str(tmp_path), audit=False).stg_loan_portfolio.count()
    pq.write_table(pq.read_table("/root/testdata/sf0.001/orders.parquet").slice(0, 100), tmp_path / "orders.parquet")
    assert Build.from_testdata(spark, str(tmp_path), audit=False).stg_loan_portfolio.count() < first
    assert os.path.exists(tmp_path / "orders.parquet")
