"""The macros as SQL functions, and counters gathered while tables are written."""

from decimal import Decimal

from pyspark.sql import functions as F

from riskforge.config import Thresholds
from riskforge.functions import macros, risk
from riskforge.operators import quality
from riskforge.operators.quality import a_less_than_b, between, in_set, not_null, positive, row_count_between, unique


def test_macros_equal_the_column_expressions(spark):
    macros.register(spark)
    ratings = [r for _, group in risk.RATING_BUCKETS for r in group] + ["NR", None]
    rows = [(r, Decimal(i).scaleb(-2), Decimal("0.45"), Decimal("100.07") * i, Decimal(i) / 2) for i, r in enumerate(ratings)]
    rows.append((None, None, None, None, None))
    df = spark.createDataFrame(rows, "r string, p decimal(10,6), l decimal(10,6), e decimal(20,2), c decimal(10,4)")
    got = df.select(
        F.expr("calculate_expected_loss(p, l, e)"), F.expr("capital_requirement(e)"), F.expr("capital_requirement(e, 0.105)"),
        F.expr("rating_bucket(r)"), F.expr("capital_adequacy_status(c)"),
    )
    want = df.select(
        risk.expected_loss("p", "l", "e"), risk.capital_requirement("e"), risk.capital_requirement("e", "0.105"),
        risk.rating_bucket("r"), risk.capital_adequacy_status("c"),
    )
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]


def test_macros_follow_thresholds_and_stay_in_the_jvm(spark):
    macros.register(spark, Thresholds(cet1_minimum_ratio=Decimal("5.0")))
    df = spark.sql("SELECT capital_adequacy_status(c) AS s FROM VALUES (4.9), (7.4), (9.4), (9.5) t(c)")
    assert [r.s for r in df.collect()] == [risk.STATUS_BELOW_MIN, risk.STATUS_BUFFER, risk.STATUS_ADEQUATE, risk.STATUS_WELL]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    macros.register(spark)


def _land(spark, df, checks, path):
    def write(rows):
        rows.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return quality.land(df, checks, write)


def test_landed_counters_give_the_same_results(spark, build, tmp_path):
    for name, checks in quality.SUITES.items():
        raw = build.raw[name]
        stored, counters = _land(spark, raw, checks, f"{tmp_path}/{name}")
        got = quality.run_suite(name, stored, checks, counters=counters)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.run_suite(name, raw, checks).collect()))


def test_landed_counters_need_no_scan(spark, build, tmp_path):
    checks = quality.SUITES["capital_components"]  # neither unique nor in-set checks
    stored, counters = _land(spark, build.raw["capital_components"], checks, f"{tmp_path}/capital")
    plan = quality.run_suite("capital", stored, checks, counters=counters)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_landed_hard_rows(spark, tmp_path):
    checks = [
        row_count_between(1, 10), not_null("a"), unique("a"), positive("b"), between("b", 0, 2),
        in_set("c", ["x"]), a_less_than_b("b", "d", threshold=50.0),
    ]
    rows = [(1, 1.0, "x", "2"), (1, float("nan"), None, "n/a"), (None, None, "y", None), (None, -1.0, "x", "-1")]
    for k, data in enumerate((rows, [])):
        df = spark.createDataFrame(data, "a int, b double, c string, d string")
        stored, counters = _land(spark, df, checks, f"{tmp_path}/{k}")
        got = quality.run_suite("s", stored, checks, counters=counters)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.run_suite("s", df, checks).collect()))
