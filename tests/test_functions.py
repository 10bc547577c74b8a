import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskforge.config import Thresholds, schema_name
from riskforge.functions import risk


def one(spark, col, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_rating_bucket_all_labels(spark):
    ratings = ["AAA", "AA-", "A+", "A-", "BBB", "BB+", "B", "CCC", "NR", None]
    got = one(spark, risk.rating_bucket("r"), "r string", [(r,) for r in ratings])
    assert got == [
        "Investment Grade — High", "Investment Grade — High",
        "Investment Grade — Upper Mid", "Investment Grade — Upper Mid",
        "Investment Grade — Lower Mid", "Sub-Investment Grade — High",
        "Sub-Investment Grade — Low", "Sub-Investment Grade — Low", "Unrated", "Unrated",
    ]


def test_pd_bucket_edges_are_right_open(spark):
    pds = ["0.009999", "0.01", "0.05", "0.10", "0.199999", "0.20", None]
    rows = [(Decimal(p) if p else None,) for p in pds]
    got = one(spark, risk.pd_bucket("p"), "p decimal(10,6)", rows)
    assert got == ["<1%", "1-5%", "5-10%", "10-20%", "10-20%", ">20%", ">20%"]


def test_maturity_bucket_counts_calendar_years(spark):
    r = dt.date(2024, 3, 31)
    rows = [
        (r, dt.date(2025, 1, 1)),   # 1 year boundary
        (r, dt.date(2027, 12, 31)),  # 3
        (r, dt.date(2029, 1, 1)),   # 5
        (r, dt.date(2034, 6, 1)),   # 10
        (r, dt.date(2035, 1, 1)),   # 11
        (r, dt.date(2020, 1, 1)),   # matured
        (r, None),
    ]
    got = one(spark, risk.maturity_bucket("r", "m"), "r date, m date", rows)
    assert got == ["0-1Y", "1-3Y", "3-5Y", "5-10Y", "10Y+", "0-1Y", "10Y+"]


def test_year_diff_is_boundary_count(spark):
    got = one(spark, risk.year_diff("a", "b"), "a date, b date", [(dt.date(2024, 3, 31), dt.date(2025, 1, 1))])
    assert got == [1]


def test_capital_adequacy_status_bands(spark):
    vals = ["4.4999", "4.5", "6.9999", "7.0", "8.9999", "9.0", None]
    rows = [(Decimal(v) if v else None,) for v in vals]
    got = one(spark, risk.capital_adequacy_status("c"), "c decimal(10,4)", rows)
    assert got == [
        risk.STATUS_BELOW_MIN, risk.STATUS_BUFFER, risk.STATUS_BUFFER, risk.STATUS_ADEQUATE,
        risk.STATUS_ADEQUATE, risk.STATUS_WELL, risk.STATUS_WELL,
    ]


def test_status_follows_thresholds(spark):
    t = Thresholds(cet1_minimum_ratio=Decimal("5.0"))
    got = one(spark, risk.capital_adequacy_status("c", t), "c decimal(10,4)", [(Decimal("4.9"),), (Decimal("7.4"),)])
    assert got == [risk.STATUS_BELOW_MIN, risk.STATUS_BUFFER]


def test_expected_loss_is_exact_half_up(spark):
    rows = [(Decimal("0.5"), Decimal("0.5"), Decimal("0.02"))]  # 0.005 -> 0.01
    got = one(spark, risk.expected_loss("p", "l", "e"), "p decimal(10,6), l decimal(10,6), e decimal(20,2)", rows)
    assert got == [Decimal("0.01")]


def test_capital_requirement_macro(spark):
    got = one(spark, risk.capital_requirement("r"), "r decimal(20,2)", [(Decimal("100.07"),)])
    assert got == [Decimal("8.01")]  # 8.0056 -> 8.01


def test_ratio_zero_divisor_is_null(spark):
    rows = [(Decimal("1.00"), Decimal("0.00")), (Decimal("1.00"), Decimal("3.00"))]
    got = one(spark, risk.ratio("a", "b"), "a decimal(20,2), b decimal(20,2)", rows)
    assert got == [None, Decimal("0.33333333")]


def test_money_units_exact(spark):
    got = one(spark, F.round(risk.money_units("x", 9), 3), "x decimal(20,2)", [(Decimal("1499500000.00"),)])
    assert got == [Decimal("1.500")]


def test_risk_weight_default(spark):
    got = one(spark, risk.risk_weight("r"), "r string", [("AAA",), ("BB",), ("NR",)])
    assert [float(x) for x in got] == [0.2, 1.5, 1.0]


@pytest.mark.parametrize(
    "custom,target,name,expected",
    [(None, "analytics", "dev", "analytics"), ("staging", "analytics", "prod", "staging"),
     (" marts ", "analytics", "dev", "analytics_marts")],
)
def test_schema_name(custom, target, name, expected):
    assert schema_name(custom, target, name) == expected


def test_cluster_profile_respects_submitted_values(spark):
    from riskforge.session import CLUSTER_DEFAULTS, get_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = get_session(profile="cluster")
    try:
        assert s.conf.get("spark.sql.files.maxPartitionBytes") in ("256m", str(256 * 1024 * 1024))
        assert s.conf.get("spark.sql.adaptive.enabled") == "true"
        assert set(CLUSTER_DEFAULTS) >= {"spark.sql.shuffle.partitions"}
    finally:
        for k in CLUSTER_DEFAULTS:
            s.conf.unset(k)
        s.conf.set("spark.sql.shuffle.partitions", before)
