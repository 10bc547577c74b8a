import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from riskforge.operators import marts

R = dt.date(2024, 3, 31)
LOANS = ("loan_id string, counterparty_id string, asset_class string, product_type string, sector string, "
         "region string, country string, currency string, exposure_amount decimal(20,2), "
         "outstanding_balance decimal(20,2), committed_amount decimal(20,2), ead_estimate decimal(20,2), "
         "collateral_value decimal(20,2), internal_rating string, pd_estimate decimal(10,6), "
         "lgd_estimate decimal(10,6), collateral_type string, origination_date date, maturity_date date, "
         "reporting_date date, is_defaulted boolean, is_impaired boolean, source_system string")
CPTY = "counterparty_id string, counterparty_name string, counterparty_type string, kyc_status string, " \
       "is_pep boolean, external_rating string"
RWA = ("loan_id string, risk_weight decimal(10,4), credit_rwa decimal(20,2), operational_rwa decimal(20,2), "
       "market_rwa decimal(20,2), total_rwa decimal(20,2), capital_requirement decimal(20,2), approach string")


def loan(lid, cp="C1", pd="0.02", out="50.00", coll="100.00", imp=False, ead="100.00", rating="AAA"):
    return (lid, cp, "SME Loan", "Term Loan", "Energy", "EU", "X", "EUR", D("100.00"), D(out), D("120.00"),
            D(ead), D(coll), rating, D(pd), D("0.4"), "Cash", R, dt.date(2026, 1, 1), R, False, imp, "M")


def test_enriched_joins_and_watch_list(spark):
    loans = spark.createDataFrame([
        loan("L1"),                                   # nothing flagged
        loan("L2", pd="0.11"),                        # PD > 10%
        loan("L3", out="130.00"),                     # LTV 1.3
        loan("L4", coll="0.00"),                      # no collateral: LTV NULL -> flag NULL
        loan("L5", cp="SANCTIONED", coll="0.00", imp=True),  # impaired wins over NULL LTV
    ], LOANS)
    cpty = spark.createDataFrame([("C1", "One", "SME", "Verified", False, "A")], CPTY)
    rwa = spark.createDataFrame([
        ("L1", D("1"), D("1"), D("1"), D("1"), D("3"), D("0.24"), "Standardized"),
        ("L1", D("1"), D("1"), D("1"), D("1"), D("3"), D("0.24"), "Standardized"),  # duplicate fans out
    ], RWA)
    e = marts.credit_risk_enriched(loans, cpty, rwa)
    assert len(e.columns) == 41
    rows = {r["loan_id"]: r for r in e.collect() if r["loan_id"] != "L1"}
    assert e.filter("loan_id = 'L1'").count() == 2
    assert rows["L2"]["is_watch_list"] is True
    assert rows["L3"]["is_watch_list"] is True and rows["L3"]["ltv_ratio"] == D("1.3000")
    assert rows["L4"]["is_watch_list"] is None and rows["L4"]["ltv_ratio"] is None
    assert rows["L5"]["is_watch_list"] is True and rows["L5"]["counterparty_name"] is None
    assert rows["L2"]["expected_loss"] == D("4.40")  # 0.11 * 0.4 * 100


def test_rwa_report_ratios_and_edge(spark):
    rows = [("2024-03-31", "A", D("100.00"), D("8.00"), D("1000.00"), D("0.05"), True),
            ("2024-03-31", "A", D("100.00"), D("0.00"), D("0.00"), D("0.05"), False)]
    e = spark.createDataFrame(rows, "reporting_date string, asset_class string, total_rwa decimal(20,2), "
                                    "capital_requirement decimal(20,2), ead_estimate decimal(20,2), "
                                    "pd_estimate decimal(10,6), is_defaulted boolean")
    full = (e.withColumn("loan_id", F.lit("x"))
            .withColumns({c: F.lit(D("1.00")).cast("decimal(20,2)") for c in (
                "exposure_amount", "outstanding_balance", "collateral_value", "credit_rwa",
                "operational_rwa", "market_rwa", "expected_loss")})
            .withColumn("lgd_estimate", F.lit(D("0.5")).cast("decimal(10,6)"))
            .withColumn("is_watch_list", F.lit(None).cast("boolean")))
    out = marts.basel3_rwa_report(full, keys=("reporting_date", "asset_class"), audit=False).first()
    assert out["loan_count"] == 2 and out["defaulted_loan_count"] == 1 and out["watch_list_count"] == 0
    assert out["meets_minimum_capital"] is False  # 8 / 200 = 0.04
    assert out["default_rate_pct"] == D("50.0000")
    assert out["exposure_weighted_pd"] == D("0.050000")
    assert out["avg_risk_weight"] == D("0.2000") and out["high_risk_segment"] is False


CAP = ("entity_id string, reporting_period string, reporting_date date, cet1_capital decimal(20,2), "
       "additional_tier1 decimal(20,2), tier2_capital decimal(20,2), total_capital decimal(20,2), "
       "risk_weighted_assets decimal(20,2), cet1_ratio decimal(10,4), tier1_ratio decimal(10,4), "
       "total_capital_ratio decimal(10,4), leverage_ratio decimal(10,4), lcr decimal(10,4), nsfr decimal(10,4)")


def cap(e, p, cet1, lcr="120", nsfr="110"):
    return (e, p, R, D("10"), D("1"), D("1"), D("12.00"), D("100.00"), D(cet1), D(cet1) + 2, D(cet1) + 4,
            D("5"), D(lcr), D(nsfr))


def test_capital_adequacy_lag_and_flags(spark):
    df = spark.createDataFrame([cap("E1", "2024-Q2", "7.0"), cap("E1", "2024-Q1", "4.5"),
                                cap("E2", "2024-Q1", "9.5", lcr="99.99")], CAP)
    rows = {(r["entity_id"], r["reporting_period"]): r for r in marts.capital_adequacy(df, audit=False).collect()}
    first, second = rows[("E1", "2024-Q1")], rows[("E1", "2024-Q2")]
    assert first["prior_period_cet1_ratio"] is None and first["cet1_ratio_qoq_change"] is None
    assert second["cet1_ratio_qoq_change"] == D("2.5000")
    assert first["meets_cet1_minimum"] is True and first["meets_cet1_with_buffer"] is False
    assert second["meets_cet1_with_buffer"] is True
    assert rows[("E2", "2024-Q1")]["fully_compliant"] is False  # LCR breach
    assert first["capital_surplus_shortfall"] == D("4.00")  # 12 - 100 * 8%


def test_liquidity_status_bands(spark):
    df = spark.createDataFrame([cap("E", "2024-Q1", "9", lcr="99.99", nsfr="104.99"),
                                cap("E", "2024-Q2", "9", lcr="109.99", nsfr="105"),
                                cap("E", "2024-Q3", "9", lcr="110", nsfr="100")], CAP)
    rows = sorted(marts.liquidity_coverage(df, audit=False).collect(), key=lambda r: r["reporting_period"])
    assert [r["lcr_status"] for r in rows] == [
        "LCR Breach — Immediate Action", "LCR Watch — Monitor Daily", "LCR Adequate"]
    assert [r["nsfr_status"] for r in rows] == [
        "NSFR Watch — Monitor Weekly", "NSFR Adequate", "NSFR Watch — Monitor Weekly"]
    assert rows[1]["lcr_qoq_change"] == D("10.00")


def test_ccar_orphans_and_rank_ties(spark):
    stress = spark.createDataFrame([
        ("S1", "L1", "Baseline", 1, D("0.1"), D("0.5"), D("100"), D("10"), D("90"), D("1"), R),
        ("S2", "L1", "Adverse", 1, D("0.2"), D("0.5"), D("110"), D("10"), D("99"), D("1"), R),
        ("S3", "LX", "Adverse", 1, D("0.2"), D("0.5"), D("110"), D("20"), D("99"), D("2"), R),
    ], "scenario_id string, loan_id string, scenario_name string, scenario_year int, stressed_pd decimal(10,6), "
       "stressed_lgd decimal(10,6), stressed_ead decimal(20,2), expected_loss decimal(20,2), "
       "stressed_rwa decimal(20,2), capital_impact decimal(20,2), reporting_date date")
    loans = spark.createDataFrame([loan("L1")], LOANS)
    out = marts.ccar_stress_test(stress, loans, audit=False).collect()
    orphan = [r for r in out if r["asset_class"] is None]
    assert len(orphan) == 1 and orphan[0]["loan_count"] == 1 and orphan[0]["total_baseline_ead"] is None
    tied = sorted(r["severity_rank"] for r in out if r["asset_class"] == "SME Loan")
    assert tied == [1, 1]  # equal EL: same rank
    assert {r["scenario_order"] for r in out} == {1, 2}
