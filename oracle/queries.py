"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from oracle.ctes import with_ctes


LOAN_DATES = ("origination_date", "maturity_date", "reporting_date")
CPTY_DATES = ("onboarding_date", "last_review_date", "reporting_date")
RD_ONLY = ("reporting_date",)


def final(src: str, doubles=(), bigints=(), drop=(), dates=()) -> str:
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    repl += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    parts = ["*"]
    if drop:
        parts = [f"* EXCLUDE ({', '.join(drop)})"]
    if repl:
        parts[0] += f" REPLACE ({', '.join(repl)})"
    return f"SELECT {parts[0]} FROM {src}"


LOAN_D = ("exposure_amount", "outstanding_balance", "committed_amount", "ead_estimate",
          "collateral_value", "pd_estimate", "lgd_estimate")
CPTY_D = ("credit_limit",)
RWA_D = ("risk_weight", "ead", "credit_rwa", "operational_rwa", "market_rwa", "total_rwa",
         "capital_requirement")
CAP_D = ("cet1_capital", "additional_tier1", "tier2_capital", "total_capital", "risk_weighted_assets",
         "cet1_ratio", "tier1_ratio", "total_capital_ratio", "leverage_ratio", "lcr", "nsfr")
STRESS_D = ("stressed_pd", "stressed_lgd", "stressed_ead", "expected_loss", "stressed_rwa", "capital_impact")
ENR_D = ("exposure_amount", "outstanding_balance", "ead_estimate", "collateral_value", "pd_estimate",
         "lgd_estimate", "risk_weight", "credit_rwa", "operational_rwa", "market_rwa", "total_rwa",
         "capital_requirement", "expected_loss", "unexpected_loss_proxy", "ltv_ratio",
         "collateral_coverage_ratio")
RWA_REP_D = ("total_exposure", "total_outstanding", "total_ead", "total_collateral", "total_credit_rwa",
             "total_operational_rwa", "total_market_rwa", "total_rwa", "total_capital_requirement",
             "exposure_weighted_pd", "exposure_weighted_lgd", "total_expected_loss", "defaulted_ead",
             "avg_risk_weight", "el_ratio_pct", "default_rate_pct", "collateral_coverage_ratio")
CAPADQ_D = CAP_D + ("cet1_minimum", "tier1_minimum", "total_capital_minimum", "conservation_buffer",
                    "lcr_minimum", "nsfr_minimum", "cet1_headroom_pct", "distributable_headroom_pct",
                    "capital_surplus_shortfall", "prior_period_cet1_ratio", "cet1_ratio_qoq_change")
LIQ_D = ("lcr", "nsfr", "leverage_ratio", "lcr_minimum", "nsfr_minimum", "lcr_headroom", "nsfr_headroom",
         "prior_lcr", "lcr_qoq_change")
CCAR_D = ("total_baseline_ead", "total_stressed_ead", "avg_stressed_pd", "avg_stressed_lgd",
          "total_expected_loss", "total_stressed_rwa", "total_capital_impact", "total_incremental_loss",
          "ead_stress_growth_pct", "stressed_loss_rate_pct")
CCAR_I = ("scenario_year", "loan_count", "severity_rank", "scenario_order")
LAST_TWO = """
  WHERE reporting_period IN (SELECT DISTINCT reporting_period FROM {} ORDER BY reporting_period DESC NULLS LAST LIMIT 2)"""


def registry() -> dict[str, str]:
    from oracle.quality_sql import registry as quality_registry

    return quality_registry() | {
        "stg_loan_portfolio": with_ctes(final("stg_loans", LOAN_D, dates=LOAN_DATES), ("stg_loans",)),
        "stg_counterparties": with_ctes(final("stg_cpty", CPTY_D, dates=CPTY_DATES), ("stg_cpty",)),
        "stg_rwa_components": with_ctes(final("stg_rwa", RWA_D, dates=RD_ONLY), ("stg_rwa",)),
        "stg_capital_components": with_ctes(final("stg_capital", CAP_D, dates=RD_ONLY), ("stg_capital",)),
        "stg_stress_scenarios": with_ctes(final("stg_stress", STRESS_D, ("scenario_year",), dates=RD_ONLY), ("stg_stress",)),
        "credit_risk_enriched": with_ctes(final("enriched", ENR_D, dates=LOAN_DATES), ("enriched",)),
        "basel3_rwa_report": with_ctes(
            final("rwa_report", RWA_REP_D, ("loan_count", "defaulted_loan_count", "watch_list_count"), dates=RD_ONLY),
            ("rwa_report",)),
        "capital_adequacy": with_ctes(final("capital_adequacy", CAPADQ_D, dates=RD_ONLY), ("capital_adequacy",)),
        "ccar_stress_test": with_ctes(final("ccar", CCAR_D, CCAR_I, dates=RD_ONLY), ("ccar",)),
        "ccar_stress_test_low_buffer": with_ctes(final("ccar_low", CCAR_D, CCAR_I, dates=RD_ONLY), ("ccar_low",)),
        "liquidity_coverage": with_ctes(final("liquidity", LIQ_D, dates=RD_ONLY), ("liquidity",)),
        "report_capital_summary": with_ctes(final("r_capital_summary", (
            "cet1_ratio_pct", "tier1_ratio_pct", "total_capital_ratio_pct", "cet1_headroom_pct",
            "capital_surplus_billions")), ("r_capital_summary",)),
        "report_rwa_by_class": with_ctes(final("r_rwa_by_class", (
            "total_ead_billions", "total_rwa_billions", "avg_risk_weight_pct", "expected_loss_millions",
            "avg_pd_pct", "default_rate_pct")), ("r_rwa_by_class",)),
        "report_scenarios": with_ctes(final("r_scenarios", (
            "baseline_ead_billions", "stressed_ead_billions", "expected_loss_billions",
            "capital_impact_billions", "avg_loss_rate_pct", "avg_ead_growth_pct"), ("scenario_year",)),
            ("r_scenarios",)),
        "report_sector_concentration": with_ctes(final("r_sector", (
            "ead_billions", "ead_pct_of_total", "rwa_billions", "avg_pd_pct", "avg_el_ratio_pct")),
            ("r_sector",)),
        "report_capital_trend": with_ctes(final("r_capital_trend", (
            "cet1_ratio", "qoq_change", "lcr", "nsfr")), ("r_capital_trend",)),
        "report_watch_list": with_ctes(final("r_watch_list", (
            "ead_millions", "pd_pct", "lgd_pct", "expected_loss_millions", "ltv_ratio")), ("r_watch_list",)),
        "report_liquidity": with_ctes(final("r_liquidity", (
            "lcr", "nsfr", "lcr_headroom", "nsfr_headroom")), ("r_liquidity",)),
        "report_row_counts": with_ctes(final("r_row_counts", (), ("row_count",)), ("r_row_counts",)),
        "raw_csv_roundtrip": with_ctes(final("src_loans", LOAN_D, dates=LOAN_DATES), ("src_loans",)),
        "raw_csv_counterparties": with_ctes(final("src_counterparties", CPTY_D, dates=CPTY_DATES), ("src_counterparties",)),
        "raw_csv_rwa": with_ctes(final("src_rwa", RWA_D, dates=RD_ONLY), ("src_rwa",)),
        "raw_csv_capital": with_ctes(final("src_capital", CAP_D, dates=RD_ONLY), ("src_capital",)),
        "raw_csv_stress": with_ctes(final("src_stress", STRESS_D, ("scenario_year",), dates=RD_ONLY), ("src_stress",)),
        "bulk_load": with_ctes(
            final("src_loans", LOAN_D, dates=LOAN_DATES) + " WHERE internal_rating IS DISTINCT FROM 'CCC'", ("src_loans",)),
        "bulk_load_rejects": with_ctes(
            "SELECT 'exposure_amount' AS columns, count(*)::BIGINT AS records FROM src_loans WHERE internal_rating = 'CCC'",
            ("src_loans",)),
        "credit_risk_enriched_bucketed": with_ctes(final("enriched", ENR_D, dates=LOAN_DATES), ("enriched",)),
        "ccar_stress_test_bucketed": with_ctes(final("ccar", CCAR_D, CCAR_I, dates=RD_ONLY), ("ccar",)),
        "report_stored_row_counts": with_ctes(
            "SELECT table_schema, table_name, CAST(row_count AS BIGINT) AS row_count FROM r_row_counts WHERE table_schema <> 'STAGING'",
            ("r_row_counts",)),
        "rwa_report_refreshed": with_ctes(
            final("rwa_report", RWA_REP_D, ("loan_count", "defaulted_loan_count", "watch_list_count"), dates=RD_ONLY),
            ("rwa_report",)),
        "capital_adequacy_carried": with_ctes(
            final("capital_adequacy", CAPADQ_D, dates=RD_ONLY) + LAST_TWO.format("capital_adequacy"), ("capital_adequacy",)),
        "liquidity_coverage_carried": with_ctes(
            final("liquidity", LIQ_D, dates=RD_ONLY) + LAST_TWO.format("liquidity"), ("liquidity",)),
        "segment_drill_clustered": with_ctes(final("f_drill_worst", ENR_D, dates=LOAN_DATES), ("f_drill_worst",)),
        "published_table": with_ctes(final("stg_capital", CAP_D, dates=RD_ONLY), ("stg_capital",)),
        "sql_macros": with_ctes("""
            SELECT 'loan' AS kind, loan_id AS id, CAST(el AS DOUBLE) AS amount,
              CAST(round(ead_estimate * 0.105, 2) AS DOUBLE) AS required, coalesce(bucket, 'Unrated') AS label
            FROM stg_loans JOIN loan_measures ON m_loan = loan_id
            UNION ALL
            SELECT 'entity', entity_id || ' ' || reporting_period, CAST(cet1_capital AS DOUBLE),
              CAST(round(risk_weighted_assets * 0.08, 2) AS DOUBLE), capital_adequacy_status FROM capital_adequacy
            """, ("stg_loans", "loan_measures", "capital_adequacy")),
        "rwa_standardized": with_ctes(final("f_rwa_std", RWA_D), ("f_rwa_std",)),
        "capital_ratios": with_ctes(final("f_capital_ratios", (
            "total_capital_calc", "cet1_ratio_calc", "tier1_ratio_calc", "total_capital_ratio_calc")),
            ("f_capital_ratios",)),
        "stress_shock": with_ctes(final("f_stress_shock", STRESS_D, ("scenario_year",), dates=RD_ONLY), ("f_stress_shock",)),
        "segment_drill_through": with_ctes(final("f_drill", ENR_D, dates=LOAN_DATES), ("f_drill",)),
        "expected_loss_by_rating": with_ctes(final("f_el_by_rating", (
            "total_ead", "total_expected_loss", "el_rate_pct"), ("loans",)), ("f_el_by_rating",)),
        "capital_requirement_by_class": with_ctes(final("f_capreq_by_class", (
            "total_rwa", "sum_loan_requirements", "requirement_at_0_08", "requirement_at_0_105"),
            ("exposures",)), ("f_capreq_by_class",)),
    }
