"""Staging: one clean, typed view per raw source.

Each row filter reads the *raw* column, before the cast of the same name,
and sits directly on the scan so Catalyst pushes it into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.functions.risk import MONEY, PROB, RATIO

STRESS_SCENARIO_NAMES = ("Baseline", "Adverse", "Severely Adverse")


def _typed(df: DataFrame, spec: list, audit: bool) -> DataFrame:
    cols = [F.col(c).cast(t).alias(c) if t else F.col(c) for c, t in spec]
    if audit:
        cols.append(F.current_timestamp().alias("_loaded_at"))
    return df.select(*cols)


def stg_loan_portfolio(raw: DataFrame, audit: bool = True) -> DataFrame:
    spec = [
        ("loan_id", None), ("counterparty_id", None), ("asset_class", None),
        ("product_type", None), ("sector", None), ("region", None), ("country", None),
        ("currency", None),
        ("exposure_amount", MONEY), ("outstanding_balance", MONEY), ("committed_amount", MONEY),
        ("ead_estimate", MONEY), ("collateral_value", MONEY),
        ("internal_rating", None), ("pd_estimate", PROB), ("lgd_estimate", PROB),
        ("collateral_type", None),
        ("origination_date", "date"), ("maturity_date", "date"), ("reporting_date", "date"),
        ("is_defaulted", "boolean"), ("is_impaired", "boolean"),
        ("source_system", None),
    ]
    kept = raw.filter(
        F.col("loan_id").isNotNull()
        & (F.col("exposure_amount") > 0)
        & F.col("reporting_date").isNotNull()
    )
    return _typed(kept, spec, audit)


def stg_counterparties(raw: DataFrame, audit: bool = True) -> DataFrame:
    spec = [
        ("counterparty_id", None), ("counterparty_name", None), ("counterparty_type", None),
        ("sector", None), ("country", None), ("region", None), ("external_rating", None),
        ("is_pep", "boolean"), ("is_sanctioned", "boolean"), ("kyc_status", None),
        ("onboarding_date", "date"), ("last_review_date", "date"),
        ("credit_limit", MONEY), ("reporting_date", "date"),
    ]
    # "= false" is NULL for a NULL flag, so unknown sanction status is dropped.
    kept = raw.filter(F.col("counterparty_id").isNotNull() & (F.col("is_sanctioned") == F.lit(False)))
    return _typed(kept, spec, audit)


def stg_rwa_components(raw: DataFrame, audit: bool = True) -> DataFrame:
    spec = [
        ("loan_id", None), ("asset_class", None), ("internal_rating", None),
        ("risk_weight", RATIO), ("ead", MONEY), ("credit_rwa", MONEY),
        ("operational_rwa", MONEY), ("market_rwa", MONEY), ("total_rwa", MONEY),
        ("capital_requirement", MONEY), ("approach", None), ("reporting_date", "date"),
    ]
    kept = raw.filter(F.col("loan_id").isNotNull() & (F.col("total_rwa") >= 0))
    return _typed(kept, spec, audit)


def stg_capital_components(raw: DataFrame, audit: bool = True) -> DataFrame:
    spec = [
        ("entity_id", None), ("reporting_period", None),
        ("cet1_capital", MONEY), ("additional_tier1", MONEY), ("tier2_capital", MONEY),
        ("total_capital", MONEY), ("risk_weighted_assets", MONEY),
        ("cet1_ratio", RATIO), ("tier1_ratio", RATIO), ("total_capital_ratio", RATIO),
        ("leverage_ratio", RATIO), ("lcr", RATIO), ("nsfr", RATIO),
        ("reporting_date", "date"),
    ]
    kept = raw.filter(F.col("entity_id").isNotNull() & (F.col("cet1_capital") > 0))
    return _typed(kept, spec, audit)


def stg_stress_scenarios(raw: DataFrame, audit: bool = True) -> DataFrame:
    spec = [
        ("scenario_id", None), ("loan_id", None), ("scenario_name", None),
        ("scenario_year", None),
        ("stressed_pd", PROB), ("stressed_lgd", PROB),
        ("stressed_ead", MONEY), ("expected_loss", MONEY), ("stressed_rwa", MONEY),
        ("capital_impact", MONEY), ("reporting_date", "date"),
    ]
    kept = raw.filter(
        F.col("scenario_id").isNotNull()
        & F.col("scenario_name").isin(*STRESS_SCENARIO_NAMES)
        & F.col("stressed_pd").between(0, 1)
        & F.col("stressed_lgd").between(0, 1)
    )
    return _typed(kept, spec, audit)


def stage_all(raw: dict[str, DataFrame], audit: bool = True) -> dict[str, DataFrame]:
    return {
        "stg_loan_portfolio": stg_loan_portfolio(raw["loan_portfolio"], audit),
        "stg_counterparties": stg_counterparties(raw["counterparties"], audit),
        "stg_rwa_components": stg_rwa_components(raw["rwa_components"], audit),
        "stg_capital_components": stg_capital_components(raw["capital_components"], audit),
        "stg_stress_scenarios": stg_stress_scenarios(raw["stress_scenarios"], audit),
    }
