"""Raw source schemas (typed as the warehouse DDL declares them)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, B, I = T.StringType(), T.DoubleType(), T.DateType(), T.BooleanType(), T.IntegerType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LOAN_PORTFOLIO = _schema(
    ("loan_id", S), ("counterparty_id", S), ("asset_class", S), ("product_type", S),
    ("sector", S), ("region", S), ("country", S), ("currency", S),
    ("exposure_amount", D), ("outstanding_balance", D), ("committed_amount", D),
    ("internal_rating", S), ("pd_estimate", D), ("lgd_estimate", D), ("ead_estimate", D),
    ("origination_date", DT), ("maturity_date", DT), ("is_defaulted", B), ("is_impaired", B),
    ("collateral_type", S), ("collateral_value", D), ("reporting_date", DT), ("source_system", S),
)

COUNTERPARTIES = _schema(
    ("counterparty_id", S), ("counterparty_name", S), ("counterparty_type", S), ("sector", S),
    ("country", S), ("region", S), ("external_rating", S), ("is_pep", B), ("is_sanctioned", B),
    ("kyc_status", S), ("onboarding_date", DT), ("last_review_date", DT), ("credit_limit", D),
    ("reporting_date", DT),
)

RWA_COMPONENTS = _schema(
    ("loan_id", S), ("asset_class", S), ("internal_rating", S), ("risk_weight", D), ("ead", D),
    ("credit_rwa", D), ("operational_rwa", D), ("market_rwa", D), ("total_rwa", D),
    ("capital_requirement", D), ("approach", S), ("reporting_date", DT),
)

CAPITAL_COMPONENTS = _schema(
    ("entity_id", S), ("reporting_period", S), ("cet1_capital", D), ("additional_tier1", D),
    ("tier2_capital", D), ("total_capital", D), ("risk_weighted_assets", D), ("cet1_ratio", D),
    ("tier1_ratio", D), ("total_capital_ratio", D), ("leverage_ratio", D), ("lcr", D), ("nsfr", D),
    ("reporting_date", DT),
)

STRESS_SCENARIOS = _schema(
    ("scenario_id", S), ("loan_id", S), ("scenario_name", S), ("scenario_year", I),
    ("stressed_pd", D), ("stressed_lgd", D), ("stressed_ead", D), ("expected_loss", D),
    ("stressed_rwa", D), ("capital_impact", D), ("reporting_date", DT),
)

# Generated and advertised by the source project but never consumed: scan only.
MARKET_RISK_POSITIONS = _schema(
    ("position_id", S), ("desk", S), ("instrument_type", S), ("currency", S),
    ("notional_amount", D), ("mtm_value", D), ("var_1d_99", D), ("var_10d_99", D),
    ("stressed_var", D), ("delta", D), ("gamma", D), ("vega", D), ("maturity_bucket", S),
    ("reporting_date", DT), ("book", S),
)

RAW_SCHEMAS = {
    "loan_portfolio": LOAN_PORTFOLIO,
    "counterparties": COUNTERPARTIES,
    "rwa_components": RWA_COMPONENTS,
    "capital_components": CAPITAL_COMPONENTS,
    "stress_scenarios": STRESS_SCENARIOS,
    "market_risk_positions": MARKET_RISK_POSITIONS,
}
