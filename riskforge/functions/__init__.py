"""Column expressions shared by every model (the reusable business macros)."""

from riskforge.functions.risk import (  # noqa: F401
    RATING_BUCKETS,
    RISK_WEIGHTS,
    avg_exact,
    capital_adequacy_status,
    capital_requirement,
    d,
    expected_loss,
    maturity_bucket,
    money_units,
    pd_bucket,
    ratio,
    rating_bucket,
    risk_weight,
    safe_div,
    weighted_avg,
    year_diff,
)
