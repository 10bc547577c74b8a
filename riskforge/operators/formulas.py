"""Business formulas as reusable operators: standardized RWA, capital
ratios, stress shocks, and segment drill-through.

All exact decimal, all per-row projections except the drill-through, which
is a null-safe semi join.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.functions.risk import (
    MONEY,
    PROB,
    RATIO,
    capital_requirement,
    d,
    expected_loss,
    rating_bucket,
    ratio,
    risk_weight,
)
from riskforge.operators.marts import RWA_SEGMENT_KEYS

# The operational-risk charge on EAD and the default market
# risk charge.
OPERATIONAL_FACTOR = Decimal("0.12")
DEFAULT_MARKET_FACTOR = Decimal("0.10")


def rwa_standardized(loans: DataFrame, market_factor=DEFAULT_MARKET_FACTOR, min_ratio="0.08") -> DataFrame:
    """Standardized-approach RWA per loan: credit (EAD x rating weight),
    operational (EAD x 12%), market (EAD x factor), total and the capital
    requirement. ``market_factor`` is a decimal or a Column."""
    ead = F.col("ead_estimate")
    rw = risk_weight("internal_rating")
    factor = market_factor if not isinstance(market_factor, (Decimal, str, int, float)) else d(market_factor)
    credit = F.round(ead * rw, 2).cast(MONEY)
    operational = F.round(ead * d(OPERATIONAL_FACTOR), 2).cast(MONEY)
    market = F.round(ead * factor, 2).cast(MONEY)
    total = (credit + operational + market).cast(MONEY)
    return loans.select(
        "loan_id",
        "asset_class",
        "internal_rating",
        rw.cast(RATIO).alias("risk_weight"),
        ead.alias("ead"),
        credit.alias("credit_rwa"),
        operational.alias("operational_rwa"),
        market.alias("market_rwa"),
        total.alias("total_rwa"),
        capital_requirement(total, min_ratio).alias("capital_requirement"),
    )


def capital_ratios(capital: DataFrame) -> DataFrame:
    """Total capital and the CET1, Tier 1 and total capital ratios (percent
    of RWA, 4 decimals) recomputed from the capital amounts."""
    cet1, at1, t2 = F.col("cet1_capital"), F.col("additional_tier1"), F.col("tier2_capital")
    rwa = F.col("risk_weighted_assets")
    total = (cet1 + at1 + t2).cast(MONEY)
    return capital.select(
        "entity_id",
        "reporting_period",
        total.alias("total_capital_calc"),
        F.round(ratio(cet1 * 100, rwa, 8), 4).alias("cet1_ratio_calc"),
        F.round(ratio((cet1 + at1) * 100, rwa, 8), 4).alias("tier1_ratio_calc"),
        F.round(ratio(total * 100, rwa, 8), 4).alias("total_capital_ratio_calc"),
        (F.round(ratio(cet1 * 100, rwa, 8), 4) == F.col("cet1_ratio")).alias("cet1_ratio_matches"),
    )


@dataclass(frozen=True)
class Scenario:
    name: str
    year: int
    pd_shock: Decimal  # stressed PD = PD x (1 + shock)
    lgd_shock: Decimal
    ead_factor: Decimal
    rwa_factor: Decimal
    impact_factor: Decimal


# Default scenario parameters (shocks are relative increases;
# Baseline leaves PD and LGD unchanged).
DEFAULT_SCENARIOS = (
    Scenario("Baseline", 1, Decimal("0"), Decimal("0"), Decimal("1.00"), Decimal("1.00"), Decimal("0.10")),
    Scenario("Adverse", 2, Decimal("1.5"), Decimal("0.25"), Decimal("1.05"), Decimal("1.10"), Decimal("0.10")),
    Scenario("Severely Adverse", 3, Decimal("4.0"), Decimal("0.5"), Decimal("1.10"), Decimal("1.25"),
             Decimal("0.12")),
)


def stress_shock(loans: DataFrame, scenarios=DEFAULT_SCENARIOS) -> DataFrame:
    """One row per loan and scenario with stressed parameters and losses.

    The scenarios are a small static list; they are attached to every loan
    with ``explode`` of a literal array (a projection, no join, no shuffle).
    PD and LGD are capped at 1; EL uses the uncapped PD and the capped LGD;
    the capital impact is computed from the unrounded EL.
    """
    structs = [
        F.struct(
            F.lit(s.name).alias("scenario_name"),
            F.lit(s.year).alias("scenario_year"),
            d(s.pd_shock).cast("decimal(10,4)").alias("pd_shock"),
            d(s.lgd_shock).cast("decimal(10,4)").alias("lgd_shock"),
            d(s.ead_factor).cast("decimal(10,4)").alias("ead_factor"),
            d(s.rwa_factor).cast("decimal(10,4)").alias("rwa_factor"),
            d(s.impact_factor).cast("decimal(10,4)").alias("impact_factor"),
        )
        for s in scenarios
    ]
    x = loans.select(
        "loan_id", "pd_estimate", "lgd_estimate", "ead_estimate", "reporting_date",
        F.explode(F.array(*structs)).alias("s"),
    )
    pd_, lgd, ead = F.col("pd_estimate"), F.col("lgd_estimate"), F.col("ead_estimate")
    base = F.col("s.scenario_name") == F.lit("Baseline")
    # Narrow each factor to the exact width it needs (PD x (1 + shock) has
    # at most 10 decimals and is < 1000; capped LGD <= 1) so the triple
    # product stays within decimal(38) without an early rounding step.
    pd_raw = F.when(base, pd_).otherwise(pd_ * (d(1) + F.col("s.pd_shock"))).cast("decimal(13,10)")
    lgd_capped = F.least(
        F.when(base, lgd).otherwise(lgd * (d(1) + F.col("s.lgd_shock"))), d(1)
    ).cast("decimal(11,10)")
    el_raw = (ead * pd_raw).cast("decimal(28,12)") * lgd_capped
    return x.select(
        F.concat(F.col("loan_id"), F.lit("-"), F.col("s.scenario_name")).alias("scenario_id"),
        "loan_id",
        "s.scenario_name",
        "s.scenario_year",
        F.round(F.least(pd_raw, d(1)), 4).cast(PROB).alias("stressed_pd"),
        F.round(lgd_capped, 4).cast(PROB).alias("stressed_lgd"),
        F.round(ead * F.col("s.ead_factor"), 2).cast(MONEY).alias("stressed_ead"),
        F.round(el_raw, 2).cast(MONEY).alias("expected_loss"),
        F.round(ead * F.col("s.rwa_factor"), 2).cast(MONEY).alias("stressed_rwa"),
        F.round(el_raw * F.col("s.impact_factor"), 2).cast(MONEY).alias("capital_impact"),
        "reporting_date",
    )


def drill_through(enriched: DataFrame, segments: DataFrame, keys=RWA_SEGMENT_KEYS) -> DataFrame:
    """The loans behind the given mart rows: a left-semi join on the segment
    keys with NULL-safe equality (a NULL key is a segment of its own)."""
    seg = segments.select(*[F.col(k).alias(f"_seg_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_seg_{k}"))
        cond = c if cond is None else cond & c
    return enriched.join(seg, cond, "left_semi")


def expected_loss_by_rating(loans: DataFrame) -> DataFrame:
    """Expected loss per rating bucket from the shared EL and bucket rules."""
    return (
        loans.withColumn("rating_bucket", rating_bucket("internal_rating"))
        .groupBy("rating_bucket")
        .agg(
            F.count(F.lit(1)).alias("loans"),
            F.sum("ead_estimate").alias("total_ead"),
            F.sum(expected_loss("pd_estimate", "lgd_estimate", "ead_estimate")).alias("total_expected_loss"),
            F.round(ratio(F.sum(expected_loss()), F.sum("ead_estimate"), 8) * 100, 4).alias("el_rate_pct"),
        )
    )


def capital_requirement_by_class(rwa: DataFrame, ratios=("0.08", "0.105")) -> DataFrame:
    """Capital requirement per asset class at the minimum ratio and at the
    minimum plus conservation buffer."""
    out = rwa.groupBy("asset_class").agg(
        F.count(F.lit(1)).alias("exposures"),
        F.sum("total_rwa").alias("total_rwa"),
        F.sum("capital_requirement").alias("sum_loan_requirements"),
    )
    for r in ratios:
        tag = r.replace(".", "_")
        out = out.withColumn(f"requirement_at_{tag}", capital_requirement("total_rwa", r))
    return out
