"""The enrichment model and the four regulatory marts.

Plans, in Spark terms:

* ``credit_risk_enriched``: loans left-join RWA on ``loan_id`` (one row per loan on
  both sides), then left-join counterparties on ``counterparty_id``. Only the attribute columns each join needs are carried.
  No broadcast hint: AQE turns a join into a broadcast join when the
  measured size of a side is under the threshold, and splits skewed
  partitions (a counterparty holding a third of all loans) on the loan side.
* ``basel3_rwa_report`` / ``ccar_stress_test``: hash aggregation with a
  map-side partial aggregate, so a hot segment is pre-combined per task
  before the shuffle; all ratios are computed from the final sums.
* ``capital_adequacy`` / ``liquidity_coverage``: thresholds are literals
  (constant-folded, no join); one window spec per model for the lag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskforge.config import DEFAULT_STRESS, DEFAULT_THRESHOLDS, StressConfig, Thresholds
from riskforge.functions.risk import (
    capital_adequacy_status,
    d,
    expected_loss,
    maturity_bucket,
    pd_bucket,
    rating_bucket,
    ratio,
    safe_div,
    weighted_avg,
)

ENRICHED_COLUMNS = [
    "loan_id", "counterparty_id",
    "counterparty_name", "counterparty_type", "kyc_status", "is_pep", "external_rating",
    "asset_class", "product_type", "sector", "region", "country", "currency", "collateral_type",
    "exposure_amount", "outstanding_balance", "ead_estimate", "collateral_value",
    "internal_rating", "pd_estimate", "lgd_estimate",
    "risk_weight", "credit_rwa", "operational_rwa", "market_rwa", "total_rwa",
    "capital_requirement", "approach",
    "origination_date", "maturity_date", "reporting_date",
    "is_defaulted", "is_impaired",
    "expected_loss", "unexpected_loss_proxy", "ltv_ratio", "collateral_coverage_ratio",
    "rating_bucket", "pd_bucket", "maturity_bucket", "is_watch_list",
]

RWA_SEGMENT_KEYS = (
    "reporting_date", "asset_class", "rating_bucket", "internal_rating",
    "approach", "currency", "region",
)

# What the RWA mart reads of the enriched loans.
RWA_MART_COLUMNS = RWA_SEGMENT_KEYS + (
    "loan_id", "exposure_amount", "outstanding_balance", "ead_estimate", "collateral_value",
    "credit_rwa", "operational_rwa", "market_rwa", "total_rwa", "capital_requirement",
    "pd_estimate", "lgd_estimate", "expected_loss", "is_defaulted", "is_watch_list",
)

# Liquidity status labels (breach below the minimum, watch
# within the band above it).
LCR_BREACH = "LCR Breach — Immediate Action"
LCR_WATCH = "LCR Watch — Monitor Daily"
LCR_ADEQUATE = "LCR Adequate"
NSFR_BREACH = "NSFR Breach — Immediate Action"
NSFR_WATCH = "NSFR Watch — Monitor Weekly"
NSFR_ADEQUATE = "NSFR Adequate"

STRESS_SEGMENT_KEYS = (
    "reporting_date", "scenario_name", "scenario_year", "asset_class", "sector", "region",
)


def credit_risk_enriched(loans: DataFrame, counterparties: DataFrame, rwa: DataFrame) -> DataFrame:
    """One row per staged loan with counterparty and RWA attributes and the
    derived risk metrics."""
    l = loans.alias("l")
    c = counterparties.select(
        "counterparty_id", "counterparty_name", "counterparty_type", "kyc_status",
        "is_pep", "external_rating",
    ).alias("c")
    r = rwa.select(
        "loan_id", "risk_weight", "credit_rwa", "operational_rwa", "market_rwa",
        "total_rwa", "capital_requirement", "approach",
    ).alias("r")
    # RWA first: both sides meet on the loan key, which is not skewed
    joined = l.join(r, F.col("l.loan_id") == F.col("r.loan_id"), "left").join(
        c, F.col("l.counterparty_id") == F.col("c.counterparty_id"), "left"
    )
    pd_, lgd, ead = F.col("l.pd_estimate"), F.col("l.lgd_estimate"), F.col("l.ead_estimate")
    collateral, outstanding = F.col("l.collateral_value"), F.col("l.outstanding_balance")
    base = joined.select(
        F.col("l.loan_id").alias("loan_id"),
        F.col("l.counterparty_id").alias("counterparty_id"),
        "c.counterparty_name", "c.counterparty_type", "c.kyc_status", "c.is_pep", "c.external_rating",
        "l.asset_class", "l.product_type", "l.sector", "l.region", "l.country", "l.currency",
        "l.collateral_type", "l.exposure_amount", "l.outstanding_balance", "l.ead_estimate",
        "l.collateral_value", "l.internal_rating", "l.pd_estimate", "l.lgd_estimate",
        "r.risk_weight", "r.credit_rwa", "r.operational_rwa", "r.market_rwa", "r.total_rwa",
        "r.capital_requirement", "r.approach",
        "l.origination_date", "l.maturity_date", "l.reporting_date", "l.is_defaulted", "l.is_impaired",
        expected_loss(pd_, lgd, ead).alias("expected_loss"),
        F.round(ead * lgd * F.sqrt(pd_ * (F.lit(1) - pd_)), 2).alias("unexpected_loss_proxy"),
        F.when(collateral > 0, F.round(outstanding / collateral, 4)).alias("ltv_ratio"),
        F.when(ead > 0, F.round(collateral / ead, 4)).otherwise(d(0)).alias("collateral_coverage_ratio"),
        rating_bucket(F.col("l.internal_rating")).alias("rating_bucket"),
        pd_bucket(pd_).alias("pd_bucket"),
        maturity_bucket(F.col("l.reporting_date"), F.col("l.maturity_date")).alias("maturity_bucket"),
    )
    # The watch-list test reads the LTV computed above (three-valued OR).
    watch = (
        (F.col("pd_estimate") > d("0.10"))
        | F.col("is_impaired")
        | (F.col("ltv_ratio") > d("1.2"))
    )
    return base.withColumn("is_watch_list", watch).select(*ENRICHED_COLUMNS)


def basel3_rwa_report(enriched: DataFrame, keys=RWA_SEGMENT_KEYS, audit: bool = True) -> DataFrame:
    """Basel III RWA by segment: exposures, RWA, capital requirement,
    exposure-weighted PD/LGD, EL and default metrics, then segment ratios."""
    ead = F.col("ead_estimate")
    defaulted = F.col("is_defaulted")
    aggs = [
        F.count("loan_id").alias("loan_count"),
        F.sum("exposure_amount").alias("total_exposure"),
        F.sum("outstanding_balance").alias("total_outstanding"),
        F.sum("ead_estimate").alias("total_ead"),
        F.sum("collateral_value").alias("total_collateral"),
        F.sum("credit_rwa").alias("total_credit_rwa"),
        F.sum("operational_rwa").alias("total_operational_rwa"),
        F.sum("market_rwa").alias("total_market_rwa"),
        F.sum("total_rwa").alias("total_rwa"),
        F.sum("capital_requirement").alias("total_capital_requirement"),
        weighted_avg("pd_estimate", "ead_estimate", 6).alias("exposure_weighted_pd"),
        weighted_avg("lgd_estimate", "ead_estimate", 6).alias("exposure_weighted_lgd"),
        F.sum("expected_loss").alias("total_expected_loss"),
        F.count_if(defaulted).alias("defaulted_loan_count"),
        F.sum(F.when(defaulted, ead).otherwise(d(0))).alias("defaulted_ead"),
        F.count_if(F.col("is_watch_list")).alias("watch_list_count"),
        F.round(ratio(F.sum("total_rwa"), F.sum("ead_estimate"), 8), 4).alias("avg_risk_weight"),
    ]
    if audit:
        aggs.append(F.current_timestamp().alias("_model_run_at"))
    return segment_ratios(enriched.groupBy(*keys).agg(*aggs))


def segment_ratios(seg: DataFrame) -> DataFrame:
    """The mart's ratio columns, from the sums of each segment."""
    return seg.select(
        "*",
        F.round(ratio("total_expected_loss", "total_ead", 8) * 100, 4).alias("el_ratio_pct"),
        F.round(safe_div(F.col("defaulted_loan_count") * d("100.0"), "loan_count"), 4).alias("default_rate_pct"),
        F.round(ratio("total_collateral", "total_ead", 8), 4).alias("collateral_coverage_ratio"),
        (ratio("total_capital_requirement", "total_rwa", 8) >= d("0.08")).alias("meets_minimum_capital"),
        ((F.col("exposure_weighted_pd") > d("0.10")) | (F.col("avg_risk_weight") > d("1.0")))
        .alias("high_risk_segment"),
    )


def _period_window() -> Window:
    return Window.partitionBy("entity_id").orderBy("reporting_period")


def capital_adequacy(capital: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS, audit: bool = True) -> DataFrame:
    """CET1 / Tier 1 / total capital ratios against the minimums, headroom,
    quarter-on-quarter change and the adequacy band, per entity and period."""
    cet1, tier1, total = F.col("cet1_ratio"), F.col("tier1_ratio"), F.col("total_capital_ratio")
    lcr, nsfr = F.col("lcr"), F.col("nsfr")
    m_cet1, m_t1, m_tot = d(t.cet1_minimum_ratio), d(t.tier1_minimum_ratio), d(t.total_capital_minimum_ratio)
    buf, m_lcr, m_nsfr = d(t.capital_conservation_buffer), d(t.lcr_minimum), d(t.nsfr_minimum)
    prior = F.lag(cet1).over(_period_window())
    cols = [
        "entity_id", "reporting_period", "reporting_date",
        "cet1_capital", "additional_tier1", "tier2_capital", "total_capital", "risk_weighted_assets",
        "cet1_ratio", "tier1_ratio", "total_capital_ratio", "leverage_ratio", "lcr", "nsfr",
        m_cet1.alias("cet1_minimum"), m_t1.alias("tier1_minimum"), m_tot.alias("total_capital_minimum"),
        buf.alias("conservation_buffer"), m_lcr.alias("lcr_minimum"), m_nsfr.alias("nsfr_minimum"),
        (cet1 >= m_cet1).alias("meets_cet1_minimum"),
        (cet1 >= m_cet1 + buf).alias("meets_cet1_with_buffer"),
        (tier1 >= m_t1).alias("meets_tier1_minimum"),
        (total >= m_tot).alias("meets_total_capital_minimum"),
        (lcr >= m_lcr).alias("meets_lcr_requirement"),
        (nsfr >= m_nsfr).alias("meets_nsfr_requirement"),
        ((cet1 >= m_cet1) & (tier1 >= m_t1) & (total >= m_tot) & (lcr >= m_lcr) & (nsfr >= m_nsfr))
        .alias("fully_compliant"),
        F.round(cet1 - m_cet1, 4).alias("cet1_headroom_pct"),
        F.round(cet1 - (m_cet1 + buf), 4).alias("distributable_headroom_pct"),
        F.round(F.col("total_capital") - (F.col("risk_weighted_assets") * m_tot / 100), 2)
        .alias("capital_surplus_shortfall"),
        prior.alias("prior_period_cet1_ratio"),
        F.round(cet1 - prior, 4).alias("cet1_ratio_qoq_change"),
        capital_adequacy_status(cet1, t).alias("capital_adequacy_status"),
    ]
    if audit:
        cols.append(F.current_timestamp().alias("_model_run_at"))
    return capital.select(*cols)


def liquidity_coverage(capital: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS, audit: bool = True) -> DataFrame:
    """LCR and NSFR against their minimums, headroom, status bands and the
    quarter-on-quarter LCR change."""
    lcr, nsfr = F.col("lcr"), F.col("nsfr")
    m_lcr, m_nsfr = d(t.lcr_minimum), d(t.nsfr_minimum)
    prior = F.lag(lcr).over(_period_window())
    cols = [
        "entity_id", "reporting_period", "reporting_date", "lcr", "nsfr", "leverage_ratio",
        m_lcr.alias("lcr_minimum"), m_nsfr.alias("nsfr_minimum"),
        (lcr >= m_lcr).alias("meets_lcr"),
        (nsfr >= m_nsfr).alias("meets_nsfr"),
        ((lcr >= m_lcr) & (nsfr >= m_nsfr)).alias("fully_liquid_compliant"),
        F.round(lcr - m_lcr, 2).alias("lcr_headroom"),
        F.round(nsfr - m_nsfr, 2).alias("nsfr_headroom"),
        F.when(lcr < m_lcr, F.lit(LCR_BREACH))
        .when(lcr < m_lcr + d(t.lcr_watch_band), F.lit(LCR_WATCH))
        .otherwise(F.lit(LCR_ADEQUATE)).alias("lcr_status"),
        F.when(nsfr < m_nsfr, F.lit(NSFR_BREACH))
        .when(nsfr < m_nsfr + d(t.nsfr_watch_band), F.lit(NSFR_WATCH))
        .otherwise(F.lit(NSFR_ADEQUATE)).alias("nsfr_status"),
        prior.alias("prior_lcr"),
        F.round(lcr - prior, 2).alias("lcr_qoq_change"),
    ]
    if audit:
        cols.append(F.current_timestamp().alias("_model_run_at"))
    return capital.select(*cols)


def ccar_stress_test(
    stress: DataFrame, loans: DataFrame, cfg: StressConfig = DEFAULT_STRESS, audit: bool = True
) -> DataFrame:
    """CCAR scenario results per segment, with a severity rank across
    scenarios of the same segment and year."""
    s = stress.alias("s")
    l = loans.select(
        "loan_id", "asset_class", "sector", "region", "internal_rating", "ead_estimate", "reporting_date"
    ).alias("l")
    base_ead = F.col("l.ead_estimate")
    enriched = s.join(l, F.col("s.loan_id") == F.col("l.loan_id"), "left").select(
        "s.scenario_id", F.col("s.loan_id").alias("loan_id"), "s.scenario_name", "s.scenario_year",
        F.col("s.reporting_date").alias("reporting_date"),
        "l.asset_class", "l.sector", "l.region", "l.internal_rating",
        base_ead.alias("baseline_ead"),
        "s.stressed_pd", "s.stressed_lgd", "s.stressed_ead", "s.expected_loss", "s.stressed_rwa",
        "s.capital_impact",
        (F.col("s.expected_loss") - (base_ead * d(cfg.baseline_pd) * d(cfg.baseline_lgd))).alias("incremental_loss"),
    )
    aggs = [
        F.count("loan_id").alias("loan_count"),
        F.sum("baseline_ead").alias("total_baseline_ead"),
        F.sum("stressed_ead").alias("total_stressed_ead"),
        F.avg("stressed_pd").alias("avg_stressed_pd"),
        F.avg("stressed_lgd").alias("avg_stressed_lgd"),
        F.sum("expected_loss").alias("total_expected_loss"),
        F.sum("stressed_rwa").alias("total_stressed_rwa"),
        F.sum("capital_impact").alias("total_capital_impact"),
        F.sum("incremental_loss").alias("total_incremental_loss"),
        F.round(ratio(F.sum("stressed_ead") - F.sum("baseline_ead"), F.sum("baseline_ead"), 8) * 100, 2)
        .alias("ead_stress_growth_pct"),
        F.round(ratio(F.sum("expected_loss"), F.sum("stressed_ead"), 8) * 100, 4).alias("stressed_loss_rate_pct"),
    ]
    if audit:
        aggs.append(F.current_timestamp().alias("_model_run_at"))
    seg = enriched.groupBy(*STRESS_SEGMENT_KEYS).agg(*aggs)
    severity = Window.partitionBy(
        "reporting_date", "asset_class", "sector", "region", "scenario_year"
    ).orderBy(F.col("total_expected_loss").desc_nulls_first())
    order = None
    for name, pos in cfg.scenario_order:
        order = (F.when if order is None else order.when)(F.col("scenario_name") == name, F.lit(pos))
    return seg.select(
        "*",
        F.rank().over(severity).alias("severity_rank"),
        order.alias("scenario_order"),
        (F.col("total_capital_impact") > d(cfg.capital_buffer)).alias("exceeds_capital_buffer"),
    )
