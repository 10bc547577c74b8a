"""The RWA mart kept by partial sums, so that changed loans rewrite only their segments.

``segment_state`` holds, for each segment, what the mart's columns are made of:
the number of rows and, for each measure, its exact sum and the number of its
non-NULL values. All of these add up, so a state can be merged with another
(``merge``) and a loan's old row can be taken out with ``sign=-1``.
``refresh`` applies the old and new rows of changed loans to a stored state and
a stored mart: touched segments are computed anew from their merged sums, all
others are passed on as they are.

Sums are decimals, so taking out and adding again is exact, in any order. A
merged sum is cast back to the type of a single sum, so that the mart's
quotients have the types of the full build.

Edge cases: a segment whose last row goes disappears; NULL keys are segments of
their own (null-safe everywhere); a sum over no value is NULL, as in the full
build; an empty change gives the mart as it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskforge.functions.risk import d, ratio, safe_div
from riskforge.operators.marts import RWA_SEGMENT_KEYS, segment_ratios

# sums that are columns of the mart, and the columns that they sum
MART_SUMS = {
    "total_exposure": "exposure_amount",
    "total_outstanding": "outstanding_balance",
    "total_ead": "ead_estimate",
    "total_collateral": "collateral_value",
    "total_credit_rwa": "credit_rwa",
    "total_operational_rwa": "operational_rwa",
    "total_market_rwa": "market_rwa",
    "total_rwa": "total_rwa",
    "total_capital_requirement": "capital_requirement",
    "total_expected_loss": "expected_loss",
}
COUNTS = ("loan_count", "defaulted_loan_count", "watch_list_count")


def _sums() -> dict[str, Column]:
    ead = F.col("ead_estimate")
    return {
        **{name: F.col(column) for name, column in MART_SUMS.items()},
        "pd_by_ead": F.col("pd_estimate") * ead,
        "lgd_by_ead": F.col("lgd_estimate") * ead,
        "defaulted_ead": F.when(F.col("is_defaulted"), ead).otherwise(d(0)),
    }


def segment_state(enriched: DataFrame, sign: int = 1, keys=RWA_SEGMENT_KEYS) -> DataFrame:
    """The partial sums of ``enriched`` by segment; ``sign=-1`` for rows that are taken out."""
    flags = {"loan_count": F.col("loan_id").isNotNull(), "defaulted_loan_count": F.col("is_defaulted"),
             "watch_list_count": F.col("is_watch_list")}
    aggs = [(F.count(F.lit(1)) * sign).alias("rows")]
    aggs += [(F.count_if(flags[c]) * sign).alias(c) for c in COUNTS]
    for name, value in _sums().items():
        total = F.sum(value)
        aggs += [(total if sign > 0 else -total).alias(name), (F.count(value) * sign).alias(f"n_{name}")]
    return enriched.groupBy(*keys).agg(*aggs)


def merge(*states: DataFrame, keys=RWA_SEGMENT_KEYS) -> DataFrame:
    """States added up; segments without rows go."""
    types = {f.name: f.dataType for f in states[0].schema.fields}
    both = reduce(DataFrame.unionByName, states)
    added = both.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in types if c not in keys])
    return added.filter("rows > 0")


def mart_of(state: DataFrame, keys=RWA_SEGMENT_KEYS) -> DataFrame:
    """The RWA mart (without audit stamp) of a state."""
    known = {name: F.when(F.col(f"n_{name}") > 0, F.col(name)) for name in _sums()}
    seg = state.select(
        *keys, *COUNTS, *[known[name].alias(name) for name in (*MART_SUMS, "defaulted_ead")],
        F.round(safe_div(known["pd_by_ead"], known["total_ead"]), 6).alias("exposure_weighted_pd"),
        F.round(safe_div(known["lgd_by_ead"], known["total_ead"]), 6).alias("exposure_weighted_lgd"),
        F.round(ratio(known["total_rwa"], known["total_ead"], 8), 4).alias("avg_risk_weight"),
    )
    return segment_ratios(seg)


def _in(df: DataFrame, touched: DataFrame, keys, how: str) -> DataFrame:
    named = touched.select(*[F.col(k).alias(f"_touched_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_touched_{k}")) for k in keys])
    return df.join(named, same, how)


def refresh(
    mart: DataFrame, state: DataFrame, old: DataFrame, new: DataFrame, keys=RWA_SEGMENT_KEYS
) -> tuple[DataFrame, DataFrame]:
    """``(mart, state)`` after the enriched rows ``old`` have become ``new``.

    ``old`` holds the changed loans as the state counts them, ``new`` as they are
    now; a new loan is only in ``new``, a removed one only in ``old``.
    """
    delta = segment_state(old, -1, keys).unionByName(segment_state(new, 1, keys))
    touched = delta.select(*keys).distinct()
    merged = merge(_in(state, touched, keys, "left_semi"), delta, keys=keys)
    kept = _in(state, touched, keys, "left_anti")
    rewritten = mart_of(merged, keys).select(mart.columns)
    return _in(mart, touched, keys, "left_anti").unionByName(rewritten), kept.unionByName(merged)
