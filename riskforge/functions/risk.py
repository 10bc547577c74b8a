"""Risk and capital column expressions.

All of these return ``Column`` objects built from ``pyspark.sql.functions``,
so they compile into whole-stage codegen; none of them is a Python UDF.
Money stays ``decimal`` end to end; literals are decimal literals so that a
product with a decimal column never degrades to double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskforge.config import DEFAULT_THRESHOLDS, Thresholds

MONEY = "decimal(20,2)"
PROB = "decimal(10,6)"
RATIO = "decimal(10,4)"

# Rating scale, grouped into the five reporting buckets.
RATING_BUCKETS = (
    ("Investment Grade — High", ("AAA", "AA+", "AA", "AA-")),
    ("Investment Grade — Upper Mid", ("A+", "A", "A-")),
    ("Investment Grade — Lower Mid", ("BBB+", "BBB", "BBB-")),
    ("Sub-Investment Grade — High", ("BB+", "BB", "BB-")),
    ("Sub-Investment Grade — Low", ("B", "CCC")),
)
UNRATED = "Unrated"

# Standardized-approach risk weight per rating group; any
# other rating gets the default weight.
RISK_WEIGHTS = (
    ("0.20", ("AAA", "AA+", "AA", "AA-")),
    ("0.50", ("A+", "A", "A-")),
    ("1.00", ("BBB+", "BBB", "BBB-")),
    ("1.50", ("BB+", "BB", "BB-", "B", "CCC")),
)
DEFAULT_RISK_WEIGHT = "1.00"

# PD bucket upper bounds (right-open) and maturity bucket
# upper bounds in whole calendar years (inclusive).
PD_BUCKETS = (("0.01", "<1%"), ("0.05", "1-5%"), ("0.10", "5-10%"), ("0.20", "10-20%"))
PD_BUCKET_TOP = ">20%"
MATURITY_BUCKETS = ((1, "0-1Y"), (3, "1-3Y"), (5, "3-5Y"), (10, "5-10Y"))
MATURITY_BUCKET_TOP = "10Y+"

# Labels of the capital adequacy bands.
STATUS_BELOW_MIN = "Below Minimum — Regulatory Action Required"
STATUS_BUFFER = "Within Buffer — Restricted Distributions"
STATUS_ADEQUATE = "Adequate — Monitor Closely"
STATUS_WELL = "Well Capitalised"


def d(value) -> Column:
    """Exact decimal literal (``F.lit(0.02)`` would be a DOUBLE)."""
    return F.lit(Decimal(str(value)))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def expected_loss(pd_col="pd_estimate", lgd_col="lgd_estimate", ead_col="ead_estimate") -> Column:
    """EL = round(PD x LGD x EAD, 2), kept at money precision so sums of it
    divide at full scale."""
    return F.round(_c(pd_col) * _c(lgd_col) * _c(ead_col), 2).cast(MONEY)


def capital_requirement(rwa_col, min_ratio="0.08") -> Column:
    """Capital requirement = round(RWA x minimum ratio, 2)."""
    return F.round(_c(rwa_col) * d(min_ratio), 2).cast(MONEY)


def rating_bucket(rating_col="internal_rating") -> Column:
    col = _c(rating_col)
    expr = None
    for label, ratings in RATING_BUCKETS:
        expr = (F.when if expr is None else expr.when)(col.isin(*ratings), F.lit(label))
    return expr.otherwise(F.lit(UNRATED))


def risk_weight(rating_col="internal_rating") -> Column:
    """Standardized risk weight by rating (decimal), default for unrated."""
    col = _c(rating_col)
    expr = None
    for weight, ratings in RISK_WEIGHTS:
        expr = (F.when if expr is None else expr.when)(col.isin(*ratings), d(weight))
    return expr.otherwise(d(DEFAULT_RISK_WEIGHT))


def pd_bucket(pd_col="pd_estimate") -> Column:
    col = _c(pd_col)
    expr = None
    for bound, label in PD_BUCKETS:
        expr = (F.when if expr is None else expr.when)(col < d(bound), F.lit(label))
    return expr.otherwise(F.lit(PD_BUCKET_TOP))


def year_diff(start, end) -> Column:
    """Number of calendar-year boundaries between two dates (end - start).

    This is year-part subtraction, not elapsed whole years: 2024-03-31 to
    2025-01-01 is 1.
    """
    return F.year(_c(end)) - F.year(_c(start))


def maturity_bucket(reporting_col="reporting_date", maturity_col="maturity_date") -> Column:
    years = year_diff(reporting_col, maturity_col)
    expr = None
    for bound, label in MATURITY_BUCKETS:
        expr = (F.when if expr is None else expr.when)(years <= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(MATURITY_BUCKET_TOP))


def capital_adequacy_status(cet1_col="cet1_ratio", t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    col = _c(cet1_col)
    minimum = d(t.cet1_minimum_ratio)
    with_buffer = d(t.cet1_minimum_ratio + t.capital_conservation_buffer)
    adequate = d(t.cet1_minimum_ratio + t.capital_conservation_buffer + t.adequate_band)
    return (
        F.when(col < minimum, F.lit(STATUS_BELOW_MIN))
        .when(col < with_buffer, F.lit(STATUS_BUFFER))
        .when(col < adequate, F.lit(STATUS_ADEQUATE))
        .otherwise(F.lit(STATUS_WELL))
    )


def safe_div(num, den) -> Column:
    """num / den with a zero divisor giving NULL (ANSI mode raises otherwise)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def ratio(num, den, scale: int = 8) -> Column:
    """Quotient of two money amounts (scale 2), at exactly 8 decimals.

    Both sides are narrowed to decimal(30,2) so Spark's division result type
    is decimal(38,8) whatever the operand precisions were; the quotient is
    then rounded half-up once more to ``scale`` (<= 8) digits. Rounding the
    quotient at a fixed scale before any further scaling keeps every later
    ``round`` reproducible in another engine.
    """
    q = _c(num).cast("decimal(30,2)") / F.nullif(_c(den).cast("decimal(30,2)"), F.lit(0))
    return F.round(q, scale)


def avg_exact(c) -> Column:
    """Aggregate: mean of a decimal column at 15 decimals.

    ``F.avg`` on a decimal rounds at a scale that depends on the input
    precision (it can be as low as the input scale); averages of segment
    ratios feed further rounding, so the scale is pinned here instead.
    """
    col = _c(c)
    total = F.sum(col).cast("decimal(27,8)")
    n = F.count(col).cast("decimal(20,0)")
    return F.round(total / F.nullif(n, F.lit(0)), 15)


def money_units(c, exponent: int) -> Column:
    """Money amount expressed in 10**exponent units (millions: 6, billions:
    9), exact: a decimal product, not a division by a DOUBLE literal."""
    return _c(c).cast("decimal(25,2)") * d(Decimal(1).scaleb(-exponent))


def weighted_avg(value, weight, scale: int = 6) -> Column:
    """Aggregate: round(sum(value * weight) / nullif(sum(weight), 0), scale)."""
    return F.round(safe_div(F.sum(_c(value) * _c(weight)), F.sum(_c(weight))), scale)
