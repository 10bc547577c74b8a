"""The business macros as SQL functions of a session.

``register`` creates the four as temporary SQL functions (``CREATE TEMPORARY
FUNCTION ... RETURN expression``), so analyst SQL calls them by name. Spark puts
the expression in place of the call: the plan is that of the Column versions in
``functions.risk``, whose bucket tables, labels and thresholds the texts are
built from. Arguments are converted to the declared types; a null argument gives
what the Column version gives for it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskforge.config import DEFAULT_THRESHOLDS, Thresholds
from riskforge.functions import risk

DEFAULT_MIN_RATIO = "0.08"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(branches, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {_text(label)}" for test, label in branches) + f" ELSE {_text(otherwise)} END"


def statements(t: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, str]:
    """Function name -> parameters, result type and expression."""
    buckets = [(f"rating IN ({', '.join(map(_text, ratings))})", label) for label, ratings in risk.RATING_BUCKETS]
    with_buffer = t.cet1_minimum_ratio + t.capital_conservation_buffer
    bands = [
        (f"cet1_ratio < {t.cet1_minimum_ratio}", risk.STATUS_BELOW_MIN),
        (f"cet1_ratio < {with_buffer}", risk.STATUS_BUFFER),
        (f"cet1_ratio < {with_buffer + t.adequate_band}", risk.STATUS_ADEQUATE),
    ]
    return {
        "calculate_expected_loss": f"(pd {risk.PROB}, lgd {risk.PROB}, ead {risk.MONEY}) RETURNS {risk.MONEY} RETURN round(pd * lgd * ead, 2)",
        "capital_requirement": f"(rwa {risk.MONEY}, min_ratio {risk.PROB} DEFAULT {DEFAULT_MIN_RATIO}) RETURNS {risk.MONEY} "
        "RETURN round(rwa * min_ratio, 2)",
        "rating_bucket": f"(rating string) RETURNS string RETURN {_case(buckets, risk.UNRATED)}",
        "capital_adequacy_status": f"(cet1_ratio {risk.RATIO}) RETURNS string RETURN {_case(bands, risk.STATUS_WELL)}",
    }


def register(spark: SparkSession, t: Thresholds = DEFAULT_THRESHOLDS) -> list[str]:
    """Create or replace the functions in the session; their names."""
    made = statements(t)
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(made)
