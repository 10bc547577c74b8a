"""Data-quality gate: expectation suites on the raw sources, and schema
tests on sources and models.

The counters of a suite are one aggregate without keys over its table (one
partial row for each task), or are gathered while the table is written (``land``). A uniqueness check is a group-by on its column
alone, and the offending values of all in-set checks are found in one further
pass that shuffles only them. The results are a row for each check. Percentages are exact: they are derived from
integer counts, so the pass/fail cut and the two-decimal text never depend
on floating-point rounding. Nothing is collected to the driver except by
``gate``, which reads a single summary row.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.functions.risk import d

PASS, FAIL = "PASS", "FAIL"
EXAMPLES = 3  # offending values quoted in an in-set check's detail


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | between | in_set | positive | row_count_between | a_less_than_b
    column: str | None = None
    args: tuple = ()
    threshold: float = 0.0

    @property
    def name(self) -> str:
        a = self.args
        if self.kind == "row_count_between":
            return f"row_count_between({a[0]}, {a[1]})"
        if self.kind == "between":
            return f"between({self.column}, {a[0]}, {a[1]})"
        if self.kind == "a_less_than_b":
            return f"{self.column}_less_than_{a[0]}"
        return f"{self.kind}({self.column})"


def not_null(col, threshold=0.0):
    return Check("not_null", col, (), threshold)


def unique(col):
    return Check("unique", col)


def between(col, lo, hi, threshold=0.0):
    return Check("between", col, (lo, hi), threshold)


def in_set(col, values):
    return Check("in_set", col, tuple(values))


def positive(col, threshold=0.0):
    return Check("positive", col, (), threshold)


def row_count_between(lo, hi):
    return Check("row_count_between", None, (lo, hi))


def a_less_than_b(a, b, threshold=0.0):
    return Check("a_less_than_b", a, (b,), threshold)


# The five source suites of the validation gate.
SUITES: dict[str, list[Check]] = {
    "loan_portfolio": [
        row_count_between(100, 10000),
        not_null("loan_id"),
        not_null("counterparty_id"),
        not_null("exposure_amount"),
        not_null("reporting_date"),
        unique("loan_id"),
        positive("exposure_amount"),
        positive("ead_estimate"),
        between("pd_estimate", 0, 1),
        between("lgd_estimate", 0, 1),
        in_set("asset_class", ["Corporate Loan", "Retail Mortgage", "SME Loan", "Sovereign Bond",
                               "Credit Card", "Auto Loan", "Commercial Real Estate", "Interbank"]),
        in_set("currency", ["USD", "EUR", "GBP", "JPY", "CHF"]),
        a_less_than_b("outstanding_balance", "committed_amount", threshold=5.0),
    ],
    "counterparties": [
        row_count_between(10, 10000),
        not_null("counterparty_id"),
        unique("counterparty_id"),
        not_null("kyc_status"),
        in_set("kyc_status", ["Verified", "Pending", "Failed"]),
        positive("credit_limit"),
        in_set("counterparty_type", ["Corporate", "Financial Institution", "Sovereign", "Retail", "SME"]),
    ],
    "rwa_components": [
        row_count_between(100, 10000),
        not_null("loan_id"),
        not_null("total_rwa"),
        between("risk_weight", 0, 2.0),
        positive("ead"),
        in_set("approach", ["Standardized", "IRB Foundation", "IRB Advanced"]),
    ],
    "capital_components": [
        row_count_between(1, 500),
        not_null("entity_id"),
        not_null("reporting_period"),
        positive("cet1_capital"),
        positive("risk_weighted_assets"),
        between("cet1_ratio", 0, 50),
        between("lcr", 50, 500),
        between("nsfr", 50, 300),
        a_less_than_b("cet1_capital", "total_capital"),
    ],
    "stress_scenarios": [
        row_count_between(100, 100000),
        not_null("scenario_id"),
        unique("scenario_id"),
        in_set("scenario_name", ["Baseline", "Adverse", "Severely Adverse"]),
        between("stressed_pd", 0, 1),
        between("stressed_lgd", 0, 1),
        positive("expected_loss"),
    ],
}


def _numeric(df: DataFrame, col: str) -> Column:
    """The column as a number; text that is none, and NaN, become NULL."""
    c = F.col(col)
    kind = df.schema[col].dataType
    if isinstance(kind, T.StringType):
        c = c.try_cast("double")
    if isinstance(kind, (T.StringType, T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def _missing(df: DataFrame, col: str) -> Column:
    """NULL, or NaN in a column of floating-point numbers."""
    c = F.col(col)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)) else c.isNull()


def _pct_text(count: Column, n: Column) -> Column:
    """count / n as a percentage with two decimals (half-up), 'nan' if n=0."""
    pct = F.round(count.cast("decimal(20,0)") * 100 / F.nullif(n, F.lit(0)).cast("decimal(20,0)"), 2)
    return F.coalesce(pct.cast("decimal(22,2)").cast("string"), F.lit("nan"))


def _within(count: Column, n: Column, threshold) -> Column:
    """count / n * 100 <= threshold, exactly; an empty table fails."""
    return F.coalesce(
        F.when(n > 0, count * 100 <= d(Decimal(str(threshold))) * n), F.lit(False)
    )


def _measures(df: DataFrame, checks: list[Check]) -> list[Column]:
    """The counters a suite needs, aliased m<i>."""
    out = [F.count(F.lit(1)).alias("n")]
    for i, ck in enumerate(checks):
        c = F.col(ck.column) if ck.column else None
        if ck.kind == "not_null":
            out.append(F.count_if(_missing(df, ck.column)).alias(f"m{i}"))
        elif ck.kind == "between":
            x = _numeric(df, ck.column)
            out.append(F.count_if(F.coalesce((x < ck.args[0]) | (x > ck.args[1]), F.lit(False))).alias(f"m{i}"))
        elif ck.kind == "in_set":
            out.append(F.count_if(~F.coalesce(c.isin(*ck.args), F.lit(False))).alias(f"m{i}"))
        elif ck.kind == "positive":
            x = _numeric(df, ck.column)
            out.append(F.count_if(F.coalesce(x <= 0, F.lit(False))).alias(f"m{i}"))
        elif ck.kind == "a_less_than_b":
            a, b = _numeric(df, ck.column), _numeric(df, ck.args[0])
            out.append(F.count_if(F.coalesce(a >= b, F.lit(False))).alias(f"m{i}"))
    return out


def _result(ck: Check, i: int) -> tuple[Column, Column]:
    """(passed, detail) of check ``i`` over the one-row aggregate."""
    n, m = F.col("n"), F.col(f"m{i}")
    t = ck.threshold
    if ck.kind == "not_null":
        return _within(m, n, t), F.concat(F.lit("Null pct: "), _pct_text(m, n), F.lit(f"% (max allowed: {t}%)"))
    if ck.kind == "unique":
        return m == 0, F.concat(F.lit("Duplicate count: "), m.cast("string"))
    if ck.kind == "between":
        return _within(m, n, t), F.concat(
            F.lit("Out-of-range pct: "), _pct_text(m, n), F.lit(f"% (max allowed: {t}%)")
        )
    if ck.kind == "in_set":
        # the examples are joined in later (see _examples)
        return m == 0, F.concat(F.lit("Invalid values: "), m.cast("string"), F.lit(" | Examples: "))
    if ck.kind == "positive":
        return _within(m, n, t), F.concat(F.lit("Non-positive pct: "), _pct_text(m, n), F.lit("%"))
    if ck.kind == "row_count_between":
        lo, hi = ck.args
        return (n >= lo) & (n <= hi), F.concat(F.lit("Actual row count: "), n.cast("string"))
    if ck.kind == "a_less_than_b":
        return _within(m, n, t), F.concat(F.lit("Violation pct: "), _pct_text(m, n), F.lit("%"))
    raise ValueError(ck.kind)


def _examples(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_no, examples) for the in-set checks with offending values: the
    first EXAMPLES distinct ones in sort order (NULL last, shown as nan),
    rendered as a list literal. One pass over the table for all checks; only
    offending values are shuffled, and at most EXAMPLES of a check are
    collected."""
    bad = []
    for i, ck in enumerate(checks):
        if ck.kind == "in_set":
            c = F.col(ck.column)
            row = F.struct(F.lit(i + 1).alias("check_no"), c.cast("string").alias("v"))
            bad.append(F.when(c.isNull() | ~c.isin(*ck.args), row))
    found = df.select(F.explode(F.array(*bad)).alias("r")).filter(F.col("r").isNotNull()).select("r.*").distinct()
    order = Window.partitionBy("check_no").orderBy(F.col("v").asc_nulls_last())
    first = found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= EXAMPLES)
    shown = F.when(F.col("v").isNull(), F.lit("nan")).otherwise(F.concat(F.lit("'"), F.col("v"), F.lit("'")))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("k", shown.alias("s")))), lambda x: x["s"])
    return first.groupBy("check_no").agg(F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]")).alias("examples"))


def land(df: DataFrame, checks: list[Check], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Write a table and gather its suite's counters on the way (no scan of
    their own): the table as ``write`` gives it back, and the one-row counters
    for ``run_suite``.

    ``write`` must run one action that reads every row of what it is given once.
    The rows are counted where they are written, in the last stage of that
    action, whose tasks count once also when they are tried again."""
    seen = Observation()
    stored = write(df.observe(seen, *_measures(df, checks)))
    found = seen.get
    schema = T.StructType([T.StructField(name, T.LongType()) for name in found])
    return stored, df.sparkSession.createDataFrame([tuple(found.values())], schema)


def run_suite(
    name: str, df: DataFrame, checks: list[Check], with_examples: bool = True, counters: DataFrame | None = None
) -> DataFrame:
    """Rows (suite, check_no, check, status, detail), one per check.

    ``with_examples=False`` leaves the offending-value examples out of the
    in-set details (and their scan out of the plan) when only the statuses
    are needed. ``counters`` are those of ``land``; without them they are
    counted here."""

    def row(i: int, ck: Check) -> Column:
        ok, detail = _result(ck, i)
        return F.struct(
            F.lit(name).alias("suite"),
            F.lit(i + 1).alias("check_no"),
            F.lit(ck.name).alias("check"),
            F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
            detail.alias("detail"),
        )

    counted = [(i, ck) for i, ck in enumerate(checks) if ck.kind != "unique"]
    if counters is None:
        counters = df.agg(*_measures(df, checks))
    res = counters.select(F.explode(F.array(*[row(i, ck) for i, ck in counted])).alias("r")).select("r.*")
    for i, ck in enumerate(checks):
        if ck.kind == "unique":
            # rows after the first of each value; NULLs count as one value
            dups = df.groupBy(ck.column).agg(F.count(F.lit(1)).alias("rows")).agg(
                F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias(f"m{i}"), F.lit(0).alias("n")
            )
            res = res.unionByName(dups.select(row(i, ck).alias("r")).select("r.*"))
    in_set = [i + 1 for i, ck in enumerate(checks) if ck.kind == "in_set"]
    if with_examples and in_set:
        # merged by a group-by on check_no over at most two rows per check
        cols = ["suite", "check", "status", "detail"]
        both = res.withColumn("examples", F.lit(None).cast("string")).unionByName(
            _examples(df, checks).select("check_no", *[F.lit(None).cast("string").alias(c) for c in cols], "examples")
        )
        shown = F.coalesce(F.first("examples", ignorenulls=True), F.lit("[]"))
        res = (
            both.groupBy("check_no")
            .agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols], shown.alias("examples"))
            .withColumn("detail", F.when(F.col("check_no").isin(*in_set), F.concat("detail", "examples")).otherwise(F.col("detail")))
            .select("suite", "check_no", "check", "status", "detail")
        )
    return res


def run_suites(
    raw: dict[str, DataFrame], suites: dict[str, list[Check]] = SUITES, with_examples: bool = True
) -> DataFrame:
    """All suites, unioned (suite order kept in ``suite_no``)."""
    out = None
    for k, (name, checks) in enumerate(suites.items()):
        part = run_suite(name, raw[name], checks, with_examples).withColumn("suite_no", F.lit(k + 1))
        out = part if out is None else out.unionByName(part)
    return out


def summarize(results: DataFrame) -> DataFrame:
    """Per-suite passed / failed / total plus an ``ALL`` row with the pass rate."""
    per = results.groupBy("suite").agg(
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )
    overall = per.agg(
        F.lit("ALL").alias("suite"),
        F.sum("passed").alias("passed"),
        F.sum("failed").alias("failed"),
        F.sum("total").alias("total"),
    )
    both = per.unionByName(overall)
    rate = F.round(F.col("passed").cast("decimal(20,0)") * 100 / F.nullif(F.col("total"), F.lit(0)), 1)
    return both.withColumn("pass_rate_pct", rate.cast("decimal(5,1)"))


def with_row_counts(bounds: dict[str, tuple[int, int]], suites: dict[str, list[Check]] = SUITES) -> dict[str, list[Check]]:
    """The suites with other row-count bounds for some tables."""
    return {
        name: [row_count_between(*bounds[name]) if ck.kind == "row_count_between" and name in bounds else ck for ck in checks]
        for name, checks in suites.items()
    }


class ValidationFailed(RuntimeError):
    pass


def gate(results: DataFrame) -> None:
    """Stop the run when any check failed (reads one aggregate row)."""
    row = results.agg(F.count_if(F.col("status") == FAIL).alias("failed")).first()
    if row["failed"]:
        raise ValidationFailed(
            f"source checks failed: {row['failed']}; see the validation report"
        )


# ---------------------------------------------------------------------------
# Schema tests on sources and models (failing-row counts).

@dataclass(frozen=True)
class SchemaTest:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | expression_is_true
    arg: object = None

    @property
    def args_text(self) -> str:
        if self.test == "accepted_values":
            return ", ".join(str(v) for v in self.arg)
        return self.arg or ""


def _expr(col: str, text: str) -> Column:
    """``<col> <text>`` (e.g. ``>= 0``, ``between 0 and 1``) as a Spark SQL
    predicate."""
    return F.expr(f"`{col}` {text}")


def _nt(model, col, test, arg=None):
    return SchemaTest(model, col, test, arg)


BUCKET_LABELS = ["Investment Grade — High", "Investment Grade — Upper Mid",
                 "Investment Grade — Lower Mid", "Sub-Investment Grade — High",
                 "Sub-Investment Grade — Low", "Unrated"]
STATUS_LABELS = ["Below Minimum — Regulatory Action Required", "Within Buffer — Restricted Distributions",
                 "Adequate — Monitor Closely", "Well Capitalised"]

# The declared tests, sources first, then models.
SCHEMA_TESTS: list[SchemaTest] = [
    _nt("loan_portfolio", "loan_id", "not_null"),
    _nt("loan_portfolio", "loan_id", "unique"),
    _nt("loan_portfolio", "counterparty_id", "not_null"),
    _nt("loan_portfolio", "exposure_amount", "not_null"),
    _nt("loan_portfolio", "exposure_amount", "expression_is_true", ">= 0"),
    _nt("loan_portfolio", "pd_estimate", "not_null"),
    _nt("loan_portfolio", "pd_estimate", "expression_is_true", "between 0 and 1"),
    _nt("loan_portfolio", "lgd_estimate", "not_null"),
    _nt("loan_portfolio", "lgd_estimate", "expression_is_true", "between 0 and 1"),
    _nt("loan_portfolio", "reporting_date", "not_null"),
    _nt("counterparties", "counterparty_id", "not_null"),
    _nt("counterparties", "counterparty_id", "unique"),
    _nt("counterparties", "kyc_status", "accepted_values", ("Verified", "Pending", "Failed")),
    _nt("rwa_components", "loan_id", "not_null"),
    _nt("rwa_components", "total_rwa", "not_null"),
    _nt("rwa_components", "total_rwa", "expression_is_true", ">= 0"),
    _nt("capital_components", "entity_id", "not_null"),
    _nt("capital_components", "cet1_ratio", "not_null"),
    _nt("capital_components", "cet1_ratio", "expression_is_true", "> 0"),
    _nt("stress_scenarios", "scenario_id", "not_null"),
    _nt("stress_scenarios", "scenario_id", "unique"),
    _nt("stress_scenarios", "scenario_name", "accepted_values", ("Baseline", "Adverse", "Severely Adverse")),
    _nt("stress_scenarios", "stressed_pd", "expression_is_true", "between 0 and 1"),
    _nt("stg_loan_portfolio", "loan_id", "not_null"),
    _nt("stg_loan_portfolio", "loan_id", "unique"),
    _nt("stg_loan_portfolio", "exposure_amount", "not_null"),
    _nt("stg_loan_portfolio", "exposure_amount", "expression_is_true", "> 0"),
    _nt("stg_loan_portfolio", "pd_estimate", "expression_is_true", "between 0 and 1"),
    _nt("stg_counterparties", "counterparty_id", "not_null"),
    _nt("stg_counterparties", "counterparty_id", "unique"),
    _nt("stg_counterparties", "is_sanctioned", "accepted_values", (False,)),
    _nt("int_credit_risk_enriched", "loan_id", "not_null"),
    _nt("int_credit_risk_enriched", "loan_id", "unique"),
    _nt("int_credit_risk_enriched", "expected_loss", "not_null"),
    _nt("int_credit_risk_enriched", "expected_loss", "expression_is_true", ">= 0"),
    _nt("int_credit_risk_enriched", "rating_bucket", "not_null"),
    _nt("int_credit_risk_enriched", "rating_bucket", "accepted_values", tuple(BUCKET_LABELS)),
    _nt("fct_basel3_rwa_report", "reporting_date", "not_null"),
    _nt("fct_basel3_rwa_report", "total_rwa", "not_null"),
    _nt("fct_basel3_rwa_report", "total_rwa", "expression_is_true", ">= 0"),
    _nt("fct_basel3_rwa_report", "total_capital_requirement", "expression_is_true", ">= 0"),
    _nt("fct_capital_adequacy", "entity_id", "not_null"),
    _nt("fct_capital_adequacy", "cet1_ratio", "not_null"),
    _nt("fct_capital_adequacy", "cet1_ratio", "expression_is_true", "> 0"),
    _nt("fct_capital_adequacy", "capital_adequacy_status", "accepted_values", tuple(STATUS_LABELS)),
    _nt("fct_ccar_stress_test", "scenario_name", "accepted_values", ("Baseline", "Adverse", "Severely Adverse")),
    _nt("fct_ccar_stress_test", "total_expected_loss", "expression_is_true", ">= 0"),
]


def _failing(t: SchemaTest) -> Column:
    c = F.col(t.column)
    if t.test == "not_null":
        return F.count_if(c.isNull())
    if t.test == "expression_is_true":
        return F.count_if(~_expr(t.column, t.arg))  # NULL results never fail
    if t.test == "accepted_values":
        # distinct non-NULL values outside the list
        return F.count_distinct(F.when(~c.isin(*t.arg), c))
    raise ValueError(t.test)


def run_schema_tests(tables: dict[str, DataFrame], tests: list[SchemaTest] = SCHEMA_TESTS) -> DataFrame:
    """(test_no, model, column_name, test, test_args, failures, status) per test.

    Per table, the not-null, expression and accepted-values tests share one
    aggregate; each uniqueness test is a group-by on its column (duplicated
    values = groups with more than one row)."""
    by_model: dict[str, list[tuple[int, SchemaTest]]] = {}
    for no, t in enumerate(tests, start=1):
        by_model.setdefault(t.model, []).append((no, t))

    def row(no: int, t: SchemaTest, failures: Column) -> Column:
        return F.struct(
            F.lit(no).alias("test_no"),
            F.lit(t.model).alias("model"),
            F.lit(t.column).alias("column_name"),
            F.lit(t.test).alias("test"),
            F.lit(t.args_text).alias("test_args"),
            failures.cast("bigint").alias("failures"),
        )

    parts = []
    for model, items in by_model.items():
        df = tables[model]
        shared = [(no, t) for no, t in items if t.test != "unique"]
        if shared:
            agg = df.agg(*[_failing(t).alias(f"t{no}") for no, t in shared])
            rows = [row(no, t, F.col(f"t{no}")) for no, t in shared]
            parts.append(agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
        for no, t in items:
            if t.test == "unique":
                dup = (
                    df.filter(F.col(t.column).isNotNull())
                    .groupBy(t.column)
                    .count()
                    .agg(F.count_if(F.col("count") > 1).alias("f"))
                )
                parts.append(dup.select(row(no, t, F.col("f")).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit(PASS)).otherwise(F.lit(FAIL)))
