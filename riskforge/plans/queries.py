"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query builds the model graph from the test tables in ``sf_dir`` and
returns one model or report, normalized for comparison (audit stamps
dropped, decimals as DOUBLE).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskforge.config import DEFAULT_STRESS
from riskforge.operators import drill, formulas, incremental, marts, quality, reports
from riskforge.operators.period_state import PERIOD, PeriodStore
from riskforge.plans.build import Build
from riskforge.plans.compare import comparable
from riskforge.session import warehouse_path
from riskforge.sources.bulk_load import copy_into, loaded, rejects
from riskforge.sources.raw import load
from riskforge.sources.versions import publish

QueryFn = Callable[[SparkSession, str], DataFrame]


def _model(attr: str, **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(getattr(Build.from_testdata(spark, sf_dir, audit=False, **kw), attr))

    run.__name__ = attr
    return run


def _build_fn(fn: Callable[[Build], DataFrame], **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(Build.from_testdata(spark, sf_dir, audit=False, **kw)))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _sorted_fn(fn: Callable[[Build], DataFrame]) -> QueryFn:
    """A sorted report with the ``position`` at which each row comes out, so
    that a comparison of row sets sees the order too."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = comparable(fn(Build.from_testdata(spark, sf_dir, audit=False)))
        numbered = report.withColumn("_at", F.monotonically_increasing_id())  # rises along the sorted output
        return numbered.withColumn("position", F.row_number().over(Window.orderBy("_at")).cast("bigint")).drop("_at")

    return run


# The default buffer (1e9) is never exceeded by test-size segments; a second
# registration runs the same mart with a buffer that splits them.
LOW_BUFFER = replace(DEFAULT_STRESS, capital_buffer=Decimal("50000"))


CSV_ROWS = 500_000  # of a file: a file whose fields may hold line breaks is read by one task


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("maxRecordsPerFile", CSV_ROWS).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def _csv_roundtrip(table: str) -> QueryFn:
    """A raw table written as CSV and read back through its raw schema."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = warehouse_path(spark, f"csv/{uuid.uuid4().hex}")
        _write_csv(Build.from_testdata(spark, sf_dir, audit=False).raw[table], path)
        return comparable(load(spark, table, path, "csv"))

    return run


def _bulk_load(spark: SparkSession, sf_dir: str) -> str:
    """The loans loaded from CSV twice, those rated CCC with an exposure that is no number."""
    base = warehouse_path(spark, f"bulk/{uuid.uuid4().hex}")
    loans = Build.from_testdata(spark, sf_dir, audit=False).raw["loan_portfolio"]
    shown = F.when(F.col("internal_rating") == "CCC", "n/a").otherwise(F.col("exposure_amount").cast("string"))
    _write_csv(loans.withColumn("exposure_amount", shown), f"{base}/in")
    for _ in range(2):  # the second load finds no new file
        copy_into(spark, "loan_portfolio", f"{base}/in", f"{base}/out")
    return f"{base}/out"


def _bulk_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = rejects(spark, _bulk_load(spark, sf_dir), "loan_portfolio")
    return comparable(refused.groupBy(F.array_join("columns", ",").alias("columns")).agg(F.count(F.lit(1)).alias("records")))


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table after a rewrite that fails half way, read through SQL."""
    capital = comparable(Build.from_testdata(spark, sf_dir, audit=False).stg_capital_components)
    base, schema = warehouse_path(spark, "published"), f"published_{uuid.uuid4().hex}"
    publish(capital, base, schema, "capital", ("reporting_date",))
    half = F.when(F.xxhash64("entity_id", "reporting_period") % 2 == 0, F.raise_error(F.lit("half way")).cast("string")).otherwise("x")
    try:
        publish(capital.withColumn("entity_id", half), base, schema, "capital", ("reporting_date",))
    except PySparkException:
        pass
    return spark.sql(f"SELECT * FROM {schema}.capital")


MACROS_SQL = """
SELECT 'loan' AS kind, loan_id AS id, calculate_expected_loss(pd_estimate, lgd_estimate, ead_estimate) AS amount,
  capital_requirement(ead_estimate, 0.105) AS required, rating_bucket(internal_rating) AS label
FROM {p}stg_loan_portfolio
UNION ALL
SELECT 'entity', concat(entity_id, ' ', reporting_period), cet1_capital,
  capital_requirement(risk_weighted_assets), capital_adequacy_status(cet1_ratio)
FROM {p}stg_capital_components
"""


def _sql_macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyst SQL that calls the four macros, over the registered views."""
    Build.from_testdata(spark, sf_dir, audit=False).register_views("macros_")
    return comparable(spark.sql(MACROS_SQL.format(p="macros_")))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five suites over tables whose counters were gathered while they were written."""
    base = warehouse_path(spark, f"landed/{uuid.uuid4().hex}")
    raw = Build.from_testdata(spark, sf_dir, audit=False).raw
    out = None
    for name, checks in quality.SUITES.items():

        def write(df: DataFrame, path: str = f"{base}/{name}") -> DataFrame:
            df.write.parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        stored, counters = quality.land(raw[name], checks, write)
        part = quality.run_suite(name, stored, checks, counters=counters)
        out = part if out is None else out.unionByName(part)
    return comparable(out)


def _bucketed(attr: str) -> QueryFn:
    """A model over loan tables that are bucketed on the loan key."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = warehouse_path(spark, f"bucketed/{uuid.uuid4().hex}")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return comparable(getattr(Build.from_testdata(spark, sf_dir, audit=False).on_loan_key(base, buckets), attr))

    return run


TABLES = ("int_credit_risk_enriched", "fct_basel3_rwa_report", "fct_capital_adequacy", "fct_ccar_stress_test", "fct_liquidity_coverage")


def _stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the five tables of a run, from their footers."""
    base = warehouse_path(spark, f"counted/{uuid.uuid4().hex}")
    models = [m for m in Build.from_testdata(spark, sf_dir, audit=False).models() if m[1] in TABLES]
    for _, name, df in models:
        df.write.partitionBy("reporting_date").parquet(f"{base}/{name}")
    return comparable(reports.row_counts(models, stored={name: f"{base}/{name}" for _, name, _ in models}))


def _rwa_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The RWA mart of an earlier book, brought up to date by the loans that changed since.

    The earlier book lacks one loan in seven, holds one in eleven that has been
    closed since, and has one in five with other amounts, rating and flags."""
    base = warehouse_path(spark, f"refreshed/{uuid.uuid4().hex}")
    now = Build.from_testdata(spark, sf_dir, audit=False).enriched_table
    pick = lambda n: F.pmod(F.xxhash64("loan_id"), F.lit(n)) == 0
    half = {c: F.col(c) for c in now.columns} | {
        "ead_estimate": F.when(pick(15), F.lit(None)).otherwise(F.col("ead_estimate") / 2).cast(now.schema["ead_estimate"].dataType),
        "internal_rating": F.lit("B"),
        "rating_bucket": F.lit(None).cast("string"),
        "is_defaulted": F.coalesce(~F.col("is_defaulted"), F.lit(True)),
    }
    differed = now.filter(~pick(7) & pick(5)).select(*[c.alias(n) for n, c in half.items()])
    closed = now.filter(pick(11)).withColumn("loan_id", F.concat(F.lit("closed "), "loan_id"))
    (now.filter(~pick(7) & ~pick(5)).unionByName(differed).unionByName(closed)).write.parquet(f"{base}/then")
    then = spark.read.schema(now.schema).parquet(f"{base}/then")
    incremental.segment_state(then).write.parquet(f"{base}/state")
    state = spark.read.parquet(f"{base}/state")
    marts.basel3_rwa_report(then, audit=False).write.parquet(f"{base}/mart")
    old = then.filter(F.col("loan_id").startswith("closed ") | pick(5))
    mart, _ = incremental.refresh(spark.read.parquet(f"{base}/mart"), state, old, now.filter(pick(7) | pick(5)))
    return comparable(mart)


def _carried(mart: Callable[[DataFrame], DataFrame]) -> QueryFn:
    """A capital mart for the last two periods, each from its own rows and carried state."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        capital = Build.from_testdata(spark, sf_dir, audit=False).stg_capital_components
        store = PeriodStore(spark, warehouse_path(spark, f"periods/{uuid.uuid4().hex}"), capital.schema)
        store.append(capital)
        newest = capital.select(PERIOD).distinct().orderBy(F.desc(PERIOD)).limit(3).collect()  # three names
        last, before, start = [r[0] for r in newest]
        store.start(start)
        earlier = store.build(mart, before, start)
        store.advance(before, start)
        return comparable(earlier.unionByName(store.build(mart, last, before)))

    return run


def _drill_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans of the high-risk segment with the largest exposure at default."""
    b = Build.from_testdata(spark, sf_dir, audit=False)
    path, keys = warehouse_path(spark, f"clustered/{uuid.uuid4().hex}"), marts.RWA_SEGMENT_KEYS
    drill.store_clustered(b.enriched_table, path)
    order = [F.desc_nulls_last("total_ead"), *[F.asc_nulls_last(k) for k in keys]]
    worst = b.basel3_rwa_report.filter("high_risk_segment").orderBy(*order).select(*keys).first()
    if worst is None:
        return comparable(b.enriched_table.limit(0))
    return comparable(drill.drill_segment(spark, path, b.enriched_table.schema, worst.asDict()))


def _text_numerics(b: Build) -> DataFrame:
    """Numeric checks on a table whose numbers are text, some of it none."""
    rating = F.col("internal_rating")
    shown = lambda c: F.when(rating == "NR", "NaN").when(rating == "CCC", "n/a").otherwise(F.col(c).cast("string"))
    names = ("exposure_amount", "pd_estimate", "outstanding_balance", "committed_amount")
    checks = [
        quality.positive("exposure_amount"),
        quality.between("pd_estimate", 0, 0.2),
        quality.a_less_than_b("outstanding_balance", "committed_amount", threshold=5.0),
    ]
    return quality.run_suite("text_numerics", b.raw["loan_portfolio"].select(*[shown(c).alias(c) for c in names]), checks)


def registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "stg_loan_portfolio": _model("stg_loan_portfolio"),
        "stg_counterparties": _model("stg_counterparties"),
        "stg_rwa_components": _model("stg_rwa_components"),
        "stg_capital_components": _model("stg_capital_components"),
        "stg_stress_scenarios": _model("stg_stress_scenarios"),
        "credit_risk_enriched": _model("credit_risk_enriched"),
        "basel3_rwa_report": _model("basel3_rwa_report"),
        "capital_adequacy": _model("capital_adequacy"),
        "ccar_stress_test": _model("ccar_stress_test"),
        "ccar_stress_test_low_buffer": _model("ccar_stress_test", stress=LOW_BUFFER),
        "liquidity_coverage": _model("liquidity_coverage"),
        # analyst reports
        "report_capital_summary": _sorted_fn(lambda b: reports.capital_summary(b.capital_adequacy)),
        "report_rwa_by_class": _sorted_fn(lambda b: reports.rwa_by_class(b.basel3_rwa_report)),
        "report_scenarios": _sorted_fn(lambda b: reports.scenario_comparison(b.ccar_stress_test)),
        "report_sector_concentration": _sorted_fn(
            lambda b: reports.sector_concentration(b.basel3_rwa_report_by_sector)
        ),
        "report_capital_trend": _sorted_fn(lambda b: reports.capital_trend(b.capital_adequacy)),
        "report_watch_list": _sorted_fn(
            lambda b: reports.watch_list(b.enriched_table, b.stg_counterparties)
        ),
        "report_liquidity": _sorted_fn(lambda b: reports.liquidity_summary(b.liquidity_coverage)),
        "report_row_counts": _sorted_fn(lambda b: reports.row_counts(b.models())),
        # data-quality gate
        "dq_summary": _build_fn(lambda b: quality.summarize(quality.run_suites(b.raw, with_examples=False))),
        "schema_tests": _build_fn(lambda b: quality.run_schema_tests(b.schema_test_tables())),
    }
    q.update({
        "raw_csv_roundtrip": _csv_roundtrip("loan_portfolio"),
        "raw_csv_counterparties": _csv_roundtrip("counterparties"),
        "raw_csv_rwa": _csv_roundtrip("rwa_components"),
        "raw_csv_capital": _csv_roundtrip("capital_components"),
        "raw_csv_stress": _csv_roundtrip("stress_scenarios"),
        "bulk_load": lambda s, d: comparable(loaded(s, _bulk_load(s, d), "loan_portfolio")),
        "bulk_load_rejects": _bulk_rejects,
        "published_table": _published,
        "dq_text_numerics": _build_fn(_text_numerics),
        "dq_landed": _landed,
        "credit_risk_enriched_bucketed": _bucketed("credit_risk_enriched"),
        "ccar_stress_test_bucketed": _bucketed("ccar_stress_test"),
        "report_stored_row_counts": _stored_counts,
        "rwa_report_refreshed": _rwa_refreshed,
        "capital_adequacy_carried": _carried(lambda c: marts.capital_adequacy(c, audit=False)),
        "liquidity_coverage_carried": _carried(lambda c: marts.liquidity_coverage(c, audit=False)),
        "segment_drill_clustered": _drill_clustered,
        "sql_macros": _sql_macros,
        # business formulas and macros
        "rwa_standardized": _build_fn(lambda b: formulas.rwa_standardized(b.stg_loan_portfolio)),
        "capital_ratios": _build_fn(lambda b: formulas.capital_ratios(b.stg_capital_components)),
        "stress_shock": _build_fn(lambda b: formulas.stress_shock(b.stg_loan_portfolio)),
        "segment_drill_through": _build_fn(
            lambda b: formulas.drill_through(
                b.enriched_table, b.basel3_rwa_report.filter("high_risk_segment")
            )
        ),
        "expected_loss_by_rating": _build_fn(lambda b: formulas.expected_loss_by_rating(b.stg_loan_portfolio)),
        "capital_requirement_by_class": _build_fn(
            lambda b: formulas.capital_requirement_by_class(b.stg_rwa_components)
        ),
    })
    for suite, checks in quality.SUITES.items():
        q[f"dq_{suite}"] = _build_fn(
            lambda b, s=suite, c=checks: quality.run_suite(s, b.raw[s], c)
        )
    return q
