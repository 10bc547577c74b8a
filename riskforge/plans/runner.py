"""End-to-end run: validate sources, build staging views, materialize the
enrichment table and the marts, then the reports.

Each materialized model is written and read back before its consumers are
planned, like a warehouse table build: downstream stages read files, not
lineage.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from riskforge.config import LAYER_SCHEMAS, schema_name
from riskforge.operators import marts, quality, reports
from riskforge.plans.build import Build
from riskforge.session import warehouse_path
from riskforge.sources.sinks import (
    _join,
    materialize_table,
    materialize_view,
    register_table,
    write_validation_report,
)


def run(
    spark: SparkSession,
    build: Build,
    warehouse: str | None = None,
    target_name: str = "dev",
    target_schema: str = "analytics",
    enforce_gate: bool = True,
    suites: dict | None = None,
) -> dict:
    """Run the whole graph; returns per-step wall times and row counts.

    ``suites`` replaces the validation suites (``quality.with_row_counts``
    gives the declared ones with other row-count bounds). A source that holds
    several reporting dates needs a build scoped to one of them, because the
    models join on ids alone.

    ``warehouse`` defaults to a folder under the session's shared
    ``spark.checkpoint.dir`` (never a machine-local folder on a cluster).
    """
    if warehouse is None:
        warehouse = warehouse_path(spark)
    day = build.reporting_date
    if day is None:
        dates = build.raw["loan_portfolio"].select("reporting_date").where("reporting_date is not null")
        if dates.distinct().limit(2).count() > 1:
            raise ValueError("loan_portfolio holds several reporting dates: scope the build to one")
    timings: dict[str, float] = {}
    out: dict[str, DataFrame] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        res = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return res

    def schema(layer: str) -> str:
        return schema_name(LAYER_SCHEMAS[layer], target_schema, target_name)

    # 1. source validation gate
    results = quality.run_suites(build.raw, suites or quality.SUITES)
    _, details = timed(
        "validation_report",
        lambda: write_validation_report(results, f"{warehouse}/_validation", quality.summarize),
    )
    if enforce_gate:
        quality.gate(details)

    stored: dict[str, str] = {}

    def table(df: DataFrame, layer: str, name: str) -> DataFrame:
        written = materialize_table(df, warehouse, schema(layer), name, reporting_date=day)
        register_table(written, warehouse, schema(layer), name)
        if day is None:  # a scoped table holds other dates too
            stored[name] = _join(warehouse, schema(layer), name)
        return written

    # 2. staging views
    for _, name, df in build.models()[:5]:
        materialize_view(df, name)
        out[name] = df

    # 3. enrichment table, then marts read from it
    enriched = timed(
        "int_credit_risk_enriched",
        lambda: table(build.credit_risk_enriched, "intermediate", "int_credit_risk_enriched"),
    )
    out["int_credit_risk_enriched"] = enriched
    out["fct_basel3_rwa_report"] = timed(
        "fct_basel3_rwa_report",
        lambda: table(marts.basel3_rwa_report(enriched), "credit", "fct_basel3_rwa_report"),
    )
    out["fct_capital_adequacy"] = timed(
        "fct_capital_adequacy",
        lambda: table(build.capital_adequacy, "capital", "fct_capital_adequacy"),
    )
    out["fct_ccar_stress_test"] = timed(
        "fct_ccar_stress_test",
        lambda: table(build.ccar_stress_test, "capital", "fct_ccar_stress_test"),
    )
    out["fct_liquidity_coverage"] = timed(
        "fct_liquidity_coverage",
        lambda: table(build.liquidity_coverage, "liquidity", "fct_liquidity_coverage"),
    )

    # 4. reports over the materialized marts, written as tables too
    report_fns = {
        "capital_summary": lambda: reports.capital_summary(out["fct_capital_adequacy"]),
        "rwa_by_class": lambda: reports.rwa_by_class(out["fct_basel3_rwa_report"]),
        "scenario_comparison": lambda: reports.scenario_comparison(out["fct_ccar_stress_test"]),
        "sector_concentration": lambda: reports.sector_concentration(
            marts.basel3_rwa_report(enriched, keys=marts.RWA_SEGMENT_KEYS + ("sector",))
        ),
        "capital_trend": lambda: reports.capital_trend(out["fct_capital_adequacy"]),
        "watch_list": lambda: reports.watch_list(enriched, out["stg_counterparties"]),
        "liquidity_summary": lambda: reports.liquidity_summary(out["fct_liquidity_coverage"]),
    }
    report_rows = {}
    for name, fn in report_fns.items():
        written = timed(
            f"report_{name}",
            lambda fn=fn, name=name: materialize_table(fn(), warehouse, "reports", name, partition_by=None),
        )
        report_rows[name] = written.count()

    # 5. schema tests on sources and the materialized models
    tables = dict(build.raw)
    tables.update(out)
    tests = timed(
        "schema_tests",
        lambda: materialize_table(quality.run_schema_tests(tables), warehouse, "_tests", "schema_tests",
                                  partition_by=None),
    )
    failed_tests = tests.filter("status = 'FAIL'").count()

    models = [(layer, name, out[name]) for layer, name, _ in build.models()]
    counts = timed(
        "report_row_counts",
        lambda: materialize_table(reports.row_counts(models, stored=stored), warehouse, "reports", "row_counts",
                                  partition_by=None),
    )
    return {
        "timings": timings,
        "report_rows": report_rows,
        "failed_schema_tests": failed_tests,
        # one row per model: a bounded, 10-row read
        "row_counts": {r["table_name"]: r["row_count"] for r in counts.collect()},
    }
