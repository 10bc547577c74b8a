"""Command line: validate sources, build the models, run the schema tests.

    python -m riskforge validate --raw-dir DIR [--report-dir PATH]
    python -m riskforge run      --raw-dir DIR --warehouse PATH [--target dev|prod] [--no-gate]
    python -m riskforge test     --raw-dir DIR

``--raw-dir`` holds one file or folder per source table, named
``<table>.csv`` or ``<table>.parquet``; ``--testdata SF_DIR`` derives the raw
tables from the TPC-H style test tables instead. Exit status 1 means a
failed gate or failed tests.

``--config FILE`` (JSON, any Hadoop path) sets ``thresholds``, ``stress`` (fields of
``riskforge.config``) and ``row_counts`` ({table: [least, most]}).
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from decimal import Decimal

from riskforge.config import DEFAULT_STRESS, DEFAULT_THRESHOLDS
from riskforge.operators import quality
from riskforge.plans.build import Build
from riskforge.session import get_session, warehouse_path

SOURCES = ("loan_portfolio", "counterparties", "rwa_components", "capital_components", "stress_scenarios")


def _exists(spark, path: str) -> bool:
    """On any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _settings(spark, path: str | None) -> tuple[dict, dict]:
    """Options of the build, and the suites, from a config file."""
    found = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect())) if path else {}

    def changed(default, values):
        kinds = {k: type(getattr(default, k)) for k in values}
        return replace(default, **{k: Decimal(str(v)) if kinds[k] is Decimal else tuple(map(tuple, v)) for k, v in values.items()})

    options = {
        "thresholds": changed(DEFAULT_THRESHOLDS, found.get("thresholds", {})),
        "stress": changed(DEFAULT_STRESS, found.get("stress", {})),
    }
    return options, quality.with_row_counts({k: tuple(v) for k, v in found.get("row_counts", {}).items()})


def _build(spark, args, options: dict) -> Build:
    if args.testdata:
        return Build.from_testdata(spark, args.testdata, reporting_date=args.reporting_date, **options)
    paths = {}
    for t in SOURCES:
        for ext in ("csv", "csv.gz", "parquet"):
            p = f"{args.raw_dir.rstrip('/')}/{t}.{ext}"
            if _exists(spark, p):
                paths[t] = p
                break
        else:
            raise SystemExit(f"missing source table {t} in {args.raw_dir}")
    return Build.from_paths(spark, paths, reporting_date=args.reporting_date, **options)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="riskforge")
    ap.add_argument("command", choices=["validate", "run", "test"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-dir")
    src.add_argument("--testdata")
    ap.add_argument("--warehouse")
    ap.add_argument("--report-dir")
    ap.add_argument("--target", default="dev")
    ap.add_argument("--target-schema", default="analytics")
    ap.add_argument("--no-gate", action="store_true")
    ap.add_argument("--config", help="JSON file with thresholds, stress and row_counts")
    ap.add_argument("--reporting-date", help="scope the run to one reporting snapshot (YYYY-MM-DD)")
    args = ap.parse_args(argv)

    spark = get_session(profile="cluster")
    options, suites = _settings(spark, args.config)
    build = _build(spark, args, options)

    if args.command == "validate":
        from riskforge.sources.sinks import write_validation_report

        base = args.report_dir or warehouse_path(spark, "_validation")
        path, details = write_validation_report(quality.run_suites(build.raw, suites), base, quality.summarize)
        failed = details.filter("status = 'FAIL'").count()
        print(json.dumps({"report": path, "failed": failed}))
        return 1 if failed else 0

    if args.command == "run":
        from riskforge.plans import runner

        try:
            res = runner.run(spark, build, args.warehouse, args.target, args.target_schema,
                               enforce_gate=not args.no_gate, suites=suites)
        except quality.ValidationFailed as e:
            print(str(e), file=sys.stderr)
            return 1
        print(json.dumps(res))
        return 0

    tests = quality.run_schema_tests(build.schema_test_tables())
    failing = tests.filter("status = 'FAIL'").select("test_no", "model", "column_name", "test", "failures")
    rows = [r.asDict() for r in failing.collect()]  # at most one row per declared test
    print(json.dumps({"tests": len(quality.SCHEMA_TESTS), "failed": rows}))
    return 1 if rows else 0


if __name__ == "__main__":
    sys.exit(main())
