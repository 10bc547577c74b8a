"""The model graph: raw -> staging -> enrichment -> marts, as lazy DataFrames.

Each model is a DataFrame built once per ``Build`` and handed to its
consumers as an argument, so one session plans the whole graph and Spark can
reuse identical exchanges between consumers. Nothing is collected.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskforge.config import DEFAULT_STRESS, DEFAULT_THRESHOLDS, StressConfig, Thresholds
from riskforge.functions import macros
from riskforge.operators import marts, staging
from riskforge.session import warehouse_path
from riskforge.sources.bucketed import bucketed
from riskforge.sources.testdata import TPCH_TABLES, Tables, raw_tables

ROW_GROUP = 16 << 20  # bytes of a row group of a stored table: the least that a task can read of a file
LOAN_KEYED = ("loan_portfolio", "rwa_components", "stress_scenarios")

_GRAPHS: dict[tuple, "Build"] = {}
_RAW: dict[tuple, Tables] = {}


def load_testdata_raw(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Tables:
    """The raw tables derived from ``sf_dir``; with ``materialize`` each is written
    and read back once per session, when a model first reads it (lineage to the
    test tables is cut there)."""
    key = _state(spark, sf_dir, materialize)
    if key not in _RAW:
        _RAW[key] = raw_tables(spark, sf_dir, _store(spark, key) if materialize else None)
    return _RAW[key]


def _state(spark: SparkSession, sf_dir: str, materialize: bool) -> tuple:
    """Names the input as it is now: files that are replaced give another key."""
    conf = spark._jsc.hadoopConfiguration()
    files = []
    for name in TPCH_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return spark.sparkContext.applicationId, sf_dir, materialize, tuple(files)


def _store(spark: SparkSession, key: tuple):
    """A function that writes a table under the shared folder and reads it back."""
    tag = hashlib.sha1(repr(key).encode()).hexdigest()[:12]
    base = warehouse_path(spark, f"raw_layer/{key[0]}/{tag}")

    def stored(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}"
        out = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return stored


class Build:
    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        thresholds: Thresholds = DEFAULT_THRESHOLDS,
        stress: StressConfig = DEFAULT_STRESS,
        audit: bool = True,
        reporting_date=None,
        store=None,
    ):
        """``reporting_date`` (a date or ISO text) scopes the run to one
        reporting snapshot: the sources are filtered on their raw
        ``reporting_date`` before staging, so the predicate reaches the scans
        and prunes date partitions of the raw tables. Capital components keep
        all periods until the marts have looked back one period. ``None``
        keeps all snapshots.

        ``store`` (name, DataFrame -> DataFrame) writes a model and reads it
        back; with it the enriched loans are evaluated once and the marts,
        reports and tests read the table."""
        if reporting_date is not None:
            day = F.lit(reporting_date).cast("date")
            of_day = lambda name, df: df if name == "capital_components" else df.filter(F.col("reporting_date") == day)
            raw = Tables({name: lambda name=name, all_days=raw: of_day(name, all_days[name]) for name in raw})
        self.raw = raw
        self.store = store
        self.thresholds = thresholds
        self.stress = stress
        self.audit = audit
        self.reporting_date = reporting_date

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, materialize: bool = True, **kw) -> "Build":
        """The graph over the test tables in ``sf_dir``.

        With ``materialize`` each raw table that a model reads is derived once
        per session and written as parquet under the shared checkpoint folder
        (before the model runs, as a warehouse load would), then read back: every model plans against written raw tables, with
        pushdown, pruning and file statistics. Plans are immutable, so one
        graph per (session, directory, options) is shared by every query.
        """
        state = _state(spark, sf_dir, materialize)
        key = (state, tuple(sorted(kw.items())))
        if key not in _GRAPHS:
            store = _store(spark, key) if materialize else None
            _GRAPHS[key] = cls(load_testdata_raw(spark, sf_dir, materialize), store=store, **kw)
        return _GRAPHS[key]

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str], **kw) -> "Build":
        """Raw tables from files (parquet or CSV by extension), by table name."""
        from riskforge.sources.raw import load

        return cls({name: load(spark, name, path) for name, path in paths.items()}, **kw)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "raw", **kw) -> "Build":
        """Raw tables from the Spark catalog: ``<database>.<table>`` for each
        of the five sources."""
        from riskforge.sources.raw import load_table

        names = ("loan_portfolio", "counterparties", "rwa_components", "capital_components", "stress_scenarios")
        return cls({n: load_table(spark, n, f"`{database}`.`{n}`") for n in names}, **kw)

    def on_loan_key(self, base: str, buckets: int) -> "Build":
        """The same graph over copies of the three loan tables that are bucketed
        on ``loan_id`` under ``base``, each when a model first reads it: loans meet
        RWA and stress rows without an exchange."""
        deal = lambda n: bucketed(self.raw[n], base, n, "loan_id", buckets) if n in LOAN_KEYED else self.raw[n]
        raw = Tables({n: lambda n=n: deal(n) for n in self.raw})
        return Build(raw, self.thresholds, self.stress, self.audit)

    # -- staging (views) ------------------------------------------------------
    @cached_property
    def stg_loan_portfolio(self) -> DataFrame:
        return staging.stg_loan_portfolio(self.raw["loan_portfolio"], self.audit)

    @cached_property
    def stg_counterparties(self) -> DataFrame:
        return staging.stg_counterparties(self.raw["counterparties"], self.audit)

    @cached_property
    def stg_rwa_components(self) -> DataFrame:
        return staging.stg_rwa_components(self.raw["rwa_components"], self.audit)

    @cached_property
    def stg_capital_components(self) -> DataFrame:
        return staging.stg_capital_components(self.raw["capital_components"], self.audit)

    @cached_property
    def stg_stress_scenarios(self) -> DataFrame:
        return staging.stg_stress_scenarios(self.raw["stress_scenarios"], self.audit)

    # -- intermediate and marts (tables) --------------------------------------
    @cached_property
    def credit_risk_enriched(self) -> DataFrame:
        return marts.credit_risk_enriched(
            self.stg_loan_portfolio, self.stg_counterparties, self.stg_rwa_components
        )

    @cached_property
    def enriched_table(self) -> DataFrame:
        """The enriched loans as a stored table (the plan itself without a store)."""
        df = self.credit_risk_enriched
        return self.store("int_credit_risk_enriched", df) if self.store else df

    @cached_property
    def rwa_mart_loans(self) -> DataFrame:
        """The columns of the enriched loans that the RWA mart reads, stored: the
        columns it does not read are then neither shuffled to the joins nor
        written. Where the whole table is stored already, that one."""
        if self.store is None or "enriched_table" in self.__dict__:
            return self.enriched_table
        return self.store("int_rwa_mart_loans", self.credit_risk_enriched.select(*marts.RWA_MART_COLUMNS))

    @cached_property
    def basel3_rwa_report(self) -> DataFrame:
        return marts.basel3_rwa_report(self.rwa_mart_loans, audit=self.audit)

    @cached_property
    def basel3_rwa_report_by_sector(self) -> DataFrame:
        """The RWA report with ``sector`` added to the segment keys (the
        sector concentration report groups by it)."""
        keys = marts.RWA_SEGMENT_KEYS + ("sector",)
        return marts.basel3_rwa_report(self.enriched_table, keys=keys, audit=self.audit)

    @cached_property
    def capital_adequacy(self) -> DataFrame:
        return self._scoped(marts.capital_adequacy(self.stg_capital_components, self.thresholds, self.audit))

    @cached_property
    def ccar_stress_test(self) -> DataFrame:
        return marts.ccar_stress_test(
            self.stg_stress_scenarios, self.stg_loan_portfolio, self.stress, self.audit
        )

    @cached_property
    def liquidity_coverage(self) -> DataFrame:
        return self._scoped(marts.liquidity_coverage(self.stg_capital_components, self.thresholds, self.audit))

    def _scoped(self, mart: DataFrame) -> DataFrame:
        """The reporting date's rows, after the prior period has been looked up."""
        if self.reporting_date is None:
            return mart
        return mart.filter(F.col("reporting_date") == F.lit(self.reporting_date).cast("date"))

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every source and model as a temp view (``loan_portfolio``
        ... ``fct_liquidity_coverage``) and the macros as SQL functions, so SQL
        written against the model names runs through ``spark.sql`` without
        materializing anything."""
        names = []
        macros.register(self.raw["loan_portfolio"].sparkSession, self.thresholds)
        for name, df in self.schema_test_tables().items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def schema_test_tables(self) -> dict[str, DataFrame]:
        """Sources and models by the names the schema tests use."""
        tables = dict(self.raw)
        tables.update({name: df for _, name, df in self.models()})
        return tables

    # layer, model name -> DataFrame, in build order
    def models(self) -> list[tuple[str, str, DataFrame]]:
        return [
            ("staging", "stg_loan_portfolio", self.stg_loan_portfolio),
            ("staging", "stg_counterparties", self.stg_counterparties),
            ("staging", "stg_rwa_components", self.stg_rwa_components),
            ("staging", "stg_capital_components", self.stg_capital_components),
            ("staging", "stg_stress_scenarios", self.stg_stress_scenarios),
            ("intermediate", "int_credit_risk_enriched", self.enriched_table),
            ("credit", "fct_basel3_rwa_report", self.basel3_rwa_report),
            ("capital", "fct_capital_adequacy", self.capital_adequacy),
            ("capital", "fct_ccar_stress_test", self.ccar_stress_test),
            ("liquidity", "fct_liquidity_coverage", self.liquidity_coverage),
        ]
