"""Sinks: view and table materialization, and the validation report.

A materialized table is written as parquet and read back, so consumers plan
against the written files: the lineage is cut there (a lost executor never
recomputes upstream models) and the optimizer sees real file statistics.
Tables are partitioned by ``reporting_date``. A run replaces the whole table;
a run scoped to one reporting date replaces that date's partition only.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts]) if "://" in base else os.path.join(base, *parts)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: a named lazy plan, recomputed by each reader."""
    df.createOrReplaceTempView(name)
    return df


def materialize_table(
    df: DataFrame,
    base: str,
    schema: str,
    name: str,
    partition_by: tuple[str, ...] | None = ("reporting_date",),
    reporting_date=None,
) -> DataFrame:
    """Table materialization: a full rebuild, after which the table holds the
    rows of ``df`` and no others (none, if the model is empty).

    With ``reporting_date`` the run is scoped: only that date's partition is
    rebuilt (removed, if the model has no rows for it) and other dates stay.
    """
    spark = df.sparkSession
    path = _join(base, schema, name)
    cols = [c for c in (partition_by or ()) if c in df.columns]
    scoped = reporting_date is not None and cols == ["reporting_date"]
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if scoped else "static")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    if scoped and df.isEmpty():
        _delete(spark, _join(path, f"reporting_date={reporting_date}"))
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def _delete(spark, path: str) -> None:
    """Remove a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def register_table(
    df: DataFrame, base: str, schema: str, name: str, partition_by: tuple[str, ...] = ("reporting_date",)
) -> str:
    """Make a materialized table queryable as ``schema.name`` in Spark SQL.

    The database is created at ``base/schema`` and the table is an external
    parquet table over the written files, so analyst SQL written against
    schema-qualified tables runs unchanged through ``spark.sql``. The schema is
    the model's, so an empty table has its columns too.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{_join(base, schema)}'")
    qualified = f"`{schema}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = [c for c in partition_by if c in df.columns]
    partitioned = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {qualified} ({cols}) USING parquet {partitioned} LOCATION '{_join(base, schema, name)}'")
    if parts:
        spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
    return f"{schema}.{name}"


def write_validation_report(results: DataFrame, base: str, summarize=None) -> tuple[str, DataFrame]:
    """JSON report under ``base/validation_<ts>``: ``details`` (one object per
    check) and ``summary`` (one per suite), stamped with the run time.

    The checks are evaluated once: the summary is computed from the written
    details. Returns the report folder and the details read back.
    """
    ts = _dt.datetime.now(_dt.timezone.utc)
    path = _join(base, f"validation_{ts.strftime('%Y%m%d_%H%M%S')}")
    stamp = F.lit(ts.isoformat()).alias("run_ts")
    results.select("*", stamp).coalesce(1).write.mode("overwrite").json(_join(path, "details"))
    details = results.sparkSession.read.schema(results.select("*", stamp).schema).json(_join(path, "details"))
    if summarize is not None:
        summary = summarize(details)
        summary.select("*", stamp).coalesce(1).write.mode("overwrite").json(_join(path, "summary"))
        # One document {summary: [...], details: [...], run_ts}: the lists
        # hold one entry per suite / declared check, a fixed small bound.
        cols = [c for c in details.columns if c != "run_ts"]
        s_part = summary.agg(F.sort_array(F.collect_list(F.struct(*summary.columns))).alias("summary"))
        d_part = details.agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("details"))
        s_type, d_type = s_part.schema["summary"].dataType, d_part.schema["details"].dataType
        both = s_part.withColumn("details", F.lit(None).cast(d_type)).unionByName(
            d_part.withColumn("summary", F.lit(None).cast(s_type))
        )
        doc = both.agg(
            F.first("summary", ignorenulls=True).alias("summary"),
            F.first("details", ignorenulls=True).alias("details"),
        ).select("summary", "details", stamp)
        doc.coalesce(1).write.mode("overwrite").json(_join(path, "report"))
    return path, details
