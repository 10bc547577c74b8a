"""Readers of the raw layer.

CSV files are read as text and mapped to the declared schema *by column
name*: a positional read silently mislabels columns when the file's order
differs from the table's. Numeric text that does not parse becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.schemas import RAW_SCHEMAS


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, typed. Missing columns are NULL.

    A column already stored as a number keeps its stored type (staging
    casts it): re-casting, say, decimal to the declared DOUBLE would hide
    the staging predicates from parquet filter pushdown.
    """
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
            have = df.schema[f.name].dataType
            numeric = isinstance(have, T.NumericType) and isinstance(f.dataType, T.NumericType)
            if have != f.dataType and not numeric:
                c = c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_csv(spark: SparkSession, path: str, table: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header row; empty strings are NULL (bulk-load semantics). Files
    whose quoted fields hold no line breaks are split among tasks with ``multi_line=False``."""
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')  # a quote inside a quoted field is doubled
        .option("multiLine", multi_line)
        .option("nullValue", "")
        .option("emptyValue", None)
        .csv(path)
    )
    return _conform(raw, RAW_SCHEMAS[table])


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return _conform(spark.read.parquet(path), RAW_SCHEMAS[table])


def load(spark: SparkSession, table: str, path: str, fmt: str | None = None) -> DataFrame:
    """Named source reference: a raw table by name from a path."""
    if table not in RAW_SCHEMAS:
        raise KeyError(f"unknown source table {table!r}")
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, table)
    if fmt == "parquet":
        return read_parquet(spark, path, table)
    raise ValueError(f"unsupported format {fmt!r}")


def load_table(spark: SparkSession, table: str, qualified_name: str) -> DataFrame:
    """Named source reference to a catalog table (``database.table``),
    conformed to the raw schema by column name."""
    if table not in RAW_SCHEMAS:
        raise KeyError(f"unknown source table {table!r}")
    return _conform(spark.table(qualified_name), RAW_SCHEMAS[table])
