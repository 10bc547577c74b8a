"""Bulk load of CSV files: each file once, each bad record kept.

``copy_into`` lists a folder, leaves out the files that the table's ledger
already holds (same path, length and time) and reads the rest as text. A record
with too few or too many fields, or with a field that its column's type cannot
hold, goes to the rejects with its file, its text and the names of the bad columns;
all others go to the table. The ledger is written last, and readers see only
batches that it holds: a load that fails half way has loaded nothing and is
repeated as a whole.

Files are split among tasks; ``multi_line`` (line breaks inside quotes) reads
each file in one task instead. Every file's header must name the columns in the
same order, or the load fails.

Edge cases: an empty folder or one without new files loads nothing; an empty
field is NULL and no reject; a changed file is a new file; columns that the table
lacks are ignored, missing ones are NULL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.schemas import RAW_SCHEMAS
from riskforge.sources.sinks import _join
from riskforge.sources.versions import _files

_LEDGER = "batch string, path string, length bigint, modificationTime timestamp"
_REJECTS = "batch string, file string, record string, columns array<string>"


def _part(spark: SparkSession, base: str, table: str, part: str, schema) -> DataFrame:
    path = _join(base, table, part)
    reader = spark.read.schema(schema)
    return reader.parquet(path) if _files(spark, path) else spark.createDataFrame([], schema)


def ledger(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Loaded files: batch, path, length, modificationTime."""
    return _part(spark, base, table, "ledger", _LEDGER)


def _committed(spark: SparkSession, base: str, table: str, part: str, schema) -> DataFrame:
    batches = ledger(spark, base, table).select("batch").distinct()
    return _part(spark, base, table, part, schema).join(batches, "batch", "left_semi")


def loaded(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The table's rows."""
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField("batch", T.StringType())])
    return _committed(spark, base, table, "rows", schema).select(*RAW_SCHEMAS[table].names)


def rejects(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Records that were not loaded: batch, file, record, columns (empty: wrong number of fields)."""
    return _committed(spark, base, table, "rejects", _REJECTS)


def copy_into(spark: SparkSession, table: str, folder: str, base: str, pattern: str = "*.csv", multi_line: bool = False) -> int:
    """Load the folder's new files into the table under ``base``; returns their number."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    found = found.select("path", "length", "modificationTime")
    new = found.join(ledger(spark, base, table).drop("batch"), ["path", "length", "modificationTime"], "left_anti")
    files = new.collect()  # names of files, as the driver lists them for any read
    if not files:
        return 0
    batch = uuid.uuid4().hex
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "nullValue": "", "enforceSchema": False, "columnPruning": False}  # all fields are counted
    paths = [f.path for f in files]
    names = spark.read.options(header=True, quote='"', escape='"').csv(paths[0]).columns
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_record"]])
    raw = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord="_record").schema(texts).csv(paths)

    target = RAW_SCHEMAS[table]
    typed = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields]
    lost = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f.name)) for f in target.fields if f.name in names]
    columns = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array().cast("array<string>")
    record = F.coalesce("_record", F.to_csv(F.struct(*[f"`{n}`" for n in names])))
    judged = raw.withColumn("_columns", columns).withColumn("_file", F.input_file_name())
    bad = F.col("_record").isNotNull() | (F.size("_columns") > 0)
    rows = judged.filter(~bad).select(*typed, F.lit(batch).alias("batch"))
    refused = judged.filter(bad).select(F.lit(batch).alias("batch"), F.col("_file").alias("file"), record.alias("record"), F.col("_columns").alias("columns"))
    rows.write.mode("append").parquet(_join(base, table, "rows"))
    refused.write.mode("append").parquet(_join(base, table, "rejects"))
    done = spark.createDataFrame([(batch, f.path, f.length, f.modificationTime) for f in files], _LEDGER)
    done.coalesce(1).write.mode("append").parquet(_join(base, table, "ledger"))
    return len(files)
