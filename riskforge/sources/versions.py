"""Tables that are replaced as a whole or not at all.

``publish`` writes a table's rows to a new folder and, when the write is
complete, points the catalog name at it: a view over the folder, replaced in one
catalog operation. Until then, and for ever if the write fails, readers get the
old rows; a reader that has already planned keeps the folder that it planned on.
Old folders stay until ``drop_old``.

Edge cases: an empty model publishes an empty table with its columns; column
types are the model's, also those of partition columns; a failed write's folder
is removed by the next ``drop_old``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskforge.sources.sinks import _delete, _join


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath() for s in system.listStatus(folder)] if system.exists(folder) else []


def publish(df: DataFrame, base: str, schema: str, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as the next version of ``schema.name`` and return its folder."""
    spark = df.sparkSession
    path = _join(base, schema, name, f"v={uuid.uuid4().hex}")
    cols = [c for c in partition_by if c in df.columns]
    (df.write.partitionBy(*cols) if cols else df.write).parquet(path)
    if cols and not any(p.getName().startswith(f"{cols[0]}=") for p in _files(spark, path)):
        df.limit(0).write.mode("overwrite").parquet(path)  # no rows, so no partition holds the columns
    typed = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema.fields)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS SELECT {typed} FROM parquet.`{path}`")
    return path


def drop_old(spark: SparkSession, base: str, schema: str, name: str) -> int:
    """Remove the folders of versions that the catalog name does not point at."""
    text = spark.sql(f"SHOW CREATE TABLE `{schema}`.`{name}`").first()[0]
    old = [p for p in _files(spark, _join(base, schema, name)) if p.getName() not in text]
    for p in old:
        _delete(spark, p.toString())
    return len(old)
