"""Tables bucketed on a join key, so that joins on it need no exchange.

``bucketed`` writes a table once, dealt by the hash of its key into a fixed
number of sorted buckets, one file each, and names it in the catalog; tables
with the same key type and number of buckets then meet bucket by bucket.

A bucket cannot be split at run time, as a shuffled partition can. So
``even`` counts the rows of each bucket first (one narrow aggregate, no rows
to the driver but one), and a table with a hot bucket is stored without
buckets: its joins shuffle, and AQE splits the hot partition. Both layouts hold
every row.

Edge cases: NULL keys share a bucket and count like any key; an empty table is
even and is stored with its columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.sources.sinks import _join

BUCKET_ROWS = 2_000_000  # a bucket of so many rows is no burden for a task
HOT_FACTOR = 4  # beyond that a bucket may hold so many times the mean


def even(df: DataFrame, key: str, buckets: int, bucket_rows: int = BUCKET_ROWS) -> bool:
    """Whether no bucket would hold more than ``HOT_FACTOR`` times the mean (or ``bucket_rows``)."""
    rows = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    most, total = rows.agg(F.coalesce(F.max("rows"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    return most <= max(bucket_rows, HOT_FACTOR * total / buckets)


def bucketed(
    df: DataFrame, base: str, name: str, key: str, buckets: int, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Write ``df`` under ``base``, bucketed on ``key`` where its keys are even, and read it back."""
    spark = df.sparkSession
    run = uuid.uuid4().hex
    path = _join(base, f"{name}_{run}")
    if not even(df, key, buckets, bucket_rows):
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    dealt = df.repartition(buckets, key)  # one task, so one file, for each bucket
    table = f"{name}_{run}"
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("compression", "zstd").option("path", path).saveAsTable(table)
    return spark.table(table)
