"""Distributed rank and prefix sum inside groups, in DataFrame functions only.

A window over a whole group would put a hot source into one task. Rows are
therefore dealt to buckets that follow the sort order, each bucket's totals
are summed up (a small table), and windows run inside one bucket only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def n_buckets(rows: int, least: int = 256) -> int:
    """Buckets of about sqrt(rows) rows: both the rows of a bucket and the
    number of buckets grow with the root of the input."""
    return max(1, math.ceil(rows / max(least, math.isqrt(max(rows, 1)))))


def seeded_key(seed: str, *cols: str) -> Column:
    """Hex digest that orders rows in a seeded random order (same in any SQL
    engine that has md5)."""
    parts: list[Column] = [F.lit(seed)]
    for c in cols:
        parts += [F.lit("|"), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts).cast("binary"))


def hash_bucket(key: str, buckets: int) -> Column:
    """Bucket of a hex digest, rising with the digest's order."""
    head = F.conv(F.substring(F.col(key), 1, 8), 16, 10).cast("long")
    return F.floor(head * F.lit(buckets) / F.lit(2**32)).cast("long")


def running(df: DataFrame, group: str, bucket: str, order: list[str], value: str | None = None) -> DataFrame:
    """Add ``rn`` (1-based rank in ``group``), ``n_group`` and, for ``value``,
    ``before`` (sum of the values ranked earlier) and ``total``.

    ``bucket`` must rise with ``order`` inside each group. Group keys must not
    be null.
    """
    sums = [F.count(F.lit(1)).alias("b_n")] + ([F.sum(value).alias("b_v")] if value else [])
    small = df.groupBy(group, bucket).agg(*sums)
    before = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(group)
    cols = [
        F.coalesce(F.sum("b_n").over(before), F.lit(0)).alias("o_n"),
        F.sum("b_n").over(whole).alias("n_group"),
    ]
    if value:
        cols += [
            F.coalesce(F.sum("b_v").over(before), F.lit(0)).alias("o_v"),
            F.sum("b_v").over(whole).alias("total"),
        ]
    offsets = small.select(group, bucket, *cols)
    inside = W.partitionBy(group, bucket).orderBy(*order)
    out = df.join(offsets, [group, bucket]).withColumn("rn", F.col("o_n") + F.row_number().over(inside))
    if value:
        out = out.withColumn(
            "before",
            F.col("o_v") + F.sum(value).over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col(value),
        )
    return out.drop("o_n", "o_v")
