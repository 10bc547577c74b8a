"""Drill-through over a table clustered by segment.

``store_clustered`` writes the enriched loans sorted by a hash of the seven
segment keys, so a segment's loans lie together in few row groups and the
footers' bounds of the hash rule out all others. ``drill_segment`` then reads
one segment: the hash is a constant that reaches the scan, and the keys
themselves decide, so a shared hash value adds no row.

The hash takes NULL as a value of its own. A segment may hold a third of all
loans: rows are dealt by hash and loan, so such a segment spans many files.

Edge cases: an unknown segment gives no rows; NULL keys match NULL; an empty
table is stored with its columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.operators.marts import RWA_SEGMENT_KEYS

SEGMENT = "_segment"


def _hash(values: list[Column]) -> Column:
    return F.xxhash64(*[part for v in values for part in (v.isNull(), v)])


def store_clustered(
    enriched: DataFrame, path: str, keys=RWA_SEGMENT_KEYS, row_group_bytes: int = 16 << 20
) -> None:
    """Write ``enriched`` to ``path``, clustered by segment."""
    hashed = enriched.withColumn(SEGMENT, _hash([F.col(k) for k in keys]))
    loan = F.xxhash64("loan_id")
    (
        hashed.repartitionByRange(F.col(SEGMENT), loan)
        .sortWithinPartitions(SEGMENT)
        .write.option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )


def drill_segment(
    spark: SparkSession, path: str, schema, segment: dict, keys=RWA_SEGMENT_KEYS
) -> DataFrame:
    """The loans of one segment (key -> value, None for NULL) of a clustered table.

    ``schema`` is that of the enriched loans that were stored."""
    types = {f.name: f.dataType for f in schema.fields}
    wanted = {k: F.lit(segment[k]).cast(types[k]) for k in keys}
    clustered = T.StructType([*schema.fields, T.StructField(SEGMENT, T.LongType())])
    stored = spark.read.schema(clustered).parquet(path)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(v) for k, v in wanted.items()])
    return stored.filter((F.col(SEGMENT) == _hash(list(wanted.values()))) & same).drop(SEGMENT)
