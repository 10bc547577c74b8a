"""Sharding by proportional stratified interleaving (operator 10, native).

Rows of each source are put in a seeded random order; the row ranked r of n
gets the fractional rank (r - u) / n, with a seeded offset u in (0, 1) for each
source (with one fixed offset, all sources of one row would meet at the same
place). Sorted by fractional rank, any stretch of the sequence holds every
source in the proportion of the whole, so cutting it into equal stretches makes
every shard match the mixture. Law: ``rows`` (shard counts at most one apart).

Ranks are found in two levels (``native.running``): no window holds a whole
source or the whole table, whatever share of the rows one source has.

Edge cases: null text has size 1 and checksum 0; null sources are one source
of their own; null ids are ordinary rows (they sort together); repeated rows
take one slot each; an empty table gives an empty result; further columns of
the input are ignored unless named in ``keep``, and a kept column may not be
named like a result column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskforge.llm.common import cut, text_or_empty
from riskforge.llm.native import hash_bucket, n_buckets, running, seeded_key

SHARDS = 8
SEED = "shards"


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (and ``keep``)."""
    base = cut(
        docs.select(
            F.col("doc_id"),
            *[F.col(c) for c in keep],
            (F.octet_length(text_or_empty()) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
            # a null source gets a key that no source name can have
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("s_key"),
            seeded_key(seed, "doc_id").alias("s_hash"),
        )
    )
    rows = base.count()
    buckets = n_buckets(rows)
    ranked = running(
        base.withColumn("s_bucket", hash_bucket("s_hash", buckets)),
        "s_key",
        "s_bucket",
        ["s_hash", "doc_id", "text_crc32", "size"],
    )
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("s_key")).cast("binary")), 1, 8)
    offset = (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**32))
    frac = (F.col("rn").cast("double") - offset) / F.col("n_group").cast("double")
    placed = cut(
        ranked.select("doc_id", *keep, "size", "text_crc32", "s_key", "s_hash", frac.alias("s_frac"))
        .withColumn("s_at", F.floor(F.col("s_frac") * F.lit(buckets)).cast("long"))
    )
    counts = placed.groupBy("s_at").agg(F.count(F.lit(1)).alias("n_at"))
    earlier = W.orderBy("s_at").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("s_at", F.coalesce(F.sum("n_at").over(earlier), F.lit(0)).alias("o_at"))
    inside = W.partitionBy("s_at").orderBy("s_frac", "s_key", "s_hash", "doc_id", "text_crc32", "size")
    at = placed.join(offsets, "s_at").withColumn("at", F.col("o_at") + F.row_number().over(inside) - F.lit(1))
    # shard k holds positions ceil(k * rows / shards) .. ceil((k + 1) * rows / shards) - 1
    shard = F.floor(F.col("at") * F.lit(shards) / F.lit(max(rows, 1))).cast("long")
    start = F.ceil(F.col("shard") * F.lit(rows) / F.lit(shards)).cast("long")
    return (
        at.withColumn("shard", shard)
        .withColumn("slot", (F.col("at") - start).cast("long"))
        .select("doc_id", *keep, "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")
    )


def digest(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """The result columns of the registered query."""
    return shard_documents(docs, shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
