"""Mixing sources to target weights (operator 5, native).

Targets. Sources in code point order (null last) weigh 5, 2, 1, repeating, and
share 150 % of all words by weight. No target is above twice its source's
words; what is above is shared again by weight. The fixed point is found in
closed form: with sources sorted by cap / weight, the first k are capped where
the level (total - caps before) / (weights left) no longer reaches the next.

Draw. A source's documents in a seeded random order, run through twice, are
its sequence of words. A copy of a document is drawn if its middle lies before
the target; then one document of the source that brings the sum nearest to the
target is added or taken back. The drawn stretch is cut into blocks.

Splitting tree. The blocks of all sources are balls in an urn. The root splits
them into two halves by drawing without replacement (a seeded random order of
the balls, first half to the left: a multivariate hypergeometric draw of the
sources' quotas), each half is split again, down to one leaf for each output
shard. That gives the exact number of blocks of each source in each shard. The
source's blocks, in another seeded order, are then dealt to the shards by
those numbers, so shards hold disjoint blocks. Inside a shard rows are
ordered by a seeded key.

The number of blocks is a parameter, so the tree is a small table at any input
size. Ranks and prefix sums over documents are found in two levels
(``native.running``), so a hot source is not one task.

Edge cases: null text has no words; null sources are one source, last in
order; null ids are ordinary rows; repeated rows are drawn on their own, each
at most twice; sources without words have target 0; an empty table gives an
empty result; further columns are ignored (``mixed_rows`` carries them all
and replaces columns named ``shard``, ``block`` or ``mix_key``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskforge.llm.common import cut, small_side, text_or_empty
from riskforge.llm.native import hash_bucket, n_buckets, running, seeded_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
SHARDS = 8
BLOCKS = 64  # blocks of words in each shard, on average
SEED = "mix"
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame) -> DataFrame:
    """(s_key, source, total) of every source -> with idx, weight, target."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("idx", F.row_number().over(order) - F.lit(1))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("idx") % F.lit(len(WEIGHTS)) + F.lit(1)).cast("int"))
    caps = ranked.withColumn("weight", weight).withColumn("cap", F.col("total") * F.lit(LIMIT))
    level = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("idx"))
    upto = level.rowsBetween(W.unboundedPreceding, -1)
    rest = level.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    levels = caps.withColumn(
        "level",
        (F.sum("total").over(everything) * F.lit(SHARE) - F.coalesce(F.sum("cap").over(upto), F.lit(0)))
        / F.sum("weight").over(rest),
    )
    # the first level that its own source's cap does not cut holds for all after it
    held = levels.withColumn(
        "height",
        F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "idx", "level")))
        .over(everything)
        .getField("level"),
    )
    share = F.col("height") * F.col("weight")
    target = F.when(F.col("height").isNull() | (share > F.col("cap")), F.col("cap").cast("double")).otherwise(share)
    return held.select("s_key", "source", "total", "idx", "weight", target.alias("target"))


def _drawn(docs: DataFrame, seed: str, keep: tuple[str, ...]) -> tuple[DataFrame, int]:
    """One row per document with ``copies`` (0..2), its place in the source's
    word sequence, and its source's target; and the number of documents."""
    base = cut(
        docs.select(
            F.col("doc_id"),
            *[F.col(c) for c in keep],
            F.col("source").alias("m_source"),
            F.regexp_count(text_or_empty(), F.lit(WORDS)).cast("long").alias("m_size"),
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("s_key"),
            seeded_key(seed, "doc_id").alias("m_hash"),
        ).withColumn("m_row", F.monotonically_increasing_id())
    )
    rows = base.count()
    placed = running(
        base.withColumn("m_bucket", hash_bucket("m_hash", n_buckets(rows))),
        "s_key",
        "m_bucket",
        ["m_hash", "doc_id", "m_size", "m_row"],
        "m_size",
    )
    targets = cut(
        source_targets(base.groupBy("s_key").agg(F.first("m_source").alias("source"), F.sum("m_size").alias("total")))
    )
    sources = targets.count()
    first = F.col("before") * F.lit(2) + F.col("m_size")  # twice the middle of the first copy
    taken = cut(
        placed.drop("total")
        .join(small_side(targets.select("s_key", "total", "target"), sources), "s_key")
        .withColumn("twice", F.col("target") * F.lit(2.0))
        .withColumn(
            "copies",
            F.when(F.col("m_size") == 0, 0)
            .otherwise((first < F.col("twice")).cast("int") + (first + F.col("total") * F.lit(2) < F.col("twice")).cast("int")),
        )
        .drop("twice", "n_group", "rn")
    )
    gaps = taken.groupBy("s_key").agg(
        (F.first("target") - F.sum(F.col("m_size") * F.col("copies"))).alias("gap")
    )
    near = taken.join(small_side(gaps, sources), "s_key")
    miss = F.abs(F.abs(F.col("gap")) - F.col("m_size"))
    fits = (F.col("m_size") > 0) & F.when(F.col("gap") > 0, F.col("copies") < LIMIT).otherwise(F.col("copies") > 0)
    fix = (
        near.filter(fits & (miss < F.abs(F.col("gap"))))
        .groupBy("s_key")
        .agg(
            F.min(F.struct(miss, "m_hash", "doc_id", "m_size", "m_row")).getField("m_row").alias("f_row"),
            F.first(F.signum("gap").cast("int")).alias("f_step"),
        )
    )
    out = (
        taken.join(small_side(fix, sources), "s_key", "left")
        .withColumn("copies", F.col("copies") + F.when(F.col("m_row") == F.col("f_row"), F.col("f_step")).otherwise(0))
        .drop("f_row", "f_step")
    )
    return cut(out), rows


def block_shards(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """(s_key, blocks) -> (s_key, block, shard) by the splitting tree."""

    def draw(*parts: Column | str) -> Column:
        cols = [F.col(p).cast("string") if isinstance(p, str) else p for p in parts]
        return F.md5(F.concat_ws("|", F.lit(seed), *cols).cast("binary"))

    balls = quotas.select("s_key", F.explode(F.sequence(F.lit(0), F.col("blocks") - F.lit(1))).alias("ball")).withColumns(
        {"low": F.lit(0), "high": F.lit(shards)}
    )
    for level in range(math.ceil(math.log2(shards))):
        node = W.partitionBy("low", "high")
        mid = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        # a node splits its balls in the proportion of the shards on each side
        left = F.round(F.count(F.lit(1)).over(node) * (mid - F.col("low")) / (F.col("high") - F.col("low")))
        goes_left = F.row_number().over(node.orderBy(draw(F.lit(f"node{level}"), "low", "s_key", "ball"), "s_key", "ball")) <= left
        leaf = F.col("high") - F.col("low") == 1
        balls = balls.withColumns(
            {
                "low": F.when(leaf | goes_left, F.col("low")).otherwise(mid),
                "high": F.when(leaf | ~goes_left, F.col("high")).otherwise(mid),
            }
        )
    # the source's quotas in shard order, against its blocks in a seeded order
    by_shard = W.partitionBy("s_key").orderBy("low", "ball")
    by_block = W.partitionBy("s_key").orderBy(draw(F.lit("block"), "s_key", "ball"), "ball")
    quota = balls.select("s_key", F.col("low").alias("shard"), F.row_number().over(by_shard).alias("place"))
    order = balls.select("s_key", F.col("ball").alias("block"), F.row_number().over(by_block).alias("place"))
    return order.join(quota, ["s_key", "place"]).select("s_key", "block", "shard")


def mix_documents(
    docs: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, seed: str = SEED, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and
    ``draws``, an array of (shard, block, mix_key), one for each copy drawn."""
    drawn, _ = _drawn(docs, seed, keep)
    words = drawn.agg(F.sum(F.col("m_size") * F.col("copies"))).first()[0] or 0
    step = max(1, math.ceil(words / (shards * blocks)))
    at = lambda copy: F.floor((F.col("before") + F.col("total") * F.lit(copy)) / F.lit(step)).cast("int")
    copies = drawn.withColumn(
        "copy", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - F.lit(1))))
    ).withColumn("block", F.when(F.col("copy") == 0, at(0)).otherwise(F.when(F.col("copy") == 1, at(1))))
    quotas = copies.groupBy("s_key").agg((F.max("block") + F.lit(1)).alias("blocks")).filter("blocks > 0")
    quotas = cut(quotas)
    n_places = quotas.agg(F.sum("blocks")).first()[0] or 0  # about shards * blocks, and one more for each source
    dealt = copies.join(small_side(block_shards(quotas, shards, seed), n_places), ["s_key", "block"], "left")
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.col("m_hash"), F.col("copy").cast("string")).cast("binary"))
    return (
        dealt.withColumn("draw", F.when(F.col("shard").isNotNull(), F.struct("shard", "block", key.alias("mix_key"))))
        .groupBy("m_row")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", *keep)],
            F.first("m_size").alias("size"),
            F.first("total").alias("source_size"),
            F.first("target").alias("target"),
            F.count("draw").alias("n_draws"),
            F.sort_array(F.collect_list("draw")).alias("draws"),
        )
        .withColumn("taken", F.col("size") * F.col("n_draws"))
        .drop("m_row", "n_draws")
    )


def mixed_rows(docs: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, seed: str = SEED) -> DataFrame:
    """The mix itself: every drawn copy as a row of ``docs`` with its shard,
    block and place in the shard's order (``mix_key``).

    The draws are made on narrow rows; the documents are shuffled once, to meet
    theirs by doc_id and the md5 of the text. Rows that share both are told
    apart by a number."""
    plain = docs.select([c for c in docs.columns if c not in ("shard", "block", "mix_key")])
    key = F.md5(text_or_empty().cast("binary"))
    narrow = plain.select("doc_id", "text", "source", key.alias("m_t"))
    drawn = cut(mix_documents(narrow, shards, blocks, seed, ("m_t",)).select("doc_id", "m_t", "draws"))
    named = plain.withColumn("m_t", key)
    on = named["m_t"] == F.col("d_t")
    if drawn.groupBy("doc_id", "m_t").count().filter("count > 1").limit(1).count():
        number = lambda *order: F.row_number().over(W.partitionBy("doc_id", "m_t").orderBy(*order))
        drawn = drawn.withColumn("d_n", number("draws"))
        others = [c for c in plain.columns if c not in ("doc_id", "text")]
        named = named.withColumn("m_n", number(F.xxhash64(*others)) if others else number("m_t"))
        on = (named["m_t"] == F.col("d_t")) & (named["m_n"] == F.col("d_n"))
    else:
        drawn = drawn.withColumn("d_n", F.lit(1))
    drawn = drawn.filter(F.size("draws") > 0).select(F.col("doc_id").alias("d_id"), F.col("m_t").alias("d_t"), "d_n", "draws")
    met = named.join(drawn, on & named["doc_id"].eqNullSafe(F.col("d_id")))
    return met.withColumn("draw", F.explode("draws")).select(*[named[c] for c in plain.columns], "draw.shard", "draw.block", "draw.mix_key")


def in_order(mix: DataFrame) -> DataFrame:
    """A mix as it is written: blocks of a shard together, in seeded order."""
    return mix.repartition("shard", "block").sortWithinPartitions("shard", "block", "mix_key")


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query, and the shards of the copies."""
    return mix_documents(docs).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.concat_ws(",", F.transform("draws", lambda d: d["shard"].cast("string"))).alias("shards"),
    )
