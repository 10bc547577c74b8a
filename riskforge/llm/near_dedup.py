"""Near duplicates by DartMinHash signatures and banded joining (operator 6).

Similarity: weighted Jaccard of the counted shingles of five words
(``dart_minhash``), 0.8 or more. A class is a connected component of the links
between texts; every document gets its class.

1. Equal texts are one item (md5 of the text). Each distinct text gets a
   signature of 32 bands of 5 darts; two texts of similarity 0.8 share no band
   with a chance of 3 in a million.
2. A band key held by several texts is a bucket. Every member is compared with
   the bucket's least member; linked texts get the label of their least
   neighbour or its least neighbour (two texts of one label are in one class).
3. A bucket that still holds several labels gets all its pairs across
   labels that their parity bitmaps (odd sketches) do not rule out: two
   texts have no fewer unshared shingles than their bitmaps have different
   bits, so nothing similar is lost and few others are left. Each pair is
   formed once, in the first band that its texts share. A
   bucket of more than ``WIDE`` members is dealt into blocks of about that many
   and block meets block, each two in a group of their own: every pair is
   formed, in tasks of bounded size. A label of more than ``WIDE`` members has
   its own blocks, which do not meet each other; homogeneous groups of copies,
   however large, are gone by then, as they have one label after step 2.
4. Every candidate pair is compared exactly on its whole shingle sets (32 bits
   of each shingle's hash); the links' components are the classes.

Pairs of copies are never expanded, nor are the pairs of a group of near
copies: a group costs its size, not its square. Hot buckets are pre-aggregated
before the shuffle and joined back with sort-merge joins that adaptive
execution can split.

Edge cases: null text is an empty text; texts without words are alike only if
they are equal; null or repeated doc_ids and repeated rows are rows on their
own, in the class of their text; an empty table gives an empty result; further
columns are ignored by ``classes`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import spread, stored, text_or_empty
from riskforge.llm.components import components, near_labels
from riskforge.llm.dart_minhash import BANDS, BATCH, bands, odd_sketches, shingles, signatures, similarity
from riskforge.llm.words import buffer, groups

THRESHOLD = 0.8
WIDE = 1024
CHUNK = 1 << 21


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts of bounded size and number, with their shingles."""
    data, at = buffer(column)
    for lo, hi in groups(np.diff(at), CHUNK):
        for a in range(lo, hi, BATCH):
            b = min(hi, a + BATCH)
            yield a, b, *shingles(data[at[a] : at[b]], at[a : b + 1] - at[a])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, values, begin in _parts(batch.column("text")):
            n = np.diff(begin)
            keys = bands(signatures(values, begin))
            flat = pa.array(keys[n > 0].ravel())
            at = np.concatenate([[0], np.cumsum((n > 0) * BANDS)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("t").slice(a, b - a), pa.array(n), pa.ListArray.from_arrays(pa.array(at), flat)], ["t", "n", "bands"]
            )


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, values, begin in _parts(batch.column("text")):
            short = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(short))
            words, first = odd_sketches(values, begin)
            odd = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), sets, odd], ["id", "shingles", "odd"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        sim = [similarity(x[i].values.to_numpy(), y[i].values.to_numpy()) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim, pa.float64())], ["a", "b", "sim"])


def _sets(ids: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, shingles, odd sketch) of these texts, read from one document of each."""
    chosen = texts.join(ids, "id").select("id", "t", "doc_id")
    found = chosen.join(docs, (docs.t == chosen.t) & docs.doc_id.eqNullSafe(chosen.doc_id)).select("id", "text")
    return stored(found.mapInArrow(_shingle_sets, "id bigint, shingles array<int>, odd array<bigint>").dropDuplicates(["id"]), "near")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of text numbers -> those whose texts are similar."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a"
    )
    return stored(both.select("a", "b", "x", "y").mapInArrow(_compare, "a bigint, b bigint, sim double").filter(F.col("sim") >= THRESHOLD), "near")


def _close(x: str, y: str):
    """Shingle counts that allow the threshold."""
    return F.least(x, y) >= F.greatest(x, y) * THRESHOLD


def _mixed(members: DataFrame, keys: list[str]) -> DataFrame:
    """Members of the buckets that hold more than one label, with the size."""
    held = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("l0"), F.max("label").alias("l1"))
    return members.join(held.filter("l0 != l1").drop("l0", "l1"), keys)


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, t (md5 of the text), class_id (least doc_id
    of the class), class_size (documents) and n_links (links of its text to
    other texts that were compared and found similar)."""
    texts_of = docs.select("doc_id", text_or_empty().alias("text")).withColumn("t", F.md5(F.col("text").cast("binary")))
    signed = spread(texts_of.select("t", "text")).mapInArrow(_sign, "t string, n bigint, bands array<bigint>")
    own = texts_of.select("t", "doc_id").groupBy("t").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    texts = stored(
        signed.dropDuplicates(["t"]).join(own, "t").withColumn("id", F.monotonically_increasing_id()),
        "near",
    )
    members = texts.select("id", "n", F.posexplode("bands").alias("band", "key"))
    firsts = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("id", "n")).alias("f")).filter("size > 1")
    shared = stored(
        members.join(firsts, "key").select("band", "key", "id", "n", F.col("f.id").alias("first"), F.col("f.n").alias("n_first")),
        "near",
    )
    sets = _sets(shared.select("id").distinct(), texts, texts_of)
    near = shared.filter((F.col("id") != F.col("first")) & _close("n", "n_first"))
    tested = stored(near.select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "near")
    links = _links(tested, sets)

    # buckets that hold several groups after this: all pairs across them
    label = near_labels(links)
    labelled = shared.select("band", "key", "id", "n").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    left = stored(_mixed(labelled, ["band", "key"]).join(texts.select("id", "bands"), "id").join(sets.select("id", "odd"), "id"), "near")
    more = _across(left.filter(F.col("size") <= WIDE))
    wide = left.filter(F.col("size") > WIDE).drop("size")
    if wide.limit(1).count():
        more = more.unionByName(_across_blocks(wide))
    links = stored(links.unionByName(_links(more.join(tested, ["a", "b"], "left_anti"), sets)), "near")

    label = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    placed = stored(
        texts.select("id", "t", "doc_id", "copies")
        .join(label, "id", "left")
        .join(degree, "id", "left")
        .withColumn("label", F.coalesce("label", "id")),
        "near",
    )
    groups_ = placed.groupBy("label").agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.sum("copies").alias("class_size"))
    of_text = placed.join(groups_, "label").select(
        "t", F.col("rep.doc_id").alias("class_id"), F.col("rep.t").alias("class_t"), "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return texts_of.select("doc_id", "t").join(of_text, "t")


def _across(members: DataFrame) -> DataFrame:
    """Pairs (a, b) across labels of a bucket, where it is the first that both share."""
    on = ["band", "key"]
    a = members.select(*on, F.col("id").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("bands").alias("xs"), F.col("odd").alias("xo"))
    b = members.select(*on, F.col("id").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("bands").alias("ys"), F.col("odd").alias("yo"))
    same = F.zip_with("xs", "ys", lambda x, y: x == y)
    first = F.array_position(same, True) == F.col("band") + 1
    apart = F.col("la") != F.col("lb")
    pairs = a.join(b, on).filter((F.col("a") < F.col("b")) & apart & _close("na", "nb") & first & _may_be_similar())
    return pairs.select("a", "b")


def _across_blocks(members: DataFrame) -> DataFrame:
    """The pairs of ``_across`` for buckets of any size: members are dealt to
    blocks of about ``WIDE``, and every two blocks of a bucket that can hold
    different labels are a group of their own."""
    bucket = ["band", "key"]
    held = members.groupBy(*bucket, "label").agg(F.count(F.lit(1)).alias("c"))
    # a label of many members has blocks of its own, the others share theirs
    owned = stored(held.withColumn("owner", F.when(F.col("c") > WIDE, F.col("label")).otherwise(-1)), "near")
    parts = stored(owned.groupBy(*bucket, "owner").agg(F.ceil(F.sum("c") / WIDE).cast("int").alias("parts")), "near")
    placed = (
        members.join(owned.drop("c"), [*bucket, "label"])
        .join(parts, [*bucket, "owner"])
        .withColumn("block", F.struct("owner", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")))
    )
    blocks = parts.select(*bucket, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "owner")
    one = blocks.select(*bucket, F.struct("owner", "part").alias("x"))
    other = blocks.select(*bucket, F.struct("owner", "part").alias("y"))
    alone = (F.col("x.owner") == F.col("y.owner")) & (F.col("x.owner") >= 0)
    met = stored(one.join(other, bucket).filter((F.col("x") <= F.col("y")) & ~alone), "near")
    columns = [*bucket, "x", "y", "id", "n", "label", "bands", "odd"]
    left = placed.withColumnRenamed("block", "x").join(met, [*bucket, "x"]).select(*columns, F.lit(0).alias("side"))
    right = placed.withColumnRenamed("block", "y").join(met.filter("x != y"), [*bucket, "y"]).select(*columns, F.lit(1).alias("side"))
    flat = [F.col("x.owner").alias("xo"), F.col("x.part").alias("xp"), F.col("y.owner").alias("yo"), F.col("y.part").alias("yp")]
    both = left.unionByName(right).select(*flat, *[c for c in columns if c not in ("x", "y")], "side")
    return both.groupBy(*bucket, "xo", "xp", "yo", "yp").applyInArrow(_block_pairs, "a bigint, b bigint")


def _block_pairs(table: pa.Table) -> pa.Table:
    """Pairs of the members of side 0 with those of side 1, or of side 0 among
    themselves, by the conditions of ``_across``."""
    side, band = table["side"].to_numpy(), table["band"][0].as_py()
    ids, n, label = (table[c].to_numpy() for c in ("id", "n", "label"))
    keys = pa.compute.list_flatten(table["bands"]).to_numpy().reshape(len(ids), BANDS)
    words = pa.compute.list_value_length(table["odd"]).to_numpy()
    flat, first = pa.compute.list_flatten(table["odd"]).to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(words)])
    rows, others = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    within = all(table[x][0] == table[y][0] for x, y in (("xo", "yo"), ("xp", "yp")))
    if within:
        others = rows
    bitmaps: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for w in np.unique(words):  # bitmaps of one size, and where each member's is
        at = np.flatnonzero(words == w)
        place = np.zeros(len(ids), np.int64)
        place[at] = np.arange(len(at))
        bitmaps[int(w)] = flat[first[at][:, None] + np.arange(w)], place

    def folded(of: np.ndarray, w: int, to: int) -> np.ndarray:
        bits = bitmaps[w][0][bitmaps[w][1][of]]
        while w > to:
            w //= 2
            bits = bits[:, :w] ^ bits[:, w:]
        return bits

    out_a, out_b = [], []
    for lo in range(0, len(rows), 64):
        mine = rows[lo : lo + 64]
        fits = label[mine][:, None] != label[others]
        fits &= np.minimum(n[mine][:, None], n[others]) >= np.maximum(n[mine][:, None], n[others]) * THRESHOLD
        if within:
            fits &= ids[mine][:, None] < ids[others]
        for k in range(band):  # met in an earlier band
            fits &= keys[mine, k][:, None] != keys[others, k]
        i, j = np.nonzero(fits)
        i, j = mine[i], others[j]
        most = (n[i] + n[j]) * ((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-6
        near = np.zeros(len(i), bool)
        for p in bitmaps:
            for q in bitmaps:
                some = np.flatnonzero((words[i] == p) & (words[j] == q))
                to, step = min(p, q), max(1, CHUNK // 8 // max(p, q))
                for s in range(0, len(some), step):
                    at = some[s : s + step]
                    unlike = np.bitwise_count(folded(i[at], p, to) ^ folded(j[at], q, to)).sum(axis=1, dtype=np.int64)
                    near[at] = unlike <= most[at]
        out_a.append(np.minimum(ids[i[near]], ids[j[near]]))
        out_b.append(np.maximum(ids[i[near]], ids[j[near]]))
    joined = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (out_a, out_b)]
    return pa.Table.from_arrays(joined, ["a", "b"])


def _may_be_similar():
    """Bitmaps xo, yo of sets of na, nb shingles allow the threshold. Sets of
    similarity s leave (1 - s) / (1 + s) of all their shingles unshared."""

    def half(x):
        h = F.floor(F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), h), F.slice(x, h + 1, h), lambda p, q: p.bitwiseXOR(q))

    def apart(x, y):
        bits = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        return F.aggregate(bits, F.lit(0), lambda total, n: total + n)

    x, y = F.col("xo"), F.col("yo")
    found = (
        F.when(F.size(x) == F.size(y), apart(x, y)).when(F.size(x) > F.size(y), apart(half(x), y)).otherwise(apart(x, half(y)))
    )
    return found <= (F.col("na") + F.col("nb")) * ((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-6


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("t") == F.col("class_t"))
    return classes(docs).select("doc_id", "class_id", "class_size", "n_links", kept.alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents, one row of each class: the least doc_id's."""
    found = classes(docs)
    reps = stored(found.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("t") == F.col("class_t"))).select("doc_id", "t"), "near")
    repeated = reps.groupBy("doc_id", "t").count().filter("count > 1").limit(1).count()
    named = docs.withColumn("__t", F.md5(text_or_empty().cast("binary")))
    kept = reps.select(F.col("doc_id").alias("__kept_id"), F.col("t").alias("__kept_t"))
    out = named.join(kept, (F.col("__t") == F.col("__kept_t")) & F.col("doc_id").eqNullSafe(F.col("__kept_id")), "left_semi")
    if repeated:  # repeated rows: the same text under the same doc_id
        out = out.dropDuplicates(["doc_id", "__t"])
    return out.drop("__t")
