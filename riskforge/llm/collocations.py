"""Collocations by Toivonen's mining of frequent phrases (operator 11).

Words and pieces: A-Z become a-z, texts are cut to pieces at ``[.,;:!?\\x0A-\\x0D]``
and those to words at spaces and tabs. Everything is counted for each language.

1. A sample (``SHARE`` of the documents, drawn by hash) is counted; the words
   and pairs found there at a lowered threshold are proposed.
2. A full pass counts the proposed phrases and their negative border exactly:
   all words, every pair of two proposed words, every triple of two proposed
   pairs. Phrases of ``LEAST`` occurrences or more are frequent.
3. A frequent word or pair that was not proposed is a failure of the border:
   phrases that contain it were not counted. It joins the proposals, and a
   further pass counts the phrases that they and their border gain, until no
   pass finds a failure. All parts of a frequent phrase are frequent, so then
   every frequent phrase has been counted, each in one pass, and exactly.

Proposals go to the tasks as two Bloom filters of ``BITS`` bits each, whatever
their number. A false member only has a phrase counted that need not be. Each
task counts its chunks in numpy, Spark adds up. A word is known by 64 bits of
hash of language and word (two words share them with a chance of 1 in 10^19).

Score of a phrase of ``a`` occurrences cut to parts of ``l`` and ``r``:
floor(1000000 a a / (l r)) in decimal arithmetic, exact for counts below 10^15.
The least cut counts, the first of equal ones. A pair inside a frequent triple
of at least half its occurrences is dropped. The first ``TOP`` of each language
by score, occurrences and phrase are returned; only rows within that rank reach
the task of a language.

Edge cases: a null or empty text has no words; a null language is ``und`` and
one with a language of that name; repeated rows count each; words of any length
are whole; an empty table or one without frequent phrases gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskforge.llm.common import arrow_rows, spread, stored, text_or_empty
from riskforge.llm.words import buffer, find, groups, mix64, ordered_ids

LEAST = 10
TOP = 2000
SHARE = 8  # one document in so many is sampled
BITS = 1 << 25
CHUNK = 1 << 20
TEXTS = 1000  # of a batch that comes from Spark
ROWS = 1 << 15  # of a batch that goes back to Spark

_LOWER = np.arange(256, dtype=np.uint16)
_LOWER[65:91] += 32
_READ = _LOWER + np.uint16(1)
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_KINDS = (~_BREAK).astype(np.uint8)
_KINDS[[0x20, 0x09]] = 0
_COUNTS = "w1 bigint, w2 bigint, w3 bigint, lang string, word string, n bigint"
_KEYS = ["w1", "w2", "w3", "lang", "word"]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a pair of words."""
    return mix64(mix64(a) + b)


def _spots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(hashes)
    return (x % np.uint64(bits)).astype(np.int64), ((x >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)


def _member(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the Bloom filter (64-bit words) holds."""
    out = np.ones(len(hashes), bool)
    for spot in _spots(hashes, 64 * len(filter_)):
        out &= (filter_[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    sizes = end - begin
    ends = np.cumsum(sizes)
    at = np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    raw = _LOWER[data[at]].astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(raw)).cast(pa.string())


def _rows(n: np.ndarray, w: tuple = (), lang: pa.Array | None = None, word: pa.Array | None = None) -> pa.RecordBatch:
    columns = [pa.array(x.view(np.int64)) for x in w] + [pa.nulls(len(n), pa.int64())] * (3 - len(w))
    texts = [pa.nulls(len(n), pa.string()) if x is None else x for x in (lang, word)]
    return pa.RecordBatch.from_arrays([*columns, *texts, pa.array(n.astype(np.int64))], [*_KEYS, "n"])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of one of each distinct value, and how often it is there."""
    _, first, n = np.unique(keys, return_index=True, return_counts=True)
    return first, n


class Chunk:
    """Words of some texts: a number for each distinct (language, word)."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        self.data, at = buffer(texts)
        hashes, self.begin, self.end, first = find(self.data, at, _READ, _KINDS)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        names = np.array([xxhash.xxh64_intdigest(x) for x in coded.dictionary.to_pylist()], np.uint64)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.lang = coded.indices.to_numpy()[doc]
        self.values, self.ids = ordered_ids(mix64(hashes ^ names[self.lang]))
        piece = np.cumsum(_BREAK[self.data], dtype=np.int32)[self.begin] if len(doc) else doc
        self.next = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])  # a word and the one after it lie in one piece

    def words(self) -> Iterator[pa.RecordBatch]:
        """Counts of all words, and of each language's words."""
        example = np.empty(len(self.values), np.int64)
        example[self.ids] = np.arange(len(self.ids))
        n = np.bincount(self.ids, minlength=len(self.values))
        lang = self.langs.take(pa.array(self.lang[example]))
        yield _rows(n, (self.values,), lang, _strings(self.data, self.begin[example], self.end[example]))
        yield _rows(np.bincount(self.lang, minlength=len(self.langs)), (), self.langs)

    def _allowed(self, words: np.ndarray | None) -> np.ndarray:
        """Places of pairs of two words that the filter holds (None: all)."""
        if words is None:
            return self.next
        some = _member(words, self.values)[self.ids]
        return self.next & some[1:] & some[:-1]

    def pairs(self, words: np.ndarray | None, before: np.ndarray | None) -> pa.RecordBatch:
        """Counts of the pairs that ``words`` allows and ``before`` did not."""
        at = self._allowed(words)
        if before is not None:
            at &= ~self._allowed(before)
        at = np.flatnonzero(at)
        first, n = _counted(self.ids[at] * len(self.values) + self.ids[at + 1])
        return _rows(n, (self.values[self.ids[at[first]]], self.values[self.ids[at[first] + 1]]))

    def triples(self, pairs: np.ndarray, before: np.ndarray | None) -> pa.RecordBatch:
        """The same for triples and filters of pairs."""
        at = np.flatnonzero(self.next)
        keys, which = np.unique(self.ids[at] * len(self.values) + self.ids[at + 1], return_inverse=True)
        hashes = _pair(self.values[keys // max(1, len(self.values))], self.values[keys % max(1, len(self.values))])
        number = np.full(len(self.next) + 1, -1)
        number[at] = which

        def both(held: np.ndarray) -> np.ndarray:
            some = np.zeros(len(number), bool)
            some[at] = _member(held, hashes)[which]
            return some[:-1] & some[1:]

        ok = both(pairs)
        if before is not None:
            ok &= ~both(before)
        at = np.flatnonzero(ok)
        first, n = _counted(number[at] * len(self.values) + self.ids[at + 2])
        at = at[first]
        return _rows(n, tuple(self.values[self.ids[at + k]] for k in range(3)))


def _count(docs: DataFrame, now=None, before=None) -> DataFrame:
    """One pass: sums over the corpus of what ``now`` allows and ``before`` did not.
    Without ``now``, all words and pairs (for the sample)."""

    def counted(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        words, pairs = now.value if now else (None, None)
        words0, pairs0 = before.value if before else (None, None)
        if before is None:
            yield from chunk.words()
        yield chunk.pairs(words, words0)
        if now:
            yield chunk.triples(pairs, pairs0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang")
            sizes = pc.binary_length(texts).to_numpy()
            for a, b in groups(sizes, CHUNK):
                chunk = Chunk(texts.slice(a, b - a), langs.slice(a, b - a))
                if len(chunk.ids):
                    for found in counted(chunk):
                        for low in range(0, found.num_rows, ROWS):
                            yield found.slice(low, ROWS)

    return spread(docs).mapInArrow(run, _COUNTS).groupBy(*_KEYS).agg(F.sum("n").alias("n"))


def _filters(frequent: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bloom filters of the words and of the pairs among these phrases. Only their
    bits reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w1 = batch.column("w1").to_numpy().view(np.uint64)
            single = pc.is_null(batch.column("w2")).to_numpy(zero_copy_only=False)
            w2 = pc.fill_null(batch.column("w2"), 0).to_numpy().view(np.uint64)
            hashes = np.where(single, w1, _pair(w1, w2))
            for kind, own in ((0, hashes[single]), (1, hashes[~single])):
                spot = np.unique(np.concatenate(_spots(own, bits)))
                at = np.flatnonzero(np.append(True, spot[1:] >> 6 != spot[:-1] >> 6)) if len(spot) else spot
                word = np.bitwise_or.reduceat(np.uint64(1) << (spot & 63).astype(np.uint64), at) if len(spot) else spot.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), kind)), pa.array(spot[at] >> 6), pa.array(word.view(np.int64))], ["kind", "spot", "bits"]
                )

    parts = frequent.select("w1", "w2").mapInArrow(run, "kind bigint, spot bigint, bits bigint")
    merged = parts.groupBy("kind", "spot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((2, bits // 64), np.uint64)
    out[merged["kind"].to_numpy(), merged["spot"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)
    return out[0], out[1]


def mine(docs: DataFrame, least: int = LEAST, share: int = SHARE, bits: int = BITS) -> DataFrame:
    """Exact counts of all frequent words, pairs and triples: w1, w2, w3 (null
    where the phrase is shorter), lang and word (of words), n; and for each
    language a row without w1, with the number of all its words."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    keyed = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"), "doc_id")
    sample = keyed.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0).select("lang", "text")
    lowered = max(2, 3 * least // (4 * share))
    with arrow_rows(docs.sparkSession, TEXTS):
        now = _filters(_count(sample).filter((F.col("n") >= lowered) & F.col("w1").isNotNull()), bits)
    before, found = None, None
    while True:
        sent = context.broadcast(now)
        with arrow_rows(docs.sparkSession, TEXTS):
            counts = stored(_count(rows, sent, before).filter((F.col("n") >= least) | F.col("w1").isNull()), "phrases")
        found = counts if found is None else found.unionByName(counts)
        gained = _filters(counts.filter("w1 is not null and w3 is null"), bits)
        after = tuple(a | b for a, b in zip(now, gained))
        if all((a == b).all() for a, b in zip(now, after)):
            return found
        now, before = after, sent


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    found = mine(docs, least, share, bits)
    totals = found.filter("w1 is null").groupBy("lang").agg(F.sum("n").alias("n"))
    words = found.filter("word is not null").select("w1", "lang", "word", "n")
    two = found.filter("w2 is not null and w3 is null").select("w1", "w2", F.col("n").alias("a"))
    three = found.filter("w3 is not null").select("w1", "w2", "w3", F.col("n").alias("a"))

    of_word = lambda w, n: words.select(F.col("w1").alias(w), F.col("n").alias(n))
    of_pair = lambda x, y, n: two.select(F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(n))
    inside = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = inside.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    kept = two.join(longest, ["w1", "w2"], "left").filter(F.coalesce(100 * F.col("longer") < 50 * F.col("a"), F.lit(True))).drop("longer")

    score = "cast(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000 div (cast({l} as decimal(15,0)) * cast({r} as decimal(15,0))) as bigint)"
    pairs = kept.join(of_word("w1", "l"), "w1").join(of_word("w2", "r"), "w2")
    pairs = pairs.select("w1", "w2", F.lit(None).cast("bigint").alias("w3"), "a", "l", "r", F.expr(score.format(l="l", r="r")).alias("score"))
    cuts = three.join(of_pair("w1", "w2", "l2"), ["w1", "w2"]).join(of_pair("w2", "w3", "r1"), ["w2", "w3"])
    cuts = cuts.join(of_word("w1", "l1"), "w1").join(of_word("w3", "r2"), "w3")
    cuts = cuts.withColumn("s1", F.expr(score.format(l="l1", r="r1"))).withColumn("s2", F.expr(score.format(l="l2", r="r2")))
    pick = lambda x, y: F.when(F.col("s1") <= F.col("s2"), F.col(x)).otherwise(F.col(y))
    triples = cuts.select("w1", "w2", "w3", "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), F.least("s1", "s2").alias("score"))

    named = lambda w, name: words.select(F.col("w1").alias(w), F.col("word").alias(name))
    both = pairs.unionByName(triples).join(words.select("w1", "lang", F.col("word").alias("x")), "w1")
    order = [F.desc("score"), F.desc("a")]
    near = both.withColumn("k", F.rank().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("k") <= top).drop("k")
    near = near.join(named("w2", "y"), "w2").join(named("w3", "z"), "w3", "left")
    near = near.withColumn("phrase", F.concat_ws(" ", "x", "y", "z"))
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase"))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    return collocations(docs)
