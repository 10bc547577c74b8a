"""Alignment of the tokens of two tokenizers on one text (operator 13).

Tokenizer A is a byte-level BPE file of the tokenizers library and encodes a
space and the text; tokenizer B is a sentencepiece model that puts the space
itself. If both give the bytes of that text again, the byte offsets at which a
token of A and one of B end cut the tokens into groups.

Method: diagonal run skipping. With i tokens of A and j of B behind, the ends
from i and from j on are compared as slices at this shift; while they agree the
slice doubles, then it is halved, so a one-to-one stretch is jumped but for its
last few tokens. Where they part, the irregular group is walked token by token to
the next common end, and the shift is the new one. Many texts are aligned in a
row, as the last tokens of each end together.

Two tokens that end together are linked. Links are counted over the corpus for
each pair of ids: every block of documents (stored, see ``blocks``) asks once for
each distinct pair it holds. The pair table is bounded by the two vocabularies; it is
broadcast when it was counted to be small, and joined by shuffle otherwise.

Memory: a block is a row of some megabytes. Rows go to the Python functions in
batches of bounded bytes, a block is aligned slice by slice, and the row groups of
the stored blocks hold few of them, so that neither Spark's memory nor a worker's
grows with the rows of a split.

Edge cases: a text that is null or empty, or that a tokenizer does not give back
byte for byte, has no tokens: numbers 0 and an empty digest; strings of special
tokens are text; null or repeated doc_ids and repeated rows are rows on their
own; texts of any length are encoded whole; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.blocks import lists
from riskforge.llm.byte_bpe import SIGNS, encoder
from riskforge.llm.common import arrow_bytes, small_side, spread, stored, text_or_empty
from riskforge.llm.words import groups

#: Signs and texts of a block, a longer text is a block of its own; signs aligned in a row.
CHUNK = 1 << 19
TEXTS = 10_000
SLICE = 1 << 17
#: Bytes handed to a Python function at a time; blocks in a row group of the stored table.
BATCH = 1 << 22
ROW_GROUP = 8
#: Rows of the pair table (24 bytes each) up to which it is broadcast.
PAIRS = 1_000_000
_FIRST = 8  # tokens of a run's first slice


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Bytes:
    """The bytes of every token id, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.begin[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _digits(n: int) -> np.ndarray:
    """Every id below ``n`` in decimal, right-aligned, and room for a sign."""
    width = len(str(n))
    return np.frombuffer("".join(f"{i:>{width}} " for i in range(n)).replace(" ", "\0").encode(), np.uint8).reshape(n, width + 1)


class Tokenizers:
    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a = encoder(a, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        sign = {c: x for x, c in SIGNS.items()}
        n = max(self.a.library.get_vocab(True).values()) + 1
        entries = [self.a.library.id_to_token(i) or "" for i in range(n)]
        self.a_bytes = Bytes([bytes(sign[c] for c in t) if all(c in sign for c in t) else t.encode() for t in entries])
        m = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(m)]
        self.b_bytes = Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.a_digits, self.b_digits = _digits(n), _digits(m)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A of all texts in a row and the number of each text's; those of B."""
        a, n_a = self.a.encode([" " + t for t in texts])
        b = self.b.encode(texts, num_threads=1)
        n_b = np.array([len(x) for x in b], np.int64)
        return a.astype(np.int64), n_a, np.fromiter(chain.from_iterable(b), np.int64, n_b.sum()), n_b


@cache
def tokenizers(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


def align(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of A and of B that end together, in order. Both
    lists rise and end alike; a mark that differs is put behind each."""
    n, i, j = len(ends_a), 0, 0
    ends_a, ends_b = [*ends_a, -1], [*ends_b, -2]
    runs = []
    while i < n:
        x, y = ends_a[i], ends_b[j]
        while x != y:  # inside an irregular group
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        p, q = i + 1, j + 1
        if ends_a[p] == ends_b[q]:  # a stretch at the new shift
            width = _FIRST
            while ends_a[p : p + width] == ends_b[q : q + width]:
                p += width
                q += width
                width *= 2
            while width > _FIRST:  # it ends inside the last slice
                width //= 2
                if ends_a[p : p + width] == ends_b[q : q + width]:
                    p += width
                    q += width
            while ends_a[p] == ends_b[q]:
                p += 1
                q += 1
        runs += (i, j, p - i)
        i, j = p, q
    from_a, from_b, length = np.array(runs, np.int64).reshape(-1, 3).T
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(from_a, length) + within, np.repeat(from_b, length) + within


def _written(
    own: Tokenizers, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray
) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of each text, in a row, for the groups that end at
    these tokens, and where each text's begins and the last ends."""
    x, y = own.a_digits[a], own.b_digits[b]
    x[:, -1] = y[:, -1] = ord(",")
    x[at_a, -1] = ord("|")
    y[at_b, -1] = ord(";")
    y[np.cumsum(n_b)[n_b > 0] - 1, -1] = 0
    wide = max(x.shape[1], y.shape[1])
    out = np.zeros((len(a) + len(b), wide), np.uint8)
    end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    end_a[at_a] = end_b[at_b] = 1
    group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
    before_b = np.append(0, at_b[:-1] + 1)  # tokens of earlier groups
    out[np.arange(len(a)) + before_b[group_a], : x.shape[1]] = x
    out[np.arange(len(b)) + at_a[group_b] + 1, : y.shape[1]] = y
    signs = np.append(0, np.cumsum(np.count_nonzero(out, axis=1)))
    flat = out.ravel()
    return flat[flat != 0].tobytes(), signs[np.append(0, np.cumsum(n_a + n_b))]


def _given_back(own: Tokenizers, texts: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Flags of the texts, not empty, that both tokenizers give back byte for byte."""
    raw = [b" " + t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    sides = ((own.a_bytes, a, n_a), (own.b_bytes, b, n_b))
    good = sizes > 1
    for tokens, ids, n in sides:
        ends = np.append(0, np.cumsum(tokens.sizes[ids]))
        good &= np.diff(ends[np.append(0, np.cumsum(n))]) == sizes
    for tokens, ids, n in sides:
        rows = np.flatnonzero(good)
        whole = np.frombuffer(b"".join(raw[k] for k in rows.tolist()), np.uint8)
        differ = np.flatnonzero(tokens.of(ids[np.repeat(good, n)]) != whole)
        good[rows[np.searchsorted(np.cumsum(sizes[rows]), differ, "right")]] = False
    return good


def _aligned(own: Tokenizers, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """For each text the numbers of tokens of A, of B and of groups, and the
    digest; the linked pairs of ids of all texts in order."""
    a, n_a, b, n_b = own.encode(texts)
    good = _given_back(own, texts, a, n_a, b, n_b)
    a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
    if not len(a):
        return np.zeros((3, len(texts)), np.int64), [""] * len(texts), a
    at_a, at_b = align(np.cumsum(own.a_bytes.sizes[a]).tolist(), np.cumsum(own.b_bytes.sizes[b]).tolist())
    n_groups = np.diff(np.searchsorted(at_a, np.append(0, np.cumsum(n_a))))
    written, at = _written(own, a, n_a, b, n_b, at_a, at_b)
    digests = [hashlib.sha256(written[x:y]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
    return np.stack([n_a, n_b, n_groups]), digests, a[at_a] << 32 | b[at_b]


_BLOCK = "doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, digests array<string>, links array<int>, a array<int>, b array<int>, n array<bigint>"
_DOCS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """doc_ids and texts of each block, whatever the batches they come in."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if texts and (size + len(text) > CHUNK or len(texts) == TEXTS):
                yield doc_ids, texts
                doc_ids, texts, size = [], [], 0
            doc_ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield doc_ids, texts


def _encode(a_path: str, b_path: str):
    """Blocks of aligned documents: their links as places in the block's list of
    distinct pairs, and how often each pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(a_path, b_path)
        for doc_ids, texts in _chunks(batches):
            parts = [_aligned(own, texts[low:high]) for low, high in groups(np.array([len(t) for t in texts], np.int64), SLICE)]
            rows, digests, links = np.hstack([p[0] for p in parts]), [x for p in parts for x in p[1]], np.concatenate([p[2] for p in parts])
            pairs, which, n = np.unique(links, return_inverse=True, return_counts=True)
            whole = np.zeros(1, np.int64)
            columns = [pa.array([doc_ids], pa.list_(pa.int64()))]
            columns += [lists(whole, r) for r in rows]
            columns += [pa.array([digests], pa.list_(pa.string())), lists(whole, which.astype(np.int32))]
            columns += [lists(whole, (pairs >> 32).astype(np.int32)), lists(whole, (pairs & 0xFFFFFFFF).astype(np.int32)), lists(whole, n)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_ids", "n_a", "n_b", "n_groups", "digests", "links", "a", "b", "n"])

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch.column(c)[row].values
            groups_ = get("n_groups").to_numpy()
            links, size = get("links").to_numpy(), len(get("a"))
            total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
            told = get("told")
            if told is not None:
                place = told.field("place").to_numpy()
                total[place], best[place] = told.field("total").to_numpy(), told.field("best").to_numpy()
            ends = np.append(0, np.cumsum(groups_))
            sums = np.append(0, np.cumsum(total[links]))
            highest = np.append(0, np.cumsum((total == best)[links]))
            columns = [get("doc_ids"), get("n_a"), get("n_b"), get("n_groups"), pa.array(np.diff(ends))]
            columns += [pa.array(np.diff(highest[ends])), pa.array(np.diff(sums[ends])), get("digests")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def _blocks(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    found = spread(rows).mapInArrow(_encode(*paths), _BLOCK)
    with arrow_bytes(docs.sparkSession, BATCH):
        return stored(found.withColumn("block", F.monotonically_increasing_id()), "alignment", **{"parquet.block.row.count.limit": str(ROW_GROUP)})


def _pairs(packed: DataFrame) -> DataFrame:
    """(a, b, total): links of each pair of ids over the corpus."""
    each = packed.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
    return each.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.n").alias("total"))


def pair_counts(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """(a, b, total): how often tokens a and b end together in the corpus, a
    table from which ids of one vocabulary can be mapped to the other."""
    return _pairs(_blocks(docs, paths or default_tokenizers()))


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per document, the result columns of the registered query."""
    packed = _blocks(docs, paths or default_tokenizers())
    totals = stored(_pairs(packed), "pairs")
    table = totals.join(totals.groupBy("b").agg(F.max("total").alias("best")), "b")
    asked = packed.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("place", "p")).select("block", "place", "p.a", "p.b")
    told = asked.join(small_side(table, totals.count(), PAIRS), ["a", "b"])
    told = told.groupBy("block").agg(F.collect_list(F.struct("place", "total", "best")).alias("told"))  # the pairs of one block
    with arrow_bytes(docs.sparkSession, BATCH):
        return stored(packed.join(told, "block", "left").mapInArrow(_finish, _DOCS), "aligned")


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    return alignments(docs)
