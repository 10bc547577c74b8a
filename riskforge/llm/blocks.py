"""Documents packed to blocks of bounded size, for operators that ask back.

A block is one row: the ids and whole texts (compressed) of some documents.
What a block has to know of the rest of the corpus is asked once for the
block, however many of its documents need it, so that a very common passage or
word is as many rows as there are blocks, not documents. Blocks are stored, so
their numbers stay the same when a task runs again.

Questions are merged in two steps, as common things are asked by every block:
blocks are dealt to sections of ``SECTION`` bytes of text, each section merges
its own blocks' questions in groups of about ``STRIPE`` bytes of text, and then
the sections' results are merged over the corpus. No group grows with the
number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import spread, stored, text_or_empty
from riskforge.llm.words import buffer, groups

#: Bytes of text of a block; a longer text is a block of its own.
BLOCK = 1 << 20
STRIPE = 1 << 22
SECTION = 1 << 32


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor()
    for batch in batches:
        data, at = buffer(batch.column("text"))
        ids = batch.column("doc_id")
        for a, b in groups(np.diff(at), BLOCK):
            doc_ids = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a))
            lengths = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(np.diff(at[a : b + 1])))
            body = press.compress(data[at[a] : at[b]])
            yield pa.RecordBatch.from_arrays(
                [doc_ids, lengths, pa.array([body]), pa.array([int(at[b] - at[a])], pa.int64())], ["doc_ids", "lengths", "body", "size"]
            )


def blocks(docs: DataFrame, name: str) -> DataFrame:
    """(block, doc_ids, lengths in bytes, body, size): every row of ``docs`` in
    one block; a null text is empty."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    packed = spread(rows).mapInArrow(_pack, "doc_ids array<bigint>, lengths array<bigint>, body binary, size bigint")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), name)


def texts_of(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a block as ``words.buffer`` gives them."""
    at = np.concatenate([[0], np.cumsum(batch.column("lengths")[row].values.to_numpy())])
    data = zstandard.ZstdDecompressor().decompress(batch.column("body")[row].as_py(), max_output_size=int(at[-1])) if at[-1] else b""
    return np.frombuffer(data, np.uint8), at


class Layout:
    """How a corpus of ``size`` bytes is dealt: sections, groups of a section,
    and stripes of the corpus. Groups and stripes are ranges of a 64-bit hash."""

    def __init__(self, size: int):
        self.sections = max(1, -(-size // SECTION))
        self.parts = max(1, -(-min(size, SECTION) // STRIPE))
        self.stripes = max(1, -(-size // STRIPE))


def range_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """The range, of ``n``, in which each hash lies; rises with it."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def lists(begin: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """Lists of the values that begin there."""
    return pa.ListArray.from_arrays(pa.array(np.append(begin, len(values)).astype(np.int32)), pa.array(values))


def flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and the number of the list of each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)
