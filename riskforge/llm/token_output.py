"""Token-ID output in seekable files, and its way back (operator 8).

Texts are encoded by a public tokenizer file (``byte_bpe``) and each document's
ids, with the end id, become one zstandard frame in the task that read it. Only
frames are shuffled: into ranges of ascending doc_id, each written as one
seekable file (``seekable``) in the shared folder. A file is written under a
passing name and then moved, its content depends on its rows only, so a task
that runs again writes the same file. The manifest (one row for each file)
gives every file's first place in the whole sequence of ids.

Paths: files are opened through pyarrow's file systems (local or mounted
folders, HDFS, S3, GCS), named by the URI of ``spark.checkpoint.dir`` or the
given folder.

Edge cases: a null text is empty and has the end id only; null doc_ids come
first, are kept as null and lie in the files like others; repeated doc_ids lie
next to each other, ordered by their ids' number and checksum; texts of any
length are one frame; an empty table gives no files and an empty result;
further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskforge.llm.byte_bpe import encoder
from riskforge.llm.common import cut, ship, spread
from riskforge.llm.seekable import Reader, Writer, frame
from riskforge.llm.words import groups
from riskforge.session import ensure_checkpoint_dir

END_ID = 2
WIDTH = 2  # bytes of an id in the files; ids of the default tokenizer stay below 2^16
DOCS_IN_FILE = 16_384
CHUNK = 1 << 20

_ENCODED = "doc_id bigint, n_tokens bigint, frame binary, plain bigint, check bigint"
_FILES = "file int, path string, n_docs bigint, n_tokens bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _open_folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, number of ids, frame, its plain size and checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in groups(np.array([len(t) for t in texts], np.int64), CHUNK):
                ids, counts = own.encode(texts[a:b])
                if len(ids) and int(ids.max()) >= 1 << 8 * width:
                    raise ValueError("an id needs more bytes than the file's ids have")
                ends = np.cumsum(counts)
                frames = [frame(np.append(ids[e - n : e], np.uint32(end_id)), width) for n, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts + 1), *(pa.array(list(x), t) for x, t in zip(zip(*frames), (pa.binary(), pa.int64(), pa.int64())))],
                    ["doc_id", "n_tokens", "frame", "plain", "check"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return spread(rows).mapInArrow(run, _ENCODED)


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, docs_in_file: int = DOCS_IN_FILE, end_id: int = END_ID, width: int = WIDTH) -> DataFrame:
    """Write the files and return the manifest: file, path, n_docs, n_tokens,
    start (ids in all files before)."""
    encoded = cut(encode(docs, tokenizer or default_tokenizer(), end_id, width))
    files = max(1, -(-encoded.count() // docs_in_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = None, ""
        writer, n_tokens = None, 0
        number = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system, base = _open_folder(folder)
                system.create_dir(base, recursive=True)
                passing = f"{base}/.{number:06d}-{uuid.uuid4().hex}"
                out = system.open_output_stream(passing)
                writer = Writer(out, width)
            n_tokens += sum(batch.column("n_tokens").to_pylist())
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "frame", "plain", "check"))):
                writer.add(*row)
        if writer is not None:
            writer.close()
            out.close()
            system.move(passing, f"{base}/{number:06d}.ids.zst")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([f"{folder}/{number:06d}.ids.zst"]), pa.array([len(writer.doc_ids)]), pa.array([n_tokens])],
                ["file", "path", "n_docs", "n_tokens"],
            )

    keys = ["doc_id", "n_tokens", "check"]
    manifest = cut(encoded.repartitionByRange(files, *keys).sortWithinPartitions(*keys).mapInArrow(run, _FILES))
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids (binary, unsigned
    little-endian numbers of 32 bits)."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                yield from _read_file(path, start)

    n = max(1, manifest.count())
    return manifest.select("path", "start", "file").repartitionByRange(n, "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _read_file(path: str, start: int, rows: int = 512) -> Iterator[pa.RecordBatch]:
    system, own = _open_folder(path)
    with system.open_input_file(own) as file:
        reader = Reader(file, file.size())
        docs, starts, counts, ids = [], [], [], []
        for doc_id, found in zip(reader.doc_ids, reader):
            docs.append(doc_id)
            starts.append(start)
            counts.append(len(found))
            ids.append(found.astype("<u4").tobytes())
            start += len(found)
            if len(docs) == rows:
                yield _batch(docs, starts, counts, ids)
                docs, starts, counts, ids = [], [], [], []
        if docs:
            yield _batch(docs, starts, counts, ids)


def _batch(docs, starts, counts, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
        ["doc_id", "start", "n_tokens", "ids"],
    )


def lookup(path: str, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file; only their frames are read."""
    system, own = _open_folder(path)
    with system.open_input_file(own) as file:
        reader = Reader(file, file.size())
        wanted = set(doc_ids)
        return {d: reader.ids(k) for k, d in enumerate(reader.doc_ids) if d in wanted}


def digest(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The result columns of the registered query, from the files."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    back = read(write(docs, folder, tokenizer))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
