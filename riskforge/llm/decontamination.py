"""Benchmark decontamination by an FM-index of every shard (operator 4).

Each task cuts its documents into shards of about a million words and builds
an FM-index of each (``fm_index``). Every window of 13 consecutive words of a
test item (a shorter item is one window) is searched backward in it; its
occurrences are located by sampled suffix positions, and the words they cover
are merged into removal spans. Documents are not shuffled.

The items go to the tasks in blocks: a block is broadcast, its text is bounded
by ``BLOCK_BYTES``, and further blocks are searched in further passes over the
documents, each adding to the spans found.

Edge cases: a null or wordless text has no words, no hits and is clean; a null
or wordless item has no windows; repeated items count once for an item_id;
texts of any length are searched whole (texts of more than ``PIECE`` words in
overlapping pieces); empty tables give empty or clean results. Columns of the
documents named ``n_words``, ``hits`` or ``items`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.llm.common import spread
from riskforge.llm.fm_index import FMIndex
from riskforge.llm.words import buffer, find, groups, ordered_ids

WINDOW = 13
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 5 << 20
PIECE = 1 << 19
SHARD_WORDS = 1 << 20

_PARTS = ("word", "words", "start", "end")
_SPAN = pa.list_(pa.struct([(p, pa.int64()) for p in _PARTS]))
_ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField(p, T.LongType()) for p in _PARTS]))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _windows(names: list[str], texts: list[str | None]) -> dict[int, tuple[np.ndarray, list[np.ndarray]]]:
    """length -> (distinct windows as rows of word hashes, the items of each as
    places in ``names``)."""
    h, _, _, first = find(*buffer(pa.array(texts, pa.large_string())))
    seen: dict[tuple[int, ...], set[int]] = {}
    for i in range(len(names)):
        own = h[first[i] : first[i + 1]].tolist()
        for k in range(max(1, len(own) - WINDOW + 1) if own else 0):
            seen.setdefault(tuple(own[k : k + WINDOW]), set()).add(i)
    out: dict[int, tuple[list, list]] = {}
    for window, items in seen.items():
        rows, owners = out.setdefault(len(window), ([], []))
        rows.append(window)
        owners.append(np.array(sorted(items)))
    return {n: (np.array(rows, np.uint64), owners) for n, (rows, owners) in out.items()}


def _shards(first: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of pieces (document, first word, end), a list for each shard."""
    shard: list[tuple[int, int, int]] = []
    size = 0
    for d in range(len(first) - 1):
        low, end = int(first[d]), int(first[d + 1])
        while low < end:
            high = min(end, low + PIECE)
            shard.append((d, low, high))
            size += high - low + 1
            if size >= SHARD_WORDS:
                yield shard
                shard, size = [], 0
            if high == end:
                break
            low = high - WINDOW + 1
    if shard:
        yield shard


def search(h: np.ndarray, first: np.ndarray, windows: dict) -> tuple[np.ndarray, set[tuple[int, int]]]:
    """For words ``h`` of documents beginning at ``first``: which words are hit,
    and the (document, item) pairs."""
    delta = np.zeros(len(h) + 1, np.int64)
    pairs: set[tuple[int, int]] = set()
    for shard in _shards(first):
        docs = np.array([d for d, _, _ in shard])
        lows = np.array([low for _, low, _ in shard])
        lengths = np.array([high - low for _, low, high in shard])
        words = np.concatenate([h[low:high] for _, low, high in shard])
        vocabulary, ids = ordered_ids(words)
        index = FMIndex(ids, lengths, len(vocabulary))
        for length, (rows, owners) in windows.items():
            at = np.minimum(np.searchsorted(vocabulary, rows), len(vocabulary) - 1)
            known = np.flatnonzero((vocabulary[at] == rows).all(axis=1))
            who, low, high = index.search(at[known])
            if not len(who):
                continue
            counts = high - low
            suffixes = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            places = index.locate(suffixes)
            piece = np.searchsorted(index.starts, places, "right") - 1
            word = lows[piece] + places - index.starts[piece]
            np.add.at(delta, word, 1)
            np.add.at(delta, word + length, -1)
            which = np.repeat(known[who], counts)
            for row, d in set(zip(which.tolist(), docs[piece].tolist())):
                pairs.update((d, int(i)) for i in owners[row])
    return np.cumsum(delta[:-1]) > 0, pairs


def _annotate(batch: pa.RecordBatch, names: list[str], windows: dict) -> pa.RecordBatch:
    data, at = buffer(batch.column("text"))
    n_words, hits, items = [], [], []
    for a, b in groups(np.diff(at), SHARD_BYTES):
        part = data[at[a] : at[b]]
        h, s, e, first = find(part, at[a : b + 1] - at[a])
        hit, pairs = search(h, first, windows)
        chars = None
        own: dict[int, set[str]] = {}
        for d, i in pairs:
            own.setdefault(d, set()).add(names[i])
        for d in range(b - a):
            low, high = int(first[d]), int(first[d + 1])
            n_words.append(high - low)
            items.append(sorted(own.get(d, ())))
            spans = []
            if d in own:
                if chars is None:  # code points before each byte
                    chars = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[low:high].astype(np.int8), [0]])))
                base = int(chars[at[a + d] - at[a]])
                for x, y in edge.reshape(-1, 2).tolist():
                    spans.append({"word": x, "words": y - x, "start": int(chars[s[low + x]]) - base, "end": int(chars[e[low + y - 1]]) - base})
            hits.append(spans)
    out = {f.name: batch.column(f.name) for f in batch.schema}
    if "hits" in out:  # a further block of items: join with what the earlier ones found
        old = out["hits"].to_pylist(), out["items"].to_pylist()
        hits = [_merge(x or [], y) for x, y in zip(old[0], hits)]
        items = [sorted(set(x or []) | set(y)) for x, y in zip(old[1], items)]
    out |= {"n_words": pa.array(n_words, pa.int64()), "hits": pa.array(hits, _SPAN), "items": pa.array(items, pa.list_(pa.string()))}
    return pa.RecordBatch.from_pydict(out)


def _merge(x: list[dict], y: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted([*x, *y], key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["word"] + out[-1]["words"]:
            last = out[-1]
            end = max(last["word"] + last["words"], s["word"] + s["words"])
            out[-1] = last | {"words": end - last["word"], "end": max(last["end"], s["end"])}
        else:
            out.append(s)
    return out


def annotate(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, hits (merged spans of hit words: first word, words,
    and code points from start to end) and items (item_ids with a window in it)."""
    spark = docs.sparkSession
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    own = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    out = spread(docs.select(own))
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = part.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").collect()
        names = sorted({r[0] for r in rows})
        number = {name: i for i, name in enumerate(names)}
        windows: dict = {}
        if rows:
            plain = _windows([r[0] for r in rows], [r[1] for r in rows])
            windows = {n: (w, [np.unique([number[rows[i][0]] for i in o]) for o in owners]) for n, (w, owners) in plain.items()}
        sent = spark.sparkContext.broadcast((names, windows))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield _annotate(batch, *sent.value)

        fields = [f for f in out.schema.fields if f.name not in ("n_words", "hits", "items")]
        out = out.mapInArrow(run, T.StructType(fields + _ADDED))
    return out


def measures(annotated: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated beside the other columns."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, s: a + s["words"])
    return annotated.withColumns(
        {
            "n_hit": n_hit,
            "n_items": F.size("items").cast("bigint"),
            "items_sha256": F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256),
            "contaminated": (n_hit > 0) & (n_hit * 20 >= F.col("n_words")),
        }
    )


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    found = annotate(docs.select("doc_id", "text"), items)
    return measures(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they were."""
    return measures(annotate(docs, items)).filter(~F.col("contaminated")).select(docs.columns)


def cut_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All documents, with the removal spans cut out of their texts."""
    found = annotate(docs, items)
    kept = F.expr(
        "aggregate(hits, named_struct('at', 0L, 'out', ''), (a, s) -> named_struct('at', s.end, 'out', "
        "concat(a.out, substring(text, int(a.at) + 1, int(s.start - a.at)))), "
        "a -> concat(a.out, substring(text, int(a.at) + 1)))"
    )
    text = F.when(F.size("hits") > 0, kept).otherwise(F.col("text"))
    return found.withColumn("text", text).select(docs.columns)
