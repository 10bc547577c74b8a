"""Removal of repeated passages: count-min prefilter, exact second pass (operator 12).

A window is ``LENGTH`` consecutive words of one document. A word goes if a
window covers it whose words also start anywhere else.

1. Documents are packed to blocks (``blocks``). A window is counted under its
   anchor: the least, by hash, of the runs of ``length // 3 + 1`` words in it (the
   leftmost of equal ones). Consecutive windows mostly share their anchor, so
   there is one anchor for about twelve windows. Equal windows have equal anchors
   at the same offset: an anchor occurs at least as often as any of its windows.
2. Every block sends its sketch in sparse form, the anchors it holds (at most
   twice each, as more than one is all that matters). Sketches are merged by
   ranges of the hash, first those of a section's blocks, then those of the
   sections: two counter rows of ``CELLS`` cells, all counts added, the lesser
   counter is the estimate. Ranges grow in number with the text, their cells
   and what they receive do not, so no sketch is broadcast and none saturates.
   A block is told which of its anchors are estimated at two or more. Estimates
   are never too low, so no repeated window is lost.
3. A block's windows under such an anchor are candidates. They alone are grouped
   exactly, by 128 bits of hash (64 of the anchor, 64 of all words), each once
   for a block, again by sections first. The answer is a bit for each window;
   the block drops the words under its repeated windows.

Edge cases: a null or empty text has no words; texts of fewer words than a
window keep them all; of repeated rows and copies every window is repeated, so
only short ones keep words; null or repeated doc_ids are rows on their own; a
text longer than a block is a block of its own; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.blocks import Layout, blocks, changes, flat, lists, range_of, texts_of
from riskforge.llm.common import stored
from riskforge.llm.words import _power, find, mix64

LENGTH = 35
#: Counters of a row of a sketch, for about 50,000 anchors (``STRIPE`` bytes of
#: text): estimates are too high for about one anchor in a hundred.
CELLS = 1 << 19

_READ = np.arange(1, 257, dtype=np.uint16)
_KINDS = np.ones(256, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = 0


def _rolling(w: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive values."""
    p, q = _power(len(w) + 1)
    sums = np.zeros(len(w) + 1, np.uint64)
    np.cumsum(w * p[: len(w)], out=sums[1:])
    return mix64((sums[n:] - sums[:-n]) * q[: len(w) - n + 1])


def _least(values: np.ndarray, m: int) -> np.ndarray:
    """The least of every ``m`` consecutive values."""
    have = 1
    while 2 * have <= m:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (m - have)], values[m - have :]) if have < m else values


class Windows:
    """The words of a block's texts and their windows of ``length`` words."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int):
        self.data, self.at, self.length = data, at, length
        self.words, self.begin, self.end, self.first = find(data, at, _READ, _KINDS)
        ends = np.repeat(self.first[1:], np.diff(self.first))
        self.starts = np.flatnonzero(np.arange(len(self.words)) + length <= ends)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every anchor, and the number of each window's anchor."""
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        gram = self.length // 3 + 1
        grams = _rolling(self.words, gram)
        low = np.uint64((1 << max(1, len(grams).bit_length())) - 1)
        least = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), self.length - gram + 1)
        place = (least[self.starts] & low).astype(np.int64)
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        return mix64(grams[place[new]]), np.cumsum(new) - 1  # mixed anew, as the least of many hashes are small

    def candidates(self, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, hash and start of the windows under these anchors, by anchor and hash."""
        hashes, number = self.anchors()
        some = np.flatnonzero(np.isin(hashes, told)[number])
        if not len(some):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        anchor, window = hashes[number[some]], _rolling(self.words, self.length)[self.starts[some]]
        order = np.lexsort((window, anchor))
        return anchor[order], window[order], self.starts[some][order]


def _distinct(anchor: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Where runs of equal (anchor, window) begin."""
    return np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1]))) if len(anchor) else np.zeros(0, np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


_ASKED = "section bigint, part bigint, block bigint, anchors array<bigint>"
_MERGED = "stripe bigint, block bigint, anchors array<bigint>"


def _sketches(length: int, parts: int):
    """Sparse sketches of the blocks, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                hashes = np.sort(Windows(*texts_of(batch, row), length).anchors()[0])
                twice = np.ones(len(hashes), bool)
                twice[2:] = hashes[2:] != hashes[:-2]
                hashes = hashes[twice]
                part = range_of(hashes, parts)
                new = changes(part)
                own = [pa.array(np.full(len(new), batch.column(c)[row].as_py(), np.int64)) for c in ("section", "block")]
                yield pa.RecordBatch.from_arrays([own[0], pa.array(part[new]), own[1], lists(new, _signed(hashes))], ["section", "part", "block", "anchors"])

    return run


def _estimated(hashes: np.ndarray, counts: np.ndarray, cells: int) -> np.ndarray:
    """The merged sketch's estimate for each of the hashes whose counts it holds."""
    rows = [(x % np.uint64(cells)).astype(np.int64) for x in (hashes, mix64(hashes))]
    held = [np.bincount(r, counts, cells) for r in rows]
    return np.minimum(held[0][rows[0]], held[1][rows[1]])


def _section_sketch(cells: int, stripes: int):
    """One range of a section: answers (stripe null) for anchors of two or more,
    and for the whole corpus the others by block, those of more once (block null)."""

    def run(table: pa.Table) -> pa.Table:
        anchors, of = flat(table["anchors"])
        anchors, block = anchors.view(np.uint64), table["block"].to_numpy()
        high = _estimated(anchors, np.ones(len(anchors)), cells) >= 2
        sure = changes(of[high])
        rows = [(np.full(len(sure), -1), block[of[high][sure]], lists(sure, _signed(anchors[high])))]
        common = np.unique(anchors[high])
        for hashes, owner in ((common, np.full(len(common), -1)), (anchors[~high], block[of[~high]])):
            stripe = range_of(hashes, stripes)
            order = np.lexsort((hashes, owner, stripe))
            stripe, owner = stripe[order], owner[order]
            new = np.flatnonzero(np.append(True, (stripe[1:] != stripe[:-1]) | (owner[1:] != owner[:-1]))) if len(order) else order
            rows.append((stripe[new], owner[new], lists(new, _signed(hashes[order]))))
        return pa.concat_tables([pa.table({"stripe": s, "block": b, "anchors": a}) for s, b, a in rows])

    return run


def _corpus_sketch(cells: int):
    """One stripe: answers to the blocks that hold an anchor whose estimate over
    all sections is two or more."""

    def run(table: pa.Table) -> pa.Table:
        anchors, of = flat(table["anchors"])
        block = table["block"].to_numpy()[of]
        high = (_estimated(anchors.view(np.uint64), np.where(block < 0, 2.0, 1.0), cells) >= 2) & (block >= 0)
        new = changes(of[high])
        return pa.table({"stripe": np.full(len(new), -1), "block": block[high][new], "anchors": lists(new, anchors[high])})

    return run


def _told(batch: pa.RecordBatch, row: int) -> np.ndarray:
    values = batch.column("told")[row].values
    return np.zeros(0, np.uint64) if values is None else values.flatten().to_numpy().view(np.uint64)


_WINDOWS = "section bigint, part bigint, block bigint, anchors array<bigint>, sizes array<int>, windows array<bigint>, more binary"


def _candidates(length: int, parts: int):
    """Distinct candidate windows of the blocks, by part; ``more`` has a bit for
    each that is there more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                anchor, window, _ = Windows(*texts_of(batch, row), length).candidates(_told(batch, row))
                at = _distinct(anchor, window)
                more = np.diff(np.append(at, len(anchor))) > 1
                anchor, window = anchor[at], window[at]
                run_of = changes(anchor)
                sizes = np.diff(np.append(run_of, len(anchor))).astype(np.int32)
                part = range_of(anchor[run_of], parts)
                new = changes(part)
                first = run_of[new]
                own = [pa.array(np.full(len(new), batch.column(c)[row].as_py(), np.int64)) for c in ("section", "block")]
                bits = pa.array([np.packbits(x).tobytes() for x in np.split(more, first[1:])][: len(new)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [own[0], pa.array(part[new]), own[1], lists(new, _signed(anchor[run_of])), lists(new, sizes), lists(first, _signed(window)), bits],
                    ["section", "part", "block", "anchors", "sizes", "windows", "more"],
                )

    return run


_BITS = "stripe bigint, part bigint, block bigint, bits binary, at array<int>, anchors array<bigint>, windows array<bigint>"


def _section_windows(stripes: int):
    """One range of a section: for every block a bit for each of its windows
    (stripe -1), and for the whole corpus the distinct windows: those found once
    with block and place, the others without."""

    def run(table: pa.Table) -> pa.Table:
        window, of = flat(table["windows"])
        sizes, _ = flat(table["sizes"])
        anchor = np.repeat(flat(table["anchors"])[0], sizes).view(np.uint64)
        window, block, part = window.view(np.uint64), table["block"].to_numpy(), table["part"][0].as_py()
        count = np.bincount(of, minlength=len(block))
        begin = np.cumsum(count) - count
        more = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table["more"].to_pylist(), count.tolist())]
        n = 1 + np.concatenate(more).astype(np.int64)
        order = np.lexsort((window, anchor))
        new = _distinct(anchor[order], window[order])
        total = np.add.reduceat(n[order], new)
        many = np.empty(len(order), bool)
        many[order] = np.repeat(total > 1, np.diff(np.append(new, len(order))))
        bits = [np.packbits(x).tobytes() for x in np.split(many, begin[1:])]
        none = lambda rows, t: pa.array([None] * rows, t)
        answer = pa.table({
            "stripe": np.full(len(block), -1), "part": np.full(len(block), part), "block": block, "bits": pa.array(bits, pa.binary()),
            "at": none(len(block), pa.list_(pa.int32())), "anchors": none(len(block), pa.list_(pa.int64())), "windows": none(len(block), pa.list_(pa.int64())),
        })
        one = order[new]  # an occurrence of each distinct window
        owner = np.where(total > 1, -1, block[of[one]])
        stripe = range_of(anchor[one], stripes)
        sort = np.lexsort((owner, stripe))
        one, owner, stripe = one[sort], owner[sort], stripe[sort]
        new = np.flatnonzero(np.append(True, (stripe[1:] != stripe[:-1]) | (owner[1:] != owner[:-1])))
        further = pa.table({
            "stripe": stripe[new], "part": np.full(len(new), part), "block": owner[new], "bits": none(len(new), pa.binary()),
            "at": lists(new, (one - begin[of[one]]).astype(np.int32)), "anchors": lists(new, _signed(anchor[one])), "windows": lists(new, _signed(window[one])),
        })
        return pa.concat_tables([answer, further])

    return run


def _corpus_windows(table: pa.Table) -> pa.Table:
    """One stripe: places of the blocks' windows that other sections hold too."""
    window, of = flat(table["windows"])
    anchor, at = flat(table["anchors"])[0], flat(table["at"])[0]
    block = table["block"].to_numpy()[of]
    order = np.lexsort((window, anchor))
    new = _distinct(anchor[order], window[order])
    total = np.add.reduceat(np.where(block[order] < 0, 2, 1), new)
    many = np.empty(len(order), bool)
    many[order] = np.repeat(total > 1, np.diff(np.append(new, len(order))))
    many &= block >= 0
    new = changes(of[many])
    return pa.table({"part": table["part"].to_numpy()[of[many][new]], "block": block[many][new], "at": lists(new, at[many])})


_OUT = "doc_id bigint, n_words bigint, n_removed bigint, text string, spans array<struct<begin:int,end:int>>"


def _without(own: Windows, starts: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Removed words of each text, the texts left and the removed word spans,
    for the starts of repeated windows."""
    n, first, at = len(own.words), own.first, own.at
    gone = np.bincount(starts, minlength=n + 1) - np.bincount(starts + own.length, minlength=n + 1)
    gone = np.cumsum(gone)[:n] > 0
    number = np.concatenate([[0], np.cumsum(gone)])
    removed = number[first[1:]] - number[first[:-1]]
    # texts: the bytes of kept words, and of the sign after each that another follows
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    kept = np.flatnonzero(~gone)
    more = np.zeros(len(kept), bool)
    more[:-1] = doc[kept[1:]] == doc[kept[:-1]]
    step = np.zeros(len(own.data) + 2, np.int8)
    step[own.begin[kept]] += 1
    np.subtract.at(step, own.end[kept] + more, 1)
    stay = np.cumsum(step, dtype=np.int8)[: len(own.data)] > 0
    data = own.data.copy()
    data[own.end[kept[more]]] = 0x20
    size = np.concatenate([[0], np.cumsum(stay)])[at]
    texts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(data[stay])).cast(pa.string())
    # spans: runs of removed words inside a text, counted from its first word
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    before = np.append(False, gone[:-1]) if n else gone
    after = np.append(gone[1:], False) if n else gone
    b = np.flatnonzero(gone & (~before | edge[:n]))
    e = np.flatnonzero(gone & (~after | edge[1:])) + 1
    base = first[doc[b]] if n else b
    spans = pa.StructArray.from_arrays([pa.array((b - base).astype(np.int32)), pa.array((e - base).astype(np.int32))], ["begin", "end"])
    return removed, texts, pa.ListArray.from_arrays(pa.array(np.searchsorted(b, first).astype(np.int32)), spans)


def _repeated(own: Windows, told: np.ndarray, answers: list[dict], parts: int) -> np.ndarray:
    """Starts of the block's repeated windows, from the answers to its parts."""
    anchor, window, starts = own.candidates(told)
    at = _distinct(anchor, window)
    part = range_of(anchor[at], parts)
    many = np.zeros(len(at), bool)
    for answer in answers:
        low, high = np.searchsorted(part, [answer["part"], answer["part"] + 1])
        if answer["bits"] is not None:
            many[low:high] |= np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=high - low).astype(bool)
        else:
            many[low + np.array(answer["at"], np.int64)] = True
    return starts[np.repeat(many, np.diff(np.append(at, len(starts))))]


def _remove(length: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = Windows(*texts_of(batch, row), length)
                starts = _repeated(own, _told(batch, row), batch.column("answers")[row].as_py() or [], parts)
                removed, texts, spans = _without(own, starts)
                ids = batch.column("doc_ids")[row].values
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(own.first)), pa.array(removed), texts, spans], ["doc_id", "n_words", "n_removed", "text", "spans"]
                )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, cells: int = CELLS) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space) and
    spans (removed words, end exclusive) of every document."""
    packed = blocks(docs, "passages")
    layout = Layout(packed.agg(F.sum("size")).first()[0] or 0)
    parts, stripes = layout.parts, layout.stripes
    packed = packed.withColumn("section", F.pmod(F.xxhash64("block"), F.lit(layout.sections)))
    body = ["section", "block", "lengths", "body"]

    asked = packed.select(*body).mapInArrow(_sketches(length, parts), _ASKED)
    merged = stored(asked.groupBy("section", "part").applyInArrow(_section_sketch(cells, stripes), _MERGED), "anchors")
    further = merged.filter("stripe >= 0").groupBy("stripe").applyInArrow(_corpus_sketch(cells), _MERGED)
    # a part of one block's anchors, so no more than the block holds
    told = merged.filter("stripe < 0").unionByName(further).groupBy("block").agg(F.collect_list("anchors").alias("told"))

    windows = packed.select(*body).join(told, "block").mapInArrow(_candidates(length, parts), _WINDOWS)
    counted = stored(windows.groupBy("section", "part").applyInArrow(_section_windows(stripes), _BITS), "windows")
    elsewhere = counted.filter("stripe >= 0").groupBy("stripe").applyInArrow(_corpus_windows, "part bigint, block bigint, at array<int>")
    answers = counted.filter("stripe < 0").select("part", "block", "bits", F.lit(None).cast("array<int>").alias("at"))
    answers = answers.unionByName(elsewhere.withColumn("bits", F.lit(None).cast("binary")))
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("part", "bits", "at")).alias("answers"))
    whole = packed.select("block", "doc_ids", "lengths", "body").join(told.join(answers, "block"), "block", "left")
    return whole.mapInArrow(_remove(length, parts), _OUT)


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
