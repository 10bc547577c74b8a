"""Main text of web pages by a tree-structured graphical model (operator 2).

The blocks of a page (``dom``) are a tree. Each block has a hidden label,
content or not. A block's potential is the chance of what is seen of it (tag,
cue words of class, id and role, length and link share of its own text) under
either label; a parent-child potential is the chance of the child's label
under its parent's, apart for parents that are the page's frame. Messages are
passed upward from the leaves and downward from the root (sum-product), which
gives each block's marginal chance of being content. Text of blocks above one
half is kept; scripts, styles and the like never are.

All chances are relative counts, smoothed, from labelled pages
(``labelled_pages``). The model is fixed by the generator's seed and size.

Edge cases: null or empty html gives an empty text; broken markup is read as
far as it goes (unclosed elements end with the page, unknown end tags are
ignored); character references are decoded; pages of any length and depth are
read whole, without recursion; repeated rows get the same text; an empty table
gives an empty result. Columns named ``text`` or ``n_chars`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskforge.llm.common import spread
from riskforge.llm.dom import SILENT, Block, read
from riskforge.llm.labelled_pages import pages

TRAIN_PAGES = 1500
FRAME = frozenset("#page html body".split())


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= b for b in bounds)


def seen(block: Block) -> tuple[str, frozenset[str], int, int]:
    """Tag, cue words, length class and link class of a block."""
    chars = sum(len(t) for _, t, _ in block.runs)
    linked = sum(n for _, _, n in block.runs)
    return block.tag, block.cues, _bucket(chars, (1, 15, 60, 200)), _bucket(linked / chars, (0.01, 0.3, 0.7)) if chars else 0


class Model:
    def __init__(self, labelled: list[tuple[str, list[int]]]):
        self.counts = [Counter(), Counter()]
        self.sizes = [0, 0]
        pair: Counter = Counter()
        self.tags: set[str] = set()
        for page, labels in labelled:
            blocks = read(page)[1:]
            if len(blocks) != len(labels):
                raise ValueError("a labelled page is not read as it was made")
            for block, y in zip(blocks, labels):
                tag, cues, length, links = seen(block)
                self.tags.add(tag)
                self.sizes[y] += 1
                self.counts[y].update([("tag", tag), ("length", length), ("links", links), *(("cue", c) for c in cues)])
                above = labels[block.parent - 1] if block.parent else 0
                frame = block.parent == 0 or blocks[block.parent - 1].tag in FRAME
                pair[frame, above, y] += 1
        self.pair = {
            (f, a): [log((pair[f, a, y] + 1) / (pair[f, a, 0] + pair[f, a, 1] + 2)) for y in (0, 1)] for f in (False, True) for a in (0, 1)
        }
        self.known_cues = {c for k in self.counts for kind, c in k if kind == "cue"}

    def potential(self, block: Block) -> list[float]:
        """Logarithm of the chance of what is seen under labels 0 and 1."""
        tag, cues, length, links = seen(block)
        out = []
        for y in (0, 1):
            n, count = self.sizes[y], self.counts[y]
            value = log((count["tag", tag] + 0.5) / (n + 0.5 * len(self.tags))) if tag in self.tags else 0.0
            value += log((count["length", length] + 1) / (n + 5)) + log((count["links", links] + 1) / (n + 4))
            value += sum(log((count["cue", c] + 0.2) / (n + 1)) for c in cues & self.known_cues)
            out.append(value)
        return out

    def marginals(self, blocks: list[Block]) -> list[float]:
        """Chance of content of every block, by messages up and down the tree."""
        n = len(blocks)
        own = [[0.0, -50.0]] + [self.potential(b) for b in blocks[1:]]  # the page itself is not content
        step = [None] + [self.pair[blocks[b.parent].tag in FRAME, 0] + self.pair[blocks[b.parent].tag in FRAME, 1] for b in blocks[1:]]
        up = [list(p) for p in own]  # potential with all messages from below
        message: list[list[float]] = [[0.0, 0.0]] * n
        for i in range(n - 1, 0, -1):  # children stand after their parents
            a, b = up[i]
            p = step[i]
            message[i] = [_sum(p[0] + a, p[1] + b), _sum(p[2] + a, p[3] + b)]
            above = up[blocks[i].parent]
            above[0] += message[i][0]
            above[1] += message[i][1]
        down = [[0.0, 0.0]] * n
        for i in range(1, n):
            k = blocks[i].parent
            # the parent's belief without what this child told it
            a = up[k][0] + down[k][0] - message[i][0]
            b = up[k][1] + down[k][1] - message[i][1]
            p = step[i]
            x, y = _sum(p[0] + a, p[2] + b), _sum(p[1] + a, p[3] + b)
            top = max(x, y)
            down[i] = [x - top, y - top]
        out = []
        for u, d in zip(up, down):
            gap = u[0] + d[0] - u[1] - d[1]
            out.append(1 / (1 + exp(min(gap, 700.0))))
        return out

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        blocks = read(page)
        kept = [r for b, p in zip(blocks, self.marginals(blocks)) if p > 0.5 and b.tag not in SILENT for r in b.runs]
        return "\n".join(text for _, text, _ in sorted(kept))


def _sum(a: float, b: float) -> float:
    """Logarithm of the sum of two chances given by their logarithms."""
    if a < b:
        a, b = b, a
    return a + log(1 + exp(b - a))


@cache
def trained(n: int = TRAIN_PAGES) -> Model:
    return Model(pages(n))


def extract(web: DataFrame) -> DataFrame:
    """``web`` (with html) with text and n_chars in place of html."""
    own = web.select([c for c in web.columns if c not in ("text", "n_chars")])
    sent = web.sparkSession.sparkContext.broadcast(trained())  # a few hundred counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sent.value.text(h) for h in batch.column("html").to_pylist()]
            out = {f.name: batch.column(f.name) for f in batch.schema if f.name != "html"}
            out |= {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_pydict(out)

    fields = [f for f in own.schema.fields if f.name != "html"]
    added = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return spread(own).mapInArrow(run, T.StructType(fields + added))


def digest(web: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    return extract(web.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
