"""Approximate nearest neighbours by a forest of random-projection trees
(operator 1).

Copies. Equal vectors are one item with its k + 1 least vec_ids: copies are
equally far from every query and ties go to the smaller vec_id, so no further
copy is ever among the k nearest, also when a query leaves out its own id. A
very common vector thus has no more weight in the search than any other.

Index. Trees are fitted on a bounded sample (``SAMPLE`` items with the least
seeded key): a node splits its items by the hyperplane halfway between two
of them, at the median of the projections, down to leaves of about
``LEAF`` sample items. All items of the table are then put into a leaf of every
tree.

Search. A query walks all trees through one shared priority queue, ordered by
how far it is on the wrong side of the worst hyperplane on the way, and takes
leaves until they hold ``SHARE`` times as many rows as there are items,
counting an item once for each tree it is found in: the same rule in a table of
any size. The leaves' true sizes are used, so the work follows the data and not
the sample.

Rerank. Items are dealt to blocks of about ``BLOCK`` by a hash of the vector,
each with its leaves, and meet the queries there, ``QUERIES`` at a time. A task
computes the exact distance (double precision, on the original vectors) of a
query to every item that lies in one of its leaves, each pair once however many
trees it meets in, and keeps the best k vec_ids; the final k are the best of
those, ties to the smaller vec_id. Blocks are dealt by hash, so a leaf of many
items is not one task.

What goes to all tasks is the forest: at most 2 * SAMPLE / LEAF nodes for each
tree, whatever the input.

``SHARE`` is set for vectors without any structure (the hardest case: the
nearest neighbours are hardly nearer than the rest); with clustered vectors a
few per cent are enough. Recall against brute force is measured in the tests.

Edge cases: null vectors and vectors that are zero, hold null or non-finite
components or differ in length from the most common length take no part; null
ids take no part; rows of one vec_id are one candidate, at the least of their
distances (a query leaves out rows of its own id, and of several vectors the
least in array order is its own); fewer rows than k give as
many; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskforge.llm.common import cut, spread

K = 10
TREES = 16
SAMPLE = 20_000
LEAF = 100
SHARE = 1.5
BLOCK = 20_000  # items of a block
QUERIES = 5_000  # queries that meet a block in one task


class Forest:
    """Trees as flat arrays: node i has a plane (vector, offset) and children;
    a child below zero is the leaf ``~child``. Leaves are numbered through."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 1):
        self.dim = sample.shape[1] if sample.ndim == 2 else 0
        rng = np.random.default_rng(seed)
        planes, offsets, children, self.roots = [], [], [], []
        self.leaves = 0
        for _ in range(trees):
            todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(sample)), -1, 0)]
            while todo:
                rows, parent, side = todo.pop()
                split = self._split(sample, rows, rng) if len(rows) > leaf else None
                if split is None:
                    me = ~self.leaves
                    self.leaves += 1
                else:
                    me = len(planes)
                    plane, offset, above = split
                    planes.append(plane)
                    offsets.append(offset)
                    children.append([0, 0])
                    todo += [(rows[~above], me, 0), (rows[above], me, 1)]
                if parent < 0:
                    self.roots.append(me)
                else:
                    children[parent][side] = me
        self.planes = np.array(planes, np.float64).reshape(len(planes), self.dim)
        self.offsets = np.array(offsets, np.float64)
        self.children = np.array(children, np.int64).reshape(-1, 2)

    @staticmethod
    def _split(sample, rows, rng):
        for _ in range(4):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            plane = a - b
            size = np.sqrt(plane @ plane)
            if size == 0:
                continue
            plane = plane / size
            at = sample[rows] @ plane
            offset = float(np.median(at))
            above = at > offset
            if above.any() and not above.all():
                return plane, offset, above
        return None  # equal vectors

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root)
            while True:
                inner = np.flatnonzero(node >= 0)
                if not len(inner):
                    break
                at = node[inner]
                above = np.einsum("ij,ij->i", x[inner], self.planes[at]) > self.offsets[at]
                node[inner] = self.children[at, above.astype(np.int64)]
            out[:, t] = ~node
        return out

    def search(self, q: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
        """Leaves in the order of the shared queue until they hold ``wanted`` rows."""
        side = self.planes @ q - self.offsets if len(self.planes) else np.zeros(0)
        queue = [(0.0, t, root) for t, root in enumerate(self.roots)]
        heapq.heapify(queue)
        out, held, n = [], 0.0, len(queue)
        while queue and held < wanted:
            far, _, node = heapq.heappop(queue)
            while node >= 0:
                d = side[node]
                near, other = (1, 0) if d > 0 else (0, 1)
                n += 1
                heapq.heappush(queue, (max(far, abs(d)), n, int(self.children[node, other])))
                node = int(self.children[node, near])
            if sizes[~node]:
                out.append(~node)
                held += sizes[~node]
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, embedding (doubles)."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.filter("vec_id is not null").select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("embedding"))
    sound = rows.filter(
        "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) "
        "and exists(embedding, x -> x != 0)"
    )
    common = sound.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return sound.filter(F.size("embedding") == (common.n if common else 0))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(vec_id, embedding) -> (embedding, vec_ids): the ``most`` least vec_ids of
    each vector, ascending. The limit is applied before the shuffle by vector,
    so a common vector brings no more than ``most`` rows from a task."""
    least = W.partitionBy("embedding").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(least)).filter(F.col("n") <= most)
    return few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _nearest_ids(ids: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k nearest different ids, ties to the smaller id."""
    most = k
    while True:
        # everything not farther than the bound, so that ties are settled by id
        bound = np.partition(d, min(most, len(d)) - 1)[min(most, len(d)) - 1]
        near = np.flatnonzero((d <= bound) & np.isfinite(d))
        near = near[np.lexsort((ids[near], d[near]))]
        near = near[np.sort(np.unique(ids[near], return_index=True)[1])]  # the nearest row of each id
        if len(near) >= k or most >= len(d):
            return near[:k]
        most *= 2


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, trees: int = TREES, share: float = SHARE, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for every query."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    items = cut(distinct_vectors(rows, k + 1))
    first = F.col("vec_ids")[0]
    key = F.md5(F.concat(F.lit("ann|"), first.cast("string")).cast("binary"))
    fitted = items.orderBy(key, first, "embedding").limit(sample).select("embedding").collect()
    x = np.array([r.embedding for r in fitted], np.float64)
    forest = Forest(x, trees) if len(x) else Forest(np.zeros((0, 0)), trees)
    sent = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            if batch.num_rows:
                leaves = own.leaves_of(_matrix(batch.column("embedding"), own.dim))
                at = np.arange(0, leaves.size + 1, leaves.shape[1], dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(at), pa.array(leaves.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_ids"), batch.column("embedding"), column], ["vec_ids", "embedding", "leaves"])

    placed = cut(spread(items).mapInArrow(place, "vec_ids array<bigint>, embedding array<double>, leaves array<bigint>"))
    counts = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()  # one row for each leaf
    sizes = np.zeros(forest.leaves, np.int64)
    for r in counts:
        sizes[r["leaf"]] = r["count"]
    n_items = int(sizes.sum() / max(1, trees))
    plan = spark.sparkContext.broadcast((sizes, share * n_items))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (n, wanted) = sent.value, plan.value
        for batch in batches:
            if batch.num_rows:
                found = [own.search(query, n, wanted) for query in _matrix(batch.column("embedding"), own.dim)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], ["query_id", "embedding", "taken"])

    ids = queries.filter("vec_id is not null").select(F.col("vec_id").cast("bigint").alias("query_id")).distinct()
    asked = cut(rows.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding")).join(ids, "query_id", "left_semi"))
    blocks = max(spark.sparkContext.defaultParallelism, -(-n_items // BLOCK))
    groups = max(1, -(-asked.count() // QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = placed.select("*", F.pmod(F.xxhash64("embedding"), F.lit(blocks)).cast("int").alias("block")).select("*", every(groups).alias("part"))
    walked = spread(asked).mapInArrow(walk, "query_id bigint, embedding array<double>, taken array<int>")
    visits = walked.select("*", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("part")).select("*", every(blocks).alias("block"))

    def rerank(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(left) or not len(right):
            return empty
        a = np.stack(left["embedding"].to_numpy()).astype(np.float64)
        leaves = np.stack(left["leaves"].to_numpy())
        lists = left["vec_ids"].to_numpy()
        ids, item, out = np.concatenate(lists), np.repeat(np.arange(len(a)), [len(x) for x in lists]), [empty]
        chosen = np.zeros(leaves.max() + 1, bool)
        for q, vector, taken in zip(right["query_id"].to_numpy(), right["embedding"].to_numpy(), right["taken"].to_numpy()):
            chosen[:] = False
            chosen[taken[taken < len(chosen)]] = True
            hit = np.flatnonzero(chosen[leaves].any(axis=1))
            d = np.full(len(a), np.inf)
            d[hit] = np.sqrt(((a[hit] - np.asarray(vector, np.float64)) ** 2).sum(axis=1))
            d = d[item]
            d[ids == q] = np.inf
            near = _nearest_ids(ids, d, k)
            out.append(pd.DataFrame({"query_id": np.full(len(near), q), "vec_id": ids[near], "score": d[near]}))
        return pd.concat(out)

    found = held.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInPandas(rerank, "query_id bigint, vec_id bigint, score double")
    # an id with several vectors may be found in several blocks
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def digest(vectors: DataFrame) -> DataFrame:
    """The result columns of the registered query: queries are the rows whose
    vec_id is divisible by 100."""
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
