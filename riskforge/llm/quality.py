"""Quality classifier (operator 3): random-indexing word vectors, pooled per
document, into a two-layer network with temperature-calibrated probabilities.

Tokens are runs of letters, of digits and of other signs. A token is known by
its vocabulary entry, else by its shape (kind, length class, capitals); a word
that is one of the three words before it is the token "repeated". Every token
has a sparse random index vector; its word vector is the mean of the index
vectors found around it in the training texts (two to each side). A document
is the mean of its tokens' word vectors and the logarithm of its length.

Fitting uses a bounded sample: the ``TRAIN_ROWS`` labelled rows with the least
seeded key outside the held-out fold, with their whole texts, which are read in
tasks: word counts, sums of word vectors and pooled vectors are what leaves
them. A fifth of them is set apart to find the temperature. Scoring reads
whole texts of all documents, without a shuffle.

Edge cases: a null or empty text is scored like any other, as a document
without tokens; labels that are null or not 0 or 1 teach nothing; without
both labels in the sample the score is the share of label 1 (0.5 without any
label); null doc_ids count as the empty text in the fold and have no label;
repeated rows get the same score; an empty table gives an empty result.
Columns named ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.llm.common import cut, ship, spread, text_or_empty
from riskforge.llm.words import buffer, find, groups, mix64

TRAIN_ROWS = 4000
TRAIN_TASKS = 8  # tasks that read the training texts
VOCABULARY = 4096
DIM, SPARSE, WINDOW, HIDDEN = 64, 4, 2, 32
EPOCHS = 40
THRESHOLD = 0.3
CHUNK = 1 << 20

_KINDS = np.full(256, 2, np.uint8)  # 0 white space, 1 letters, 2 signs, 3 digits
_KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KINDS[48:58] = 3
_KINDS[[0x20, *range(9, 14)]] = 0
_SAME = np.arange(256, dtype=np.uint8)
_LENGTHS = np.array([1, 2, 3, 5, 8, 13, 21])
_REPEATED = 0
_SHAPES = 1 + 4 * 8 * 4


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of every token, and where each text's begin."""
    h, s, e, first = find(data, at, _SAME, _KINDS)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    n_upper = upper[e] - upper[s]
    kind = _KINDS[data[s]] if len(s) else np.zeros(0, np.uint8)
    capitals = (n_upper > 0).astype(np.int64) + (n_upper > 1) + ((n_upper > 1) & (2 * n_upper > e - s))
    shape = 1 + (kind.astype(np.int64) * 8 + np.searchsorted(_LENGTHS, e - s, "right")) * 4 + capitals
    words = np.flatnonzero(kind == 1)
    doc = np.searchsorted(first, words, "right")
    again = np.zeros(len(words), bool)
    for lag in (1, 2, 3):
        if len(words) > lag:
            again[lag:] |= (h[words[lag:]] == h[words[:-lag]]) & (doc[lag:] == doc[:-lag])
    shape[words[again]] = _REPEATED
    return h, shape, first


class Model:
    """Word vectors and network. ``fit`` gets texts and labels."""

    def __init__(self) -> None:
        self.words = np.zeros(0, np.uint64)
        self.vectors = np.zeros((_SHAPES, DIM), np.float32)
        self.net: list[np.ndarray] | None = None
        self.temperature, self.prior = 1.0, 0.5

    def ids(self, h: np.ndarray, shape: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return shape
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where((self.words[at] == h) & (shape != _REPEATED), _SHAPES + at, shape)

    def pooled(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One row for each text: mean word vector and length."""
        h, shape, first = _tokens(data, at)
        ids = self.ids(h, shape)
        n = np.diff(first)
        out = np.zeros((len(n), DIM + 1))
        some = np.flatnonzero(n)
        if len(some):
            out[some, :DIM] = np.add.reduceat(self.vectors[ids], first[some], axis=0, dtype=np.float64) / n[some, None]
        out[:, DIM] = np.log1p(n) / 10
        return out

    def choose_words(self, values: np.ndarray, counts: np.ndarray) -> None:
        """The vocabulary: the commonest words that occur more than once, ties to the smaller hash."""
        best = np.lexsort((values, -counts))[:VOCABULARY]
        self.words = np.sort(values[best][counts[best] > 1])

    def index_vectors(self) -> np.ndarray:
        size = _SHAPES + len(self.words)
        index = np.zeros((size, DIM), np.float32)
        name = np.concatenate([np.arange(_SHAPES, dtype=np.uint64), self.words])  # by the word itself, not its place
        for j in range(SPARSE):
            x = mix64(name + mix64(np.array([j + 1], np.uint64)))
            index[np.arange(size), (x % np.uint64(DIM)).astype(np.int64)] += np.where(x >> np.uint64(63) == 1, 1, -1)
        return index

    def around(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the index vectors found around every token: whole
        numbers, so sums over parts of the texts add up exactly."""
        h, shape, first = _tokens(data, at)
        ids, index = self.ids(h, shape), self.index_vectors()
        size = len(index)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        total, seen = np.zeros((size, DIM)), np.zeros(size)
        for lag in range(1, WINDOW + 1):
            same = np.flatnonzero(doc[lag:] == doc[:-lag])
            for a, b in ((same, same + lag), (same + lag, same)):
                pair, times = np.unique(ids[a] * size + ids[b], return_counts=True)
                left, right = pair // size, pair % size
                for lo in range(0, len(pair), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    edges = np.flatnonzero(np.diff(left[part], prepend=-1))
                    total[left[part][edges]] += np.add.reduceat(index[right[part]] * times[part, None], edges, axis=0)
                seen += np.bincount(ids[a], minlength=size)
        return total, seen

    def set_vectors(self, total: np.ndarray, seen: np.ndarray) -> None:
        self.vectors = (total / np.maximum(seen, 1)[:, None]).astype(np.float32)

    def fit_vectors(self, data: np.ndarray, at: np.ndarray) -> None:
        """Word vectors of texts held in memory."""
        self.choose_words(*np.unique(_tokens(data, at)[0], return_counts=True))
        self.set_vectors(*self.around(data, at))

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2, mean, scale = self.net
        hidden = np.maximum((x - mean) / scale @ w1 + b1, 0)
        return hidden @ w2 + b2

    def fit_network(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> "Model":
        """Network and temperature from one row for each text, as ``pooled`` gives it."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        apart, learn = order[: len(y) // 5], order[len(y) // 5 :]
        mean, scale = x[learn].mean(0), x[learn].std(0) + 1e-6
        d = x.shape[1]
        net = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
        xs, step = (x - mean) / scale, 0
        for _ in range(EPOCHS):
            shuffled = rng.permutation(learn)
            for lo in range(0, len(shuffled), 64):
                rows = shuffled[lo : lo + 64]
                hidden = xs[rows] @ net[0] + net[1]
                act = np.maximum(hidden, 0)
                p = 1 / (1 + np.exp(-np.clip(act @ net[2] + net[3], -40, 40)))
                g = (p - y[rows]) / len(rows)
                back = g[:, None] * net[2][None, :] * (hidden > 0)
                grads = [xs[rows].T @ back + 1e-4 * net[0], back.sum(0), act.T @ g + 1e-4 * net[2], np.array([g.sum()])]
                step += 1
                for k, grad in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad**2
                    net[k] = net[k] - 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.net = [*net, mean, scale]
        if len(apart):  # the temperature with the least log loss on the rows set apart
            z, t = self.logits(x[apart]), y[apart]
            grid = np.geomspace(0.25, 8, 61)
            loss = [np.mean(np.logaddexp(0, z / k) - t * z / k) for k in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(at) - 1, self.prior)
        z = self.logits(self.pooled(data, at)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out() -> Column:
    """The fold that no label is learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_texts(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``train_rows`` labelled texts outside the held-out fold, whole:
    (k, quality, t, text). Equal rows of a table count once."""
    key = F.md5(F.concat(F.lit("quality|"), F.col("doc_id").cast("string")).cast("binary"))
    digest_of = F.md5(text_or_empty().cast("binary"))
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .select("doc_id", "quality", key.alias("k"))
        .distinct()
        .orderBy("k", "quality")
        .limit(train_rows)
    )
    own = docs.select("doc_id", "text")
    met = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "k", digest_of.alias("t"))  # train_rows rows at most
    names = cut(met.distinct().orderBy("k", "quality", "t").limit(train_rows))
    texts = own.withColumn("t", digest_of).join(F.broadcast(names), ["doc_id", "t"])
    return cut(texts.groupBy("k", "quality", "t").agg(F.first("text").alias("text")).repartition(TRAIN_TASKS, "k", "t"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of about CHUNK bytes of whole texts, with their rows."""
    for batch in batches:
        data, at = buffer(batch.column("text"))
        for a, b in groups(np.diff(at), CHUNK):
            yield batch.slice(a, b - a), data[at[a] : at[b]], at[a : b + 1] - at[a]


def word_sums(texts: DataFrame, model: Model) -> DataFrame:
    """(id, seen, s0, s1, ...): ``Model.around`` over all texts, one row for each token found."""
    columns = ["seen", *(f"s{j}" for j in range(DIM))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, 0
        for _, data, at in _each(batches):
            more = model.around(data, at)
            total, seen = total + more[0], seen + more[1]
        ids = np.flatnonzero(seen)
        if len(ids):
            numbers = np.column_stack([seen[ids], total[ids]]).astype(np.int64)  # whole numbers
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), *map(pa.array, numbers.T.copy())], ["id", *columns])

    each = texts.mapInArrow(run, "id int, " + ", ".join(f"{c} bigint" for c in columns))
    return each.groupBy("id").agg(*(F.sum(c).alias(c) for c in columns))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from the labelled documents outside the held-out fold. Texts are
    read in tasks; the driver gets the commonest words, the sums of each of their
    word vectors and one vector of each text."""
    ship(docs.sparkSession)
    texts = training_texts(docs, labels, train_rows)
    model = Model()
    shares = texts.agg(F.avg("quality"), F.count_distinct("quality")).first()
    if shares[0] is not None:
        model.prior = float(shares[0])
    if shares[1] < 2:
        return model
    top = np.uint64(1 << 63)  # keeps the order of unsigned hashes in signed longs

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in _each(batches):
            h, n = np.unique(_tokens(data, at)[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": pa.array((h ^ top).view(np.int64)), "n": pa.array(n.astype(np.int64))})

    common = (
        texts.mapInArrow(words, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
        .filter("n > 1").orderBy(F.desc("n"), "h").limit(VOCABULARY).collect()
    )
    model.choose_words(np.array([r.h for r in common], np.int64).view(np.uint64) ^ top, np.array([r.n for r in common], np.int64))

    parts = word_sums(texts, model).collect()  # a row for each token at most, however many tasks there are
    total, seen = np.zeros((_SHAPES + len(model.words), DIM)), np.zeros(_SHAPES + len(model.words))
    for id_, n, *sums in parts:
        total[id_], seen[id_] = sums, n
    model.set_vectors(total, seen)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in _each(batches):
            x = pa.array(list(model.pooled(data, at)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("k", "quality", "t")] + [x], ["k", "quality", "t", "x"])

    label = texts.schema["quality"].dataType.simpleString()
    rows = texts.mapInArrow(pool, f"k string, quality {label}, t string, x array<double>").collect()  # train_rows rows at most
    rows.sort(key=lambda r: (r.k, r.quality, r.t))
    return model.fit_network(np.array([r.x for r in rows]), np.array([r.quality for r in rows], np.float64))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score."""
    own = docs.select([c for c in docs.columns if c != "score"])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffer(batch.column("text"))
            parts = [sent.value.score(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in groups(np.diff(at), CHUNK)]
            out = {f.name: batch.column(f.name) for f in batch.schema}
            out["score"] = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_pydict(out)

    return spread(own).mapInArrow(run, T.StructType(own.schema.fields + [T.StructField("score", T.DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    model = learn(docs, labels)
    scored = score_documents(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
