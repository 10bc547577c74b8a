"""Language identification by cross-parsing entropy (operator 7).

For each language a suffix automaton of labelled text is built. A document is
cut greedily into the longest phrases that occur in the language's text (walk
the automaton until no transition is left, start the next phrase there). The
language that needs the fewest phrases for each letter wins.

Learning uses a bounded sample: of each language at most ``TRAIN_DOCS``
different texts in a seeded order, and of each of them one stretch from a seeded
place. All languages together give ``TRAIN_CHARS`` symbols in equal shares, so
what reaches the driver is bounded whatever the number of languages; a stretch
has ``LEAST_STRETCH`` symbols or more where the share holds them. Prediction reads whole texts: a text becomes a row of symbols
(lower-case letters; any other run is one space) cut into stretches of
``STRETCH``, and many stretches of many documents walk the automata at the same
time in numpy. A phrase ends with its stretch, for every language alike.

Score: phrases of the second best language over those of the best two (above
0.5 if one language wins, nearer to 1 the clearer); 1 if only one language was
learned. Ties go to the language that sorts first.

Edge cases: a null text or one without letters is ``und`` with score 0; so is
everything if no labelled text was given; labels without letters in their texts
teach nothing; null doc_ids count as the empty text in the fold; repeated rows
get the same prediction; an empty table gives an empty result. Columns named
``lang_pred`` or ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.llm.common import cut, small_side, spread
from riskforge.llm.words import groups

TRAIN_DOCS = 60
TRAIN_CHARS = 160_000
LEAST_STRETCH = 200
STRETCH = 1024
CHUNK = 1 << 20
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states; 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


class Model:
    """The automata of all languages in one table: row = state, column =
    symbol. An entry is the next row's place in the table; where no transition
    is left, it is the complement of the place to which the root goes."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        streams = {k: _stream(texts[k].lower()) for k in self.languages}
        points = np.unique(np.concatenate(list(streams.values()))) if streams else np.zeros(0, np.uint32)
        self.points = points  # the symbols 0 .. n - 1; n is any other letter
        self.width = len(points) + 1
        rows: list[np.ndarray] = []
        self.roots: list[int] = []
        base = 0
        for k in self.languages:
            automaton = suffix_automaton(np.searchsorted(points, streams[k]).tolist())
            root = np.full(self.width, ~(base * self.width), np.int64)
            for c, to in automaton[0].items():
                root[c] = ~((base + to) * self.width)
            table = np.tile(root, (len(automaton), 1))
            for s, moves in enumerate(automaton):
                if moves and s:  # at the root, before a text and after a strange letter, any letter begins a phrase
                    table[s, list(moves)] = (base + np.fromiter(moves.values(), np.int64)) * self.width
            rows.append(table.astype(np.int32))
            self.roots.append(base * self.width)
            base += len(automaton)
        self.table = np.concatenate(rows).ravel() if rows else np.zeros(0, np.int32)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text in each language, and in the last column its
        letters."""
        streams = [_stream(t.lower()) for t in texts]
        out = np.zeros((len(texts), len(self.languages) + 1), np.int64)
        sizes = np.array([len(s) for s in streams])
        out[:, -1] = [int((s != 32).sum()) for s in streams]
        if not sizes.sum() or not self.languages:
            return out
        symbol = np.full(0x110000, self.width - 1, np.int32)
        symbol[self.points] = np.arange(len(self.points))
        flat = symbol[np.concatenate(streams)]
        n = -(-sizes // STRETCH)  # stretches of each text
        owner = np.repeat(np.arange(len(texts)), n)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        begin = np.repeat(np.cumsum(sizes) - sizes, n) + number * STRETCH
        length = np.minimum(STRETCH, np.repeat(sizes, n) - number * STRETCH)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(owner), axis=1)
        count = np.zeros(state.shape, np.int32)
        active = np.searchsorted(-length, -np.arange(STRETCH), "left")  # stretches longer than j
        for j in range(int(length[0])):
            m = int(active[j])
            to = self.table[state[:, :m] + flat[begin[:m] + j][None, :]]
            end = to >> 31  # -1 where a phrase begins
            count[:, :m] -= end
            state[:, :m] = to ^ end
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(owner, weights=count[k], minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        phrases = self.phrases(texts)
        names, scores = [], []
        for row in phrases.tolist():
            *parts, n = row
            if not n or not parts:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = min(range(len(parts)), key=parts.__getitem__)
            rest = [p for k, p in enumerate(parts) if k != best]
            names.append(self.languages[best])
            scores.append(min(rest) / (min(rest) + parts[best]) if rest else 1.0)
        return names, scores


def _stream(text: str) -> np.ndarray:
    """Code points of the letters, other runs as one space; no letters: nothing."""
    points = code_points(text)
    is_letter = letters()[points]
    if not is_letter.any():
        return points[:0]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of each other run
    return np.where(is_letter, points, np.uint32(32))[keep]


def held_out() -> Column:
    """The fold that no label is learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(labelled: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model:
    """A model from rows of (text, lang); null labels teach nothing."""
    key = F.md5(F.col("text").cast("binary")).alias("key")
    named = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", key).distinct()
    order = W.partitionBy("lang").orderBy("key")
    names = cut(named.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= train_docs))
    rows, languages = names.agg(F.count(F.lit(1)), F.count_distinct("lang")).first()
    share = train_chars // max(1, languages)
    each = max(1, min(share, max(LEAST_STRETCH, share // train_docs)))
    begin = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - F.lit(each), F.lit(0)) + F.lit(1)) + F.lit(1)
    some = labelled.select("lang", key, F.substr("text", begin.cast("int"), F.lit(each)).alias("stretch"))
    sample = some.join(small_side(names, rows), ["lang", "key"]).groupBy("lang", "k").agg(F.first("stretch").alias("stretch")).collect()
    texts: dict[str, list[str]] = {}
    for row in sorted(sample, key=lambda r: (r.lang, r.k)):
        texts.setdefault(row.lang, []).append(row.stretch)
    return Model({k: " ".join(v)[:share] for k, v in texts.items()})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score."""
    own = docs.select([c for c in docs.columns if c not in ("lang_pred", "score")])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names: list[str] = []
            scores: list[float] = []
            for a, b in groups(np.array([len(t) for t in texts], np.int64), CHUNK):
                some = sent.value.predict(texts[a:b])
                names += some[0]
                scores += some[1]
            out = {f.name: batch.column(f.name) for f in batch.schema}
            out |= {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_pydict(out)

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return spread(own).mapInArrow(run, T.StructType(own.schema.fields + added))


def digest(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query; learns outside the held-out fold."""
    model = learn(docs.filter(~held_out()).select("text", "lang"))
    plain = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(plain, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language could be told, as they were."""
    model = learn(docs.filter(~held_out()).select("text", "lang"))
    return identify(docs, model).filter(F.col("lang_pred") != UNKNOWN).select(docs.columns)
