"""Hard rows that every operator has to take, and plain versions of the rules."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

#: columns of documents, and others named like columns that operators add
COLUMNS = [
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("shard", T.StringType()), ("score", T.StringType()), ("hits", T.IntegerType()),
    ("items", T.StringType()), ("spans", T.StringType()), ("size", T.StringType()), ("t", T.StringType()),
    ("n", T.IntegerType()), ("label", T.IntegerType()), ("lang_pred", T.IntegerType()), ("block", T.IntegerType()),
]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in COLUMNS])


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def prose(rng: random.Random, n: int, stems: str) -> str:
    parts = stems.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, rows: int = 60, seed: int = 1):
    """Prose in two languages, copies, near copies, and every odd row."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        lang = rng.choice(["aa", "bb"])
        text = prose(rng, rng.randint(20, 120), "lo ra mi ten dus" if lang == "aa" else "sch öb ung ket zwi")
        out.append((i, text, lang, f"s{rng.choice([0, 0, 0, 1, 2, 3, 4])}"))
    base = prose(rng, 200, "lo ra mi ten dus").split()
    for k in range(6):  # near copies, each with one other word
        w = list(base)
        w[10 + 30 * k] = "changed"
        out.append((1000 + k, " ".join(w), "aa", "s0"))
    out += [
        (2000, None, None, None), (2001, "", "aa", "s1"), (2002, "!!! ... 123 --", None, "s1"), (2003, "!!! ... 123 --", "aa", "s0"),
        (2004, "one two", "aa", "s0"), (2005, "One, two!", "bb", None), (None, "row without an id lora", "aa", "s2"),
        (2006, out[3][1], "aa", "s9"), (2007, out[3][1].upper(), "bb", "s9"), (out[5][0], *out[5][1:]), (out[5][0], *out[5][1:]),
        (2008, prose(rng, 40_000, "lo ra mi ten dus"), "aa", "s0"), (2009, "x" * 300_000, None, "s0"),
        (2010, "  é漢字 emoji 😀 İ ß", "bb", "s0"),
    ]
    fill = tuple(None if isinstance(t, T.IntegerType) else "clash" for n, t in COLUMNS[5:])
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *fill) for r in out], SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None) -> Counter:
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0))


def near_classes(texts: list[str]) -> list[int]:
    """Class of every text (number of its first text), by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    sizes = [sum(s.values()) for s in sets]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(texts)):
        for a in range(b):
            same = texts[a] == texts[b]
            if not same and min(sizes[a], sizes[b]) >= 0.8 * max(sizes[a], sizes[b]) and sizes[a]:
                shared = sum((sets[a] & sets[b]).values())
                same = shared >= 0.8 * (sizes[a] + sizes[b] - shared)
            if same and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(len(texts))]
