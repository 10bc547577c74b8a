"""Fast whole-text encoding with a byte-level BPE file of the tokenizers library.

The library's pre-tokenizer cuts a text into pieces that are encoded on their
own, so a piece needs encoding once for all its occurrences. Here the pieces of
many texts are found at once in numpy by the pre-tokenizer's rule (classes of
code points are asked from the library itself), new pieces are encoded by the
library's model of the file, and the ids of all texts are put together from the
pieces' ids. The result is the library's. Texts that hold an added token's
string go to the library whole.
"""

from __future__ import annotations

import json
import os
from functools import cache
from itertools import chain

import numpy as np

from riskforge.llm.words import _power, mix64, ordered_ids

_SPACE, _LETTER, _NUMBER, _OTHER, _UNSEEN = 0, 1, 2, 3, 255
#: The signs by which a byte-level model knows the bytes: what Latin-1 prints stands for itself.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SIGNS = {x: chr(x) for x in _PRINTED} | {x: chr(256 + k) for k, x in enumerate(x for x in range(256) if x not in _PRINTED)}
_SIGN_OF = "".join(SIGNS[x] for x in range(256))
#: Pieces whose ids are remembered in a worker.
REMEMBERED = 300_000


class Encoder:
    def __init__(self, path: str, plain_text: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain_text
        with open(path, encoding="utf-8") as f:
            rule = json.load(f)
        pre = rule.get("pre_tokenizer") or {}
        self.plain = (
            rule.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and rule.get("truncation") is None
            and rule.get("padding") is None
        )
        self.added = [t["content"] for t in rule.get("added_tokens", []) if not (plain_text and t.get("special"))]
        self.classes = np.full(0x110000, _UNSEEN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of pieces, sorted
        self.slot = np.zeros(0, np.int64)  # their places in begin and size
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _class(self, points: np.ndarray) -> np.ndarray:
        out = self.classes[points]
        if (out == _UNSEEN).any():
            whole = lambda s: len(self.library.pre_tokenizer.pre_tokenize_str(s)) == 1
            for c in np.unique(points[out == _UNSEEN]).tolist():
                x = chr(c)
                self.classes[c] = _LETTER if whole("a" + x) else _NUMBER if whole("1" + x) else _OTHER if whole("!" + x) else _SPACE
            out = self.classes[points]
        return out

    def _piece_starts(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Flags of the code points with which a piece begins. ``at``: where
        the (non-empty) texts begin, and the end."""
        n = len(points)
        kind = self._class(points)
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        first[at[:-1]] = True
        last[at[1:] - 1] = True
        before = np.full(n, _UNSEEN, np.uint8)
        before[1:] = kind[:-1]
        before[first] = _UNSEEN
        after = np.full(n, _UNSEEN, np.uint8)
        after[:-1] = kind[1:]
        after[last] = _UNSEEN
        space = kind == _SPACE
        blank_before = np.zeros(n, bool)
        blank_before[1:] = points[:-1] == 0x20
        blank_before &= ~first
        # a run of white space leaves its last sign to what follows
        start = space & ((before != _SPACE) | ((after != _SPACE) & ~last))
        start |= ~space & (before != kind) & ~blank_before
        # contractions
        for i in np.flatnonzero((points == 0x27) & start & (after == _LETTER)).tolist():
            a = chr(points[i + 1])
            b = chr(points[i + 2]) if i + 2 < n and not last[i + 1] else ""
            width = 2 if a in "stmd" else 3 if a + b in ("re", "ve", "ll") else 0
            if width:
                start[i + 1] = False
                if not last[i + width - 1]:
                    start[i + width] = True
        return start

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        special = [i for i, t in enumerate(texts) if not self.plain or any(a in t for a in self.added)]
        if special:
            parts = self._library(texts) if not self.plain else None
            if parts is None:
                own = set(special)
                rest = self._pieces([t if i not in own else "" for i, t in enumerate(texts)])
                parts = np.split(rest[0], np.cumsum(rest[1])[:-1])
                for i, ids in zip(special, self._library([texts[i] for i in special])):
                    parts[i] = ids
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return self._pieces(texts)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        if not lengths.sum():
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        some = lengths > 0
        at = np.concatenate([[0], np.cumsum(lengths[some])])
        s = np.flatnonzero(self._piece_starts(points, at))
        e = np.append(s[1:], len(points))
        p, q = _power(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * p[: len(points)], out=sums[1:])
        values, which = ordered_ids(mix64((sums[e] - sums[s]) * q[s]))
        place = np.searchsorted(self.known, values)
        new = np.ones(len(values), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != values[inside]
        if new.any():
            example = np.empty(len(values), np.int64)
            example[which] = np.arange(len(which))
            rows = example[new]
            self._learn(values[new], [joined[a:b] for a, b in zip(s[rows].tolist(), e[rows].tolist())])
        slot = self.slot[np.searchsorted(self.known, values)][which]
        sizes = self.size[slot]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[slot] - (ends - sizes), sizes) + np.arange(ends[-1])]
        counts = np.zeros(len(texts), np.int64)
        bound = np.concatenate([[0], ends])[np.searchsorted(s, at)]
        counts[some] = np.diff(bound)
        if len(self.known) > REMEMBERED:
            self._forget()
        return ids, counts

    def _learn(self, values: np.ndarray, pieces: list[str]) -> None:
        tokens = self.library.model.tokenize  # a piece has nothing to normalize or cut
        lists = [[t.id for t in tokens(x.encode().decode("latin-1").translate(_SIGN_OF))] for x in pieces]
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.array(list(chain.from_iterable(lists)), np.uint32)
        begin = len(self.ids) + np.cumsum(sizes) - sizes
        slot = np.concatenate([self.slot, len(self.begin) + np.arange(len(sizes))])
        known = np.concatenate([self.known, values])
        order = np.argsort(known, kind="stable")
        self.known, self.slot = known[order], slot[order]
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, flat])


@cache
def encoder(path: str, plain_text: bool = False) -> Encoder:
    """One encoder for each file and worker. ``plain_text``: strings of special
    tokens are ordinary text. The library's own threads stay off, as every core
    has a task of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, plain_text)
