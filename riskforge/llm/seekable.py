"""Seekable file of token ids: one independent zstandard frame for each
document, then a table of doc_ids, then a seek table.

Layout, all numbers little-endian:

* frame after frame, a document's ids as unsigned integers of ``width`` bytes;
* a skippable frame (magic 0x184D2A50) with ``width`` (1 byte), the number of
  documents (8 bytes), their doc_ids (8 bytes each, signed) and a bit for each
  that says whether the doc_id is null;
* a skippable frame (magic 0x184D2A5E) with the seek table of the public
  zstandard seekable format: for each frame its compressed and plain size and
  the low 32 bits of the plain bytes' XXH64 (4 bytes each), then the number of
  frames, a descriptor byte with the checksum flag, and the magic 0x8F92EAB1.
  The doc_id table is the last entry, of plain size 0.

Any zstandard reader decompresses the whole file to all ids in a row; a reader
of single documents reads the tables at the end and the wanted frames only.
"""

from __future__ import annotations

import struct
from functools import cache

import numpy as np
import xxhash
import zstandard

_SKIP, _SEEK, _FOOT = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80


def checksum(plain: bytes) -> int:
    return xxhash.xxh64(plain).intdigest() & 0xFFFFFFFF


@cache
def _compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, write_content_size=True)


@cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def frame(ids: np.ndarray, width: int, level: int = 3) -> tuple[bytes, int, int]:
    """A document's frame, its plain size and checksum."""
    plain = ids.astype(f"<u{width}").tobytes()
    return _compressor(level).compress(plain), len(plain), checksum(plain)


class Writer:
    """Appends frames to an open binary file; ``close`` adds the tables."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.doc_ids: list[int | None] = []
        self.entries: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, compressed: bytes, plain: int, check: int) -> None:
        self.out.write(compressed)
        self.doc_ids.append(doc_id)
        self.entries.append((len(compressed), plain, check))

    def close(self) -> None:
        n = len(self.doc_ids)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        null = np.packbits(np.array([d is None for d in self.doc_ids], bool), bitorder="little").tobytes()
        table = struct.pack("<BQ", self.width, n) + ids + null
        self.out.write(struct.pack("<II", _SKIP, len(table)) + table)
        entries = np.array([*self.entries, (len(table) + 8, 0, checksum(b""))], "<u4").tobytes()
        foot = struct.pack("<IBI", n + 1, _CHECKSUMS, _FOOT)
        self.out.write(struct.pack("<II", _SEEK, len(entries) + len(foot)) + entries + foot)


class Reader:
    """Reads the tables of an open binary file, then documents by number."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - 9)
        frames, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != _FOOT or not flags & _CHECKSUMS:
            raise ValueError("no seek table")
        at = size - 9 - 12 * frames
        file.seek(at - 8)
        head = file.read(8 + 12 * frames)
        if struct.unpack_from("<II", head) != (_SEEK, 12 * frames + 9):
            raise ValueError("broken seek table")
        entries = np.frombuffer(head, "<u4", offset=8).reshape(frames, 3).astype(np.int64)
        self.sizes, self.plain, self.checks = entries[:-1].T
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        file.seek(int(self.begin[-1]) + 8)
        table = file.read(int(entries[-1, 0]) - 8)
        self.width, n = struct.unpack_from("<BQ", table)
        null = np.unpackbits(np.frombuffer(table, np.uint8, offset=9 + 8 * n), bitorder="little")[:n]
        self.doc_ids = [None if x else int(d) for d, x in zip(np.frombuffer(table, "<i8", n, 9), null)]

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, k: int) -> np.ndarray:
        """The ids of document number ``k``; only its frame is read."""
        self.file.seek(int(self.begin[k]))
        return self._plain(self.file.read(int(self.sizes[k])), k)

    def _plain(self, compressed: bytes, k: int) -> np.ndarray:
        plain = _decompressor().decompress(compressed, max_output_size=int(self.plain[k])) if self.plain[k] else b""
        if len(plain) != self.plain[k] or checksum(plain) != self.checks[k]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(plain, f"<u{self.width}")

    def __iter__(self):
        self.file.seek(0)
        for k in range(len(self)):
            yield self._plain(self.file.read(int(self.sizes[k])), k)
