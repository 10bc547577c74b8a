import random
import zlib

import numpy as np
import pytest
import zstandard

import __spark_entry__ as E
from riskforge.llm import seekable, token_output
from riskforge.llm.byte_bpe import Encoder
from tests.llm import cases


@pytest.fixture(scope="module")
def library():
    return Encoder(token_output.default_tokenizer())


def ids_of(library, text):
    return [*library.library.encode(text or "", add_special_tokens=False).ids, 2]


def test_encoder_equals_the_library(library):
    rng = random.Random(5)
    signs = "aab'strevldm'' \n\t 12!.é漢 　½²ⅷ_​😀<|>A\r"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += ["I'll don't we're <|endoftext|> x", "", "  ", " a  b   \n\n c ", "'s's'll'x", "it'S", "x" * 5000]
    ids, counts = library.encode(texts)
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert own.tolist() == ids_of(library, text)[:-1], text


def test_encoder_forgets_without_harm(library, monkeypatch):
    from riskforge.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    for text in ("one two three", "four five six seven eight nine", "one two three"):
        assert library.encode([text])[0].tolist() == ids_of(library, text)[:-1]


def test_file_round_trip(tmp_path):
    path = tmp_path / "x.ids.zst"
    docs = {None: [2], -5: [1, 50000, 2], 7: list(range(3000)), 9: []}
    with path.open("wb") as out:
        writer = seekable.Writer(out, 2)
        for doc_id, ids in docs.items():
            writer.add(doc_id, *seekable.frame(np.array(ids, np.uint32), 2))
        writer.close()
    with path.open("rb") as file:
        reader = seekable.Reader(file, path.stat().st_size)
        assert reader.doc_ids == list(docs)
        assert [x.tolist() for x in reader] == list(docs.values())
        assert reader.ids(2).tolist() == docs[7]
    # any zstandard reader sees all ids in a row
    plain = zstandard.ZstdDecompressor().stream_reader(path.open("rb"), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u2").tolist() == [i for ids in docs.values() for i in ids]
    raw = bytearray(path.read_bytes())
    raw[reader.begin[2] + 40] ^= 1
    path.write_bytes(raw)
    with path.open("rb") as file, pytest.raises((ValueError, zstandard.ZstdError)):
        seekable.Reader(file, len(raw)).ids(2)


def expected(library, rows):
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array(ids_of(library, text), "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_registered_query_against_the_library(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, E.queries()["op8_token_output"](spark, cases.SF).collect())) == expected(library, docs)


def test_several_files_and_hard_rows(spark, library, tmp_path):
    docs = cases.documents(spark)
    manifest = token_output.write(docs, f"file://{tmp_path}/out", docs_in_file=20)
    rows = manifest.orderBy("file").collect()
    assert len(rows) > 2 and rows[0].start == 0
    back = token_output.read(manifest).orderBy("start").collect()
    ends = [r.start + r.n_tokens for r in back]
    assert [r.start for r in back] == [0, *ends[:-1]]
    assert [r.doc_id for r in back] == sorted((r.doc_id for r in back), key=lambda d: (d is not None, d))
    texts = sorted((str(r.doc_id), tuple(ids_of(library, r.text))) for r in docs.collect())
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in back) == texts
    one = {r.doc_id: r.text for r in docs.collect()}
    found = {}
    for r in rows:
        found |= token_output.lookup(r.path, [2004, 2009])
    assert {k: v.tolist() for k, v in found.items()} == {k: ids_of(library, one[k]) for k in (2004, 2009)}
    assert token_output.digest(spark, cases.none(spark)).collect() == []


def test_new_pieces_make_no_whole_encodings(monkeypatch):
    """Pieces met for the first time go to the library's model alone, with the library's ids."""
    own = Encoder(token_output.default_tokenizer())
    texts = ["one  new\tword,漢字 and é😀\x00 it's 12½", " again one", "", "\n \n"]
    want = [own.library.encode(t, add_special_tokens=False).ids for t in texts]

    class Model:
        model, pre_tokenizer = own.library.model, own.library.pre_tokenizer

    monkeypatch.setattr(own, "library", Model)
    ids, counts = own.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
