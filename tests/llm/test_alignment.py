import hashlib
import random
from collections import Counter
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

import __spark_entry__ as E
from riskforge.llm import alignment as A
from tests.llm import cases

PATHS = A.default_tokenizers()


def ends(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def test_align_finds_the_common_ends():
    rng = random.Random(1)
    for _ in range(400):
        last = rng.randint(1, 300)
        some = [sorted({*rng.sample(range(1, last + 1), rng.randint(0, last)), last}) for _ in range(2)]
        if rng.random() < 0.5:  # long stretches
            some[1] = sorted({*some[0], *some[1][:2]} - set(some[0][3:4])) if some[0][3:4] != [last] else some[0]
        a, b = A.align(*some)
        common = sorted(set(some[0]) & set(some[1]))
        assert [some[0][i] for i in a] == common and [some[1][j] for j in b] == common


def cut(ids, at, common):
    """The ids of each group, comma-joined."""
    out = [[]]
    for i, e in zip(ids, at):
        out[-1].append(str(i))
        if e in common:
            out.append([])
    return [",".join(g) for g in out[:-1]]


def expected(texts):
    """From the libraries, and sets of offsets."""
    lib = Tokenizer.from_file(PATHS[0])
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(x): x for x in printed} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printed)}
    rows, count = [], Counter()
    for text in texts:
        a = lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        x = [bytes(sign[c] for c in lib.id_to_token(i)) for i in a]
        y = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            rows.append(None)
            continue
        ea, eb = ends(x), ends(y)
        own = set(ea) & set(eb)
        common = sorted(own)
        links = list(zip((i for i, e in zip(a, ea) if e in own), (j for j, f in zip(b, eb) if f in own)))
        count.update(links)
        groups = ";".join(f"{p}|{q}" for p, q in zip(cut(a, ea, own), cut(b, eb, own)))
        rows.append((len(a), len(b), len(common), links, groups))
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            digest = hashlib.sha256(r[4].encode()).hexdigest()
            out.append((*r[:3], len(r[3]), sum(count[p] == best[p[1]] for p in r[3]), sum(count[p] for p in r[3]), digest))
    return out, count


def test_rows_equal_the_libraries(spark, monkeypatch):
    extra = ["a <|endoftext|> b </s> <s>", " two  spaces ", "tab\tand\nline", "a\x00b", "▁x", "é漢字😀 ﬁ İ", "12,345.67", "   "]
    docs = cases.documents(spark).select("doc_id", "text", "n", "block")
    docs = docs.unionByName(spark.createDataFrame([(5000 + k, t) for k, t in enumerate(extra)], "doc_id bigint, text string"), allowMissingColumns=True)
    texts = [(r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect()]
    want, count = expected([t for _, t in texts])
    wide = sorted(((i, *w) for (i, _), w in zip(texts, want)), key=lambda r: (r[0], r[1], r[2]))
    for small in (A.PAIRS, 0):  # the pair table broadcast, and joined by shuffle
        monkeypatch.setattr(A, "PAIRS", small)
        got = sorted(((r.doc_id if r.doc_id is not None else -1, *tuple(r)[1:]) for r in A.alignments(docs).collect()), key=lambda r: (r[0], r[1], r[2]))
        assert got == wide
    assert {(r.a, r.b): r.total for r in A.pair_counts(docs).collect()} == dict(count)


def test_token_bytes_decode(spark):
    own = A.tokenizers(*PATHS)
    plain = ByteLevel()
    for i in range(0, 50_000, 97):
        raw = own.a_bytes.data[own.a_bytes.begin[i] :][: own.a_bytes.sizes[i]].tobytes()
        assert raw.decode("utf-8", "replace") == plain.decode([own.a.library.id_to_token(i)])


def test_empty_table_and_query(spark):
    assert A.alignments(cases.none(spark)).count() == 0
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()
    want, _ = expected([r.text or "" for r in docs])
    got = {r.doc_id: tuple(r)[1:] for r in E.queries()["op13_alignment"](spark, cases.SF).collect()}
    for r, w in zip(docs, want):
        assert got[r.doc_id] == w


def test_texts_of_a_chunk_are_aligned_in_a_row(monkeypatch):
    """One pass over many texts gives each text what it gets alone, with texts between that are not given back."""
    own = A.tokenizers(*PATHS)
    texts = ["one two three", "", "a  b\tc", "ﬁne ½", "a▁b", "\x00", "unbelievable 12,5 漢字 é", "x", "one two three", "ab" * 300]
    calls, plain = [], A.align
    monkeypatch.setattr(A, "align", lambda *ends: calls.append(1) or plain(*ends))
    rows, digests, links = A._aligned(own, texts)
    assert len(calls) == 1
    alone = [A._aligned(own, [t]) for t in texts]
    assert rows.T.tolist() == [r[0][:, 0].tolist() for r in alone] and digests == [r[1][0] for r in alone]
    assert links.tolist() == [x for r in alone for x in r[2].tolist()]
    assert [bool(d) for d in digests].count(False) >= 2


def test_blocks_are_full_whatever_batches_they_come_in(monkeypatch):
    """Rows that come one at a time give the blocks of rows that come at once, and slices of a block what it gets whole."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("one", "two  ", "漢字", "é,", "ab" * 9)) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    texts[7], texts[40:44], texts[50] = "long " * 200, ["", "", "", ""], "a▁b"
    ids = [None if k % 9 == 0 else k // 2 for k in range(60)]
    table = pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts)})
    monkeypatch.setattr(A, "CHUNK", 500)
    monkeypatch.setattr(A, "TEXTS", 25)
    run = A._encode(*PATHS)
    at_once = [b.to_pylist()[0] for b in run(iter([table]))]
    assert [b.to_pylist()[0] for b in run(table.slice(k, 1) for k in range(60))] == at_once
    monkeypatch.setattr(A, "SLICE", 60)
    assert [b.to_pylist()[0] for b in run(iter([table.slice(0, 31), table.slice(31)]))] == at_once
    assert [i for b in at_once for i in b["doc_ids"]] == ids and 5 < len(at_once) < 30
    low, own = 0, A.tokenizers(*PATHS)
    for b in at_once:
        part = texts[low : low + len(b["doc_ids"])]
        rows, digests, links = A._aligned(own, part)
        assert len(part) == 1 or sum(map(len, part)) <= 500 and len(part) <= 25
        assert [b["n_a"], b["n_b"], b["n_groups"]] == rows.tolist() and b["digests"] == digests
        pairs = np.array(b["a"], np.int64) << 32 | np.array(b["b"], np.int64)
        assert pairs[np.array(b["links"], np.int64)].tolist() == links.tolist()
        low += len(part)


def test_batches_and_row_groups_are_bounded(spark, monkeypatch, tmp_path):
    """Neither function is handed more than some bytes or one block at a time, and a row group holds few blocks."""
    encode, finish, folder = A._encode, A._finish, str(tmp_path)

    def told(name, plain):
        def run(batches):
            def each():
                for b in batches:
                    with open(f"{folder}/{name}-{uuid4().hex}", "w") as f:
                        f.write(f"{b.num_rows} {b.nbytes}")
                    yield b

            yield from plain(each())

        return run

    monkeypatch.setattr(A, "_encode", lambda *paths: told("encode", encode(*paths)))
    monkeypatch.setattr(A, "_finish", told("finish", finish))
    monkeypatch.setattr(A, "BATCH", 1 << 16)
    monkeypatch.setattr(A, "ROW_GROUP", 2)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    stored, kept = A.stored, {}
    monkeypatch.setattr(A, "stored", lambda df, name, **options: kept.setdefault(name, stored(df, name, **options)))
    docs = spark.range(120_000).selectExpr("id doc_id", "if(id % 20 = 0, repeat('one two ', 20), '') text")
    rows = A.alignments(docs).groupBy("n_a", "n_links", "n_best").count().collect()
    assert sorted((r.n_a > 0, r["count"]) for r in rows) == [(False, 114_000), (True, 6_000)]
    sizes = {name: [tuple(map(int, f.read_text().split())) for f in tmp_path.glob(f"{name}-*")] for name in ("encode", "finish")}
    assert max(n for _, n in sizes["encode"]) <= 2 * A.BATCH and sum(n for n, _ in sizes["encode"]) == 120_000
    blocks = kept["alignment"].count()
    assert [n for n, _ in sizes["finish"]] == [1] * blocks and blocks >= 12
    groups = [m.row_group(k).num_rows for m in (pq.read_metadata(f.removeprefix("file://")) for f in kept["alignment"].inputFiles()) for k in range(m.num_row_groups)]
    assert sum(groups) == blocks and max(groups) <= A.ROW_GROUP
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
