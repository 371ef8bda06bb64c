"""Packing along the curve, against the tokenizer on whole texts."""

import zlib
from collections import Counter, defaultdict

import fixtures as fx
import numpy as np
import oracle
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from folioflow.llm import curve_packing as cp
from folioflow.llm import texts as fixed
from folioflow.llm import word_strings
from folioflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [np.array([*e.ids, cp.END_ID], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_pieces(rows, expected, crc, sequence=cp.SEQUENCE):
    """`expected`: (doc_id, ids) of every row; `crc`: gets the checksum of the ids of a piece."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    total = sum(len(ids) for _, ids in expected)
    sizes = []
    for s in range(len(by_seq)):
        at = 0
        for offset, length in sorted(by_seq[s]):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert sum(sizes) == total and max(sizes) <= sequence
    assert all(n == sequence or n & (n - 1) == 0 for n in sizes), "a sequence that is padded"
    wanted = Counter()
    for doc, ids in expected:
        wanted[doc, len(ids)] += 1
    assert Counter((d, r["doc_tokens"]) for d, own in by_doc.items() for r in own if r["start"] == 0) == wanted
    for doc, ids in expected:
        if wanted[doc, len(ids)] == 1 and sum(n for (d, _), n in wanted.items() if d == doc) == 1:
            at = 0
            for r in sorted(by_doc[doc], key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(ids))
                assert crc(r) == zlib.crc32(ids[at : at + r["length"]].tobytes()), (doc, at)
                at += r["length"]
            assert at == len(ids)


def test_query(spark):
    docs = fx.pairs(fx.table(spark, "documents"))
    rows = QUERIES["op11_curve_packing"](spark, oracle.SF_DIR).collect()
    check_pieces(rows, list(zip([d for d, _ in docs], whole_ids([t for _, t in docs]), strict=True)), lambda r: r["ids_crc32"])


@pytest.mark.parametrize("sequence", [64, 4096])
def test_odd_documents(spark, sequence):
    extra = [(200, "<|endoftext|> it's We'll ́x é \xa0a b IİΣ 12345 a\x00b", "en", "a"), (201, "x1-" * 50_000, "en", "a"), (202, "q" * 3000, "en", "a")]
    docs = fx.documents(spark, extra)
    pairs = fx.pairs(docs)
    pieces = cp.pack(docs, PATH, sequence, range_tokens=500)
    check_pieces(pieces.collect(), list(zip([d for d, _ in pairs], whole_ids([t for _, t in pairs]), strict=True)), lambda r: zlib.crc32(r["ids"]), sequence)
    whole = {r["sequence_id"]: r for r in cp.sequences(pieces).collect()}
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole.values()) and len(whole) == len({r["sequence_id"] for r in pieces.collect()})


def test_empty_table(spark):
    assert cp.pack(fx.empty(spark), PATH).collect() == []


def test_long_pieces_are_cut_where_the_tokenizer_cuts(monkeypatch):
    encoder = cp.PieceEncoder(PATH)
    text = "abc12def-#!ghi'sJK9léḿ" * 40
    plain = encoder([text])[0]
    assert np.frombuffer(plain, "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(cp, "LONG", 50)
    assert cp.PieceEncoder(PATH)([text])[0] == plain


def test_pieces_encoded_together(monkeypatch):
    """With few pieces kept, and with and without a separator, as one by one."""
    monkeypatch.setattr(cp, "KEPT", 5)
    monkeypatch.setattr(cp, "TOGETHER", 4)
    pieces = ["a,", "½", "x½y", "'s", "ḿ", "12a", "!!", "ǅ", "中文", "a,b", "\x00", "é'", "q" * 100, "ÀÖß", "Straße", "abcdefghijk", "x"]
    encoder = cp.PieceEncoder(PATH)
    assert encoder.separator is not None and encoder.words_end
    wanted = [np.array(e.ids, "<u2").tobytes() for e in encoder.tokenizer.encode_batch(pieces, add_special_tokens=False)]
    for _ in range(3):
        assert encoder(pieces) == wanted and encoder(pieces[::-1]) == wanted[::-1]
    encoder.separator, encoder.words_end = None, False
    encoder.kept.clear()
    assert encoder(pieces) == wanted


def test_pieces_are_cut_where_the_tokenizer_cuts():
    """Every pair of ASCII characters within a word, with letters, signs and marks around: whole, and cut by the table."""
    encoder = cp.PieceEncoder(PATH)
    texts = [f"{x}{chr(a)}{chr(b)}{y}" for a in range(0x21, 0x7F) for b in range(0x21, 0x7F) for x, y in (("", "s"), ("é", "re"), ("'", "\u0301"))]
    column = pa.array([t.encode() for t in texts])
    pieces, row, _ = word_strings.word_runs(*fixed.flat(column), fixed.NOT_SPACE_BYTE, breaks=cp.BREAKS)
    ids = encoder(cp._strings(pieces))
    joined = [b"" for _ in texts]
    for r, own in zip(row.tolist(), ids, strict=True):
        joined[r] += own
    assert b"".join(pieces.to_pylist()) == "".join(texts).encode() and len(pieces) > len(texts)
    wanted = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(j, "<u2").tolist() for j in joined] == [e.ids for e in wanted]


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = cp.hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    along = cells[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_near_copies_lie_close(spark):
    """Documents of one vocabulary follow each other more often than by chance, and copies stand together."""
    rows = [(i, fx.prose(9, 80) if i % 3 == 0 else " ".join(fx.prose(i, 80).split(" ")) + " zz" * 40, "en", "a") for i in range(90)]
    pieces = cp.pack(fx.documents(spark).limit(0).unionByName(fx.documents(spark, rows).where("doc_id < 90")), PATH).collect()
    order = [r["doc_id"] for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
    copies = [i for i, d in enumerate(order) if d in {r[0] for r in rows if r[0] % 3 == 0 and r[0] > 13}]
    assert copies[-1] - copies[0] <= len(copies) + 4


@pytest.mark.parametrize("total", [0, 1, 4095, 4096, 4097, 10_000])
def test_tail_is_cut_at_powers_of_two(total):
    edges = [*cp.tail_edges(total), total]
    assert edges[0] == total - total % cp.SEQUENCE
    assert all(n & (n - 1) == 0 for n in np.diff(edges))


def test_a_worker_holds_little_beside_its_batch():
    """Working memory of the tokens of one large batch; the ids are stand-ins."""
    import random
    import tracemalloc

    class OneId:
        kept = {}

        def __call__(self, pieces):
            return [b"\1\0"] * len(pieces)

    r = random.Random(3)
    words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(5000)]
    texts = [" ".join(r.choices(words, k=1500)) for _ in range(800)]  # 8 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    cp._encoders["stand-in"] = OneId()
    tracemalloc.start()
    try:
        tokens = sum(sum(out.column(2).to_pylist()) for out in cp._tokenize("stand-in")(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        del cp._encoders["stand-in"]
    assert tokens == 800 * 1501
    assert peak < 64 << 20, peak >> 20
