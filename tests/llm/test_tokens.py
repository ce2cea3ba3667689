from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chalkline.llm import arrowfile, packing, queries
from chalkline.llm.tokens import Encoder

from .conftest import sentence

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a\x1cb", "x y", "İstanbul ΣΑΣ", "<|endoftext|>a b<|endoftext|>", "é ́x", "don't DON'T it's'", "3.14 1,000", "日本語 テスト。", "á.", "ÀB'S ÿ́", "a​b", "ﬁ ǅ ß", "'s", "_a_ a_b", "É²x½", "́b", "a-b--c ... !!x"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text, end):
    return np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_equals_the_tokenizer(tokenizer):
    own, whole = Encoder(PATH), Encoder(PATH, by_word=False)
    rng = random.Random(0)
    random_texts = ["".join(rng.choice("aB é.,'ß́\n1<|>_-x ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for text in ODD + random_texts + [sentence(rng, 200)]:
        wanted = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == wanted, repr(text)
        assert np.frombuffer(whole.encode(text), "<u4").tolist() == wanted
    assert own.encode(None) == b"" and own.merges is not None
    # many at once, and known pieces again
    again = ODD + random_texts + ["x" * 50_000, None]
    for text, ids in zip(again, own.encode_all(again)):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_pieces_that_share_a_slot(tokenizer, monkeypatch):
    monkeypatch.setattr("chalkline.llm.tokens.SLOTS", 3)
    monkeypatch.setattr("chalkline.llm.tokens.POOL", 64)
    own, rng = Encoder(PATH), random.Random(5)
    texts = [sentence(rng, 60) for _ in range(40)]
    for _ in range(2):
        for text, ids in zip(texts, own.encode_all(texts)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_of_one_hash_are_told_apart(tokenizer, monkeypatch):
    own, rng = Encoder(PATH), random.Random(6)
    monkeypatch.setattr(own.seen, "hashes", lambda data, starts, sizes: np.full(len(starts), 1 << 63 | 1, np.uint64) + (sizes.astype(np.uint64) % np.uint64(2) << np.uint64(1)))
    texts = [sentence(rng, 40) for _ in range(5)] + ["a b c ab ba " + "z" * 40]
    for _ in range(2):
        for text, ids in zip(texts, own.encode_all(texts)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_full_memo_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr("chalkline.llm.tokens.WORDS", 3)
    own = Encoder(PATH)
    for text in ("α b γ d ε a α", "e δ c, b. α", "f γ h ι a"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def rows_for(rng):
    return [(4, sentence(rng, 3000)), (2, None), (2, "again"), (2, "again"), (None, "no id"), (9, ""), (1, "x"), (7, sentence(rng, 700)), *[(20 + i, sentence(rng, rng.randint(0, 90))) for i in range(60)], *[(100 + i, t) for i, t in enumerate(ODD)]]


def test_queries_equal_brute_force(spark, tokenizer):
    """op5 and op6 as registered, over whole tables, from the library's own encoding of each text."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    five = queries.op5_token_binary(spark, SF)
    assert five.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    start, got = 0, {r.doc_id: tuple(r)[1:4] for r in five.collect()}
    for doc_id in sorted(docs):
        ids = ids_of(tokenizer, docs[doc_id], 1)
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got
    pieces, sequences, total = {}, {}, 0
    for r in queries.op6_packing(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == docs.keys()
    for doc_id, found in pieces.items():
        ids, at = ids_of(tokenizer, docs[doc_id], 2), 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        total += at
    padded = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        padded += at if at & (at - 1) == 0 else 4096
    assert padded <= 1.05 * total


def test_files_round_trip(spark, make, tokenizer, tmp_path):
    rows = rows_for(random.Random(1))
    path = f"file://{tmp_path}/tokens"
    shards = arrowfile.write_tokens(make(rows), path, PATH, 1, sequence_length=64)
    got = arrowfile.read_tokens(spark, shards, ids=True).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    assert len(got) == len(rows)
    for (doc_id, text), row in zip(order, got):
        ids = ids_of(tokenizer, text, 1)
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes())) and bytes(row.ids) == ids.tobytes()
        start += len(ids)
    valid = 0
    for _, stem, before in shards:
        table = arrowfile.open_sequences(f"{stem}.arrow".removeprefix("file://"))
        assert before == valid and table.schema.field("ids").type == pa.list_(pa.uint16(), 64) and table.schema.field("mask").type == pa.list_(pa.bool_(), 64)
        masks = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["mask"].chunks])
        assert not (np.diff(masks.astype(int)) > 0).any()  # padding is at the end only
        valid += int(masks.sum())
        first = table["ids"].chunk(0)
        assert first.flatten().to_numpy(zero_copy_only=True).base is not None  # a view of the mapped file
    assert valid == start


def test_no_documents(spark, make, tmp_path):
    assert arrowfile.read_tokens(spark, arrowfile.write_tokens(make([]), f"file://{tmp_path}/t", PATH, 1)).count() == 0
    assert packing.pack(make([]), PATH, 2).count() == 0


@pytest.mark.parametrize("capacity,classes", [(4096, 32), (64, 8), (100, 7), (1, 4)])
def test_packed_pieces_are_the_documents(spark, make, tokenizer, capacity, classes):
    rows = rows_for(random.Random(2))
    pieces = packing.pack(make(rows), PATH, 2, capacity=capacity, classes=classes).collect()
    got = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        got.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    wanted = {}
    for doc_id, text in rows:
        ids = ids_of(tokenizer, text, 2)
        wanted.setdefault((doc_id, len(ids)), []).append(ids.tobytes())
    assert got.keys() == wanted.keys()
    for key, texts in wanted.items():
        covered = sorted((p.start, p.start + p.length) for p in got[key])
        n = len(texts)
        assert sum(b - a for a, b in covered) == key[1] * n  # each id once for each row
        if n == 1:
            assert b"".join(bytes(p.ids) for p in sorted(got[key], key=lambda p: p.start)) == texts[0]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding <= 0.02 * total if capacity == 4096 else padding <= 0.2 * total


def test_harmonic_bins_take_a_fixed_number():
    packer = packing.Packer(64, 8)
    for i in range(50):
        packer.add(i, 21)  # 64 // 3: three to a bin
    full = packer.take()
    bins = {}
    for doc, _, length, sequence, _ in full:
        bins.setdefault(sequence, []).append(length)
    assert len(bins) == 16 and all(b == [21, 21, 21] for b in bins.values())
    packer.finish()
    assert sum(p[2] for p in packer.take()) == 42


def test_query_digests(spark):
    got = queries.op6_packing(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.where("ids_crc32 < 0").count() == 0
