"""Encoding, packing and token files against the tokenizers library and exact round trips."""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ementario.llm import bpe, packing, planes, tokens

LIBRARY = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
TEXTS = [
    None, "", " ", "\n", "a", "The end.", "the  the\n\n the\t the ,", "Éa ñ ß 漢字 🙂🙃", "<|endoftext|> x<|endoftext|>", "it's they'll 'S",
    "ab" * 9000, "word " * 3000, "x" * 4097, "\x00\x1c \x1d a　b  c", "1234567890 12.5e-7",
]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def little(ids):
    return np.array(ids, "<u4").tobytes()


@given(st.text(st.sampled_from("ab e'sthing 12 \n\t éß漢🙂.,-\x1c\x85　A0|<>"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_librarys(text):
    want = little(library_ids(text))
    assert tokens.encode_texts([text]) == [want]
    coder, table = bpe.encoder()
    assert table.ids([text]) == [want]
    assert coder.decode(np.frombuffer(want, "<u4")) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


@given(st.binary(min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_prefixes_of_any_bytes_join_to_the_word(raw):
    coder, _ = bpe.encoder()
    assert b"".join(coder.bytes[i] for i in coder.word(raw)) == raw


@given(st.lists(st.text(st.sampled_from("ab e'sthing 12 \n\t éß漢🙂.,-\x1c\x85　A0|<>"), max_size=40) | st.none() | st.sampled_from(TEXTS), max_size=12))
@settings(max_examples=150, deadline=None)
def test_batches_of_texts_keep_their_order(texts):
    assert tokens.encode_texts(texts) == [little(library_ids(t)) for t in texts]


def test_batches_are_cut_by_their_text():
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 3]), pa.array(["ab", None, "c" * 50, ""])], ["doc_id", "text"])
    cut = [r.column("doc_id").to_pylist() for r in tokens.slices(batch, most=10)]
    assert [i for c in cut for i in c] == [0, 1, 2, 3] and len(cut) == 2
    assert list(tokens.slices(batch.slice(0, 0))) == []


def test_merges_of_long_and_rare_words():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzéÀ漢"), size=n)) for n in rng.integers(1, 70, size=3000)]
    text = " ".join(words)
    assert tokens.encode_texts([text, text + "\n" + text]) == [little(library_ids(text)), little(library_ids(text + "\n" + text))]


def test_table_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 3)
    table = tokens.Table(tokens.library_encoder(public_tokenizers.path(tokens.VOCABULARY)))
    for _ in range(3):
        for text in ("one two three four, five", "six seven two one. five", "x" * 100 + " y two,", ""):
            assert table.ids([text]) == [little(library_ids(text))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "x", 0), (None, "no id", "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int")


def test_encode_documents(docs):
    got = bpe.encode_documents(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else "no id"
        assert bytes(r.ids) == little(library_ids(text))
        assert r.decoded == (text or "")
    assert bpe.encode_documents(docs.limit(0)).count() == 0


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=80, deadline=None)
def test_plan_uses_every_piece(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=65).astype(np.int64)
    entries = packing.plan(counts, 64)
    used = np.zeros(65, np.int64)
    for times, members in entries:
        assert times > 0 and sum(members) <= 64
        for x in members:
            used[x] += times
    assert (used == counts).all()


@pytest.mark.parametrize(
    "counts, least",
    [({64: 5}, 5), ({40: 3, 24: 3}, 3), ({30: 4, 20: 4, 14: 4}, 4), ({20: 2, 16: 2, 15: 2, 13: 2}, 2), ({33: 4}, 4), ({16: 1_000_000_000}, 250_000_000)],
)
def test_exact_complements_are_found(counts, least):
    c = np.zeros(65, np.int64)
    for k, v in counts.items():
        c[k] = v
    entries = packing.plan(c, 64)
    assert sum(t for t, _ in entries) == least and len(entries) < 10


@given(st.lists(st.integers(1, 20), max_size=12), st.integers(1, 30))
@settings(max_examples=300, deadline=None)
def test_complements_against_all_choices(lengths, gap):
    left = np.bincount(np.array(lengths, int), minlength=41).astype(np.int64)
    found = packing.complement(left, gap)
    exists = any(sum(c) == gap for n in (1, 2, 3) for c in combinations(lengths, n))
    assert bool(found) == exists
    if found:
        assert sum(found) == gap and all(left[x] >= found.count(x) for x in found)


def test_a_triple_is_found_where_its_first_pair_fails():
    left = np.zeros(65, np.int64)
    left[[4, 3, 2]] = 1, 2, 1
    assert packing.complement(left, 10) == (4, 3, 3)
    left[64 - 10] = 1
    assert (1, (54, 4, 3, 3)) in packing.plan(left, 64)


@pytest.mark.parametrize("ranked", [100_000, 3])
def test_packing(spark, docs, monkeypatch, ranked):
    monkeypatch.setattr(packing, "RANKED", ranked)
    rows = packing.pack_documents(docs.where("doc_id is not null")).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(range(len(TEXTS)))
    for i, found in pieces.items():
        ids = [*library_ids(TEXTS[i]), 0]
        want = sorted(packing.cut(len(ids), 2048) * (2 if i == 5 else 1))
        assert sorted((r.start, r.length) for r in found) == want
        for r in found:
            assert r.ids_crc32 == zlib.crc32(little(ids[r.start : r.start + r.length]))
        assert max(r.piece for r in found) + 1 == len(set(want))
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 2048) + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packed_sequences_hold_the_ids(docs):
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    placed = packing.pack_documents(one)
    got = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in packing.sequences(one, placed).collect()}
    assert all(len(v) <= 2048 for v in got.values())
    for r in placed.collect():
        part = got[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(part.astype("<u4").tobytes()) == r.ids_crc32
    assert sum(map(len, got.values())) == sum(len(library_ids(t)) + 1 for t in TEXTS)


@given(
    st.lists(st.integers(0, 2**32 - 1), max_size=90), st.integers(1, 20),
    st.sampled_from([planes.BYTE_PLANES, planes.BIT_PLANES]), st.integers(0, 95), st.integers(0, 95),
)
@settings(max_examples=100, deadline=None)
def test_chunks_round_trip(ids, block, kind, first, last):
    ids = np.array(ids, np.uint32)
    data = planes.encode_chunk(ids, block, kind)
    assert (planes.decode_chunk(data) == ids).all()
    assert (planes.decode_chunk(data, first, last) == ids[first:last]).all()


def test_chunks_of_something_else_are_refused():
    with pytest.raises(ValueError):
        planes.decode_chunk(b"no chunk at all, but long enough")


@pytest.mark.parametrize("kind", [planes.BYTE_PLANES, planes.BIT_PLANES])
def test_token_files(spark, docs, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(planes, "CHUNK", 500)
    path = str(tmp_path / "tokens")
    planes.write_tokens(docs, path, block=64, kind=kind)
    got = planes.read_tokens(spark, path).orderBy("start").collect()
    texts = ["no id", *TEXTS[:6], *TEXTS[5:]]  # null ids come first
    assert [r.doc_id for r in got] == [None, *range(6), *range(5, len(TEXTS))]
    at = 0
    for r, text in zip(got, texts, strict=True):
        ids = [*library_ids(text), 2]
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(ids), little(ids))
        at += len(ids)
    empty = str(tmp_path / "empty")
    planes.write_tokens(docs.limit(0), empty)
    assert planes.read_tokens(spark, empty).count() == 0
