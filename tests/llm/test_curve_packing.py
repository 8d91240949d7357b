from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import example, given, settings
from hypothesis import strategies as st

from vaultline.llm import curve_packing as module
from vaultline.llm.curve_packing import (
    ByteEncoder, curve_packing, encoded_documents, hashed_vector, hilbert_keys, pieces_of, starts_along_the_curve, tail_cuts,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
plain = tokenizers.Tokenizer.from_file(BYTES)
encoder = ByteEncoder(BYTES)
ODD = [
    "", " ", "  ", "a ", "a  b", " \n a", "a\n  b", "don't DON'T we'll x' 's", "é è́ à", "<|endoftext|> x<|endoftext|>y <|endoftext|",
    "İstanbul, ÜNİVERSİTESİ.", "中文 字。 x", "１２ ² x²! a1, 1a.", "a　 b c  d", "x" * 5000, "word, " * 3000, "  ​ x", "_a_ b_! c",
]


def ids_of(text):
    return plain.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(monkeypatch):
    assert encoder.splits and encoder.words
    for text, ids in zip(ODD, encoder.encode(ODD), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)
    monkeypatch.setattr(module, "REMEMBERED", 1)
    small = ByteEncoder(BYTES)
    for text in ODD * 2:
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == ids_of(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1 ,.'\n\t s|<>endofx中é́²İ \x85", max_size=40) | st.text(max_size=20))
@example("a<|endoftext|>, b")
def test_any_text_encodes_alike(text):
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcdefghijklmnopqrstuvwxyzABCDEFéèÖßøſıİŐ", min_size=1, max_size=30), min_size=1, max_size=30))
def test_words_encode_alike_in_the_faster_library(words):
    text = " ".join(words)
    assert np.frombuffer(ByteEncoder.encode(encoder, [text])[0], "<u4").tolist() == ids_of(text)


def test_no_unit_is_encoded_twice(monkeypatch):
    fresh, slow, fast = ByteEncoder(BYTES), [], []
    ids, word_ids = fresh._ids, fresh._word_ids
    monkeypatch.setattr(fresh, "_ids", lambda some: slow.extend(some) or ids(some))
    monkeypatch.setattr(fresh, "_word_ids", lambda some: fast.extend(some) or word_ids(some))
    for text in ("A few words, words.", "Few few, words! été.", "A words, b. été"):
        fresh.encode([text])
    assert len(slow) == len(set(slow)) and len(fast) == len(set(fast))


def test_real_words_encode_alike(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text, ids in zip(texts, encoder.encode([text or "" for text in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("dimensions, bits", [(1, 4), (2, 5), (3, 3), (4, 3)])
def test_the_curve_visits_every_cell_and_steps_to_neighbours(dimensions, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = hilbert_keys(points, bits)
    assert sorted(keys) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=30), st.sampled_from([1, 7, 16, 33]))
def test_pieces_cover_all_and_pad_nothing(sizes, capacity):
    total = sum(sizes)
    tail = tail_cuts(total, capacity)
    filled, at = Counter(), 0
    places = {}
    for size in sizes:
        pieces = list(pieces_of(at, size, tail, capacity))
        assert [start for start, *_ in pieces] == [sum(length for _, length, *_ in pieces[:i]) for i in range(len(pieces))]
        assert sum(length for _, length, *_ in pieces) == size
        for _, length, sequence, offset in pieces:
            filled[sequence] += length
            places.setdefault(sequence, []).append((offset, length))
        at += size
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == capacity or n & (n - 1) == 0 for n in filled.values())
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]


def test_packed_documents(docs):
    rng = np.random.default_rng(5)
    topics = [[f"{c}{i}" for i in range(30)] for c in "pqrs"]
    texts = {i: " ".join(rng.choice(topics[i % 4], int(rng.integers(5, 300)))) for i in range(400)}
    texts |= {1000: "long words " * 9000, 1001: None, 1002: "", 1003: "İ, é! " * 10}
    rows = [*texts.items(), *[(5000, "many copies of one text")] * 300, (None, "x")]
    got = curve_packing(docs(*rows), BYTES).collect()
    expected = Counter()
    for doc_id, text in rows:
        expected[doc_id] += len(ids_of(text)) + 1
    packed = Counter()
    filled, members = {}, {}
    for r in got:
        text = dict(rows)[r["doc_id"]]
        ids = np.array([*ids_of(text), 1], "<u4")
        part = ids[r["start"] : r["start"] + r["length"]]
        assert (r["length"], r["ids_crc32"], r["doc_tokens"]) == (len(part), zlib.crc32(part.tobytes()), len(ids))
        packed[r["doc_id"]] += r["length"]
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        members.setdefault(r["sequence_id"], []).append(r["doc_id"])
    assert packed == expected
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 2048 or (end < 2048 and end & (end - 1) == 0)
    # Neighbours on the curve are alike: most topics of a sequence are one.
    shares = [max(Counter(i % 4 for i in own if i < 400).values()) / len([i for i in own if i < 400])
              for own in members.values() if len([i for i in own if i is not None and i < 400]) > 3 and None not in own]
    assert np.mean(shares) > 0.6


def test_copies_lie_together_and_are_dealt(docs):
    rows = docs(*[(1, "the same words")] * 2000)
    encoded = module.materialise(encoded_documents(rows, BYTES), "test")
    assert encoded.select("curve").distinct().count() == 1
    starts = sorted(r["from"] for r in starts_along_the_curve(encoded).collect())
    assert starts == [i * encoded.first()["doc_tokens"] for i in range(2000)]


def test_vectors_of_no_tokens_and_empty_table(docs):
    assert hashed_vector(np.zeros(0, np.uint32), module.slots_of(9)).sum() == 0
    assert curve_packing(docs((1, "a")).limit(0), BYTES).count() == 0
    [row] = curve_packing(docs((1, None)), BYTES).collect()
    assert tuple(row) == (1, 0, 1, zlib.crc32(np.array([1], "<u4").tobytes()), 1, 0, 0)
