from __future__ import annotations

import bisect
import zlib
from collections import Counter as Tally

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultline.llm.common import bytes_of_signs
from vaultline.llm.packing import Encoder, best_fit_rounds, packed_documents
from vaultline.llm.token_counts import Counter, splits_before_spaces, token_counts, units

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "TARİHİ, ÜNİVERSİTESİ.", "ŞEHRİ'", "\ufb2a!", "\u09dc,", "\u0958.", "e\u0301, é\u0323!",
    "", " ", "  ", "a ", "a  b", "  a  ", "\n", "a\n\nb", " \n ", "▁", "a▁b", "</s> <s>", "\t\x0b\x0c", "x" * 5000,
    "é é e ́", "<|endoftext|> <|ENDOFTEXT|>X", "foo<|startoftext|>bar, Baz. don't DON'T", "Σας ΣΑΣ İ ß", "１２ 中文",
    "a b　c", "​ x", "K.", "..", "a.,", "A,", "é!!", "é´!", "²!", "x_!", "ﬁ?", "don'", "a's", "é's", "word " * 3000,
]

library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
plain = tokenizers.Tokenizer.from_file(WORDS)
counter, encoder = Counter(PIECES), Encoder(WORDS)


def test_units_and_boundaries():
    assert list(units("a b")) == ["a", "b"]
    assert list(units("  a  b ")) == ["  a", " b", ""]
    assert splits_before_spaces(["▁a", "▁▁", "b"])
    assert not splits_before_spaces(["a▁b"])


def test_counts_equal_the_library():
    assert counter.splits
    assert counter.counts(ODD) == [len(library.encode(text)) for text in ODD]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .,'\n▁é中<|>\tİ\ufb2a\u09dc\u0958\u0307\u0301ß²", max_size=30) | st.text(max_size=20))
def test_any_text_counts_and_encodes_alike(text):
    assert counter.counts([text]) == [len(library.encode(text))]
    expected = plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected


def test_ids_equal_the_library():
    assert encoder.by_word
    for text, ids in zip(ODD, encoder.encode(ODD), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr("vaultline.llm.token_counts.REMEMBERED", 1)
    monkeypatch.setattr("vaultline.llm.packing.REMEMBERED", 1)
    assert Counter(PIECES, batch_bytes=1).counts(ODD[:8]) == [len(library.encode(text)) for text in ODD[:8]]
    assert encoder.encode(ODD[:8]) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD[:8]]


def test_words_of_letters_encode_alike_in_the_faster_library():
    vocabulary = [token.removesuffix("</w>") for token in plain.get_vocab()]
    known = [bytes(bytes_of_signs()[c] for c in token).decode("utf-8", "ignore") for token in vocabulary if "|" not in token]
    words = sorted({*known, *(a + b for a, b in zip(known, known[1:], strict=False)), "straße", "ŉ", "x" * 3000, "éè" * 40})
    for word, ids in zip(words, encoder.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(word, add_special_tokens=False).ids


def test_new_words_of_letters_go_through_the_faster_library_once(monkeypatch):
    fresh, slow, fast = Encoder(WORDS), [], []
    ids, word_ids = fresh._ids, fresh._word_ids
    monkeypatch.setattr(fresh, "_ids", lambda some: slow.extend(some) or ids(some))
    monkeypatch.setattr(fresh, "_word_ids", lambda some: fast.extend(some) or word_ids(some))
    fresh.encode(["Some words, some ÉTÉ\tété.", "Words; some!", ""])
    assert sorted(fast) == ["some", "words", "été"]
    assert not {"some", "words", "été"} & set(slow) and len(slow) == len(set(slow))


def test_token_counts_of_rows(docs):
    rows = docs(*enumerate(ODD), (None, "a b"), (3, None), (3, None))
    got = Tally(map(tuple, token_counts(rows, PIECES).collect()))
    texts = [*enumerate(ODD), (None, "a b"), (3, ""), (3, "")]
    assert got == Tally((i, len(t.encode()), len(library.encode(t))) for i, t in texts)
    assert token_counts(rows.limit(0), PIECES).count() == 0


def plain_best_fit(lengths, capacity):
    """The number of sequences that one piece after the other needs, longest first, each in the least gap that holds it."""
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        for _ in range(lengths[length]):
            at = bisect.bisect_left(gaps, length)
            gap = gaps.pop(at) if at < len(gaps) else capacity
            opened += gap == capacity
            if gap > length:
                bisect.insort(gaps, gap - length)
    return opened


@pytest.mark.parametrize(
    ("lengths", "capacity"),
    [
        ({30: 4, 12: 7, 3: 9}, 40),
        ({37: 2, 25: 9, 18: 30, 17: 4, 11: 13, 7: 21, 4: 8, 1: 3}, 40),
        ({40: 3, 21: 20, 13: 50, 5: 1}, 40),
        ({600: 1000, 3: 10_000}, 2048),
        ({1: 7}, 5),
        ({}, 40),
    ],
)
def test_rounds_place_every_piece_like_plain_best_fit(spark, lengths, capacity):
    frame = spark.createDataFrame(list(lengths.items()), "length bigint, number bigint")
    ranks, filled = {length: [] for length in lengths}, {}
    for run in best_fit_rounds(frame, capacity).collect():
        ranks[run["size"]] += range(run["first"], run["first"] + run["per"] * run["number"])
        for i in range(run["number"]):
            filled.setdefault(run["sequence"] + i, []).append((run["offset"], run["size"] * run["per"]))
    assert {length: sorted(own) for length, own in ranks.items()} == {length: list(range(n)) for length, n in lengths.items()}
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(filled) <= plain_best_fit(lengths, capacity) + 1


def test_packed_documents(docs):
    texts = {**{i: "a few words " * (i % 90) for i in range(300)}, 1000: "long words " * 3000, 1001: None, 1002: ""}
    rows = packed_documents(docs(*texts.items(), (None, "x"), (7, texts[7])), WORDS).collect()
    assert sum(r["doc_id"] == 7 for r in rows) == 2
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        text = "x" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert r["start"] == 2048 * r["piece"]
        part = ids[r["start"] : r["start"] + 2048]
        assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(part.tobytes()))
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r["length"] for r in rows)
    assert len(filled) <= -(-total // 2048) + 1


@pytest.mark.parametrize("capacity", [1, 5])
def test_small_capacity_and_empty_table(docs, capacity):
    rows = packed_documents(docs((1, "a b c d e f g"), (2, None)), WORDS, capacity).collect()
    assert sum(r["length"] for r in rows) == 9
    assert packed_documents(docs((1, "a")).limit(0), WORDS).count() == 0
