from __future__ import annotations

import random

import numpy as np
import pytest

from vaultline.llm import substring_dedup as own
from vaultline.llm.substring_dedup import Windows, substring_dedup, window_hashes, word_hashes


def brute(rows, window):
    firsts, result = {}, {}
    ordered = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in ordered:
        i, text = rows[k][:2]
        words = (text or "").split()
        gone = set()
        for start in range(len(words) - window + 1 if i is not None else 0):
            if firsts.setdefault(tuple(words[start : start + window]), (i, start)) < (i, start):
                gone.update(range(start, start + window))
        result.setdefault(i, []).append((" ".join(w for p, w in enumerate(words) if p not in gone), len(words), len(gone)))
    return {i: sorted(v) for i, v in result.items()}


def found(frame, **options):
    result = {}
    for r in substring_dedup(frame, **options).collect():
        result.setdefault(r["doc_id"], []).append((r["text"], r["n_words"], r["n_removed"]))
    return {i: sorted(v) for i, v in result.items()}


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passages = [[word() for _ in range(rng.randrange(5, 70))] for _ in range(12)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(0, 8)):
            words += rng.choice(passages) if rng.random() < 0.4 else [word() for _ in range(rng.randrange(1, 60))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(words))
    texts += ["a b " * 60, "a " * 45, "", None, texts[3], texts[3]]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("window, first", [(20, 10), (20, 5), (8, 2), (7, 3), (1, 1), (2, 1)])
def test_equals_brute_force(docs, window, first):
    rows = corpus(window)
    assert found(docs(*rows), window=window, first=first) == brute(rows, window)


def test_hash_collisions_of_the_first_level_cost_nothing(docs, monkeypatch):
    monkeypatch.setattr(own, "mixed", lambda values: values % np.uint64(7))
    rows = corpus(9, 40)
    assert found(docs(*rows)) == brute(rows, 20)


def test_nulls_repeated_rows_and_empty_table(docs):
    text = " ".join(map(str, range(50)))
    rows = docs((2, text), (2, text), (None, text), (1, None), (5, "x " + text))
    got = found(rows)
    assert got[2] == [(text, 50, 0)] * 2
    assert got[None] == [(text, 50, 0)]
    assert got[1] == [("", 0, 0)]
    assert got[5] == [("x", 51, 50)]
    assert substring_dedup(rows.limit(0)).count() == 0


def test_many_copies_and_a_common_passage(docs):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + f" own{i} " + " ".join(f"{i}x{k}" for k in range(25))) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]
    assert found(docs(*rows)) == brute(rows, 20)


def test_window_hashes_and_representatives():
    words = [str(i % 9).encode() for i in range(60)]
    hashes = word_hashes(words)
    for length in (1, 2, 3, 5, 7, 20):
        got = window_hashes(hashes[:, 0], length)
        assert len(got) == 60 - length + 1
        assert got[0] == got[9]
        assert got[0] != got[1]
    level = Windows(word_hashes([str(i).encode() for i in range(200)]), 10, 20)
    places = level.representatives()
    assert all(((places >= s) & (places <= s + 10)).any() for s in range(181))
    assert level.marked(places).all()
    assert not level.marked(places[:0]).any()
    assert len(places) < 60
