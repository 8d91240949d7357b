from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultline.llm import periodic_runs as module
from vaultline.llm.periodic_runs import periodic_runs, runs_of
from vaultline.llm.queries import QUERIES


def by_definition(words, min_length=6, min_powers=4):
    """Every stretch with every period, the smallest of each kept."""
    found = set()
    n = len(words)
    for q in range(1, n // min_powers + 1):
        start = 0
        while start < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(min_length, min_powers * q):
                smaller = any(
                    all(words[i] == words[i - p] for i in range(start + p, end)) for p in range(1, q)
                )
                if not smaller:
                    found.add((start, end - start, q))
            start = max(start + 1, end - q + 1)
    return sorted(found)


def found_in(*texts):
    numbers = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for text in texts for w in text], np.int64)
    return runs_of(words, np.cumsum([len(text) for text in texts]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("ab", max_size=60) | st.text("abc", max_size=90), min_size=1, max_size=4))
def test_random_texts_equal_the_definition(texts):
    expected, shift = [], 0
    for text in texts:
        expected += [(start + shift, length, q) for start, length, q in by_definition(text)]
        shift += len(text)
    assert found_in(*texts) == expected


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=20), st.integers(2, 9), st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_planted_repeats_equal_the_definition(root, times, before, after):
    text = before + root * times + root[: len(root) // 2] + after
    assert found_in(text) == by_definition(text)


@pytest.mark.parametrize("q", [1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 33, 64, 100])
def test_shortest_runs_of_each_period(q):
    period = [f"w{i}" for i in range(q)]
    shortest = max(6, 4 * q)
    words = (period * 10)[:shortest]
    assert found_in(["x", *words, "y"]) == [(1, shortest, q)]
    assert found_in(["x", *words[:-1], "y"]) == []


def test_long_runs_with_factors_that_recur_inside_the_period():
    text = "aaab" * 5000 + "c" + "aab" * 7000
    assert found_in(text) == [(0, 20000, 4), (20001, 21000, 3)]


def test_a_text_of_one_word_repeated():
    assert found_in("a" * 100_000) == [(0, 100_000, 1)]


def test_runs_do_not_cross_texts():
    assert found_in("aaa", "aaa", "", "aaa") == []


def test_fewer_powers_are_refused():
    with pytest.raises(ValueError):
        runs_of(np.zeros(9, np.int64), np.array([9]), min_powers=3)


def test_rows(docs, monkeypatch):
    monkeypatch.setattr(module, "BATCH_WORDS", 3)
    texts = {1: "a b " * 4 + "c", 2: None, 3: "", 4: " \t\n", 5: "é　x é　x é　x é　x é　x é　x", 6: "one two", 7: "z\n" * 50_000}
    rows = docs(*texts.items(), (None, "a a a a a a"), (1, texts[1]))
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(rows).collect()), key=str)
    expected = [
        (1, 9, [(0, 8, 2)], "a b c"), (1, 9, [(0, 8, 2)], "a b c"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""),
        (5, 6, [(0, 6, 1)], "é　x"), (6, 2, [], "one two"), (7, 50_000, [(0, 50_000, 1)], "z"), (None, 6, [(0, 6, 1)], "a"),
    ]
    assert got == sorted(expected, key=str)
    assert periodic_runs(rows.limit(0)).count() == 0


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_definition(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_query_equals_the_definition(spark, docs, tmp_path):
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice(list("abé"), int(rng.integers(0, 60)))) for i in range(400)}
    texts |= {900: None, 901: "", 902: "x y " * 30 + "z " * 20}
    # Ids whose checksum ends in 0, among them an empty text.
    planted = [i for i in range(1000, 5000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    texts |= {i: " ".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 80)))) for i in planted}
    rows = docs(*texts.items(), (5, texts[5]), (None, "a a a a a a b"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = [expected_row(i, t) for i, t in [*texts.items(), (5, texts[5]), (None, "a a a a a a b")]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
