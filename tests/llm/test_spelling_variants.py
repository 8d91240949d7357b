from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vaultline.llm.queries import QUERIES
from vaultline.llm.spelling_variants import letter_runs, near_words, spelling_variants, word_counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_definition(counts, ratio=5):
    rows, forms = [], {}
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= ratio * counts[word]:
            forms[word] = best
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        rows.append((word, forms.get(word), root, n, len(near[word]), counts[forms[word]] if word in forms else None))
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def vocabulary():
    rng = np.random.default_rng(1)
    words = {"".join(rng.choice(list("abé"), int(rng.integers(0, 8)))) for _ in range(400)}
    words |= {"".join(w) for w in itertools.product("xyzuvw", repeat=3)}  # one half shared by many
    words |= {"common" + "".join(w) for w in itertools.product("abcd", repeat=4)}
    return sorted(words | {"𝒳yz", "𝒳y", "x" * 3000, "x" * 3001})


@pytest.mark.parametrize("pairs_of_chunk", [0, 50, 10_000])
def test_near_words_equal_all_pairs(spark, vocabulary, pairs_of_chunk):
    words = spark.createDataFrame([(w, "k") for w in [*vocabulary, vocabulary[3], None]], "word string, key string")
    got = sorted(map(tuple, near_words(words, pairs_of_chunk).collect()))
    expected = sorted((a, b) for a in vocabulary for b in vocabulary if a.encode() < b.encode() and one_edit(a, b))
    assert got == expected


def test_a_shared_half_does_not_form_all_pairs(spark):
    """Words of one hot half: candidates stay in proportion to the words."""
    from vaultline.llm import spelling_variants as module

    words = spark.createDataFrame([(f"prefix{i:06d}",) for i in range(3000)], "word string")
    # Half of 12 letters is the prefix; groups by what is left are at most alphabet x length.
    grams = module.grams_of(words).filter("key = '12:0:prefix'")
    groups = grams.select("key", module.F.explode(module._shortened(module.F.col("rest"))).alias("variant")).groupBy("variant").count()
    assert groups.agg({"count": "max"}).first()[0] <= 10 * 8
    pairs = near_words(words)
    texts = [f"{i:06d}" for i in range(3000)]
    expected = sum(1 for t in texts for i in range(6) for c in "0123456789" if c > t[i] and int(t[:i] + c + t[i + 1 :]) < 3000)
    assert pairs.count() == expected


def test_forms_and_roots(spark):
    rng = np.random.default_rng(2)
    counts = {"".join(rng.choice(list("ab"), int(rng.integers(3, 7)))): int(5 * 5 ** rng.uniform(0, 5)) for _ in range(200)}
    counts |= {"colour": 25, "color": 125, "colr": 625, "colar": 5, "tiea": 100, "tieb": 100, "tiec": 20}
    rows = spark.createDataFrame([(*item, "x") for item in [*counts.items(), (None, 3)]], "word string, n bigint, root string")
    assert sorted(map(tuple, spelling_variants(rows).collect()), key=str) == by_definition(counts)
    assert dict((r["word"], r["root"]) for r in spelling_variants(rows).collect())["colour"] == "colr"
    assert spelling_variants(rows.limit(0)).count() == 0


def test_letter_runs(docs):
    rows = docs((1, "Déjà-VU ÀB×ÿz don't"), (2, None), (3, ""), (None, "Ok" * 50_000))
    got = Counter(map(tuple, letter_runs(rows).collect()))
    assert got == Counter([(1, "déjà".replace("é", "é")), (1, "vu"), (1, "Àb×ÿz"), (1, "don"), (1, "t"), (None, "ok" * 50_000)])
    assert word_counts(letter_runs(rows), 2, 1).count() == 5


def test_query_equals_the_definition(spark, docs, tmp_path):
    rng = np.random.default_rng(4)
    words = [f"{x}{y}" for x in ("Straße", "garden", "ÉCOLES", "window") for y in ("", "s", "ing", "à")]
    texts = {i: " ".join(rng.choice(words, int(rng.integers(0, 40)))) for i in range(300)} | {900: None, 901: "", 902: "windowing " * 2000}
    all_rows = [*texts.items(), (7, texts[7]), (None, "gardens gardens")]
    docs(*all_rows).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc_id, text in all_rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == by_definition(counts)
