from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vaultline.llm.simhash import fingerprint, fingerprint_links, kept_documents, simhash_dedup


def slow_fingerprint(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    head = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and head[b] < head[a]:
                    head[a], changed = head[b], True
    return head


@pytest.mark.parametrize("width", [1, 3, 5])
def test_fingerprint_equals_the_definition(width):
    words = "the cat Sat ON mat é É \x0b x".split(" ")
    for seed in range(30):
        text = " ".join(random.Random(seed).choices(words, k=seed * 3))
        assert fingerprint(text, width) % (1 << 64) == slow_fingerprint(text, width)
    assert fingerprint(None) == fingerprint("") == fingerprint(" \n") == 0


def test_fingerprint_of_spark_hashes(spark):
    """A shingle's hash is the one Spark's own function gives."""
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert fingerprint("A b C") == value


def test_long_texts_are_counted_in_chunks(monkeypatch):
    text = " ".join(map(str, range(500)))
    whole = fingerprint(text)
    monkeypatch.setattr("vaultline.llm.simhash.CHUNK", 7)
    assert fingerprint(text) == whole


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(40)}
    for value in list(values):
        for flips in (1, 2, 2, 3, 4):
            values.add(value ^ sum(1 << b for b in rng.sample(range(64), flips)))
    values |= {0, 1, 3, (1 << 64) - 1, (1 << 63)}
    signed = [int(np.uint64(v).astype(np.int64)) for v in sorted(values)]
    points = spark.createDataFrame(list(enumerate(signed)), "id bigint, fingerprint bigint")
    links = {(r["a"], r["b"]) for r in fingerprint_links(points).collect()}
    near = {
        (i, j)
        for i, a in enumerate(signed)
        for j, b in enumerate(signed)
        if i < j and ((a ^ b) % (1 << 64)).bit_count() <= 2
    }
    assert links <= near
    ids = list(range(len(signed)))
    assert components(ids, lambda a, b: (min(a, b), max(a, b)) in links) == components(
        ids, lambda a, b: (min(a, b), max(a, b)) in near
    )


def test_components_of_documents(docs):
    text = " ".join(f"w{i}" for i in range(400))
    found = simhash_dedup(docs((5, text), (3, text.upper()), (9, "other words here"), (4, None), (8, ""), (8, ""), (None, text)))
    rows = sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=str)
    assert rows == sorted([(5, 3), (3, 3), (9, 9), (4, 4), (8, 4), (8, 4), (None, 3)], key=str)


def test_kept_documents(docs):
    text = " ".join(f"w{i}" for i in range(2000))
    rows = docs((1, text + " end"), (2, text), (3, "clean and other words of a text"), (None, text))
    kept = kept_documents(rows)
    assert kept.columns == rows.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, None}
    assert kept_documents(rows.limit(0)).count() == 0
