import hashlib
import random

import numpy as np
import pytest

from parcelwise.llm import substrings
from parcelwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def brute(docs, window=50):
    """doc_id -> (words, removed, kept) by a plain table of all windows."""
    words = {i: (t or "").encode().split() for i, t in docs}
    least = {}
    for i in sorted(words, reverse=True):
        for at in range(len(words[i]) - window + 1):
            least[tuple(words[i][at : at + window])] = i
    out = {}
    for i, own in words.items():
        gone = set()
        for at in range(len(own) - window + 1):
            if least[tuple(own[at : at + window])] < i:
                gone.update(range(at, at + window))
        out[i] = (len(own), len(gone), b" ".join(w for n, w in enumerate(own) if n not in gone).decode())
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected = {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in brute(docs).items()}
    rows = QUERIES["op9_repeated_phrases"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected
    assert sum(r.n_removed > 0 for r in rows) > 20


@pytest.mark.parametrize("chunk_bytes", [1 << 24, 4000])
def test_shuffled_passages(spark, chunk_bytes):
    rng = random.Random(4)
    vocabulary = [f"w{n}" for n in range(12)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(6, 30))] for _ in range(12)]
    docs = []
    for i in rng.sample(range(1000), 120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=9) for _ in range(6)]
        docs.append((i, " ".join(w for p in parts for w in p)))
    docs += [(2000 + n, docs[n][1]) for n in range(10)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(frame, window=10, phrase=4, chunk_bytes=chunk_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute(docs, 10)


def test_odd_rows(spark):
    long = " ".join(f"t{n % 977}" for n in range(60_000))
    same = "again " * 300
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (None, long), (5, same), (6, "\t" + same), (7, "x y")]
    docs = spark.createDataFrame([(a, b, "c", 0) for a, b in rows], "doc_id long, text string, h string, chunk int")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()), key=str)
    assert got == sorted(
        [(1, 0, 0), (2, 0, 0), (3, 60_000, 0), (4, 60_000, 60_000), (4, 60_000, 60_000), (None, 60_000, 0)]
        + [(5, 300, 0), (6, 300, 300), (7, 2, 0)],
        key=str,
    )
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_rolled_and_sampled():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    base = 0x9E3779B97F4A7C15
    for length in (1, 2, 3, 20, 31, 50, 200, 201):
        plain = []
        for at in range(len(words) - length + 1):
            h = 0
            for w in words[at : at + length].tolist():
                h = (h * base + w) % (1 << 64)
            plain.append(h)
        assert substrings.rolled(words, length, base).tolist() == plain
    taken = substrings.sampled(words, 31)
    assert all(any(at <= t < at + 31 for t in taken) for at in range(len(words) - 30))
    expected = {t for at in range(170) for t in range(at, at + 31) if words[t] == words[at : at + 31].min()}
    assert set(taken.tolist()) == expected


def test_windows_are_looked_up_by_both_halves():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 6, (2, 40)).astype(np.uint64)
    w1, w2 = rng.integers(0, 8, (2, 500)).astype(np.uint64)
    order = np.lexsort((b, a))
    taken = set(zip(a.tolist(), b.tolist()))
    assert substrings._among(w1, w2, a[order], b[order]).tolist() == [p in taken for p in zip(w1.tolist(), w2.tolist())]
    assert not substrings._among(w1, w2, a[:0], b[:0]).any()


def test_memory_is_given_back_after_each_group(monkeypatch):
    from parcelwise.llm import tables

    calls = []
    monkeypatch.setattr(tables, "give_back", lambda: calls.append(1))
    assert list(tables.freeing(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3]
    assert tables.freeing(lambda own, known: own - known)(5, 2) == 3
    assert tables.freeing(lambda key, own, known: (key, own, known))(1, 2, 3) == (1, 2, 3)
    assert len(calls) == 3
