import hashlib
import random

import numpy as np

from parcelwise.llm import editprint
from parcelwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def plain_walk(text):
    """Sign of each bin by a walk of one character at a time."""
    moves, signs, bins = editprint.tables()
    sums, at, step = np.zeros(editprint.BINS, int), 0, 0
    while at < len(text):
        kind = ord(text[at]) * 0x9E3779B97F4A7C15 % (1 << 64) >> 56
        row = step % editprint.PERIOD
        sums[bins[row]] += signs[row, kind]
        at += moves[row, kind]
        step += 1
    return np.sign(sums)


def test_walks_in_step_equal_single_walks():
    rng = random.Random(1)
    texts = ["", "a", "é\U0001f600", *("".join(rng.choices("abcdefgh ñ", k=n)) for n in (3, 40, 127, 128, 500, 2000))]
    got = editprint.embedded(texts)
    for text, own in zip(texts, got, strict=True):
        assert (plain_walk(text) == own).all()
    assert (editprint.signs_of(editprint._hex(got)) == got).all()


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs.sort(reverse=True)
    prints = dict(zip([i for i, _ in docs], editprint._hex(editprint.embedded([t for _, t in docs])), strict=True))
    rows = {r.doc_id: r for r in QUERIES["op10_edit_embedding"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    near, other = [], []
    for n, (i, text) in enumerate(docs):
        following, r = docs[(n + 1) % len(docs)], rows[i]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[1][:third]
        assert r.n_chars == len(text) and r.fingerprint == prints[i]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.edited_fingerprint == editprint._hex(editprint.embedded([edited]))[0]
        a, b, c = (editprint.signs_of([p]) for p in (r.fingerprint, r.edited_fingerprint, prints[following[0]]))
        assert abs(r.near_edited - editprint.likeness_of(a, b)[0]) < 1e-12
        assert abs(r.near_next - editprint.likeness_of(a, c)[0]) < 1e-12
        if text != following[1]:
            near.append(r.near_edited)
            other.append(r.near_next)
    assert np.mean(np.array(near) > np.array(other)) > 0.97
    assert np.median(near) > 0.5 and np.median(other) < 0.35


def test_small_blocks_give_the_same_neighbours(spark):
    docs = spark.createDataFrame([(i * 7 % 101, f"text {i} " * (i % 9)) for i in range(101)], "doc_id long, text string")
    whole = editprint.edited_pairs(docs).orderBy("doc_id").collect()
    for size in (40, 300):
        assert editprint.edited_pairs(docs, block_bytes=size).orderBy("doc_id").collect() == whole
    by_id = {r.doc_id: r for r in docs.collect()}
    for r in whole:
        text, following = by_id[r.doc_id].text, by_id[(r.doc_id - 1) % 101].text
        third = len(text) // 3
        assert r.edited == text[: len(text) - third] + following[:third]


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefghijklmnop ", k=3000))
    likes = []
    for share in (0, 0.01, 0.1, 1):
        edited = [rng.choice("abcdefgh") if rng.random() < share else c for c in text]
        a, b = editprint.embedded([text, "x" * int(30 * share) + "".join(edited)])
        likes.append(float(editprint.likeness_of(a, b)))
    assert likes[0] == 1 and likes == sorted(likes, reverse=True) and likes[1] > 0.6 and likes[3] < 0.3


def test_near_pairs_find_copies(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=2000)) for _ in range(60)]
    copies = [t[:-20] + "changed at the end.." for t in texts[:30]] + [texts[0][: -k] for k in range(1, 20)]
    prints = editprint._hex(editprint.embedded(texts + copies))
    frame = spark.createDataFrame([(p,) for p in set(prints)], "fp string")
    pairs = editprint.near_pairs(frame).collect()
    signs = dict(zip(prints, editprint.signs_of(prints), strict=True))
    assert all(editprint.likeness_of(signs[r.a], signs[r.b]) >= 0.8 for r in pairs)
    linked = {frozenset((r.a, r.b)) for r in pairs}
    assert all(frozenset((prints[n], prints[60 + n])) in linked for n in range(1, 30))
    assert not any({r.a, r.b} <= set(prints[:60]) for r in pairs)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "z" * 100_000), (3, "z" * 100_000), (None, "last"), (9, "ab\U0001f600")]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, fingerprint string")
    got = editprint.edited_pairs(docs).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 4), (1, 0), (2, 0), (3, 100_000), (3, 100_000), (9, 3)]
    by_id = {r.doc_id: r for r in got}
    assert by_id[9].edited == "abz" and by_id[None].edited == "lasa" and by_id[2].near_next == 1.0
    assert by_id[1].near_next == 0.0
    single = editprint.edited_pairs(docs.where("doc_id = 9")).collect()
    assert [(r.edited, r.near_next) for r in single] == [("aba", 1.0)]
    assert editprint.edited_pairs(docs.limit(0)).count() == 0
