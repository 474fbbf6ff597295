import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import mixing
from parcelwise.llm.language import held_out
from parcelwise.llm.queries import QUERIES
from parcelwise.llm.tables import unpacker

SMALL = "/root/testdata/sf0.01"


def tokens(text):
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), ""]


def test_query_base_equals_plain_counts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    count = Counter(t for i, text in docs.items() if not held[i] for t in tokens(text))
    n, v = sum(count.values()), len(count)
    rows = QUERIES["op3_context_mixing"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        own = tokens(docs[r.doc_id])
        base = sum(math.log10((count[t] + 1) / (n + 1 * (v + 1))) for t in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(count[t] > 0 for t in own)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
    unseen = [r for r in rows if r.held_out]
    bits = -sum(r.score for r in unseen) * math.log2(10) / sum(r.n_bytes for r in unseen)
    data = Counter(b for r in unseen for b in " ".join(tokens(docs[r.doc_id])).encode())
    size = sum(data.values())
    single = -sum(c / size * math.log2(c / size) for c in data.values())
    assert bits < 2.15 < 0.6 * single
    known = [r for r in unseen if r.n_known == r.n_tokens]
    assert len(known) > 20 and sum(r.score >= r.base_score for r in known) >= 0.95 * len(known)


def test_scores_equal_plain_counts(spark, monkeypatch):
    """Words that training texts have: their and the pairs' counts, and fixed gates, over several chunks and buckets."""
    gates = mixing.Gates(np.linspace(0.2, 0.8, mixing.GATED), np.linspace(0.3, 0.01, mixing.GATED))
    monkeypatch.setattr(mixing, "all_gates", lambda parts, share: gates)
    monkeypatch.setattr(mixing, "BUCKET_BYTES", 50_000)
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = {r.doc_id: tokens(r.text) for r in frame.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    word, pair = Counter(), Counter()
    for i, own in docs.items():
        if not held[i]:
            word.update(own)
            pair.update(zip(["", *own[:-1]], own))
    total, compared = sum(word.values()), 0
    for r in mixing.score_documents(frame, held_out(folds=7), chunk_bytes=100_000).collect():
        own, itself, score = docs[r.doc_id], 0 if held[r.doc_id] else 1, 0.0
        if r.n_known < r.n_tokens:
            continue
        for before, w in zip(["", *own[:-1]], own):
            context = word[before] - itself
            gate = int(math.log2(context + 1))
            by_pair = (pair[before, w] - itself) / context if context else 0.0
            by_word = max(word[w] - itself, 0.5) / total
            mixed = gates.pair[gate] * by_pair + (1 - gates.pair[gate]) * by_word
            score += math.log10((1 - gates.unknown[gate]) * mixed)
        assert abs(r.score - score) < 1e-6 * abs(score)
        compared += 1
    assert compared > 100


def test_shuffled_texts_score_lower_and_more_text_helps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rng = random.Random(1)
    held = docs.where(held_out(folds=7)).collect()
    mixed = [(r.doc_id + 10**9, " ".join(rng.sample(w, len(w)))) for r in held for w in [(r.text or "").split()]]
    marked = docs.withColumn("held", held_out(folds=7))
    both = marked.union(spark.createDataFrame(mixed, "doc_id long, text string").withColumn("held", F.lit(True)))
    score = {r.doc_id: r for r in mixing.score_documents(both, F.col("held")).collect()}
    pairs = [(score[r.doc_id], score[r.doc_id + 10**9]) for r in held if score[r.doc_id].n_tokens > 20]
    assert sum(a.score > b.score for a, b in pairs) > 0.95 * len(pairs)
    assert sum(a.score - b.score for a, b in pairs) > 0.1 * -sum(a.score for a, _ in pairs)
    # A tenth of the training texts, the same held-out ones.
    few = marked.where("held or doc_id % 10 = 0")
    less = [r for r in mixing.score_documents(few, F.col("held")).collect() if r.held_out]
    assert sum(r.score for r in less) < 1.05 * sum(score[r.doc_id].score for r in less)


def test_totals_of_a_chunk_read_in_parts(spark):
    rng = np.random.default_rng(2)
    keys = [rng.integers(0, 40, n).astype(np.uint64) << np.uint64(29) for n in (30, 50, 20, 60)]
    chunks = (7, 7, 8, 9)
    rows = [mixing._pair_rows(c, k, np.arange(len(k)) % 3 > 0)[0] for c, k in zip(chunks, keys)]
    parts = spark.createDataFrame(pa.Table.from_batches(rows), mixing.CHUNK_SCHEMA)
    count = Counter()
    for k in keys:
        count.update(k[np.arange(len(k)) % 3 > 0].tolist())
    found = {}
    for r in sorted(mixing.pair_totals(parts).collect(), key=lambda r: (r.chunk, r.bucket)):
        found.setdefault(r.chunk, []).extend(mixing.unsqueezed(r.totals, unpacker()).tolist())
    for chunk in (7, 8, 9):
        own = np.unique(np.concatenate([k for c, k in zip(chunks, keys) if c == chunk]))
        assert found[chunk] == [count[k] for k in own.tolist()]


def test_gates_find_the_share_of_pairs():
    rng = np.random.default_rng(4)
    gate = rng.integers(0, 3, 60_000)
    by_word = np.full(len(gate), 0.01)
    by_pair = np.where(rng.random(len(gate)) < np.array([0.1, 0.5, 0.9])[gate], 0.8, 0.0)
    alone = np.where(rng.random(len(gate)) < 0.05, 0, 5)
    table = mixing.gate_table(by_pair, by_word, gate, alone)
    assert table.sum() == len(gate)
    gates = mixing.fitted_gates(table, 0.02)
    assert np.allclose(gates.pair[:3], [0.1, 0.5, 0.9], atol=0.03) and np.allclose(gates.unknown[:3], 0.02, atol=0.003)
    nothing = mixing.fitted_gates(table * 0, 0.5)
    assert np.allclose(nothing.pair, 0.5) and np.isfinite(nothing.unknown).all()


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the", 40, 9), ("then", 5, 0), ("", 3, 7), ("of", 30, 1), ("é", 1, 0)]
    vocabulary = spark.createDataFrame(rows, "word string, n0 long, n1 long")
    counts = mixing.bit_counts(vocabulary)
    return mixing.Model(counts, *mixing.mixer(vocabulary, counts))


def test_bit_counts_equal_a_loop(spark, model):
    plain = np.zeros((mixing.SLOTS, 2))
    for word, begin, n in (("the", False, 40), ("the", True, 9), ("then", False, 5), ("", False, 3), ("", True, 7)):
        bits = mixing.bits_of([word.encode()], np.array([begin]))
        for slots in bits.slots:
            for slot, bit in zip(slots, bits.bit, strict=True):
                plain[slot, int(bit)] += n
    for word, begin, n in (("of", False, 30), ("of", True, 1), ("é", False, 1)):
        bits = mixing.bits_of([word.encode()], np.array([begin]))
        for slots in bits.slots:
            for slot, bit in zip(slots, bits.bit, strict=True):
                plain[slot, int(bit)] += n
    assert np.allclose(plain, model.counts)


def test_bits_do_not_depend_on_other_words():
    words = [b"the", b"", b"then", "é".encode(), b"a" * 300]
    begin = np.array([True, False, False, True, True])
    together = mixing.bits_of(words, begin)
    for at, word in enumerate(words):
        alone = mixing.bits_of([word], begin[at : at + 1])
        assert (together.slots[:, together.word == at] == alone.slots).all()


def test_probabilities_of_all_first_bytes_sum_to_one(model):
    # Words of one byte and the empty word share the first byte; take that byte's bits alone.
    total = 0.0
    for byte in range(256):
        bits = mixing.bits_of([b" " if byte == 32 else bytes([byte])], np.array([True]))
        mixed = mixing._mixed(*mixing._stretched(model.counts, bits, None), model.weights)
        slot, share = mixing._refine_at(mixed, bits.node)
        p = (mixing._squash(mixed) + model.refined[slot] * (1 - share) + model.refined[slot + 1] * share) / 2
        total += np.prod(np.where(bits.bit, p, 1 - p)[:8])
    assert abs(total - 1) < 1e-6


def test_odd_rows(spark):
    rows = [(1, None), (11, ""), (3, "word. Next " * 50_000), (3, "x"), (None, "Word. word")]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, word int")
    got = {(r.doc_id, r.n_bytes): r for r in mixing.score_documents(docs, held_out(folds=7), chunk_bytes=64).collect()}
    assert len(got) == 5 and got[1, 0].n_tokens == got[11, 0].n_tokens == 1
    assert got[1, 0].held_out and got[11, 0].held_out and got[1, 0].score == got[11, 0].score < 0
    nothing = mixing.score_documents(docs.where("doc_id = 3").limit(1), ~held_out(folds=1, fold=5)).collect()
    assert [r.held_out for r in nothing] == [True]
    assert (nothing[0].n_known, nothing[0].train_tokens, nothing[0].base_score) == (0, 0, 0.0)
    assert mixing.score_documents(docs.limit(0), held_out(folds=7)).count() == 0


def test_mixed_choices_of_all_words_sum_to_one():
    """Every known word is reached through mixed bits, whatever the weights."""
    rng = np.random.default_rng(5)
    count = np.sort(rng.zipf(1.3, 300).clip(1, 5000))[::-1]
    kind = mixing.class_of(count)
    sums = np.bincount(kind, count, mixing.CLASSES)
    ranks = mixing.Ranks.of(np.bincount(kind, minlength=mixing.CLASSES), sums)
    assert ranks.known == 300 and ranks.before(np.array(300)) == count.sum()
    keys = np.concatenate([np.arange(300) + (k << 32) for k in (0, 7, 300)])
    total = rng.poisson(np.tile(count / 200, 3)) * (keys >> 32 < 300)
    below = np.stack([np.concatenate(([0], np.cumsum(n))) for n in (total, total > 0)])
    weights, refined = rng.normal(0.5, 0.2, (mixing.GATES, 4)), rng.uniform(0.01, 0.99, 256 * mixing.REFINE_STEPS)
    found = mixing.choices(keys, total, below, np.arange(len(keys)), ranks, 0)
    mixed = mixing._mixed(found.inputs, found.gate, weights)
    slot, share = mixing._refine_at(mixed, found.node)
    p = (mixing._squash(mixed) + refined[slot] * (1 - share) + refined[slot + 1] * share) / 2
    logs = np.bincount(found.pair, np.log10(np.where(found.bit, p, 1 - p))[found.which], len(keys)) + found.rest
    assert len(found.bit) > 300 and np.allclose((10**logs).reshape(3, 300).sum(axis=1), 1)
    # Left out of its own counts, a pair seen once after a word seen once is left to order 0.
    alone = mixing.choices(keys[:300], np.eye(300, dtype=int)[9], np.stack([np.cumsum(np.eye(301)[10])] * 2), np.array([9]), ranks, 1)
    assert len(alone.pair) == 0 and alone.rest[0] < -1


def test_packed_pairs_come_back():
    rng = np.random.default_rng(6)
    from parcelwise.llm.tables import packer

    keys = np.unique(rng.integers(0, 50, 2000) << 32 | rng.integers(0, 400, 2000))
    for own in (keys, keys[:1], keys[:0]):
        assert (mixing.unpacked_keys(mixing.packed_keys(own, packer()), unpacker()) == own).all()


def test_only_choices_that_a_pair_makes():
    """A choice from counts without the pair itself and one with it are both there only if pairs make both."""
    rng = np.random.default_rng(3)
    counts = np.sort(rng.integers(1, 50, 40))[::-1]
    kind = mixing.class_of(counts)
    ranks = mixing.Ranks.of(np.bincount(kind, minlength=mixing.CLASSES), np.bincount(kind, counts, mixing.CLASSES).astype(np.int64))
    keys = np.unique((rng.integers(0, 12, 150) << 32) | rng.integers(0, 40, 150)).astype(np.int64)
    total = rng.integers(1, 4, len(keys))
    below = np.stack([np.concatenate(([0], np.cumsum(n))) for n in (total, total > 0)])
    for itself in (0, 1):
        for own in (np.arange(len(keys)), np.arange(30, 60), np.array([7])):
            found = mixing.choices(keys, total, below, own, ranks, itself)
            assert sorted(set(found.which.tolist())) == list(range(len(found.bit)))
            alone = [mixing.choices(keys, total, below, own[i : i + 1], ranks, itself) for i in range(len(own))]
            for i, single in enumerate(alone):
                made = found.which[found.pair == i]
                assert np.array_equal(found.inputs[:, made], single.inputs) and np.array_equal(found.gate[made], single.gate)
                assert np.array_equal(found.bit[made], single.bit) and found.rest[i] == single.rest[0]
