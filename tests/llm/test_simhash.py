import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from parcelwise.llm import simhash
from parcelwise.llm.components import components
from parcelwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id within reach, for a list of (id, unsigned fingerprint)."""
    ids = [i for i, _ in prints]
    fp = np.array([p for _, p in prints], np.uint64)
    label = np.arange(len(ids))
    for at in range(len(ids)):
        near = np.flatnonzero(np.bitwise_count(fp ^ fp[at]) <= 4)
        for old in {*label[near]}:
            label[label == old] = label[at]
    least = defaultdict(list)
    for i, own in zip(ids, label, strict=True):
        least[own].append(i)
    return {i: min(least[own]) for i, own in zip(ids, label, strict=True)}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    out = {r.doc_id: r for r in QUERIES["op5_simhash_near_duplicates"](spark, SMALL).collect()}
    prints = [(r.doc_id, plain_print(r.text)) for r in docs]
    assert {i: f"{p:016x}" for i, p in prints} == {i: r.fingerprint for i, r in out.items()}
    assert brute_components(prints) == {i: r.component_id for i, r in out.items()}


@pytest.mark.parametrize("blocks,bucket", [(3, 4096), (3, 4), (1, 4096), (2, 10)])
def test_no_link_is_lost_in_crowded_balls(spark, blocks, bucket):
    rng = np.random.default_rng(3)
    values = set()
    for centre in rng.integers(0, 1 << 63, 12):
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            values.add(int(centre) ^ sum(1 << int(b) for b in flips))
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(sorted(values))]
    prints = spark.createDataFrame([(v,) for _, v in signed], "fp long").repartition(3)
    links = simhash.near_links(prints, 4, blocks, bucket).collect()
    ids = {v: i for i, v in signed}
    for a, b in links:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 4
    got = spark.createDataFrame([(ids[a], ids[b]) for a, b in links], "a long, b long")
    roots = {r.node: r.root for r in components(got).collect()}
    expected = brute_components([(i, v % (1 << 64)) for i, v in signed])
    assert {i: roots.get(i, i) for i in expected} == expected


def test_odd_rows(spark):
    long = "alpha beta gamma delta " * 30_000
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One Two"), (8, "one  two"), (2, long), (2, long), (None, "one two")]
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, fp int, component_id int")
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    assert {c for d, f, c in got if d in (3, 4, 5)} == {3}
    assert {c for d, f, c in got if d in (8, 9, None)} == {8}
    assert all(f == 0 for d, f, _ in got if d in (3, 4, 5))
    kept = simhash.one_per_component(docs, simhash.near_duplicates(docs)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_keep_a_row_of_each_component(spark):
    texts = [" ".join(f"{w}{n}" for n in range(80)) for w in ("alpha", "beta", "gamma", "delta", "eps")]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (3, texts[2]), (3, texts[3]), (3, texts[3])]
    rows += [(None, texts[4]), (7, texts[4].upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.one_per_component(docs, simhash.near_duplicates(docs)).collect()
    expected = [(None, texts[0]), (None, texts[1]), (3, texts[2]), (3, texts[3]), (7, texts[4].upper())]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(i), t) for i, t in expected)


def test_components_of_a_long_chain(spark):
    links = spark.range(500).selectExpr("id AS a", "id + 1 AS b")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == dict.fromkeys(range(501), 0)
