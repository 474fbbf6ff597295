import re

import numpy as np

from parcelwise.llm import quality
from parcelwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else None
    if many is None:
        seen, many = set(), set()
        for w in windows:
            (many if w in seen else seen).add(w)
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
        seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_query_counts_and_accuracy(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op8_quality_regression"](spark, SMALL).collect()}
    assert set(rows) == set(docs)
    for i, r in rows.items():
        n = plain_counts(docs[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.base_failed and r.kept)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.learn(docs, labels.where("doc_id % 3 <> 0"))
    held = quality.judge(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = [(r.probability >= 0.5) == (r.quality == 1) for r in held]
    assert np.mean(right) >= 0.9
    # Calibrated: the mean probability is near the share of good rows.
    assert abs(np.mean([r.probability for r in held]) - np.mean([r.quality for r in held])) < 0.08


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n \n"), (4, "word " * 60_000), (4, "word " * 60_000), (None, "é# b\nc\né# b")]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, kept string")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn(docs, empty) is None
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (4, 1), (4, 0)], "doc_id long, quality int")
    assert quality.learn(docs, one) is None
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = [tuple(r[n] for n in names) for r in quality.judge(docs, None).collect()]
    assert sorted(got) == sorted(
        [(0, 0, 0, 0, 0, True, False)] * 3
        + [(60_000, 240_000, 0, 0, 60_000, True, False)] * 2
        + [(5, 7, 2, 1, 0, True, False)]
    )
    assert quality.judge(docs.limit(0), None).count() == 0
