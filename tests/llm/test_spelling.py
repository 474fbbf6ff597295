import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from parcelwise.llm import spelling
from parcelwise.llm.queries import QUERIES

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def plain_counts(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def near(a, b):
    """One edit apart, by trimming what both begin and end with."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return max(len(a), len(b)) - start - end == 1


def plain_pairs(words):
    """Words that share a form with one place blanked or skipped, compared."""
    meet = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            meet[w[:i] + "*" + w[i + 1 :]].add(w)
            meet[w[:i] + w[i + 1 :]].add(w)
        meet[w].add(w)
    return {(a, b) for own in meet.values() for a in own for b in own if a < b and near(a, b)}


def plain(docs):
    n = plain_counts(docs)
    around = defaultdict(set)
    for a, b in plain_pairs(n):
        around[a].add(b)
        around[b].add(a)
    form = {}
    for w in n:
        best = min(around[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return out


def rows(df):
    return {tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = QUERIES["op13_variable_grams"](spark, folder)
    assert set(df.columns) == set(COLUMNS)
    got = rows(df)
    assert len(got) == df.count()
    assert got == plain(docs)


@pytest.mark.parametrize("least, at_most", [(0, 100_000), (3, 100_000), (40, 100_000), (0, 50)])
def test_pairs_of_crowded_words_at_any_pruning(spark, least, at_most):
    rng = random.Random(least + at_most)
    words = {"".join(rng.choices("ab", weights=(3, 1), k=rng.randint(5, 9))) for _ in range(400)}
    words |= {"".join(rng.choices("abcé", k=rng.randint(5, 18))) for _ in range(800)}
    for w in list(words)[:300]:
        at = rng.randrange(len(w))
        words |= {w[:at] + w[at + 1 :], w[:at] + "z" + w[at:]}
    words = {w for w in words if len(w) >= 5}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [tuple(sorted(r)) for r in spelling.near_words(df, least, at_most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_pairs(words)


def test_one_gram_is_never_affected():
    rng = random.Random(1)
    for _ in range(3000):
        word = "".join(rng.choices("ab", k=rng.randint(5, 20)))
        cls = rng.choice(spelling.classes(word))
        longest = spelling.longest_gram(cls)
        frequent = {"".join(rng.choices("ab\x02\x03", k=rng.randint(2, longest))): 9 for _ in range(60)}
        marked = spelling.FIRST + word + spelling.LAST
        grams = spelling.decompose(marked, frequent, longest)
        ends = spelling.inner_ends(frequent, longest)
        bound = spelling.affected(marked, grams, frequent, ends, longest)
        assert bound < len(grams)
        # Real edits change no more grams than the bound says.
        for at in range(1, len(marked) - 1):
            for other in (marked[:at] + marked[at + 1 :], marked[:at] + "a" + marked[at + 1 :], marked[:at] + "b" + marked[at:]):
                if other != marked and len(other) >= cls + 2:
                    kept = Counter(g for _, g in grams) & Counter(g for _, g in spelling.decompose(other, frequent, longest))
                    assert len(grams) - sum(kept.values()) <= bound


def test_frequent_grams_are_bounded(spark):
    words = spark.createDataFrame([("".join(random.Random(i).choices("abcd", k=9)),) for i in range(2000)], "word string").distinct()
    for at_most in (10, 200):
        assert sum(map(len, spelling.frequent_grams(words, 0, at_most).values())) < at_most


def test_odd_rows(spark):
    long = "Variant variand " * 40_000
    data = [(None, "Colour colour colour"), (1, None), (2, ""), (3, "1234 !!"), (4, long), (5, "color Color color color color color")]
    data += [(6, "naïveté naïveté naïveté naivété")] * 3 + [(7, "étage étages étage étages étages étage")]
    schema = "doc_id long, text string, word long, n string, form string"
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in data], schema)
    assert rows(spelling.variants(docs.repartition(3))) == plain(data)
    empty = spelling.variants(docs.limit(0))
    assert empty.count() == 0 and dict(empty.dtypes)["n_near"] == "bigint"
    assert isinstance(empty.schema["form"].dataType, T.StringType)
