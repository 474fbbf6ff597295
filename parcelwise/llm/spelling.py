"""Groups of spelling variants by an index of variable-length grams.

Two words are near if one insertion, deletion or replacement of a code point turns one into the other.
Near words are found per length class: class l pairs the words of length l with each other and with
those of length l + 1, and has a gram dictionary of its own.

1. Dictionary. Grams of 2 code points up to `longest_gram(l)` are counted over the words of a class,
   with an edge mark before and after each word. A gram is extended only while it is frequent, so the
   dictionary holds all bigrams and the extensions of frequent grams; it is given by the frequent grams
   alone. Grams more frequent than `least`, or than the total divided by `MAX_FREQUENT`, are frequent,
   so there are never more than `MAX_FREQUENT` of them, and only they are sent to the tasks.
2. Decomposition. From every place of a word the longest gram of the dictionary is taken, unless an
   earlier one covers it.
3. Bounds. For each place of an edit, the grams that it may affect are counted: those that span it, those
   to the left that a longer gram reaching over the edit could replace, and those to the right that a gram
   coming from the edit could cover. The greatest number, `affected`, is the word's bound: a near word
   shares all its other grams. Grams in a class of length l have at most (l + 1) / 2 code points, so
   either the first or the last gram of a word is never affected and the bound is below the number of grams.
4. Merging. Of two near words, each shares a gram among the `affected + 1` first grams of the other in
   one common order, rarest first; so only these short lists are merged. A list holds words with the
   same gram at the same place, counted from the start (left of the edit) or from the end (right of it).
5. Words that meet are verified by their edit distance.

Lists are shuffled by their key and never collected; a crowded one is a skewed join side.

Every word follows its form, the near word of largest count if that is at least twice its own, to the
last one, its root. Counts grow along the way, so there are no cycles, and pointers are doubled each round.

Defined cases: a null text has no runs; an empty text or one without letters gives nothing; a null id is
written as empty in the checksum; repeated rows count as often as they come; an empty table gives no rows;
equal counts go to the smallest word in code-point order. Other columns are not carried.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.scale import written

# Lower-cased runs in UTF-8, where U+00C0 to U+00FF are the byte C3 and another.
PLAIN_RUNS = re.compile(rb"[a-z]+")
RUNS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
DAMAGE = 97
SHORTEST, LEAST_COUNT = 5, 3
SHORTEST_GRAM, LONGEST_GRAM = 2, 6
FIRST, LAST = "\x02", "\x03"
"""Edge marks, which no word holds."""

LEAST_FREQUENT = 40
MAX_FREQUENT = 500_000
KEPT_COUNTS = 500_000
"""Distinct words or grams a task counts before it passes them on."""


def damaged_runs(text: bytes, name: str) -> Iterator[tuple[bytes, int]]:
    """Letter runs of a text with their counts, A-Z lower-cased and one code point deleted where the checksum says so."""
    start = zlib.crc32(f"{name}:".encode())
    found = (PLAIN_RUNS if text.isascii() else RUNS).findall(text.lower())
    for run, n in Counter(found).items():
        if len(run) >= SHORTEST:
            check = zlib.crc32(run, start)
            if check % DAMAGE == 0:
                points = run.decode()
                at = check % len(points)
                run = (points[:at] + points[at + 1 :]).encode()
            if len(run) >= 2 * SHORTEST or len(run.decode()) >= SHORTEST:
                yield run, n


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words with at least `least` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for run, n in damaged_runs(value.as_py(), name or ""):
                    found[run] += n
                if len(found) > KEPT_COUNTS:
                    yield counted(found)
                    found.clear()
        yield counted(found)

    def counted(found: Counter) -> pa.RecordBatch:
        words = pa.array(list(found), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("string"), F.col(text))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def longest_gram(cls: int) -> int:
    """Code points of the longest grams in a class; a word of it with its marks has at least twice as many and one."""
    return min(LONGEST_GRAM, (cls + 1) // 2)


def classes(word: str) -> list[int]:
    """The classes a word belongs to: as one of the shorter words, and as one of the longer."""
    return [len(word), len(word) - 1] if len(word) > SHORTEST else [len(word)]


def frequent_grams(words: DataFrame, least: int = LEAST_FREQUENT, at_most: int = MAX_FREQUENT) -> dict[int, dict[str, int]]:
    """Per class the counts of its frequent grams, `at_most` of them over all classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = defaultdict(Counter)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                marked = FIRST + word + LAST
                for cls in classes(word):
                    for q in range(SHORTEST_GRAM, longest_gram(cls) + 1):
                        found[cls].update([marked[p : p + q] for p in range(len(marked) - q + 1)])
            if sum(map(len, found.values())) > KEPT_COUNTS:
                yield from passed(found)
                found.clear()
        yield from passed(found)

    def passed(found: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
        for cls, own in found.items():
            columns = [pa.array([cls] * len(own), pa.int32()), pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "gram", "n"])

    counted = words.select("word").mapInArrow(count, "cls int, gram string, n long")
    counted = written(counted.groupBy("cls", "gram").agg(F.sum("n").alias("n")).where(F.col("n") > least), "grams")
    # A gram above this count takes more than its share of the total, so fewer than `at_most` are.
    total = counted.agg(F.sum("n")).first()[0] or 0
    out: dict[int, dict[str, int]] = {}
    for row in counted.where(F.col("n") > total // at_most).toLocalIterator():
        out.setdefault(row.cls, {})[row.gram] = row.n
    return out


def inner_ends(frequent: dict[str, int], longest: int) -> set[str]:
    """Proper suffixes of the frequent grams that are extended, and nothing (the end of any gram's beginning)."""
    return {g[k:] for g in frequent if len(g) < longest for k in range(1, len(g))} | {""}


def decompose(marked: str, frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """(place, gram): the longest gram of the dictionary at each place that no earlier one covers."""
    out, covered = [], 0
    for p in range(len(marked) - SHORTEST_GRAM + 1):
        end = p + SHORTEST_GRAM
        while end < len(marked) and end - p < longest and marked[p:end] in frequent:
            end += 1
        if end > covered:
            out.append((p, marked[p:end]))
            covered = end
    return out


def affected(marked: str, grams: list[tuple[int, str]], frequent: dict[str, int], ends: set[str], longest: int) -> int:
    """The most grams that one edit inside the marks may change.

    Grams are in order of both their starts and their ends, so those that stay are some first and some last ones."""
    starts = [p for p, _ in grams]
    stops = [p + len(g) for p, g in grams]
    size = len(marked)
    after = [0] * (size + 1)
    for right in range(1, size):
        # What is kept begins at `right`; a gram that comes from before it may cover all up to `cover`.
        cover = right
        for e in range(min(size, right + longest - 1), right, -1):
            if e - right < SHORTEST_GRAM or marked[right : e - 1] in ends:
                cover = e
                break
        after[right] = len(grams) - max(bisect_left(starts, right), bisect_right(stops, cover))
    least = len(grams)
    for left in range(1, size):
        # Kept are marked[:left] and what begins at `left` (an insertion) or one further (the code point there goes).
        reach = left
        for j in range(max(0, left - longest + 1), left):
            if left - j < SHORTEST_GRAM or marked[j:left] in frequent:
                reach = j
                break
        before = min(bisect_right(stops, left), bisect_left(starts, reach))
        least = min(least, before + after[left])
        if left < size - 1:
            least = min(least, before + after[left + 1])
    return len(grams) - least


POSTING = "key string, word string, longer boolean, letters long"


def postings(words: DataFrame, frequent: dict[int, dict[str, int]]) -> DataFrame:
    """(key, word, longer, letters): the lists that each word goes into; `longer` if it is one of the class's longer
    words, `letters` a bit for each letter (or for some) that it has."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        ends = {cls: inner_ends(own, longest_gram(cls)) for cls, own in tables.items()}
        for batch in batches:
            for low in range(0, batch.num_rows, 5000):
                out = []
                for word in batch.column(0)[low : low + 5000].to_pylist():
                    marked, letters = FIRST + word + LAST, 0
                    for c in word:
                        letters |= 1 << (ord(c) % 63)
                    for cls in classes(word):
                        own, longest = tables.get(cls, {}), longest_gram(cls)
                        grams = decompose(marked, own, longest)
                        lists = 1 + affected(marked, grams, own, ends.get(cls, {""}), longest)
                        rarest = sorted(grams, key=lambda g: (own.get(g[1], 0), g[1], g[0]))[:lists]
                        longer = len(word) > cls
                        for p, g in rarest:
                            out.append((f"{cls}<{p}{g}", word, longer, letters))
                            out.append((f"{cls}>{len(marked) - p}{g}", word, longer, letters))
                columns = list(zip(*out, strict=True)) or [(), (), (), ()]
                kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "word", "longer", "letters"]
                )

    return words.select("word").mapInArrow(emit, POSTING)


def near_words(words: DataFrame, least: int = LEAST_FREQUENT, at_most: int = MAX_FREQUENT) -> DataFrame:
    """(a, b): all pairs of near words of `words` (word, distinct), each once in one direction."""
    lists = written(postings(words, frequent_grams(words, least, at_most)), "gram-lists")
    short = lists.where("not longer").select("key", F.col("word").alias("a"), F.col("letters").alias("x"))
    other = lists.select("key", F.col("word").alias("b"), "longer", F.col("letters").alias("y"))
    # Words of equal length are in step from either end, so their lists from the start are enough.
    wanted = F.col("longer") | ((F.col("a") < F.col("b")) & F.col("key").rlike("^[0-9]+<"))
    # One edit takes at most one letter out and brings one in; this is cheap and leaves few pairs to be verified.
    alike = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= 2
    met = short.join(other, "key").where(wanted & alike & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of `forms` (word, form); a word without a form is its own root."""
    at = written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        moved = written(
            at.join(step, "root").select("word", F.col("__next").alias("root"), (F.col("__next") != F.col("root")).alias("__moved")),
            "roots",
        )
        at = moved.drop("__moved")
        if moved.where("__moved").isEmpty():
            return at


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST_FREQUENT,
    at_most: int = MAX_FREQUENT,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of `docs`."""
    words = written(word_counts(docs, doc_id, text), "words")
    pairs = written(near_words(words, least, at_most), "near-words")
    both = pairs.union(pairs.select("b", "a"))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("__n")), "b")
    # The largest count first, then the smallest word.
    best = counted.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("__n")).alias("m"), F.col("b").alias("w"))).alias("__best")
    )
    large = -F.col("__best.m") >= 2 * F.col("n")
    found = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("__best.w")).alias("form"),
        F.when(large, -F.col("__best.m")).alias("form_n"),
    )
    found = written(found, "forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")
