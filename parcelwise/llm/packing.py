"""Packing of token pieces into sequences: linear grouping, then best fit for the small ones.

Only the histogram of lengths (at most one row per length up to the capacity) reaches the driver:

1. Large lengths are cut into groups of equal cardinality and rounded up to the largest of their
   group. The few sizes are packed by configurations: the linear program over all configurations
   is solved by column generation, whole multiples are taken, the rest is packed by best fit.
2. Documents are substituted: the k-th piece of a group, by a distributed rank, takes the k-th place
   that the configurations give to the group. Real lengths are not above the rounded ones.
3. The space left in each sequence, counted per amount, is filled with small pieces, longest first
   into the tightest space, whole runs of equal pieces and equal spaces at a time. What finds no
   space opens new sequences.

The plan is a list of runs (class, first rank, count, first sequence). Its length depends on the
number of lengths and groups, not on the rows, and ranks find their run by bisection.

Defined cases: a null text is an empty text and gives one piece with the end id alone; only texts
above the capacity are cut; repeated rows are packed once each; an empty table gives no rows.
Columns of the input other than id and text are not carried.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelwise.llm.ranking import rank_in_class
from parcelwise.llm.tables import give_back
from parcelwise.scale import written

CAPACITY = 4096
GROUPS = 64
SMALL_SHARE = 8
"""Pieces up to capacity / SMALL_SHARE are small."""

CACHED_WORDS = 150_000
"""Distinct words in each of the two generations that a Python worker keeps."""

PIECE = "array<struct<piece:int,start:long,length:long,ids:binary>>"


LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
"""Words of these letters are composed already, have simple lower-case forms and are not split by the tokenizer."""

STOPPED = re.compile(r"(.*[A-Za-zÀ-ÖØ-öø-ÿ0-9])([!#$%&()*,./:;=?@^_~-]+)", re.DOTALL)
"""Marks behind a letter or digit are a piece of their own in the tokenizer. Quotes and the signs of special tokens are left out."""


class WordIds(dict):
    """Ids of each word as little-endian unsigned 32-bit integers, encoded once while it is in use.

    A full generation becomes the old one, from which words that come again are taken back."""

    def __init__(self, tokenizer, size: int = CACHED_WORDS):
        super().__init__()
        self.tokenizer, self.merges, self.size = tokenizer, tokenizer.model, size
        self.old: dict[bytes, bytes] = {}
        marked = {c: tokenizer.pre_tokenizer.pre_tokenize_str(c) for c in map(chr, range(0xDF, 0x100)) if LATIN.match(c)}
        self.byte_names = {ord(c): found[0][0] for c, found in marked.items()}

    def encoded(self, word: bytes) -> bytes:
        """Ids of a new word. Latin words are lower-cased and go to the merges in the names that the tokenizer
        gives to bytes; all others, among them those that hold a special token, go through the whole tokenizer."""
        if word.isalpha():
            return array("I", [t.id for t in self.merges.tokenize(word.lower().decode())]).tobytes()
        if word[-1:] in (b".", b",") and word[-2:-1].isalnum():
            return self[word[:-1]] + self[word[-1:]]
        text = word.decode()
        if LATIN.fullmatch(text):
            text = text.lower().translate(self.byte_names)
            return array("I", [t.id for t in self.merges.tokenize(text)]).tobytes()
        parts = STOPPED.fullmatch(text)
        if parts:
            return self[parts[1].encode()] + self[parts[2].encode()]
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encoded(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


@lru_cache(maxsize=2)
def word_encoder(tokenizer_path: str):
    """A function of a text's bytes that gives its ids as little-endian unsigned 32-bit integers.

    The tokenizer drops white space before it merges and no rule of it looks across white space, so
    the ids of a text are those of its words in turn, and words repeat. Special tokens hold no white
    space; where one stands in a word, the tokenizer splits the word there."""
    from tokenizers import Tokenizer

    known = WordIds(Tokenizer.from_file(tokenizer_path))
    return lambda text: b"".join(map(known.__getitem__, text.split()))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length and ids (binary, little-endian unsigned 32-bit) of every piece."""

    @F.arrow_udf(PIECE)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of = word_encoder(tokenizer_path)
        end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for texts in batches:
            ends, piece, start, length, ids = [0], [], [], [], []
            for value in texts.cast(pa.binary()):
                own = ids_of(value.as_py() or b"") + end
                for n, at in enumerate(range(0, len(own), width)):
                    part = own[at : at + width]
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    ids.append(part)
                ends.append(len(piece))
            parts = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            values = pa.StructArray.from_arrays(
                [*parts, pa.array(ids, pa.binary())], ["piece", "start", "length", "ids"]
            )
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        del ids_of
        give_back()

    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(cut(text)).alias("p")).select("doc_id", "p.*")


def equal_groups(histogram: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths, largest first, in runs of about equal cardinality; a frequent length is its own run."""
    goal = max(1, -(-sum(histogram.values()) // groups))
    out: list[list[int]] = []
    filled = goal
    for length in sorted(histogram, reverse=True):
        if filled + histogram[length] > goal and (filled >= goal or histogram[length] >= goal or not out):
            out.append([])
            filled = 0
        out[-1].append(length)
        filled += histogram[length]
    return out


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """(multiplicity, items per size): whole parts of the linear program's solution.

    Column generation: duals of the present basis price a knapsack, whose best filling enters."""
    n = len(sizes)
    if not n:
        return []
    size = np.array(sizes)
    basis = np.diag(capacity // size).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    x = inverse @ np.array(counts, float)
    shift = np.arange(capacity + 1)[None, :] - size[:, None]
    fits = shift >= 0
    shift[~fits] = 0
    for _ in range(40 * n):
        value = inverse.sum(axis=0)
        layers, best = [], np.zeros(capacity + 1)
        for _ in range(capacity // int(size.min())):
            gain = np.where(fits, best[shift] + value[:, None], -1.0)
            item = gain.argmax(axis=0)
            top = gain[item, np.arange(capacity + 1)]
            item[top <= best + 1e-12] = -1
            layers.append(item)
            best = np.maximum(best, top)
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(n), capacity
        for item in reversed(layers):
            if item[room] >= 0:
                column[item[room]] += 1
                room -= sizes[item[room]]
        move = inverse @ column
        ratio = np.where(move > 1e-9, x / np.where(move > 1e-9, move, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * move, 0)
        x[out] = step
        basis[:, out] = column
        row = inverse[out] / move[out]
        inverse = inverse - np.outer(move, row)
        inverse[out] = row
    left, plan = list(counts), []
    for j in np.argsort(-x):
        column = basis[:, j].astype(int)
        used = np.flatnonzero(column)
        times = min([int(x[j] + 1e-6), *(left[g] // int(column[g]) for g in used)])
        if times > 0:
            plan.append((times, column.tolist()))
            for g in used:
                left[g] -= times * int(column[g])
    return plan


class Spaces:
    """Equal spaces in runs of sequences: for each amount of space a list of (class, first, count)."""

    def __init__(self, runs: dict[int, list[tuple[int, int, int]]]):
        self.runs = {space: list(own) for space, own in runs.items() if own}
        self.order = sorted(self.runs)

    def put(self, space: int, run: tuple[int, int, int]) -> None:
        if space not in self.runs:
            self.runs[space] = []
            insort(self.order, space)
        self.runs[space].append(run)

    def tightest(self, length: int) -> tuple[int, tuple[int, int, int]] | None:
        at = bisect_left(self.order, length)
        if at == len(self.order):
            return None
        space = self.order[at]
        run = self.runs[space].pop()
        if not self.runs[space]:
            del self.runs[space], self.order[at]
        return space, run


def best_fit(
    lengths: dict[int, int], spaces: Spaces, capacity: int, fresh: int, first: dict[int, int] | None = None
) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, class of sequences, first of them). Class `fresh` holds new ones.

    `first` has the rank from which a length's pieces are still to be placed."""
    out, opened = [], 0
    for length in sorted(lengths, reverse=True):
        rank = (first or {}).get(length, 0)
        todo = lengths[length]
        while todo:
            found = spaces.tightest(length)
            if found is None:
                new = -(-todo // (capacity // length))
                found = capacity, (fresh, opened, new)
                opened += new
            space, (cls, start, count) = found
            take = min(todo, count)
            out.append((length, rank, take, cls, start))
            spaces.put(space - length, (cls, start, take))
            if take < count:
                spaces.put(space, (cls, start + take, count - take))
            rank, todo = rank + take, todo - take
    return out


def large_plan(histogram: dict[int, int], capacity: int, groups: int) -> tuple[dict[int, int], list[tuple], int]:
    """Group of each large length; runs (group, first rank, count, first sequence); sequences used."""
    grouped = equal_groups(histogram, groups)
    group_of = {length: g for g, own in enumerate(grouped) for length in own}
    sizes = [own[0] for own in grouped]
    left = [sum(histogram[length] for length in own) for own in grouped]
    runs, used, rank = [], 0, [0] * len(sizes)
    for times, column in configurations(sizes, left, capacity):
        for g, items in enumerate(column):
            for _ in range(items):
                runs.append((g, rank[g], times, used))
                rank[g] += times
                left[g] -= times
        used += times
    # A few pieces of each group remain; sizes are distinct, so a size names its group.
    rest = {sizes[g]: left[g] for g in range(len(sizes)) if left[g]}
    starts = {sizes[g]: rank[g] for g in range(len(sizes))}
    group_at = {size: g for g, size in enumerate(sizes)}
    most = used
    for size, first, count, _, at in best_fit(rest, Spaces({}), capacity, 0, starts):
        runs.append((group_at[size], first, count, used + at))
        most = max(most, used + at + count)
    return group_of, runs, most


def _lookup(runs: list[tuple[int, int, int, int, int]]):
    """An Arrow function of (class, rank) that gives the class and the rank of the sequence."""
    runs = sorted(runs)
    start = np.array([(cls << 40) | rank for cls, rank, *_ in runs], np.int64)
    seq_class = np.array([r[3] for r in runs], np.int64)
    seq_first = np.array([r[4] for r in runs], np.int64)

    @F.arrow_udf("struct<c:long,r:long>")
    def place(cls: pa.Array, rank: pa.Array) -> pa.Array:
        key = (cls.to_numpy().astype(np.int64) << 40) | rank.to_numpy()
        at = np.searchsorted(start, key, "right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(seq_class[at]), pa.array(seq_first[at] + key - start[at])], ["c", "r"]
        )

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """`pieces` (doc_id, piece, length and more) with `sequence_id` and `offset`."""
    spark = pieces.sparkSession
    stored = written(pieces.drop("sequence_id", "offset"), "pieces")
    stored = stored.select("*", F.xxhash64(F.col("_metadata.file_path")).alias("__block"))
    histogram = {r.length: r.n for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    small = {length: n for length, n in histogram.items() if length <= capacity // SMALL_SHARE}
    large = {length: n for length, n in histogram.items() if length not in small}
    group_of, large_runs, used = large_plan(large, capacity, groups)
    order = ["doc_id", "piece", "length"]

    # Classes: small lengths as they are, groups of large lengths above the capacity.
    names = [(length, capacity + 1 + group_of[length] if length in group_of else length) for length in histogram]
    classes = F.broadcast(spark.createDataFrame(names, "length long, __class long"))
    ranked = rank_in_class(stored.join(classes, "length"), "__class", "__block", order, "__rank")
    ranked = written(ranked.drop("__block"), "ranked-pieces")

    place = _lookup([(capacity + 1 + g, rank, n, 0, seq) for g, rank, n, seq in large_runs] or [(0, 0, 0, 0, 0)])
    placed = (
        ranked.where(F.col("__class") > capacity)
        .withColumn("sequence_id", place("__class", "__rank")["r"])
        .drop("__class", "__rank")
    )
    filled = placed.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).cast("long").alias("__space"))
    open_sequences = rank_in_class(
        filled.where("__space > 0").withColumn("__block", F.expr("sequence_id div 65536")),
        "__space",
        "__block",
        ["sequence_id"],
        "__rank",
    )
    open_sequences = written(open_sequences.drop("__block"), "open-sequences")
    spaces = {r[0]: r[1] for r in open_sequences.groupBy("__space").agg(F.count(F.lit(1))).collect()}
    small_runs = best_fit(small, Spaces({s: [(s, 0, n)] for s, n in spaces.items()}), capacity, 0)
    place_small = _lookup(small_runs or [(0, 0, 0, 0, 0)])
    targets = (
        ranked.where(F.col("__class") <= capacity)
        .withColumn("__at", place_small("__class", "__rank"))
        .withColumns({"__c": F.col("__at.c"), "__r": F.col("__at.r")})
        .drop("__class", "__rank", "__at")
    )
    into_open = (
        targets.where("__c > 0")
        .join(open_sequences.withColumnsRenamed({"__space": "__c", "__rank": "__r"}), ["__c", "__r"])
        .drop("__c", "__r")
    )
    into_new = targets.where("__c = 0").withColumn("sequence_id", F.col("__r") + used).drop("__c", "__r")
    everything = placed.unionByName(into_open).unionByName(into_new)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece")
    ends = F.sum("length").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return everything.withColumn("offset", (ends - F.col("length")).cast("long"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the joined ids of each sequence of packed pieces that carry `ids`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda out, p: F.concat(out, p["ids"])).alias("ids")
    )
