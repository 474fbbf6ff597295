"""Removal of word sequences that a document with a smaller id has too, by repeated-phrase automata.

A window is `window` consecutive words. Words covered by a window that also starts in a document
with a smaller id are removed; windows are judged on the input.

1. Texts are grouped by a 128-bit hash. Of equal texts, all but the one with the smallest id lose
   every word (if there are enough for a window) and take no part in what follows.
2. Phrases of `phrase` words are sampled by their content: a phrase is taken where its hash is the
   smallest of the phrases in some window. Equal windows sample equal phrases, so a window that two
   texts share holds a phrase that both have sampled. Sampled phrases of two texts or more recur;
   this is confirmed by a grouped minimum and maximum of the texts' hashes over all documents.
3. Documents are dealt to chunks of bounded size. Each chunk compiles the recurring phrases its
   documents have sampled into an Aho-Corasick automaton over word numbers: the automata are shards
   of one phrase list, each with what its own documents can hold. All documents of the chunk are
   streamed through it, which locates every occurrence, sampled there or not.
4. Windows around an occurrence are hashed to 128 bits. A chunk keeps the smallest id per window and
   asks all others for a smaller one: one row per window and chunk, however many copies there are.
5. Chunks cut the documents that hold such windows; all others were finished in step 3.

Defined cases: a null text has no words; texts shorter than a window stay whole; a null id is not
compared, its text stays whole; rows that repeat an id are one document; equal texts are cut down to
the one with the smallest id; an empty table gives no rows. Columns other than id and text are not
carried.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelwise.llm.tables import compressed, freeing, packer, stored, text_bytes, uncompressed, unpacker
from parcelwise.scale import written

WINDOW, PHRASE = 50, 20
CHUNK_BYTES = 8 * 1024**2
"""Text of the documents that share an automaton."""

CACHED_WORDS = 500_000
"""Word hashes a Python worker keeps before it empties the store."""

LETTER_BITS = 6
"""A word is spelled with letters of so many bits in the automata."""

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
"""Odd bases of the two rolling hashes."""

FOUND = "chunk long, doc_id long, n_words long, n_removed long, frame binary, done boolean, w1 long, w2 long"
CUT = "doc_id long, n_words long, n_removed long, frame binary"


class WordHashes(dict):
    """64-bit hash of each word, computed once."""

    def __init__(self, seed: int):
        from xxhash import xxh3_64_intdigest

        super().__init__()
        self.of = xxh3_64_intdigest
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.of(word, self.seed)
        return value


class WordNumbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def rolled(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of every run of `length` words, from runs of doubled length."""
    if len(words) < length:
        return words[:0]
    out, have, run, size = None, 0, words, 1
    rest = length
    while rest:
        if rest & 1:
            if out is None:
                out = run
            else:
                fit = min(len(out), len(run) - have)
                out = out[:fit] * np.uint64(pow(base, size, 1 << 64)) + run[have : have + fit]
            have += size
        rest >>= 1
        if rest:
            run = run[: len(run) - size] * np.uint64(pow(base, size, 1 << 64)) + run[size:]
            size *= 2
    return out[: len(words) - length + 1]


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """`best` (minimum or maximum) of every `width` neighbours."""
    have = 1
    while 2 * have <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    return best(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def sampled(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is the smallest of some `width` neighbours. Every `width` hold one."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = _sliding(grams, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    most = _sliding(np.concatenate((pad, least, pad)), width, np.maximum)
    return np.flatnonzero(most == grams)


def phrase_rows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(h, chunk, lo, hi): sampled phrases with the smallest and largest hash `t` of a batch's texts that have them."""

    def sample(batches):
        hashes = WordHashes(0)
        for batch in batches:
            h, chunk, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            names = ("doc_id", "chunk", "t")
            rows = zip(*(batch.column(c).to_pylist() for c in names), batch.column("text").cast(pa.binary()), strict=True)
            for doc_id, own, name, text in rows:
                words = (text.as_py() or b"").split()
                if len(words) < window or doc_id is None:
                    continue
                if len(hashes) > CACHED_WORDS:
                    hashes.clear()
                numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                grams = rolled(numbers, phrase, MULTIPLIERS[0])
                taken = np.unique(grams[sampled(grams, window - phrase + 1)])
                h.append(taken)
                chunk.append(np.full(len(taken), own))
                ids.append(np.full(len(taken), name))
            h, chunk, ids = np.concatenate(h), np.concatenate(chunk), np.concatenate(ids)
            order = np.lexsort((ids, chunk, h))
            h, chunk, ids = h[order], chunk[order], ids[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (chunk[1:] != chunk[:-1])
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(h))[: len(start)] - 1
            columns = [h[start].view(np.int64), chunk[start], ids[start], ids[end]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "chunk", "lo", "hi"])

    return docs.mapInArrow(freeing(sample), "h long, chunk long, lo long, hi long")


class Chunk:
    """The rows of a chunk; `least` has the smallest id of each distinct text that takes part."""

    def __init__(self, docs: pa.Table, copies: frozenset = frozenset()):
        self.ids = docs.column("doc_id").to_pylist()
        self.texts = list(map(unpacker(), docs.column("frame").to_pylist()))
        self.least: dict[bytes, int] = {}
        for doc_id, text in zip(self.ids, self.texts, strict=True):
            if doc_id is not None and doc_id not in copies:
                self.least[text] = min(doc_id, self.least.get(text, doc_id))
        self.numbers = WordNumbers()

    def numbered(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))

    def hashes(self, seed: int) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        return np.fromiter((xxh3_64_intdigest(w, seed) for w in self.numbers), np.uint64, len(self.numbers))


def _letters(numbers: np.ndarray, rank: np.ndarray, width: int) -> tuple:
    """Each word as `width` letters, one alphabet per place: the automaton searches a node's edges one by
    one, so no node may have an edge per word."""
    digits = (rank[numbers][:, None] >> (LETTER_BITS * np.arange(width))) & ((1 << LETTER_BITS) - 1)
    return tuple((digits + (np.arange(width) << LETTER_BITS)).ravel().tolist())


def _occurrences(streams: dict[bytes, np.ndarray], grams: dict, recurring: np.ndarray, window: int, phrase: int):
    """Starts of recurring phrases in each text: the chunk's automaton, run over all its texts."""
    import ahocorasick

    recurring = np.sort(recurring)
    phrases: dict[bytes, np.ndarray] = {}
    for text, numbers in streams.items():
        own = grams[text]
        at = sampled(own, window - phrase + 1)
        near = np.minimum(np.searchsorted(recurring, own[at]), len(recurring) - 1)
        for start in at[recurring[near] == own[at]].tolist():
            words = numbers[start : start + phrase]
            phrases[words.tobytes()] = words
    if not phrases:
        return {}
    # Words of phrases are ranked from 1; all others are 0, which no phrase has.
    used = np.unique(np.concatenate(list(phrases.values())))
    rank = np.zeros(max(int(n.max()) for n in streams.values()) + 1, np.int64)
    rank[used] = np.arange(1, len(used) + 1)
    width = -(-int(len(used)).bit_length() // LETTER_BITS)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for words in phrases.values():
        automaton.add_word(_letters(words, rank, width), 1)
    automaton.make_automaton()
    found = {}
    for text, numbers in streams.items():
        ends = [end for end, _ in automaton.iter(_letters(numbers, rank, width))]
        if ends:
            found[text] = np.array(ends) // width - (phrase - 1)
    return found


def _least_ids(w1: np.ndarray, w2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by window and id, where windows begin, and the window of each ordered row."""
    order = np.lexsort((ids, w2, w1))
    a, b = w1[order], w2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _rows(chunk: int, docs: list[tuple], w1=(), w2=(), w_ids=()) -> pa.Table:
    """Rows of documents (doc_id, n_words, n_removed, frame, done), then rows of windows."""
    windows = len(w1)
    doc_id, n_words, n_removed, frame, done = zip(*docs, strict=True)
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "frame": pa.binary(), "done": pa.bool_()}
    columns = {
        "chunk": pa.array(np.full(len(docs) + windows, chunk)),
        "doc_id": pa.chunked_array([pa.array(doc_id, pa.int64()), pa.array(w_ids, pa.int64())]),
    }
    for (name, kind), values in zip(kinds.items(), (n_words, n_removed, frame, done), strict=True):
        columns[name] = pa.chunked_array([pa.array(values, kind), pa.nulls(windows, kind)])
    for name, values in (("w1", w1), ("w2", w2)):
        columns[name] = pa.chunked_array([pa.nulls(len(docs), pa.int64()), pa.array(values, pa.int64())])
    return pa.table(columns)


def _find(window: int, phrase: int):
    def find(key: tuple, docs: pa.Table, notes: pa.Table) -> pa.Table:
        copies = frozenset(notes.column("doc_id").drop_null().to_pylist())
        chunk = Chunk(docs, copies)
        wanted = notes.column("h").drop_null().to_numpy().view(np.uint64)
        counts, streams = {}, {}
        for text in {*chunk.texts}:
            words = text.split()
            counts[text] = len(words)
            if len(words) >= window and text in chunk.least and len(wanted):
                streams[text] = chunk.numbered(words)
        hashes = chunk.hashes(0)
        grams = {text: rolled(hashes[numbers], phrase, MULTIPLIERS[0]) for text, numbers in streams.items()}
        found = _occurrences(streams, grams, wanted, window, phrase)
        second = chunk.hashes(1) if found else hashes
        w1, w2, ids = [], [], []
        for text, starts in found.items():
            windows = counts[text] - window + 1
            mark = np.zeros(windows + 1, np.int64)
            np.add.at(mark, np.clip(starts - (window - phrase), 0, windows), 1)
            np.add.at(mark, np.clip(starts + 1, 0, windows), -1)
            at = np.flatnonzero(np.cumsum(mark[:-1]))
            w1.append(rolled(hashes[streams[text]], window, MULTIPLIERS[0])[at])
            w2.append(rolled(second[streams[text]], window, MULTIPLIERS[1])[at])
            ids.append(np.full(len(at), chunk.least[text]))
        if w1:
            w1, w2, ids = (np.concatenate(c) for c in (w1, w2, ids))
            order, first, _ = _least_ids(w1, w2, ids)
            w1, w2, ids = (c[order][first] for c in (w1.view(np.int64), w2.view(np.int64), ids))
        rows, pack = [], packer()
        for doc_id, text in zip(chunk.ids, chunk.texts, strict=True):
            n = counts[text]
            if doc_id in copies and n >= window:
                rows.append((doc_id, n, n, pack(b""), True))
            elif doc_id is not None and doc_id not in copies and text in found:
                rows.append((doc_id, n, 0, pack(text), False))
            else:
                rows.append((doc_id, n, 0, pack(b" ".join(text.split())), True))
        return _rows(key[0].as_py(), rows, w1, w2, ids)

    return find


def _among(w1: np.ndarray, w2: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the windows (w1, w2) are among the sorted ones (a, b)."""
    if not len(a):
        return np.zeros(len(w1), bool)
    low, high = np.searchsorted(a, w1, "left"), np.searchsorted(a, w1, "right")
    hit = (low < high) & (b[np.minimum(low, len(a) - 1)] == w2)
    for at in np.flatnonzero((high - low > 1) & ~hit).tolist():
        hit[at] = bool((b[low[at] : high[at]] == w2[at]).any())
    return hit


def _cut(window: int):
    def cut(key: tuple, docs: pa.Table, taken: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        texts = list(chunk.least)
        words = [text.split() for text in texts]
        numbers = [chunk.numbered(w) for w in words]
        first, second = chunk.hashes(0), chunk.hashes(1)
        sizes = [max(0, len(w) - window + 1) for w in words]
        none = np.zeros(0, np.uint64)
        w1 = np.concatenate([none, *(rolled(first[n], window, MULTIPLIERS[0]) for n in numbers)])
        w2 = np.concatenate([none, *(rolled(second[n], window, MULTIPLIERS[1]) for n in numbers)])
        ids = np.repeat(np.array([chunk.least[t] for t in texts], np.int64), sizes)
        order, begin, group = _least_ids(w1, w2, ids)
        later = np.zeros(len(ids), bool)
        if len(order):
            later[order] = ids[order] > ids[order][begin][group]
            # Windows taken by other chunks are looked up by their first half, then compared whole.
            a, b = (taken.column(c).to_numpy().view(np.uint64) for c in ("w1", "w2"))
            sorted_rows = np.lexsort((b, a))
            later |= _among(w1, w2, a[sorted_rows], b[sorted_rows])
        kept, at = {}, 0
        for text, own_words, size in zip(texts, words, sizes, strict=True):
            mark = np.zeros(len(own_words) + 1, np.int64)
            starts = np.flatnonzero(later[at : at + size])
            at += size
            np.add.at(mark, starts, 1)
            np.add.at(mark, starts + window, -1)
            stays = np.cumsum(mark[:-1]) == 0
            kept[text] = (len(own_words), int((~stays).sum()), b" ".join(compress(own_words, stays.tolist())))
        rows, pack = [], packer()
        for doc_id, text in zip(chunk.ids, chunk.texts, strict=True):
            n, removed, left = kept[text]
            rows.append((doc_id, n, removed, pack(left)))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_words", "n_removed", "frame"]
        )

    return cut


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    phrase: int = PHRASE,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by blanks) of every row."""
    chunks = max(1, -(-text_bytes(docs, text) // chunk_bytes))
    hashed = F.coalesce(F.col(text), F.lit(""))
    dealt = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.pmod(F.xxhash64(doc_id, text), F.lit(chunks)).cast("long").alias("chunk"),
        F.xxhash64(hashed).alias("t"),
        F.xxhash64(F.lit(1), hashed).alias("t2"),
    )
    slim = written(dealt.where("doc_id is not null").drop("text"), "text-hashes")
    equal = slim.groupBy("t", "t2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    copies = slim.join(equal.where("least < most"), ["t", "t2"]).where("doc_id > least").select("chunk", "doc_id")
    phrases = written(phrase_rows(dealt.drop("t2"), window, phrase), "phrases")
    span = phrases.groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("h")
    recurring = phrases.join(span, "h", "left_semi").select("chunk", "h").distinct()
    notes = recurring.select("chunk", "h", F.lit(None).cast("long").alias("doc_id")).union(
        copies.select("chunk", F.lit(None).cast("long"), "doc_id")
    )
    rows = dealt.select("chunk", "doc_id", compressed(F.col("text")).alias("frame"))
    found = rows.groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(freeing(_find(window, phrase)), FOUND)
    found = stored(found, "occurrences")
    windows = found.where("w1 is not null").select("chunk", "w1", "w2", "doc_id")
    smallest = F.min("doc_id").over(Window.partitionBy("w1", "w2"))
    taken = windows.withColumn("least", smallest).where("least < doc_id").select("chunk", "w1", "w2")
    held = found.where("done = false").select("chunk", "doc_id", "frame")
    cut = held.groupBy("chunk").cogroup(taken.groupBy("chunk")).applyInArrow(freeing(_cut(window)), CUT)
    everything = cut.union(found.where("done = true").select("doc_id", "n_words", "n_removed", "frame"))
    return everything.select("doc_id", "n_words", "n_removed", uncompressed(F.col("frame")).alias("kept"))
