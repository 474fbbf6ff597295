"""Language-model scores: the bits of words, and of the spelling of unknown ones, by mixed and gated predictors.

A text is its words, A-Z lower-cased, and an end after the last one. Words of training texts are numbered by falling
count, so a word is a way of binary choices, the bits of its number. Each choice is predicted in the logistic domain
from what came after the word before it (the end, for the first), from all words, and from both together; weights are
from sets chosen by how often the word before has been at that choice (the gate), and the result is refined by an
adaptive map. A way on which the word before has seen nothing more is left to the counts of all words. The chance of
an unknown word is gated by how often the word before was seen; its spelling is predicted bit by bit too.

Weights are trained on all pairs of the training texts, each as often as it comes and predicted from counts without
itself; training texts are scored without themselves in the same way, held-out texts from all counts. A text's score is
the sum of its log probabilities, which gives total bits per byte.

Texts are parsed once, into streams of word numbers per chunk of documents, and do not move. A chunk sends its
distinct words, compressed per bucket of words, and gets their numbers, counts and spellings back; it then sends its
distinct pairs, compressed per bucket of previous words, and gets their log probabilities back. A bucket has all pairs
of its previous words, so the counts at every choice are sums over runs of its sorted pairs. No pair is left out, and
what is gathered grows with the corpus.

The spelling model mixes five bit predictors that look at different contexts: the place in the word, the
last one, two and three bytes, and all bytes of the word so far together with whether a sentence begins.
Each keeps counts of zeros and ones per hashed context. Their probabilities are stretched and summed with
weights from one of sixteen sets, chosen by how much the two longest contexts have seen (the gate), and
squashed. The result is refined by an adaptive map from its own value and the bits of the byte so far to
what really came. It is learned from the words that came once, which are what new words are like. Bit
counts are added up over partitions; weights are trained online, step by step through the words of a
partition, each predicted from counts without itself, and averaged over partitions by their number of bits.

No table that grows with the corpus is broadcast or fetched: the driver gets numbers of words per class of counts.

Defined cases: a null text is empty, and an empty text is its end alone; a null id is learned from; repeated
rows count as often as they come; without training rows every bit has probability one half and the base
score is 0 per token; an empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelwise.llm.tables import CHUNK_BYTES, freeing, packer, stored, text_bytes, unpacker

# Slots of each predictor as a power of two.
SLOT_BITS = (11, 16, 18, 19, 20)
BEGIN = np.concatenate(([0], np.cumsum([1 << b for b in SLOT_BITS])))
SLOTS = int(BEGIN[-1])
PREDICTORS = len(SLOT_BITS)

PRIOR = 0.1
"""Added to both counts of a context."""

GATES, INPUTS = 16, PREDICTORS + 1
FIRST_WEIGHTS = (0.25,) * INPUTS
RATE, STEP_BITS = 0.02, 1 << 15
REFINE_STEPS, REFINE_LIMIT, REFINE_PRIOR = 33, 8.0, 20.0
WORDS_AT_ONCE = 5_000
SUM_PARTS = 32
"""Groups in which the partitions' weights are added up."""

BUCKET_BYTES = 16 * 1024**2
"""Text whose pairs share a bucket, on average."""

KEY_BITS = 32
GATED, RATIO_STEPS, LOWEST, HIGHEST = 40, 64, -15, 25
FIT_ROUNDS, PRIOR_TOKENS = 20, 20.0

CLASSES, EXACT = 640, 64
CHUNK_ROWS, PAIRS_AT_ONCE, TOKENS_AT_ONCE = 100_000, 50_000, 500_000
WORD_WEIGHTS = (0.0, 0.0, 1.0, 0.0)
"""Weights of the words' inputs before training."""

SEEN_STEPS = (1.5, 2.5, 4.5, 8.5, 16.5, 64.5, 512.5)
"""Counts of the word before at which the gate of a choice changes."""

SEEN_LEVELS = np.searchsorted(SEEN_STEPS, np.arange(int(SEEN_STEPS[-1]) + 2))
"""The same for each count up to the last change."""

ENDERS = (b".", b"!", b"?")
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def words_of(text: str | bytes | None) -> list[bytes]:
    """Lower-cased words and the end token, which is an empty word."""
    raw = text or b""
    return [*(raw.encode() if isinstance(raw, str) else raw).lower().split(), b""]


def ending(words: list[bytes]) -> np.ndarray:
    """True for words that end a sentence."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words) + b" ", np.uint8)
    return (size > 0) & np.isin(data[np.cumsum(size) - 1], [e[0] for e in ENDERS])


def begins(numbers: np.ndarray, enders: np.ndarray) -> np.ndarray:
    """True for tokens at the beginning of a text or after a word that ends a sentence."""
    out = np.ones(len(numbers), bool)
    out[1:] = enders[numbers[:-1]]
    return out


def begins_at(tokens: np.ndarray, first: np.ndarray, enders: np.ndarray) -> np.ndarray:
    """The same for the joined tokens of several texts, which begin at the places `first`."""
    out = begins(tokens, enders)
    out[first] = True
    return out


@dataclass
class Bits:
    """All bits of some words: slot per predictor, the bit, its word, and the byte's bits so far."""

    slots: np.ndarray
    bit: np.ndarray
    word: np.ndarray
    node: np.ndarray


def bits_of(words: list[bytes], begin: np.ndarray) -> Bits:
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    word = np.repeat(np.arange(len(words)), size)
    start = np.repeat(np.cumsum(size) - size, size)
    place = np.arange(len(data)) - start
    mark = np.where(begin[word], np.uint64(1), np.uint64(2))
    last = []
    for back in (1, 2, 3):
        at = np.arange(len(data)) - back
        last.append(np.where(place >= back, data[np.maximum(at, 0)], np.where(place == back - 1, mark, 0)))
    two = last[0] | (last[1] << np.uint64(8))
    three = two | (last[2] << np.uint64(16))
    # Hash of the word so far: running sums of mixed bytes, less what came before the word.
    mixed = (data + np.uint64(1)) * MIX
    mixed = (mixed ^ (mixed >> np.uint64(29))) * (2 * place.astype(np.uint64) + np.uint64(1)) * MIX
    before = np.concatenate(([np.uint64(0)], np.cumsum(mixed)))
    prefix = before[:-1] - before[start] + mark
    contexts = (np.minimum(place, 7).astype(np.uint64), last[0], two, three, prefix)
    byte = data.astype(np.int64)
    shift = np.arange(8)
    node = ((1 << shift) | (byte[:, None] >> (8 - shift))).astype(np.uint64)
    bit = ((byte[:, None] >> (7 - shift)) & 1).astype(bool)
    slots = np.empty((PREDICTORS, len(data), 8), np.int32)
    for k, (context, width) in enumerate(zip(contexts, SLOT_BITS, strict=True)):
        if k < 2:
            slots[k] = (context[:, None] << np.uint64(8)) | node
        else:
            h = ((context * MIX)[:, None] ^ (node << np.uint64(40))) * MIX
            slots[k] = (h ^ (h >> np.uint64(31))) * MIX >> np.uint64(64 - width)
        slots[k] += BEGIN[k]
    return Bits(slots.reshape(PREDICTORS, -1), bit.ravel(), np.repeat(word, 8), node.ravel().astype(np.int32))


def _items(words: list[bytes], counts: tuple[np.ndarray, np.ndarray]):
    """Words once per way of beginning in which they were seen, with their counts."""
    out_words, begin, weight = [], [], []
    for at, own in enumerate(counts):
        seen = np.flatnonzero(own > 0)
        out_words += [words[i] for i in seen.tolist()]
        begin.append(np.full(len(seen), at == 1))
        weight.append(own[seen].astype(np.float64))
    return out_words, np.concatenate(begin), np.concatenate(weight)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], tuple]]:
    """Words and counts of the columns word, n0 and n1, some batches at once."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= WORDS_AT_ONCE:
            yield _columns(held)
            held, rows = [], 0
    if rows:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> tuple[list[bytes], tuple]:
    table = pa.Table.from_batches(batches)
    words = [w.encode() for w in table.column("word").to_pylist()]
    return words, tuple(table.column(c).to_numpy() for c in ("n0", "n1"))


def bit_counts(vocabulary: DataFrame) -> np.ndarray:
    """Zeros and ones per slot over all training words, each as often as it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, total = packer(), np.zeros(2 * SLOTS)
        for words, counts in _grouped(batches):
            items, begin, weight = _items(words, counts)
            if items:
                bits = bits_of(items, begin)
                for own in bits.slots:
                    total += np.bincount(2 * own + bits.bit, weight[bits.word], 2 * SLOTS)
        at = np.flatnonzero(total)
        # Parts of the table, so that the sum is shared among tasks.
        part = at >> 16
        for p in np.unique(part):
            own = at[part == p]
            steps = np.diff(own & 0xFFFF, prepend=0).astype(np.uint16)
            columns = [[int(p)], [pack(steps.tobytes())], [pack(total[own].tobytes())]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                ["part", "at", "n"],
            )

    def add(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, total = unpacker(), np.zeros(1 << 16)
        for batch in rows:
            for at, n in zip(batch.column("at").to_pylist(), batch.column("n").to_pylist(), strict=True):
                total[np.cumsum(np.frombuffer(unpack(at), np.uint16))] += np.frombuffer(unpack(n))
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())],
            ["part", "n"],
        )

    counted = vocabulary.where("n0 + n1 > 0").select("word", "n0", "n1")
    parts = counted.mapInArrow(freeing(count), "part int, at binary, n binary")
    out = np.zeros(((2 * SLOTS >> 16) + 1) << 16, np.float32)
    for row in parts.groupBy("part").applyInArrow(add, "part int, n binary").collect():
        out[row.part << 16 : (row.part + 1) << 16] = np.frombuffer(row.n, np.float32)
    return out[: 2 * SLOTS].reshape(SLOTS, 2)


def _stretched(counts: np.ndarray, bits: Bits, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of the mixer and the weight set of each bit. `own` is what to leave out of the counts."""
    inputs = np.empty((INPUTS, len(bits.bit)), np.float32)
    level = []
    for k, slots in enumerate(bits.slots):
        zeros, ones = counts[slots].T
        if own is not None:
            zeros = np.maximum(zeros - own * ~bits.bit, 0)
            ones = np.maximum(ones - own * bits.bit, 0)
        inputs[k] = np.log((ones + PRIOR) / (zeros + PRIOR))
        if k >= PREDICTORS - 2:
            seen = zeros + ones
            level.append(sum((seen > step).astype(np.int64) for step in (0.5, 2.5, 12.5)))
    inputs[-1] = 0.3
    return inputs, level[0] * 4 + level[1]


def _mixed(inputs: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(gate))
    for row, own in zip(inputs, np.ascontiguousarray(weights.T), strict=True):
        total += row * own[gate]
    return np.clip(total, -REFINE_LIMIT, REFINE_LIMIT)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _refine_at(mixed: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower slot of the refinement table and the share of the one above it."""
    place = (mixed + REFINE_LIMIT) * (REFINE_STEPS - 1) / (2 * REFINE_LIMIT)
    low = np.minimum(place.astype(np.int64), REFINE_STEPS - 2)
    return node * REFINE_STEPS + low, place - low


@dataclass
class Model:
    counts: np.ndarray
    weights: np.ndarray
    refined: np.ndarray

    def log10(self, words: list[bytes], begin: np.ndarray) -> np.ndarray:
        """log10 probability of each word and its end."""
        bits = bits_of(words, begin)
        mixed = _mixed(*_stretched(self.counts, bits, None), self.weights)
        slot, share = _refine_at(mixed, bits.node)
        p = (_squash(mixed) + self.refined[slot] * (1 - share) + self.refined[slot + 1] * share) / 2
        return np.bincount(bits.word, np.log10(np.where(bits.bit, p, 1 - p)), len(words))


PARTS = "part int, weights binary, seen binary, came binary"


def _parts_row(part: int, *sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32()), *(pa.array([s.tobytes()], pa.binary()) for s in sums)]
    return pa.RecordBatch.from_arrays(columns, ["part", "weights", "seen", "came"])


class Learning:
    """Weights trained online, and what came at each mixed value."""

    def __init__(self, first: tuple[float, ...]):
        self.weights = np.tile(np.array(first), (GATES, 1))
        self.squares, self.seen = np.full(self.weights.shape, 1e-4), np.zeros(GATES)
        self.came = np.zeros((256 * REFINE_STEPS, 2))

    def learn(self, inputs: np.ndarray, gate: np.ndarray, bit: np.ndarray, worth: np.ndarray, node: np.ndarray) -> None:
        for at in range(0, len(worth), STEP_BITS):
            part = slice(at, at + STEP_BITS)
            x, g, w = inputs[:, part], gate[part], worth[part]
            error = w * (bit[part] - _squash(_mixed(x, g, self.weights)))
            total = np.bincount(g, w, GATES)
            slope = np.stack([np.bincount(g, error * row, GATES) for row in x], axis=1)
            slope /= np.maximum(total, 1e-9)[:, None]
            self.squares += slope**2
            self.weights += RATE * slope / np.sqrt(self.squares) * (1 + 4 / np.sqrt(1 + self.seen / STEP_BITS))[:, None]
            self.seen += np.bincount(g, minlength=GATES)
        slot, share = _refine_at(_mixed(inputs, gate, self.weights), node)
        for step, part in ((0, 1 - share), (1, share)):
            self.came[:, 0] += np.bincount(slot + step, worth * part * ~bit, len(self.came))
            self.came[:, 1] += np.bincount(slot + step, worth * part * bit, len(self.came))

    def row(self) -> pa.RecordBatch:
        part = TaskContext.get().partitionId() % SUM_PARTS
        return _parts_row(part, self.weights * self.seen[:, None], self.seen, self.came)


def averaged(parts: DataFrame, first: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Averaged weights, and the refinement table of what came at each mixed value."""

    inputs = len(first)

    def add(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(GATES * inputs), np.zeros(GATES), np.zeros(256 * REFINE_STEPS * 2)]
        for batch in rows:
            for total, name in zip(sums, ("weights", "seen", "came"), strict=True):
                for value in batch.column(name).to_pylist():
                    total += np.frombuffer(value)
        yield _parts_row(key[0].as_py(), *sums)

    weights, seen = np.zeros((GATES, inputs)), np.zeros(GATES)
    came = np.zeros((256 * REFINE_STEPS, 2))
    # Partitions' results are added up in a fixed number of groups before the driver gets them.
    for row in parts.groupBy("part").applyInArrow(add, PARTS).collect():
        weights += np.frombuffer(row.weights).reshape(weights.shape)
        seen += np.frombuffer(row.seen)
        came += np.frombuffer(row.came).reshape(came.shape)
    weights = np.where(seen[:, None] > 0, weights / np.maximum(seen, 1)[:, None], Learning(first).weights)
    value = np.tile(_squash(np.linspace(-REFINE_LIMIT, REFINE_LIMIT, REFINE_STEPS)), 256)
    refined = (came[:, 1] + REFINE_PRIOR * value) / (came.sum(axis=1) + REFINE_PRIOR)
    return weights, np.clip(refined, 1e-5, 1 - 1e-5)


def mixer(vocabulary: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement of the spelling."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Learning(FIRST_WEIGHTS)
        for words, pair in _grouped(batches):
            items, begin, weight = _items(words, pair)
            if not items:
                continue
            order = np.random.default_rng(len(items)).permutation(len(items))
            bits = bits_of([items[i] for i in order], begin[order])
            inputs, gate = _stretched(counts, bits, np.float32(1))
            state.learn(inputs, gate, bits.bit, weight[order][bits.word], bits.node)
        yield state.row()

    trained = vocabulary.where("n0 + n1 > 0").select("word", "n0", "n1")
    return averaged(trained.mapInArrow(freeing(train), PARTS), FIRST_WEIGHTS)


def pair_keys(hashes: np.ndarray, before: np.ndarray, tokens: np.ndarray, bucket_bits: int) -> np.ndarray:
    """Key of each token with the one before it. The first bits are the bucket."""
    mixed = (hashes[before] * MIX) ^ (hashes[before] >> np.uint64(32))
    mixed = (mixed + hashes[tokens]) * MIX
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    return mixed >> np.uint64(64 - KEY_BITS - bucket_bits)


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def squeezed(values: np.ndarray, pack) -> bytes:
    """32-bit numbers, lowest bytes first, compressed."""
    return pack(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unsqueezed(data: bytes, unpack) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpack(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _pair_rows(chunk: int, keys: np.ndarray, taught: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
    """One row per bucket with the chunk's distinct keys and how often training texts have them; that count per token."""
    pack = packer()
    distinct, place = np.unique(keys, return_inverse=True)
    count = np.bincount(place, taught, len(distinct)).astype(np.int64)
    bucket = (distinct >> np.uint64(KEY_BITS)).astype(np.int64)
    start = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = (distinct & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64)
    blobs, counts = [], []
    for a, b in zip(start.tolist(), [*start[1:].tolist(), len(distinct)], strict=True):
        blobs.append(squeezed(np.diff(low[a:b], prepend=0), pack))
        counts.append(squeezed(count[a:b], pack))
    columns = {"bucket": pa.array(bucket[start].astype(np.int32)), "keys": pa.array(blobs, pa.binary())}
    return _chunk_rows(chunk, len(start), **columns, counts=pa.array(counts, pa.binary())), count[place]


CHUNK_SCHEMA = "chunk long, word string, n0 long, n1 long, seen int, bucket int, keys binary, counts binary"
CHUNK_TYPES = {
    "word": pa.string(),
    "n0": pa.int64(),
    "n1": pa.int64(),
    "seen": pa.int32(),
    "bucket": pa.int32(),
    "keys": pa.binary(),
    "counts": pa.binary(),
}


def _chunk_rows(chunk: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
    arrays = [columns.get(name, pa.nulls(n, kind)) for name, kind in CHUNK_TYPES.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk, np.int64)), *arrays], ["chunk", *CHUNK_TYPES])


def pair_totals(parts: DataFrame) -> DataFrame:
    """(chunk, bucket, totals): training counts over all chunks of each chunk's distinct keys, in their order."""

    def add(key: tuple, blobs: pa.Table) -> pa.Table:
        pack, unpack = packer(), unpacker()
        chunks = blobs.column("chunk").to_numpy()
        keys = [np.cumsum(unsqueezed(k, unpack).astype(np.int64)) for k in blobs.column("keys").to_pylist()]
        counts = [unsqueezed(c, unpack) for c in blobs.column("counts").to_pylist()]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        out = []
        for chunk in np.unique(chunks):
            # A chunk that was read in parts has several blobs here.
            own = np.unique(np.concatenate([place[ends[r] - len(keys[r]) : ends[r]] for r in np.flatnonzero(chunks == chunk)]))
            out.append((int(chunk), key[0].as_py(), squeezed(total[own], pack)))
        names, buckets, totals = zip(*out, strict=True)
        return pa.table([pa.array(names, pa.int64()), pa.array(buckets, pa.int32()), pa.array(totals, pa.binary())], ["chunk", "bucket", "totals"])

    blobs = parts.where("bucket is not null").select("bucket", "chunk", "keys", "counts")
    return blobs.groupBy("bucket").applyInArrow(add, "chunk long, bucket int, totals binary")


def laid_out(tokens: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' tokens joined, those before them, the text of each, and where texts begin."""
    size = np.array([len(t) for t in tokens])
    at, first = np.concatenate(tokens), np.cumsum(size) - size
    prior = np.concatenate(([end], at[:-1]))
    prior[first] = end
    return at, prior, np.repeat(np.arange(len(tokens)), size), first


def estimates(count: np.ndarray, pair: np.ndarray, at: np.ndarray, prior: np.ndarray, itself: np.ndarray, total: int):
    """Probabilities by the pair and by the word, the gate, and the word's count, all without the token itself."""
    before, alone = count[prior] - itself, count[at] - itself
    by_word = np.maximum(alone, 0.5) / max(total, 1)
    by_pair = np.maximum(pair - itself, 0) / np.maximum(before, 1)
    gate = np.minimum(np.log2(np.maximum(before, 0) + 1).astype(np.int64), GATED - 1)
    return by_pair, by_word, gate, alone


def gate_table(by_pair: np.ndarray, by_word: np.ndarray, gate: np.ndarray, alone: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """Per gate the number of tokens by the ratio of both probabilities, then of words that nothing else has. Each
    entry stands for `times` tokens, or one."""
    ratio = np.log2(np.maximum(by_pair / by_word, 2.0**LOWEST))
    step = 1 + np.round((ratio - LOWEST) * (RATIO_STEPS - 2) / (HIGHEST - LOWEST)).astype(np.int64)
    step = np.where(by_pair > 0, np.clip(step, 1, RATIO_STEPS - 1), 0)
    step = np.where(alone > 0, step, RATIO_STEPS)
    width = RATIO_STEPS + 1
    return np.bincount(gate * width + step, times, GATED * width).astype(np.int64).reshape(GATED, width)


@dataclass
class Gates:
    """Per gate the weight of the pair counts, beside that of the word counts, and the chance of an unknown word."""

    pair: np.ndarray
    unknown: np.ndarray
    linear: bool = True
    """Known words by the weighted counts alone, as the tests compare them; a fit mixes their bits instead."""


def fitted_gates(table: np.ndarray, share: float) -> Gates:
    """Weights by expectation maximisation on the tabulated ratios. `share` is that of words seen once in the whole
    corpus, to which the chances of an unknown word are scaled: chunks alone know fewer words."""
    found, single = table[:, :RATIO_STEPS].astype(float), table[:, RATIO_STEPS]
    value = np.concatenate(([0.0], 2.0 ** np.linspace(LOWEST, HIGHEST, RATIO_STEPS - 1)))
    pair = np.full(GATED, 0.5)
    for _ in range(FIT_ROUNDS):
        part = pair[:, None] * value
        part /= part + (1 - pair[:, None])
        pair = ((found * part).sum(axis=1) + 0.5 * PRIOR_TOKENS) / (found.sum(axis=1) + PRIOR_TOKENS)
    local = max(single.sum(), 1) / max(table.sum(), 1)
    chance = (single + PRIOR_TOKENS * local) / (table.sum(axis=1) + PRIOR_TOKENS)
    return Gates(pair, np.clip(chance * share / local, 1e-7, 0.5), linear=False)


def all_gates(parts: DataFrame, share: float) -> Gates:
    """Gates fitted to the tables of all chunks, which are added up in a fixed number of groups."""

    def add(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(GATED * (RATIO_STEPS + 1), np.int64)
        for batch in rows:
            for table in batch.column("keys").to_pylist():
                total += np.frombuffer(table, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["keys"])

    tables = parts.where("bucket is null and keys is not null").select(F.pmod("chunk", F.lit(SUM_PARTS)).alias("part"), "keys")
    total = np.zeros((GATED, RATIO_STEPS + 1), np.int64)
    for row in tables.groupBy("part").applyInArrow(add, "keys binary").collect():
        total += np.frombuffer(row["keys"], np.int64).reshape(total.shape)
    return fitted_gates(total, share)


def class_of(counts: np.ndarray) -> np.ndarray:
    """Class of words by their training count: exact ones below EXACT, then sixteen to a doubling."""
    above = EXACT + np.floor(16 * np.log2(np.maximum(counts, 1) / EXACT)).astype(np.int64)
    return np.where(counts < EXACT, counts, np.minimum(above, CLASSES - 1))


@dataclass
class Ranks:
    """Known words numbered by falling class. `edges` are the numbers at which classes begin, `below` the counts
    before them: order-0 counts of any run of numbers, as exact as the classes."""

    first: np.ndarray
    edges: np.ndarray
    below: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, counts: np.ndarray) -> Ranks:
        falling = np.arange(CLASSES - 1, 0, -1)
        edges = np.concatenate(([0], np.cumsum(words[falling])))
        first = np.zeros(CLASSES, np.int64)
        first[falling] = edges[:-1]
        first[0] = edges[-1]
        return cls(first, edges, np.concatenate(([0.0], np.cumsum(counts[falling], dtype=float))))

    @property
    def known(self) -> int:
        return int(self.edges[-1])

    @property
    def bits(self) -> int:
        return max(1, (self.known - 1).bit_length())

    def before(self, rank: np.ndarray) -> np.ndarray:
        return np.interp(rank, self.edges, self.below)


PARSED = (
    "chunk long, doc_id {0}, at int, n_bytes long,"
    " bucket int, words binary, numbers binary, keys binary, stream binary, held binary"
)


def parsed(rows: DataFrame, chunk_bytes: int, bucket_bits: int) -> DataFrame:
    """Documents as streams of word numbers.

    Per document (chunk, doc_id, at, n_bytes); per chunk and bucket of words the distinct words and their
    `numbers`: how often they come, training counts inside and at the beginning of sentences, and bits 1 and 2 if
    any document has the word there; per chunk the gate table in `keys`; and per chunk the stream, in numbers by
    falling frequency, `numbers` with that frequency and whether the word ends a sentence, and `held` per document."""
    schema = PARSED.format(rows.schema["doc_id"].dataType.simpleString())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, part, serial = packer(), TaskContext.get().partitionId(), 0
        numbers, streams, held, size, types = WordNumbers(), [], [], 0, None

        def rows_of(n: int, **columns) -> pa.RecordBatch:
            chunk = pa.array(np.full(n, part << 32 | serial, np.int64))
            arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in types]
            return pa.RecordBatch.from_arrays([chunk, *arrays], ["chunk", *(f.name for f in types)])

        def flush() -> Iterator[pa.RecordBatch]:
            words, flags = list(numbers), np.array(held, bool)
            at, prior, doc, first = laid_out(streams, numbers[b""])
            taught = ~flags[doc]
            enders = ending(words)
            start = begins_at(at, first, enders)
            n = [np.bincount(at[own], minlength=len(words)) for own in (slice(None), taught & ~start, taught & start, ~start, start)]
            tallies = np.stack([n[0], n[1], n[2], (n[3] > 0) + 2 * (n[4] > 0)])
            bucket = bucket_of(word_hashes(words), bucket_bits)
            spelled = np.empty(len(words), np.int64)
            spelled[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
            order = np.lexsort((spelled, -n[0], bucket))
            for a, b in runs(bucket[order]):
                own = order[a:b]
                blob = pack(b"\n".join([words[i] for i in own.tolist()]))
                yield rows_of(1, bucket=[bucket[own[0]]], words=[blob], numbers=[squeezed(tallies[:, own].ravel(), pack)])
            del doc, start, tallies
            own, before, count = at[taught], prior[taught], n[1] + n[2]
            del prior, taught
            pairs, times = np.unique(before.astype(np.int64) * len(words) + own, return_counts=True)
            before, own = np.divmod(pairs, len(words))
            table = np.zeros((GATED, RATIO_STEPS + 1), np.int64)
            for k in range(0, len(own), TOKENS_AT_ONCE):
                part = slice(k, k + TOKENS_AT_ONCE)
                found = estimates(count, times[part], own[part], before[part], np.int64(1), int(count.sum()))
                table += gate_table(*found, times[part])
            yield rows_of(1, keys=[table.tobytes()])
            number = np.empty(len(words), np.int64)
            number[order[np.argsort(-n[0][order], kind="stable")]] = np.arange(len(words))
            stream, often = squeezed(number[at], pack), squeezed(np.concatenate((n[0][order], enders[order])), pack)
            yield rows_of(1, stream=[stream], numbers=[often], held=[pack(flags.tobytes())])

        for batch in batches:
            if types is None:
                kinds = {"at": pa.int32(), "n_bytes": pa.int64(), "bucket": pa.int32()}
                blobs = ("words", "numbers", "keys", "stream", "held")
                types = [batch.schema.field("doc_id"), *(pa.field(*k) for k in kinds.items()), *(pa.field(b, pa.binary()) for b in blobs)]
            ids, texts, flags = batch.column("doc_id"), batch.column("text").cast(pa.binary()), batch.column("held_out").to_pylist()
            begin, lengths = 0, []
            for i in range(batch.num_rows):
                raw = texts[i].as_py() or b""
                words = words_of(raw)
                streams.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                held.append(flags[i])
                lengths.append(len(raw))
                size += len(raw)
                full = size >= chunk_bytes or len(held) >= CHUNK_ROWS
                if full or i + 1 == batch.num_rows:
                    places = np.arange(len(held) - len(lengths), len(held))
                    own = {"doc_id": ids[begin : i + 1], "at": places, "n_bytes": lengths}
                    yield rows_of(len(lengths), **own)
                    begin, lengths = i + 1, []
                if full:
                    yield from flush()
                    serial, numbers, streams, held, size = serial + 1, WordNumbers(), [], [], 0
        if held:
            yield from flush()

    return rows.select("doc_id", "text", "held_out").mapInArrow(freeing(parse), schema)


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    begin = np.flatnonzero(np.diff(values, prepend=-1)).tolist()
    return list(zip(begin, [*begin[1:], len(values)], strict=True)) if begin else []


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


VOCABULARY = "bucket int, words binary, numbers binary, chunks array<long>, places array<binary>, sizes array<long>, sums array<long>"


def vocabulary_of(parts: DataFrame) -> DataFrame:
    """One row per bucket: its words by falling class with their training counts, the places in it of each chunk's
    words, and the number of words and tokens per class."""

    def merge(key: tuple, blobs: pa.Table) -> pa.Table:
        pack, unpack = packer(), unpacker()
        names, places, numbers = WordNumbers(), [], []
        for words, counts in zip(blobs.column("words").to_pylist(), blobs.column("numbers").to_pylist(), strict=True):
            found = unpack(words).split(b"\n")
            places.append(np.fromiter(map(names.__getitem__, found), np.int64, len(found)))
            numbers.append(unsqueezed(counts, unpack).reshape(4, -1))
        at, tallies = np.concatenate(places), np.concatenate(numbers, axis=1)
        n0, n1 = (np.bincount(at, tallies[k], len(names)).astype(np.int64) for k in (1, 2))
        seen = np.zeros(len(names), np.int64)
        np.bitwise_or.at(seen, at, tallies[3].astype(np.int64))
        kind = class_of(n0 + n1)
        order = np.argsort(-kind, kind="stable")
        back = np.empty(len(names), np.int64)
        back[order] = np.arange(len(names))
        words = list(names)
        row = {
            "bucket": pa.array([key[0].as_py()], pa.int32()),
            "words": pa.array([pack(b"\n".join([words[i] for i in order.tolist()]))], pa.binary()),
            "numbers": pa.array([pack(np.stack([n0, n1, seen])[:, order].tobytes())], pa.binary()),
            "chunks": pa.array([blobs.column("chunk").to_pylist()], pa.list_(pa.int64())),
            "places": pa.array([[squeezed(back[p], pack) for p in places]], pa.list_(pa.binary())),
            "sizes": pa.array([np.bincount(kind, minlength=CLASSES).tolist()], pa.list_(pa.int64())),
            "sums": pa.array([np.bincount(kind, n0 + n1, CLASSES).astype(np.int64).tolist()], pa.list_(pa.int64())),
        }
        return pa.table(row)

    blobs = parts.where("words is not null").select("chunk", "bucket", "words", "numbers")
    return blobs.groupBy("bucket").applyInArrow(freeing(merge), VOCABULARY)


def _vocabulary(words: bytes, numbers: bytes, unpack) -> tuple[list[bytes], np.ndarray]:
    return unpack(words).split(b"\n"), np.frombuffer(unpack(numbers), np.int64).reshape(3, -1)


def word_rows(vocabulary: DataFrame, once: bool) -> DataFrame:
    """(word, n0, n1): the words that training texts have, or only those that came once."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            for blobs in zip(*(batch.column(c).to_pylist() for c in ("words", "numbers")), strict=True):
                words, (n0, n1, _) = _vocabulary(*blobs, unpack)
                own = np.flatnonzero(n0 + n1 == 1 if once else n0 + n1 > 0)
                for part in np.array_split(own, max(1, -(-len(own) // WORDS_AT_ONCE))):
                    names = pa.array([words[i] for i in part.tolist()], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([names, pa.array(n0[part]), pa.array(n1[part])], ["word", "n0", "n1"])

    return vocabulary.select("words", "numbers").mapInArrow(freeing(unfold), "word string, n0 long, n1 long")


def ranked_words(vocabulary: DataFrame, ranks: Ranks, model: Model) -> DataFrame:
    """(chunk, bucket, ranks, counts, logs): numbers and training counts of each chunk's words, in the chunk's order,
    and of its unknown ones the log10 probability of the spelling inside and at the beginning of sentences."""
    sizes = vocabulary.select("bucket", F.posexplode("sizes").alias("kind", "n")).where("n > 0")
    before = Window.partitionBy("kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = offsets.groupBy("bucket").agg(F.collect_list("kind").alias("kinds"), F.collect_list("offset").alias("offsets"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = packer(), unpacker()
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                words, (n0, n1, seen) = _vocabulary(get["words"], get["numbers"], unpack)
                count = n0 + n1
                kind = class_of(count)
                offset = np.zeros(CLASSES, np.int64)
                offset[get["kinds"]] = get["offsets"]
                begin = np.zeros(CLASSES, np.int64)
                at = np.flatnonzero(np.diff(kind, prepend=-1))
                begin[kind[at]] = at
                rank = ranks.first[kind] + np.where(kind > 0, offset[kind] + np.arange(len(kind)) - begin[kind], 0)
                logs = np.zeros((2, len(words)), np.float32)
                for k in (0, 1):
                    own = np.flatnonzero((count == 0) & (seen & (1 << k) > 0))
                    for part in np.array_split(own, max(1, -(-len(own) // WORDS_AT_ONCE))):
                        if len(part):
                            logs[k, part] = model.log10([words[i] for i in part.tolist()], np.full(len(part), k == 1))
                out = []
                for place in get["places"]:
                    own = unsqueezed(place, unpack)
                    unknown = own[count[own] == 0]
                    out.append((squeezed(rank[own], pack), pack(count[own].tobytes()), squeezed(logs[:, unknown].ravel().view(np.uint32), pack)))
                blobs = [pa.array(c, pa.binary()) for c in zip(*out, strict=True)]
                buckets = pa.array(np.full(len(out), get["bucket"], np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(get["chunks"], pa.int64()), buckets, *blobs], ["chunk", "bucket", "ranks", "counts", "logs"])

    rows = vocabulary.drop("sizes", "sums").join(offsets, "bucket")
    return rows.mapInArrow(freeing(number), "chunk long, bucket int, ranks binary, counts binary, logs binary")


class Tokens:
    """The tokens of a chunk: place of each among the chunk's words, the one before, its text, and their pairs."""

    def __init__(self, own: pa.Table, known: pa.Table, nothing: int, bucket_bits: int):
        unpack = unpacker()
        row = own.filter(own.column("stream").is_valid())
        stream, often, held = (row.column(c)[0].as_py() for c in ("stream", "numbers", "held"))
        self.held = np.frombuffer(unpack(held), bool)
        known = known.filter(known.column("ranks").is_valid()).sort_by("bucket")
        ranks, counts, logs = (known.column(c).to_pylist() for c in ("ranks", "counts", "logs"))
        self.rank = np.concatenate([unsqueezed(r, unpack) for r in ranks]).astype(np.int64)
        self.count = np.concatenate([np.frombuffer(unpack(c), np.int64) for c in counts])
        self.spelled = np.zeros((2, len(self.rank)))
        unknown = [unsqueezed(b, unpack).view(np.float32).reshape(2, -1) for b in logs]
        self.spelled[:, self.count == 0] = np.concatenate(unknown, axis=1)
        often, enders = unsqueezed(often, unpack).astype(np.int64).reshape(2, -1)
        self.enders = enders > 0
        by_number = np.argsort(-often, kind="stable")
        self.at = by_number[unsqueezed(stream, unpack)]
        end = self.at[-1]
        self.prior = np.concatenate(([end], self.at[:-1]))
        ends = self.at == end
        self.doc = np.cumsum(ends) - ends
        self.known = self.rank[self.at] < nothing
        keys = (self.rank[self.prior[self.known]] << 32) | self.rank[self.at[self.known]]
        distinct, place = np.unique(keys, return_inverse=True)
        bucket = bucket_of((distinct >> 32).astype(np.uint64) * MIX, bucket_bits)
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.place, self.keys, self.bucket = back[place], distinct[order], bucket[order]
        out = self.held[self.doc[self.known]]
        self.taught = np.bincount(self.place[~out], minlength=len(order))
        self.asked = np.bincount(self.place[out], minlength=len(order)) > 0


def packed_keys(keys: np.ndarray, pack) -> bytes:
    """Sorted pairs of numbers as steps: of the first, then of the second where the first stays."""
    first, second = keys >> 32, keys & 0xFFFFFFFF
    step = np.diff(first, prepend=0)
    return squeezed(np.concatenate((step, np.where(step == 0, np.diff(second, prepend=0), second))), pack)


def unpacked_keys(data: bytes, unpack) -> np.ndarray:
    step, second = unsqueezed(data, unpack).astype(np.int64).reshape(2, -1)
    total = np.cumsum(second)
    begin = np.flatnonzero((step > 0) | (np.arange(len(step)) == 0))
    total -= np.repeat(total[begin] - second[begin], np.diff(begin, append=len(step)))
    return (np.cumsum(step) << 32) | total


TOTALS = "bucket int, keys binary, totals binary, chunks array<long>, places array<binary>, flags array<binary>"


def pairs_of(parts: DataFrame, known: DataFrame, nothing: int, bucket_bits: int) -> DataFrame:
    """One row per bucket of previous words: all pairs with their training counts, and the place in it of each
    chunk's pairs, with bits 1 and 2 if a training text and a held-out one of the chunk has the pair."""

    def find(own: pa.Table, words: pa.Table) -> pa.Table:
        pack, tokens = packer(), Tokens(own, words, nothing, bucket_bits)
        out = []
        for a, b in runs(tokens.bucket):
            numbers = np.concatenate((tokens.taught[a:b], tokens.asked[a:b]))
            out.append((int(tokens.bucket[a]), packed_keys(tokens.keys[a:b], pack), squeezed(numbers, pack)))
        bucket, keys, numbers = zip(*out, strict=True) if out else ((), (), ())
        chunk = pa.array([own.column("chunk")[0].as_py()] * len(out), pa.int64())
        return pa.table([chunk, pa.array(bucket, pa.int32()), pa.array(keys, pa.binary()), pa.array(numbers, pa.binary())], ["chunk", "bucket", "keys", "numbers"])

    def add(key: tuple, blobs: pa.Table) -> pa.Table:
        pack, unpack = packer(), unpacker()
        keys = [unpacked_keys(k, unpack) for k in blobs.column("keys").to_pylist()]
        numbers = [unsqueezed(n, unpack).reshape(2, -1) for n in blobs.column("numbers").to_pylist()]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate([n[0] for n in numbers]), len(distinct)).astype(np.int64)
        places = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        row = {
            "bucket": pa.array([key[0].as_py()], pa.int32()),
            "keys": pa.array([packed_keys(distinct, pack)], pa.binary()),
            "totals": pa.array([squeezed(total, pack)], pa.binary()),
            "chunks": pa.array([blobs.column("chunk").to_pylist()], pa.list_(pa.int64())),
            "places": pa.array([[squeezed(np.diff(p, prepend=0), pack) for p in places]], pa.list_(pa.binary())),
            "flags": pa.array([[pack(((n[0] > 0) + 2 * n[1]).astype(np.uint8).tobytes()) for n in numbers]], pa.list_(pa.binary())),
        }
        return pa.table(row)

    streams = parts.where("stream is not null").select("chunk", "stream", "numbers", "held")
    found = streams.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(freeing(find), "chunk long, bucket int, keys binary, numbers binary")
    return found.groupBy("bucket").applyInArrow(freeing(add), TOTALS)


@dataclass
class Choices:
    """Binary choices on the way to words, once for all pairs that share them: the choice, inputs of the mixer, gate and
    refinement slot. `pair` makes choice `which`; `rest` is the log10 probability by order 0 of what is left of each
    pair's way where the word before has seen nothing."""

    bit: np.ndarray
    inputs: np.ndarray
    gate: np.ndarray
    node: np.ndarray
    pair: np.ndarray
    which: np.ndarray
    rest: np.ndarray


def choices(keys: np.ndarray, total: np.ndarray, below: np.ndarray, own: np.ndarray, ranks: Ranks, itself: int) -> Choices:
    """Choices of the pairs keys[own], in their order, bit by bit of the word's number. `below` are the counts before
    each key and the numbers of pairs; `itself` is left out of the counts on the way.

    The mixer's inputs are the counts after the word before, those of order 0, both together (order 0 has as much
    weight as different words were seen) and a constant."""
    below, kinds = below
    pair, prior, word = np.arange(len(own)), keys[own] >> 32 << 32, keys[own] & 0xFFFFFFFF
    gone = (itself * (total[own] == 1)).astype(np.int64)
    # Only pairs of the same words before are looked at.
    least, most = np.searchsorted(keys, (prior[0], prior[-1] + (1 << 32))) if len(own) else (0, 0)
    keys, below, kinds = keys[least:most], below[least : most + 1], kinds[least : most + 1]
    low, high = np.searchsorted(keys, prior), np.searchsorted(keys, prior + (1 << 32))
    # Counts of order 0 before the run of numbers on the way, and up to its end.
    left, right = (np.full(len(own), ranks.before(at)) for at in (0, 1 << ranks.bits))
    rest, made, out = np.zeros(len(own)), 0, []
    for depth in range(ranks.bits):
        shift = ranks.bits - 1 - depth
        way = prior + (word >> shift << shift)
        new = np.ones(len(way), bool)
        new[1:] = way[1:] != way[:-1]
        head, run = np.flatnonzero(new), np.cumsum(new) - 1
        first, last = low[head], high[head]
        start = word[head] >> (shift + 1) << (shift + 1)
        middle = np.searchsorted(keys, prior[head] + start + (1 << shift))
        bit = (word[head] >> shift & 1).astype(bool)
        zeros, ones = below[middle] - below[first] - itself * ~bit, below[last] - below[middle] - itself * bit
        seen = zeros + ones
        edge = left[head], ranks.before(start + (1 << shift)), right[head]
        # What the word before has never been followed by is left to order 0.
        alone = seen <= 0
        ends = alone[run]
        if alone.any():
            at = word[ends]
            count = np.maximum(ranks.before(at + 1) - ranks.before(at) - itself, 0.5)
            rest[pair[ends]] = np.log10(np.minimum(count / np.maximum((edge[2] - edge[0])[run[ends]] - itself, 1), 1))
        # A choice with nothing on its other side is none.
        real = ~alone & (start + (1 << shift) < ranks.known)
        # Pairs seen once take a kind of word with them when they are left out; only choices that a pair makes count.
        makes = real[run]
        used = np.zeros((1 + itself) * len(head), bool)
        which = (1 + itself) * run[makes] + gone[makes]
        used[which] = True
        of, less = np.divmod(np.flatnonzero(used), 1 + itself)
        b, zeros, ones = bit[of], zeros[of], ones[of]
        zero, one = np.maximum((edge[1] - edge[0])[of] - itself * ~b, 0) + PRIOR, np.maximum((edge[2] - edge[1])[of] - itself * b, 0) + PRIOR
        weight = np.maximum(kinds[last[of]] - kinds[first[of]] - less, PRIOR) / (zero + one)
        inputs = np.empty((len(WORD_WEIGHTS), len(of)), np.float32)
        inputs[0] = np.log((ones + PRIOR) / (zeros + PRIOR))
        inputs[1] = np.log(one / zero)
        inputs[2] = np.log((ones + weight * one) / (zeros + weight * zero))
        inputs[3] = 0.3
        gate = 2 * SEEN_LEVELS[np.minimum(seen[of], len(SEEN_LEVELS) - 1).astype(np.int64)] + ((zeros <= 0) | (ones <= 0))
        number = made - 1 + np.cumsum(used)
        out.append((b, inputs, gate, gate * 16 + min(depth, 31) // 2, pair[makes], number[which]))
        made += len(of)
        stays = ~ends
        onward = run[stays]
        low, high = np.where(bit, middle, first)[onward], np.where(bit, last, middle)[onward]
        left, right = np.where(bit, edge[1], edge[0])[onward], np.where(bit, edge[2], edge[1])[onward]
        pair, prior, word, gone = pair[stays], prior[stays], word[stays], gone[stays]
    bit, inputs, *others = zip(*out, strict=True)
    return Choices(np.concatenate(bit), np.concatenate(inputs, axis=1), *map(np.concatenate, others), rest)


def _sorted_pairs(keys: bytes, totals: bytes, unpack) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    total = unsqueezed(totals, unpack).astype(np.int64)
    return unpacked_keys(keys, unpack), total, np.stack([np.concatenate(([0], np.cumsum(n))) for n in (total, total > 0)])


def word_mixer(pairs: DataFrame, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement of the words' choices: each pair as often as training texts have it, predicted from
    counts without itself, step by step through a partition."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, state = unpacker(), Learning(WORD_WEIGHTS)
        for batch in batches:
            for blobs in zip(*(batch.column(c).to_pylist() for c in ("keys", "totals")), strict=True):
                keys, total, below = _sorted_pairs(*blobs, unpack)
                taught = np.flatnonzero(total > 0)
                for own in np.array_split(taught, max(1, -(-len(taught) // PAIRS_AT_ONCE))):
                    if len(own):
                        found = choices(keys, total, below, own, ranks, 1)
                        worth = np.bincount(found.which, total[own][found.pair], len(found.bit))
                        # The choices come bit by bit; a step sees all bits.
                        order = np.random.default_rng(len(own)).permutation(np.flatnonzero(worth))
                        state.learn(found.inputs[:, order], found.gate[order], found.bit[order], worth[order], found.node[order])
        yield state.row()

    return averaged(pairs.select("keys", "totals").mapInArrow(freeing(train), PARTS), WORD_WEIGHTS)


def scored_pairs(pairs: DataFrame, ranks: Ranks, weights: np.ndarray | None, refined: np.ndarray | None) -> DataFrame:
    """(chunk, place, totals, logs): per chunk and bucket (`place`) the pairs' training counts without weights, else the
    log10 probabilities of the pairs of training texts, from counts without one of them, then of those of held-out ones."""

    def log10(keys: np.ndarray, total: np.ndarray, below: np.ndarray, own: np.ndarray, itself: int) -> np.ndarray:
        out = np.zeros(len(keys), np.float32)
        for part in np.array_split(own, max(1, -(-len(own) // PAIRS_AT_ONCE))):
            if len(part):
                found = choices(keys, total, below, part, ranks, itself)
                mixed = _mixed(found.inputs, found.gate, weights)
                slot, share = _refine_at(mixed, found.node)
                p = (_squash(mixed) + refined[slot] * (1 - share) + refined[slot + 1] * share) / 2
                logs = np.bincount(found.pair, np.log10(np.where(found.bit, p, 1 - p))[found.which], len(part))
                out[part] = logs + found.rest
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = packer(), unpacker()
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                keys, total, below = _sorted_pairs(get["keys"], get["totals"], unpack)
                places = [np.cumsum(unsqueezed(p, unpack).astype(np.int64)) for p in get["places"]]
                flags = [np.frombuffer(unpack(f), np.uint8) for f in get["flags"]]
                asked = np.zeros(len(keys), bool)
                for place, flag in zip(places, flags, strict=True):
                    asked[place[flag > 1]] = True
                if weights is not None:
                    without, whole = log10(keys, total, below, np.flatnonzero(total > 0), 1), log10(keys, total, below, np.flatnonzero(asked), 0)
                totals, logs = [], []
                for place, flag in zip(places, flags, strict=True):
                    totals.append(squeezed(total[place], pack) if weights is None else None)
                    both = None if weights is None else np.concatenate((without[place[flag & 1 > 0]], whole[place[flag > 1]]))
                    logs.append(None if both is None else squeezed(both.view(np.uint32), pack))
                columns = [pa.array(get["chunks"], pa.int64()), pa.array([get["bucket"]] * len(places), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.binary()), pa.array(logs, pa.binary())], ["chunk", "place", "totals", "scores"])

    return pairs.mapInArrow(freeing(score), "chunk long, place int, totals binary, scores binary")


RESULT = (
    "doc_id {0}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double, n_bytes long, bits_per_byte double"
)


def score_documents(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Counts, base score and model score (log10) of every row; rows with `held_out` are not learned from."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    bucket_bits = max(0, (text_bytes(rows) // BUCKET_BYTES).bit_length())
    parts = stored(parsed(rows, chunk_bytes, bucket_bits), "parsed-texts")
    vocabulary = stored(vocabulary_of(parts), "vocabulary")
    sizes, sums = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    folded = vocabulary.select(F.posexplode(F.arrays_zip("sizes", "sums")).alias("kind", "n")).groupBy("kind")
    for r in folded.agg(F.sum("n.sizes").alias("size"), F.sum("n.sums").alias("sum")).collect():
        sizes[r.kind], sums[r.kind] = r["size"], r["sum"]
    total, distinct, singles = int(sums.sum()), int(sizes[1:].sum()), int(sizes[1])
    ranks = Ranks.of(sizes, sums)
    # New words are like those that came once.
    rare = word_rows(vocabulary, singles > 0)
    counts = bit_counts(rare)
    model = Model(counts, *mixer(rare, counts))
    known = stored(ranked_words(vocabulary, ranks, model), "word-ranks")
    gates = all_gates(parts, min(0.5, (singles + 1) / (total + 2)))
    pairs = stored(pairs_of(parts, known, ranks.known, bucket_bits), "pairs")
    mixing = (None, None) if gates.linear else word_mixer(pairs, ranks)
    back = known.unionByName(scored_pairs(pairs, ranks, *mixing), allowMissingColumns=True)

    def add_up(key: tuple, own: pa.Table, found: pa.Table) -> pa.Table:
        unpack, tokens = unpacker(), Tokens(own, found, ranks.known, bucket_bits)
        rows = own.filter(own.column("at").is_valid()).sort_by("at")
        found = found.filter(found.column("place").is_valid()).sort_by("place")
        held, at, doc, count = tokens.held, tokens.at, tokens.doc, tokens.count
        # Training texts are predicted from counts without the token itself.
        itself = np.where(held[doc], 0, 1)
        before = np.maximum(count[tokens.prior] - itself, 0)
        gate = np.minimum(np.log2(before + 1).astype(np.int64), GATED - 1)
        log10 = np.zeros(len(at))
        if gates.linear:
            totals = np.concatenate([np.zeros(0, np.uint32), *(unsqueezed(t, unpack) for t in found.column("totals").to_pylist())])
            pair = totals.astype(np.int64)[tokens.place]
            by_pair, by_word, _, _ = estimates(count, pair, at[tokens.known], tokens.prior[tokens.known], itself[tokens.known], total)
            weight = gates.pair[gate[tokens.known]]
            log10[tokens.known] = np.log10(weight * by_pair + (1 - weight) * by_word)
        else:
            values = np.zeros((2, len(tokens.keys)))
            for (a, b), blob in zip(runs(tokens.bucket), found.column("scores").to_pylist(), strict=True):
                logs = unsqueezed(blob, unpack).view(np.float32)
                taught = tokens.taught[a:b] > 0
                values[0, a:b][taught] = logs[: taught.sum()]
                values[1, a:b][tokens.asked[a:b]] = logs[taught.sum() :]
            log10[tokens.known] = values[1 - itself[tokens.known], tokens.place]
        log10 += np.log10(np.where(tokens.known, 1 - gates.unknown[gate], gates.unknown[gate]))
        names = ~tokens.known
        start = begins_at(at, np.flatnonzero(np.diff(doc, prepend=-1)), tokens.enders)
        log10[names] += tokens.spelled[start[names].astype(np.int64), at[names]]
        base = np.log10((count + 1) / (total + distinct + 1))
        n_bytes = rows.column("n_bytes").to_numpy()
        score = np.bincount(doc, log10, len(held))
        bits = [-s * np.log2(10) / b if b else None for s, b in zip(score.tolist(), n_bytes.tolist(), strict=True)]
        columns = [
            pa.array(held),
            pa.array(np.bincount(doc, minlength=len(held)), pa.int64()),
            pa.array(np.bincount(doc, tokens.known, len(held)).astype(np.int64)),
            pa.array(np.full(len(held), total), pa.int64()),
            pa.array(np.bincount(doc, base[at], len(held))),
            pa.array(score),
            pa.array(n_bytes, pa.int64()),
            pa.array(bits, pa.float64()),
        ]
        fields = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
        return pa.table([rows.column("doc_id").combine_chunks(), *columns], ["doc_id", *fields])

    schema = RESULT.format(rows.schema["doc_id"].dataType.simpleString())
    own = parts.where("stream is not null or at is not null").select("chunk", "doc_id", "at", "n_bytes", "stream", "numbers", "held")
    return own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(freeing(add_up), schema)
