"""Quality rules: plain counts, and a calibrated logistic regression on hashed n-grams.

Features are word unigrams and bigrams and byte n-grams of two lengths, hashed to a fixed number of
weights; each family enters as its mean. The regression is fitted on labelled rows, a bounded sample
of `sample` of them chosen by a hash of their id, and its logit is mapped to a probability by a
second regression on the fifth of the sample that was held back. The model is a vector of fixed
size; all documents are scored in Arrow batches and judged by fixed thresholds.

Defined cases: a null text has no words and fails the rule on their number; rows with a null label
or id, and ids with contradicting labels, are not learned from; without rows of both labels only the
plain rules decide; repeated rows are judged alike; an empty table gives no rows. Extra columns are
kept, those named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.tables import freeing, give_back

SAMPLE = 4000
"""Labelled rows the regression is fitted on, at most."""

THRESHOLD = 0.5
"""Least probability of good quality."""

MIN_WORDS, MAX_REPEATED = 50, (50, 100)
BITS = 15
BYTE_GRAMS = (2, 4)
EPOCHS, RATE = 30, 0.5
BYTES_AT_ONCE = 1 << 20
CACHED_WORDS = 200_000
BASE = 0x9E3779B97F4A7C15

# The symbols that the rules count, and ASCII white space.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"

COUNTS = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,p:double>"


def _marks(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


IS_SYMBOL, IS_BLANK = _marks(SYMBOLS), _marks(BLANKS)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        value = self[word] = xxh3_64_intdigest(word)
        return value


    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _chained(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of `n`."""
    out = h
    for at in range(1, n):
        out = out[: len(h) - at] * np.uint64(BASE) + h[at:]
    return out


def counts_of(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated three-word windows."""
    raw = np.frombuffer(text, np.uint8)
    lines = [line for line in text.split(b"\n") if line.strip()]
    chars = int((((raw & 0xC0) != 0x80) & ~IS_BLANK[raw]).sum())
    repeated = 0
    if len(words) > 3:
        windows = _chained(hashes, 3)
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(windows) + 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = twice.copy()
        covered[1:] |= twice[:-1]
        covered[2:] |= twice[:-2]
        repeated = int(covered.sum())
    return len(words), chars, int(IS_SYMBOL[raw].sum()), len(lines) - len(set(lines)), repeated


def _slots(h: np.ndarray, family: int) -> np.ndarray:
    mixed = (h + np.uint64(family)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def families(text: bytes, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(family, slots) of a text, in parts of bounded size."""
    for n in (1, 2):
        if len(hashes) >= n:
            yield n - 1, _slots(_chained(hashes, n), n)
    raw = np.frombuffer(text, np.uint8)
    for at, n in enumerate(BYTE_GRAMS):
        for start in range(0, max(0, len(raw) - n + 1), BYTES_AT_ONCE):
            part = raw[start : start + BYTES_AT_ONCE + n - 1].astype(np.uint64)
            code = part[: len(part) - n + 1]
            for step in range(1, n):
                code = (code << np.uint64(8)) | part[step : len(part) - n + 1 + step]
            yield 2 + at, _slots(code, 3 + n)


FAMILIES = 2 + len(BYTE_GRAMS)


@dataclass
class Model:
    """Weights per family and slot, bias, and slope and shift of the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, text: bytes, hashes: np.ndarray) -> float:
        total, size = np.zeros(FAMILIES), np.zeros(FAMILIES)
        for family, slots in families(text, hashes):
            total[family] += self.weights[family][slots].sum(dtype=np.float64)
            size[family] += len(slots)
        logit = self.bias + float((total / np.maximum(size, 1)).sum())
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row starts, slots and values of the sample as one sparse matrix."""
    starts, slots, values, known = [0], [], [], WordHashes()
    for text in texts:
        own = np.zeros((FAMILIES, 1 << BITS), np.float32)
        for family, found in families(text, known.of(text.split())):
            own[family] += np.bincount(found, minlength=1 << BITS)
        own /= np.maximum(own.sum(axis=1, keepdims=True), 1)
        at = np.flatnonzero(own)
        starts.append(starts[-1] + len(at))
        slots.append(at.astype(np.int32))
        values.append(own.ravel()[at])
    return np.array(starts), np.concatenate(slots), np.concatenate(values)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[bytes], good: np.ndarray) -> Model | None:
    """Adaptive-rate gradient steps over the training part, then the calibration on the rest."""
    if not len(texts) or good.min() == good.max():
        return None
    held = np.arange(len(texts)) % 5 == 4
    if good[held].size == 0 or good[held].min() == good[held].max() or good[~held].min() == good[~held].max():
        held[:] = False
    width = FAMILIES << BITS
    starts, slot, value = _features(texts)
    weights, bias = np.zeros(width), 0.0
    squares, bias_square = np.full(width, 1e-8), 1e-8
    training = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        for part in np.array_split(np.random.default_rng(epoch).permutation(training), max(1, len(training) // 256)):
            at = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in part])
            local = np.repeat(np.arange(len(part)), starts[part + 1] - starts[part])
            logit = bias + np.bincount(local, weights[slot[at]] * value[at], len(part))
            error = good[part] - _logistic(logit)
            step = np.bincount(slot[at], error[local] * value[at], width) / len(part)
            squares += step**2
            weights += RATE * step / np.sqrt(squares)
            bias_square += error.mean() ** 2
            bias += RATE * error.mean() / np.sqrt(bias_square)
    weights = weights.astype(np.float32).reshape(FAMILIES, -1)
    sums = np.concatenate(([0.0], np.cumsum(weights.ravel()[slot] * value, dtype=np.float64)))
    logit = bias + sums[starts[1:]] - sums[starts[:-1]]
    slope, shift = 1.0, 0.0
    if held.any():
        x, y = logit[held], good[held]
        for _ in range(50):
            p = _logistic(slope * x + shift)
            w = p * (1 - p) + 1e-6
            hessian = np.array([[(w * x * x).sum(), (w * x).sum()], [(w * x).sum(), w.sum()]]) + 1e-3 * np.eye(2)
            move = np.linalg.solve(hessian, [((y - p) * x).sum() - 1e-3 * slope, (y - p).sum() - 1e-3 * shift])
            slope, shift = slope + move[0], shift + move[1]
            if np.abs(move).max() < 1e-6:
                break
    return Model(weights, float(bias), float(slope), float(shift))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Model of the labelled rows of `docs` (doc_id, text); `labels` has doc_id and quality (0 or 1).

    The sample is fixed by a hash of the id. It is bounded, so one task fits the regression."""
    agreed = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"), F.max("quality").alias("__most"))
        .where("good = __most")
        .select("doc_id", "good")
    )
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def train(key: tuple, own: pa.Table) -> pa.Table:
        order = np.argsort(own.column("doc_id").to_numpy(), kind="stable")
        texts = [t or b"" for t in own.column("text").cast(pa.binary()).take(pa.array(order)).to_pylist()]
        model = fit(texts, own.column("good").to_numpy()[order].astype(float))
        if model is None:
            return pa.table({"weights": pa.array([], pa.binary()), "rest": pa.array([], pa.list_(pa.float64()))})
        rest = [[model.bias, model.slope, model.shift]]
        return pa.table({"weights": [model.weights.tobytes()], "rest": rest})

    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(freeing(train), "weights binary, rest array<double>").collect()
    if not found:
        return None
    return Model(np.frombuffer(found[0].weights, np.float32).reshape(FAMILIES, -1), *found[0].rest)


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """`docs` with the counts, `probability`, `base_failed` and `kept`."""

    @F.arrow_udf(COUNTS)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = [pa.int64()] * 5 + [pa.float64()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "p"]
        known = WordHashes()
        for texts in batches:
            rows = []
            for value in texts.cast(pa.binary()):
                own = value.as_py() or b""
                words = own.split()
                hashes = known.of(words)
                rows.append((*counts_of(own, words, hashes), 1.0 if model is None else model.probability(own, hashes)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )
        known.clear()
        give_back()

    found = docs.withColumn("__c", count(F.col(text)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = found.withColumns({**{n: F.col(f"__c.{n}") for n in names}, "probability": F.col("__c.p")}).drop("__c")
    low, (share, of) = F.col("n_words") < MIN_WORDS, MAX_REPEATED
    failed = low | (of * F.col("n_repeat_words") > share * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= threshold)
    )
