"""Document fingerprints by a randomised edit embedding.

A text is walked by characters. At step j the walk reads the character under its pointer and a
random bit, shared by all texts and fixed by j and the character, says whether the pointer moves on.
The characters read are the embedding: an edit makes two walks part, but the shared bits bring them
together again soon, so texts at a small edit distance have embeddings at a small Hamming distance.

The embedding is not kept. Every step falls into one of 256 bins and adds a random sign, fixed by j
and the character. A fingerprint holds the sign of each bin (128 hexadecimal digits: which bins are
positive, then which are negative). The share of bins with unlike signs is an angle whose cosine
estimates the share of equal steps: the likeness, from 0 to 1.

`near_pairs` finds likely pairs by banding: each band samples some bins, fingerprints with equal
samples meet, and those that meet are verified by their likeness.

Walks run in step over the texts of an Arrow batch, whole texts of any length.

Defined cases: a null text is empty; two empty texts are alike (1), an empty and another text are not
(0); equal texts have equal fingerprints; a single document is its own next one; rows with equal id
and text are interchangeable in the order; a null id comes last; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from parcelwise.llm.sharding import HALF, _key, _parts, keys_up_to, splitters
from parcelwise.llm.tables import compressed, unpacker
from parcelwise.scale import written

BINS, CLASSES, PERIOD = 256, 256, 4096
SEED = 20240601
BLOCK_BYTES = 16 * 1024**2
"""Text in one block of neighbouring ids."""

MAX_BLOCKS = 50_000
"""Blocks of which the driver holds the borders; blocks grow beyond, as they are read as a stream."""

ROWS_AT_ONCE = 1000
WALKED_AT_ONCE = 1 << 21
"""Characters of the texts that walk in step."""

BANDS, BAND_BINS = 24, 8
LIKENESS = 0.8


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per step: does a character move the pointer, its sign, and the step's bin. The last class ends a text."""
    rng = np.random.default_rng(SEED)
    moves = rng.integers(0, 2, (PERIOD, CLASSES + 1)).astype(np.int64)
    signs = rng.choice(np.array([-1, 1], np.int32), (PERIOD, CLASSES + 1))
    moves[:, CLASSES] = signs[:, CLASSES] = 0
    return moves, signs, rng.permutation(PERIOD) % BINS


def embedded(texts: list[str]) -> np.ndarray:
    """Sign (1, 0 or -1) of each bin for every text."""
    out = np.zeros((len(texts), BINS), np.int8)
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    start = 0
    while start < len(order):
        end, chars = start, 0
        while end < len(order) and (end == start or chars + len(texts[order[end]]) < WALKED_AT_ONCE):
            chars += len(texts[order[end]]) + 1
            end += 1
        own = order[start:end]
        out[own] = _walk([texts[i] for i in own])
        start = end
    return out


def _walk(texts: list[str]) -> np.ndarray:
    moves, signs, bins = tables()
    parts, first, at = [], np.zeros(len(texts), np.int64), 0
    for i, text in enumerate(texts):
        code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        first[i] = at
        parts += [((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int16), [CLASSES]]
        at += len(code) + 1
    codes = np.concatenate(parts).astype(np.int16)
    total = np.zeros((BINS, len(texts)), np.int32)
    live, pointer, step = np.arange(len(texts)), first, 0
    sums = np.zeros((BINS, len(live)), np.int32)
    while len(live):
        for _ in range(128):
            row = step % PERIOD
            char = codes[pointer]
            sums[bins[row]] += signs[row].take(char)
            pointer = pointer + moves[row].take(char)
            step += 1
        ended = codes[pointer] == CLASSES
        if ended.any():
            total[:, live[ended]] = sums[:, ended]
            live, pointer, sums = live[~ended], pointer[~ended], sums[:, ~ended]
    return np.sign(total.T).astype(np.int8)


def _hex(signs: np.ndarray) -> list[str]:
    bits = np.concatenate((np.packbits(signs > 0, axis=1), np.packbits(signs < 0, axis=1)), axis=1)
    return [row.tobytes().hex() for row in bits]


def signs_of(prints: list[str]) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), -1)
    bits = np.unpackbits(raw, axis=1).astype(np.int8)
    return bits[:, :BINS] - bits[:, BINS:]


def likeness_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of rows of signs; a bin that only one text has reached counts as half unlike."""
    reached = (a != 0) | (b != 0)
    unlike = np.abs(a.astype(np.int16) - b).sum(axis=-1) / 2
    share = unlike / np.maximum(reached.sum(axis=-1), 1)
    empty = (a == 0).all(axis=-1) != (b == 0).all(axis=-1)
    return np.where(empty, 0.0, np.maximum(0.0, np.cos(np.pi * share)))


def fingerprint(text: Column) -> Column:
    @F.arrow_udf("string")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(_hex(embedded([t or "" for t in texts.to_pylist()])), pa.string())

    return prints(text)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns."""

    @F.arrow_udf("double")
    def like(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.float64())
        return pa.array(likeness_of(signs_of(left.to_pylist()), signs_of(right.to_pylist())))

    return like(a, b)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, copy, h, i, doc_id, frame): blocks of neighbouring ids, each with the row that comes after it.

    Sorted by block, copy, falling h and falling i, every row is followed by its next one. Rows with `copy`
    are there only to be somebody's next. Blocks are cut by exact byte counts, so the whole order is
    never in one task; there are at most `MAX_BLOCKS`. `frame` is the compressed text."""
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-HALF)).alias("h"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("i"),
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    slim = written(keyed.select("h", "i", size.alias("size")), "order-keys")
    total = slim.agg(F.sum("size")).first()[0] or 0
    block_bytes = max(block_bytes, -(-total // MAX_BLOCKS))
    cuts = splitters(slim, max(1, -(-total // (4 * block_bytes))), tolerance=0.1, block_bytes=4 * block_bytes)
    ph, pi = _parts([c[0] for c in cuts])

    @F.arrow_udf("int")
    def block_of(h: pa.Array, i: pa.Array) -> pa.Array:
        return pa.array(keys_up_to(ph, pi, h.to_numpy(), i.to_numpy()).astype(np.int32))

    tops = (
        slim.groupBy(block_of("h", "i").alias("block")).agg(F.max(F.struct("h", "i")).alias("top")).collect()
    )
    tops = sorted((r.block, _key(*r.top)) for r in tops)
    above = {key: tops[(n + 1) % len(tops)][0] for n, (_, key) in enumerate(tops)}
    top_keys = sorted(above)
    th, ti = _parts(top_keys)
    targets = np.array([above[k] for k in top_keys], np.int32)

    @F.arrow_udf("array<int>")
    def blocks_of(h: pa.Array, i: pa.Array) -> pa.Array:
        hs, is_ = h.to_numpy(), i.to_numpy()
        own = keys_up_to(ph, pi, hs, is_)
        at = keys_up_to(th, ti, hs, is_) - 1
        top = (at >= 0) & (th[np.maximum(at, 0)] == hs) & (ti[np.maximum(at, 0)] == is_)
        return pa.array(
            [[b, targets[a]] if t else [b] for b, a, t in zip(own.tolist(), at.tolist(), top.tolist(), strict=True)],
            pa.list_(pa.int32()),
        )

    framed = keyed.select("doc_id", "h", "i", compressed(F.col("text")).alias("frame"), blocks_of("h", "i").alias("to"))
    return framed.select(F.posexplode("to").alias("copy", "block"), "h", "i", "doc_id", "frame")


PAIRS = (
    "doc_id {0}, n_chars long, edited string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_chars, edited, both fingerprints and their likeness, and that to the next document.

    The edited text has its last third replaced by the beginning of the next one by falling id. Texts are
    exchanged once, compressed, and read as a stream in which each row is followed by its next one."""
    rows = with_next(docs, doc_id, text, block_bytes)
    kind = to_arrow_type(rows.schema["doc_id"].dataType)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        last: list[tuple] = []

        def paired(own: list[tuple], following: list[tuple]) -> pa.RecordBatch:
            """Rows (block, copy, id, text, print) with those after them, the same row where none of its block is."""
            found = [(a, b if a[0] == b[0] else a) for a, b in zip(own, following, strict=True) if not a[1]]
            thirds = [len(a[3]) // 3 for a, _ in found]
            edited = [a[3][: len(a[3]) - n] + b[3][:n] for (a, b), n in zip(found, thirds, strict=True)]
            prints = _hex(embedded(edited)) if edited else []
            fp, after = [a[4] for a, _ in found], [b[4] for _, b in found]
            near = [likeness_of(signs_of(fp), signs_of(o)) if fp else [] for o in (prints, after)]
            columns = [
                pa.array([a[2] for a, _ in found], kind),
                pa.array([len(a[3]) for a, _ in found], pa.int64()),
                *(pa.array(c, pa.string()) for c in (edited, fp, prints)),
                *(pa.array(c, pa.float64()) for c in near),
            ]
            names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            return pa.RecordBatch.from_arrays(columns, names)

        for whole in batches:
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(low, ROWS_AT_ONCE)
                texts = [unpack(f.as_py()).decode() for f in batch.column("frame")]
                columns = (batch.column(c).to_pylist() for c in ("block", "copy", "doc_id"))
                held = last + list(zip(*columns, texts, _hex(embedded(texts)), strict=True))
                last = held[-1:]
                if len(held) > 1:
                    yield paired(held[:-1], held[1:])
        if last:
            yield paired(last, last)

    ordered = rows.repartition("block").sortWithinPartitions("block", "copy", F.desc("h"), F.desc("i"))
    return ordered.mapInArrow(pair, PAIRS.format(rows.schema["doc_id"].dataType.simpleString()))


def bands(prints: DataFrame) -> DataFrame:
    """(band, fp): a number per band and sampled bins for each distinct fingerprint `fp`."""
    rng = np.random.default_rng(SEED + 1)
    samples = np.stack([rng.choice(BINS, BAND_BINS, replace=False) for _ in range(BANDS)])
    place = 3 ** np.arange(BAND_BINS)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_pylist()
            if not fp:
                continue
            signs = signs_of(fp).astype(np.int64) + 1
            keys = (signs[:, samples] * place).sum(axis=2) + np.arange(BANDS) * 3**BAND_BINS
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(np.array(fp, object), BANDS), pa.string())], ["band", "fp"]
            )

    return prints.select("fp").mapInArrow(emit, "band long, fp string")


def near_pairs(prints: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(a, b, likeness) of distinct fingerprints `fp` that meet in a band and are at least `least` alike.

    Rows of a band arrive sorted and are compared with the heads of the groups found so far in it, as
    a stream; each is linked to the first head it is near, or becomes a head. So a group of copies
    gives one link per member."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, heads, signs = None, [], np.zeros((0, BINS), np.int8)
        for batch in batches:
            out = []
            keys, fps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own = signs_of(fps) if fps else signs
            for n, (key, fp) in enumerate(zip(keys, fps, strict=True)):
                if key != band:
                    band, heads, signs = key, [], np.zeros((0, BINS), np.int8)
                like = likeness_of(signs, own[n][None, :]) if heads else np.zeros(0)
                near = np.flatnonzero(like >= least)
                if len(near):
                    out.append((heads[near[0]], fp, float(like[near[0]])))
                else:
                    heads.append(fp)
                    signs = np.concatenate((signs, own[n : n + 1]))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = [pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "likeness"]
            )

    met = bands(prints).repartition("band").sortWithinPartitions("band", "fp")
    return met.mapInArrow(link, "a string, b string, likeness double").distinct()
