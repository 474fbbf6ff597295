"""Sharding by bytes with a histogram sort.

Rows are ordered by a hash of their text and then by id, so equal texts lie together. Splitters of
that order, one for every shard and some more that cut shards into blocks, are found by counting:
each round counts the exact bytes and rows between candidate keys on all partitions, together with
the smallest and largest key found there, and puts new candidates between those, until each
splitter is within its tolerance or no key lies between two candidates. Then rows are exchanged
once, by block. A block is bounded in bytes, so no task holds a shard, and the rows below every
splitter are known, so slots need no further pass.

The driver sees counts per candidate only: a number fixed by shards and blocks, never rows.

Defined cases: a null text has no bytes and the size `overhead`, its hash is that of an empty text;
a null id sorts before all others; rows with equal hash and id are interchangeable and never cut
apart; fewer rows than shards leave shards empty; an empty table gives no rows. Extra columns are
kept, those named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelwise.scale import written

TOLERANCE = 0.0005
"""Bytes a shard boundary may be off, as a share of a shard."""

BLOCK_BYTES = 256 * 1024**2
BLOCKS_PER_SHARD = 4
"""Least number of blocks in a shard."""

PROBES = 2048
"""Candidate keys of a round, shared among the open splitters (three each at least)."""

HALF, WHOLE = 1 << 63, 1 << 64
COUNTED = "interval int, bytes long, rows long, low struct<h:long,i:long>, high struct<h:long,i:long>"


def _key(h: int, i: int) -> int:
    return ((h + HALF) << 64) | (i + HALF)


def _parts(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys as two arrays of int64 with the same order."""
    return (
        np.array([(k >> 64) - HALF for k in keys], np.int64),
        np.array([(k % WHOLE) - HALF for k in keys], np.int64),
    )


def keys_up_to(ph: np.ndarray, pi: np.ndarray, h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """For each row, how many of the sorted keys (ph, pi) are equal to or below (h, i)."""
    first, last = np.searchsorted(ph, h, "left"), np.searchsorted(ph, h, "right")
    below = first.copy()
    among = np.flatnonzero(last > first)
    for f in np.unique(first[among]):
        rows = among[first[among] == f]
        below[rows] = f + np.searchsorted(pi[f : last[rows[0]]], i[rows], "right")
    return below


def _count(slim: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Bytes, rows, lowest and highest key between neighbouring probes, over all partitions."""
    ph, pi = _parts(probes)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, i, size = (batch.column(c).to_numpy() for c in range(3))
            order = np.lexsort((i, h))
            h, i, size = h[order], i[order], size[order]
            interval = keys_up_to(ph, pi, h, i)
            if not len(interval):
                continue
            start = np.flatnonzero(np.diff(interval, prepend=-1))
            end = np.append(start[1:], len(interval)) - 1
            ends = [pa.StructArray.from_arrays([pa.array(h[at]), pa.array(i[at])], ["h", "i"]) for at in (start, end)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(interval[start].astype(np.int32)),
                    pa.array(np.add.reduceat(size, start)),
                    pa.array(end - start + 1),
                    *ends,
                ],
                ["interval", "bytes", "rows", "low", "high"],
            )

    found = (
        slim.mapInArrow(counted, COUNTED)
        .groupBy("interval")
        .agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n"), F.min("low").alias("lo"), F.max("high").alias("hi"))
        .collect()
    )
    return {r.interval: (r.b, r.n, _key(*r.lo), _key(*r.hi)) for r in found}


@dataclass
class Target:
    """A splitter to find: `low` and `high` are keys whose bytes below are known."""

    wanted: int
    slack: int
    low: tuple[int, int, int]
    high: tuple[int, int, int]

    @property
    def best(self) -> tuple[int, int, int]:
        return min(self.low, self.high, key=lambda cut: (abs(cut[1] - self.wanted), cut[0]))

    @property
    def open(self) -> bool:
        return abs(self.best[1] - self.wanted) > self.slack and self.high[0] - self.low[0] > 1


def splitters(
    slim: DataFrame, shards: int, tolerance: float = TOLERANCE, block_bytes: int = BLOCK_BYTES, probes: int = PROBES
) -> list[tuple[int, int, int, int]]:
    """Starts of the blocks after the first: (key, rows below, shard, 1 if a shard starts there).

    `slim` has the columns h, i and size."""
    whole = _count(slim, [])
    if not whole:
        return []
    total, rows, low, high = whole[0]
    per_shard = max(BLOCKS_PER_SHARD, -(-total // (shards * block_bytes)))
    blocks = shards * per_shard
    targets = [
        Target(
            total * b // blocks,
            int((tolerance if b % per_shard == 0 else 0.25 / per_shard) * total / shards),
            (low, 0, 0),
            (high + 1, total, rows),
        )
        for b in range(1, blocks)
    ]
    while still := [t for t in targets if t.open]:
        each = max(3, probes // len(still))
        spans = {(t.low, t.high) for t in still}
        asked = sorted({lo[0] + (hi[0] - lo[0]) * k // (each + 1) for lo, hi in spans for k in range(1, each + 1)})
        found = _count(slim, asked)
        below_b = below_n = 0
        known = [(low, 0, 0)]
        # The first and the last key of an interval narrow it to where rows are.
        for at in range(len(asked) + 1):
            b, n, first, last = found.get(at, (0, 0, 0, 0))
            if n:
                known += [(first, below_b, below_n), (last + 1, below_b + b, below_n + n)]
            below_b, below_n = below_b + b, below_n + n
        bytes_below = [k[1] for k in known]
        for t in still:
            right = int(np.searchsorted(bytes_below, t.wanted, "left"))
            t.low = max(t.low, known[max(0, right - 1)])
            t.high = min(t.high, known[min(right, len(known) - 1)])
    cuts = [(t.best[0], t.best[2], b // per_shard, int(b % per_shard == 0)) for b, t in enumerate(targets, 1)]
    # Targets that met the same cut leave blocks without rows between them.
    for at in range(1, len(cuts)):
        if cuts[at][0] < cuts[at - 1][0]:
            cuts[at] = (*cuts[at - 1][:2], *cuts[at][2:])
    return cuts


def shard_by_bytes(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", overhead: int = 8, **bounds
) -> DataFrame:
    """`docs` with `size`, `shard` and `slot` (gapless from 0 in each shard).

    Shards differ in size by the tolerance, or by one document where documents are larger."""
    sized = docs.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead,
            "__h": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
            "__i": F.coalesce(F.col(doc_id).cast("long"), F.lit(-HALF)),
        }
    )
    slim = written(sized.select(F.col("__h").alias("h"), F.col("__i").alias("i"), "size"), "shard-keys")
    cuts = splitters(slim, shards, **bounds)
    ph, pi = _parts([c[0] for c in cuts])
    shard_of = np.array([0, *(c[2] for c in cuts)], np.int32)
    rows_below = np.array([0, *(c[1] for c in cuts)], np.int64)
    shard_base = np.zeros(shards, np.int64)
    for _, below, shard, starts in cuts:
        if starts:
            shard_base[shard] = below
    base_of = rows_below - shard_base[shard_of]

    @F.arrow_udf("struct<block:int,shard:int,base:long>")
    def place(h: pa.Array, i: pa.Array) -> pa.Array:
        block = keys_up_to(ph, pi, h.to_numpy(), i.to_numpy())
        parts = [pa.array(block.astype(np.int32)), pa.array(shard_of[block]), pa.array(base_of[block])]
        return pa.StructArray.from_arrays(parts, ["block", "shard", "base"])

    placed = sized.withColumn("__p", place("__h", "__i")).withColumn("__block", F.col("__p.block"))
    in_block = F.row_number().over(Window.partitionBy("__block").orderBy("__h", "__i"))
    return placed.withColumns(
        {"shard": F.col("__p.shard"), "slot": (F.col("__p.base") + in_block - 1).cast("long")}
    ).drop("__h", "__i", "__p", "__block")
