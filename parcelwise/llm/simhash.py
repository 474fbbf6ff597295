"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart both lie within r/2 bits of a point between them. Every
distinct fingerprint emits the points within half the radius, points are shuffled, and fingerprints
that meet are compared. On all 64 bits and r = 4 that is 1 + 64 + 2016 = 2081 points each. By default
the ball is laid in three projections instead: the bits are cut into three blocks and one block is
left out in turn. Leaving out the block with most differing bits leaves at most two, so one bit of
radius, 129 points in all, is enough, and no pair is lost. Meeting pairs are verified on all bits.

A point where more than `bucket` fingerprints meet is not compared pair by pair: its fingerprints
go through the full ball (2081 points), where all that meet are within the radius of each other, so
a link to the first of them is exact and their number does not matter.

Links between different fingerprints become components; rows join them by fingerprint.

Defined cases: a null, empty or blank text has the fingerprint 0; texts of fewer words than a
shingle hash whole; repeated rows share a component; a null id is never the smallest unless all ids
of the component are null, which gives a null component; an empty table gives no rows. Other columns
are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.components import components
from parcelwise.llm.tables import compressed, freeing, give_back, uncompressed
from parcelwise.scale import written

WORDS, SEED, RADIUS = 4, 42, 4
BLOCKS = 3
BUCKET = 4096
"""Fingerprints compared pair by pair at one point; more go through the full ball."""

SHINGLES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 18


def fingerprint_of(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a text's shingles, repeats included."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    first = np.concatenate(([0], blanks + 1))
    last = np.append(blanks, len(joined))
    if len(first) > words:
        first, last = first[: len(first) - words + 1], last[words - 1 :]
    else:
        first, last = first[:1], last[-1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), SHINGLES_AT_ONCE):
        spans = zip(first[at : at + SHINGLES_AT_ONCE].tolist(), last[at : at + SHINGLES_AT_ONCE].tolist(), strict=True)
        hashes = np.fromiter((xxh64_intdigest(joined[i:j], seed) for i, j in spans), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first)).view("<i8")[0])


def fingerprint(text: Column) -> Column:
    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = texts.cast(pa.binary())
            yield pa.array([fingerprint_of(v.as_py() or b"") for v in values], pa.int64())
        give_back()

    return prints(text)


def ball(radius: int, blocks: int) -> list[tuple[int, int, np.ndarray]]:
    """For each projection: the kept bits, a mark in the left-out block, the flips of the ball."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    out = []
    for left_out in range(blocks):
        dropped = range(edges[left_out], edges[left_out + 1]) if blocks > 1 else range(0)
        kept = [bit for bit in range(64) if bit not in dropped]
        rest = radius - (-(-radius // blocks) if blocks > 1 else 0)
        flips = [sum(1 << b for b in c) for n in range((rest + 1) // 2 + 1) for c in combinations(kept, n)]
        mark = (left_out + 1) << edges[left_out] if blocks > 1 else 0
        out.append((sum(1 << b for b in kept), mark, np.array(flips, np.uint64)))
    return out


def points(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(point, fp): every point of the balls around the distinct fingerprints `fp`."""
    balls = ball(radius, blocks)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy().view(np.uint64)
            for kept, mark, flips in balls:
                step = max(1, ROWS_AT_ONCE // len(flips))
                for at in range(0, len(whole), step):
                    fp = whole[at : at + step]
                    point = ((fp & np.uint64(kept))[:, None] ^ flips[None, :]) | np.uint64(mark)
                    columns = [point.ravel().view(np.int64), np.repeat(fp, len(flips)).view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["point", "fp"])

    return prints.select("fp").mapInArrow(freeing(emit), "point long, fp long")


def local_links(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius that connect all fingerprints chained by such links."""
    if len(fp) == 2:
        near = np.bitwise_count(fp[:1] ^ fp[1:]) <= radius
        return fp[:1][near], fp[1:][near]
    heads, members, todo = [], [], np.ones(len(fp), bool)
    for start in range(len(fp)):
        if not todo[start]:
            continue
        todo[start] = False
        stack = [start]
        while stack:
            at = stack.pop()
            near = np.flatnonzero(todo & (np.bitwise_count(fp ^ fp[at]) <= radius))
            todo[near] = False
            stack.extend(near.tolist())
            heads += [at] * len(near)
            members += near.tolist()
    return fp[heads], fp[members]


def meeting(met: DataFrame, radius: int, bucket: int | None) -> DataFrame:
    """(a, b) links among fingerprints at the same point; (a, a) marks one at an overfull point.

    Rows arrive sorted by point and are read as a stream: at most one batch and one point's
    fingerprints up to the bound are held. Without a bound all that meet are linked to the first."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        overfull: int | None = None
        for batch in batches:
            point = np.concatenate((carry[0], batch.column(0).to_numpy()))
            fp = np.concatenate((carry[1], batch.column(1).to_numpy().view(np.uint64)))
            a, b = [], []
            if overfull is not None:
                same = int(np.searchsorted(point, overfull, "right"))
                a.append(fp[:same])
                b.append(fp[:same])
                point, fp = point[same:], fp[same:]
                overfull = overfull if not len(point) else None
            if len(point):
                start = np.flatnonzero(np.concatenate(([True], point[1:] != point[:-1])))
                last = int(start[-1])
                if bucket is None:
                    first = fp[start[np.cumsum(np.concatenate(([True], point[1:] != point[:-1]))) - 1]]
                    a.append(first[first != fp])
                    b.append(fp[first != fp])
                    carry = (point[last : last + 1], fp[last : last + 1])
                else:
                    done = _bounded(point[:last], fp[:last], start[:-1], radius, bucket)
                    a += done[0]
                    b += done[1]
                    carry = (point[last:], fp[last:])
                    if len(carry[0]) > bucket:
                        overfull = int(carry[0][0])
                        a.append(carry[1])
                        b.append(carry[1])
                        carry = (carry[0][:0], carry[1][:0])
            else:
                carry = (point, fp)
            yield _links(a, b)
        if bucket is not None and len(carry[0]) > 1:
            yield _links(*map(list, zip(local_links(carry[1], radius), strict=True)))

    return met.mapInArrow(freeing(link), "a long, b long")


def _bounded(point, fp, start, radius, bucket) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links of whole points; points with two fingerprints, nearly all, are compared at once."""
    end = np.append(start[1:], len(point))
    size = end - start
    pair = start[size == 2]
    near = np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= radius
    a, b = [fp[pair][near]], [fp[pair + 1][near]]
    for at in np.flatnonzero(size > 2):
        own = fp[start[at] : end[at]]
        links = local_links(own, radius) if len(own) <= bucket else (own, own)
        a.append(links[0])
        b.append(links[1])
    return a, b


def _links(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    none = np.zeros(0, np.uint64)
    columns = [np.concatenate([none, *c]).view(np.int64) for c in (a, b)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` within the radius of each other."""
    met = points(prints, radius, blocks).repartition("point").sortWithinPartitions("point", "fp")
    found = written(meeting(met, radius, bucket).distinct(), "meeting")
    crowded = found.where("a = b").select(F.col("a").alias("fp")).distinct()
    full = points(crowded, radius, 1).repartition("point").sortWithinPartitions("point", "fp")
    return found.where("a <> b").union(meeting(full, radius, None))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    bucket: int = BUCKET,
) -> DataFrame:
    """doc_id, fp (signed 64-bit fingerprint), component_id (smallest reachable doc_id) of every row,
    with `mark`, a hash of its text, and `root`, a fingerprint that names the component."""
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp"), F.xxhash64(F.col(text)).alias("mark")
    )
    slim = written(slim, "fingerprints")
    prints = written(slim.groupBy("fp").agg(F.min("doc_id").alias("own")), "distinct-fingerprints")
    roots = components(near_links(prints, radius, blocks, bucket)).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    label = rooted.groupBy("root").agg(F.min("own").alias("component_id"))
    return slim.join(rooted.join(label, "root").select("fp", "component_id", "root"), "fp")


def one_per_component(docs: DataFrame, assigned: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id, a null id last, then the smallest text hash.

    Rows are told apart by id and text, so neither null ids nor an id that different texts share drop
    a row in favour of another component's."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    kept = assigned.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("__kept"), F.col("first.mark").alias("__kept_mark")
    )
    # Texts are exchanged compressed.
    framed = docs.withColumns(
        {"__mark": F.xxhash64(F.col(text)), "__none": F.col(text).isNull(), "__frame": compressed(F.col(text))}
    ).drop(text)
    same = F.col(doc_id).eqNullSafe(F.col("__kept")) & (F.col("__mark") == F.col("__kept_mark"))
    single = framed.join(kept, same, "left_semi").dropDuplicates([doc_id, "__mark"])
    return single.withColumn(text, F.when(~F.col("__none"), uncompressed(F.col("__frame")))).select(*docs.columns)
