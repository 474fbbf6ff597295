"""Sliding-window admission over an event log: at most `limit` admitted calls per `window` seconds.

Whether a call is admitted depends on the calls admitted before it, so a key has to be walked in
time order. The walk needs only the at most `limit` admission times of the last window, which makes
the blocks of a hot key independent once the times carried into them are known."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BooleanType, StructField, StructType

from parcelwise.operators.ordering import BLOCK, day_number, ordered_blocks
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, lookup_side, written


def admit(times: Sequence[int], carried: Sequence[int], limit: int, window: int) -> tuple[list[bool], list[int]]:
    """Decisions for ascending `times` (micros) after the earlier admissions `carried`, and the
    admissions still inside the window at the end."""
    live = deque(carried)
    decisions = []
    for now in times:
        while live and live[0] <= now - window:
            live.popleft()
        admitted = len(live) < limit
        if admitted:
            live.append(now)
        decisions.append(admitted)
    return decisions, list(live)


def admissions(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    limit: int = 100,
    seconds: int = 60,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(key, ts, tie, admitted) for every call of the log.

    The blocks of a hot key are read twice. First each is walked on its own to find out what it leaves to the
    next one, if that can be known without what came before it: a call with fewer than `limit` calls in the
    window before it is admitted whatever was decided earlier, so after a whole window of such calls the
    admissions are all of them. Then chains of blocks are walked as streams, each from a known beginning.
    Only a stretch in which the limit is reached all the time makes a chain of several blocks, which is one
    task's work with `limit` times in memory."""
    window = seconds * 1_000_000
    calls = df.select(key, ts, tie, F.unix_micros(F.col(ts).cast("timestamp")).alias("__t"))
    blocks = ordered_blocks(calls, [key], ["__t", tie], day_number(F.col(ts)), max_rows)
    plain = _types(df, key, ts, tie)
    if not blocks.split:
        return _walk(blocks.df, key, ts, tie, limit, window, plain)
    base = written(blocks.df, "calls")
    ends = written(_ends(base, key, limit, window, plain), "ends")
    return _walk_chains(join_keys(base, lookup_side(_chains(ends, key, window)), [key, BLOCK]), key, ts, tie, limit, window)


def _types(df: DataFrame, *cols: str) -> dict[str, str]:
    return {c: df.schema[c].dataType.simpleString() for c in cols}


def _no_times() -> Column:
    return F.array().cast("array<bigint>")


def _walk(df, key, ts, tie, limit, window, types) -> DataFrame:
    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["__t", tie], kind="stable")
        decisions, _ = admit(group["__t"].tolist(), [], limit, window)
        return group[[key, ts, tie]].assign(admitted=decisions)

    schema = ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", admitted boolean"
    return df.groupBy(key, BLOCK).applyInPandas(walk, schema)


def known_end(times: np.ndarray, limit: int, window: int) -> list[int] | None:
    """Admissions still inside the window at the end of ascending `times`, if they do not depend on what was
    admitted before the first of them, else None."""
    at = np.arange(len(times))
    first = np.searchsorted(times, times - window, "right")
    sure = (at - first < limit) & (times - window >= times[0])
    unsure = np.concatenate(([0], np.cumsum(~sure)))
    anchors = np.flatnonzero(unsure[at + 1] == unsure[first])
    if not len(anchors):
        return None
    last = anchors[-1]
    return admit(times[last + 1 :].tolist(), times[first[last] : last + 1].tolist(), limit, window)[1]


def _ends(df, key, limit, window, types) -> DataFrame:
    """Per block its first and last time, and the admissions it leaves where they are known."""

    def end(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(group["__t"].to_numpy())
        columns = {key: [keys[0]], BLOCK: [keys[1]], "__first": [times[0]], "__last": [times[-1]]}
        return pd.DataFrame({**columns, "__live": [known_end(times, limit, window)]})

    schema = f"`{key}` {types[key]}, {BLOCK} bigint, __first bigint, __last bigint, __live array<bigint>"
    return df.select(key, BLOCK, "__t").groupBy(key, BLOCK).applyInPandas(end, schema)


def _chains(ends: DataFrame, key: str, window: int) -> DataFrame:
    """(key, block, __chain, __carried): runs of blocks to be walked one after the other. `__carried` is what is
    admitted at the beginning of a chain."""
    along = Window.partitionBy(key).orderBy(BLOCK)
    before = F.lag("__live").over(along)
    alone = F.coalesce(F.col("__first") - F.lag("__last").over(along) >= window, F.lit(True))
    carried = F.when(alone, _no_times()).otherwise(before)
    chain = F.sum(F.when(carried.isNotNull(), 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return ends.select(key, BLOCK, chain.alias("__chain"), carried.alias("__carried"))


def _walk_chains(df: DataFrame, key: str, ts: str, tie: str, limit: int, window: int) -> DataFrame:
    """Decisions along each chain, read as a stream in time order."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, live = None, []
        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in (key, "__chain")), strict=True))
            times, at, decisions = batch.column("__t").to_pylist(), 0, []
            for name, run in groupby(names):
                end = at + sum(1 for _ in run)
                if name != chain:
                    chain, live = name, batch.column("__carried")[at].as_py()
                decided, live = admit(times[at:end], live, limit, window)
                decisions += decided
                at = end
            kept = [batch.column(c) for c in (key, ts, tie)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(decisions, pa.bool_())], [key, ts, tie, "admitted"])

    out = StructType([*(df.schema[c] for c in (key, ts, tie)), StructField("admitted", BooleanType())])
    ordered = df.repartition(key, "__chain").sortWithinPartitions(key, "__chain", "__t", tie)
    return ordered.mapInArrow(walk, out)
