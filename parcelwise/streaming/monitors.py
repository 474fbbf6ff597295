"""Windowed request statistics, drift and admission on streams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DataType, LongType, StructField, StructType

from parcelwise.models.scoring import score_requests
from parcelwise.operators.admission import admit
from parcelwise.operators.alerts import cumulative_quantile
from parcelwise.operators.drift import DriftBins, drift_scores
from parcelwise.operators.encoding import RobustScale
from parcelwise.schemas import LATENCY_BOUNDS


def windowed_requests(
    log: DataFrame,
    ts: str = "ts",
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "10 minutes",
    bounds: Sequence[float] = LATENCY_BOUNDS,
    q: float = 0.95,
) -> DataFrame:
    """Requests, errors, cumulative latency counts and a latency quantile per window, emitted once the window closed.

    Events are counted into panes as long as the slide, of which `size` must be a multiple; windows are sums of
    closed panes. So an event is counted once, not once per window, and the second state holds panes only."""
    seconds = F.col("latency_ms") / 1000
    buckets = {f"b{i}": F.count_if(seconds <= b) for i, b in enumerate(bounds)}
    counts = {
        "n": F.count(F.lit(1)),
        "errors": F.count_if(F.col("status").between(500, 599)),
        **buckets,
        "timed": F.count("latency_ms"),
    }
    panes = log.withWatermark(ts, delay).groupBy(F.window(ts, slide).alias("pane"))
    panes = panes.agg(*[c.alias(name) for name, c in counts.items()])
    windows = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("window"))
    windows = windows.agg(*[F.sum(name).alias(name) for name in counts])
    cumulative = F.array(*buckets, "timed")
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "n",
        "errors",
        (F.col("errors") / F.col("n")).alias("error_ratio"),
        cumulative.alias("cumulative"),
        cumulative_quantile(cumulative, bounds, q).alias("quantile"),
    )


def daily_drift(rows: DataFrame, fit: DriftBins, ts: str = "ts", delay: str = "1 day", threshold: float = 0.2) -> DataFrame:
    """Stability index per feature and day against fixed bins, emitted once the day closed."""
    watermarked = rows.withWatermark(ts, delay)
    scores = drift_scores(watermarked, fit, [F.window(ts, "1 day").alias("day")], threshold)
    return scores.withColumn("day", F.col("day.start"))


def stream_scores(requests: DataFrame, model: Model, scale: RobustScale | None = None) -> DataFrame:
    """Features and predicted price of each request; stateless."""
    return score_requests(requests, model, scale)


class Admission(StatefulProcessor):
    """Per bucket of keys: the calls that wait for the watermark, and each key's admission times of the last window.

    A call is decided when the watermark has passed it, since no earlier one can then arrive. An event-time
    timer stands at the earliest waiting call, or at the end of the window when none waits. State is read and
    written once per bucket and batch: each access is a message to the JVM, which costs far more than a call."""

    def __init__(self, columns: tuple[str, str, str], types: tuple[DataType, DataType], limit: int, window: int):
        self.columns, self.types, self.limit, self.window = columns, types, limit, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        key_type, tie_type = self.types
        name, time = StructField("key", key_type), StructField("t", LongType())
        self.waiting = handle.getListState("waiting", StructType([name, time, StructField("tie", tie_type)]))
        self.live = handle.getListState("live", StructType([name, time]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        name, time, tie = self.columns
        passed, calls = timerValues.getCurrentWatermarkInMs() * 1000, []
        for frame in rows:
            frame = frame[frame[time] > passed]
            # The bucket of the null key holds no other, so that pandas keeps the type of all others.
            names = [None] * len(frame) if key[0] == NULL_BUCKET else frame[name].tolist()
            calls += zip(names, frame[time].tolist(), frame[tie].tolist(), strict=True)
        if calls:
            self.waiting.appendList(calls)
            self._wake(min(t for _, t, _ in calls), timerValues)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, rest, live, out = defaultdict(list), [], defaultdict(list), []
        for name, t, tie in self.waiting.get():
            if t <= passed:
                due[name].append((t, tie))
            else:
                rest.append((name, t, tie))
        for name, t in self.live.get():
            live[name].append(t)
        for name, calls in due.items():
            calls.sort()
            decisions, live[name] = admit([t for t, _ in calls], live[name], self.limit, self.window)
            out += [(name, *call, admitted) for call, admitted in zip(calls, decisions, strict=True)]
        # Calls to come are later than the watermark, so older admissions are outside of their windows.
        kept = [(name, t) for name, times in live.items() for t in times if t + self.window > passed]
        for state, rows in ((self.waiting, rest), (self.live, kept)):
            if rows:
                state.put(rows)
            else:
                state.clear()
        if rest:
            self._wake(min(t for _, t, _ in rest), timerValues)
        elif kept:
            self._wake(max(t for _, t in kept) + self.window, timerValues)
        if out:
            yield pd.DataFrame(dict(zip((*self.columns, "admitted"), map(list, zip(*out, strict=True)), strict=True)))

    def _wake(self, micros: int, timerValues) -> None:
        self.handle.registerTimer(max(micros // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))


NULL_BUCKET = -1
BUCKET = "__bucket"
ADMISSION_BUCKETS = 1024
"""Groups of keys that share a state; a key's calls all lie in one."""

MICROS = "event_micros"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_admissions(
    log: DataFrame,
    key: str,
    ts: str,
    tie: str,
    limit: int = 100,
    seconds: int = 60,
    delay: str = "10 minutes",
    buckets: int = ADMISSION_BUCKETS,
) -> DataFrame:
    """Admission decisions on a stream, in event order whatever the order of arrival within `delay`.

    A decision comes when the watermark has passed its call; calls behind the watermark are dropped. The
    waiting calls and the admissions of the last window of the keys in a bucket are its state. `buckets` may not
    change over the life of a checkpoint. The session's state store is set to RocksDB, which this kind of state needs."""
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kinds = {c: log.schema[c].dataType for c in (key, ts, tie)}
    out = StructType(
        [
            StructField(key, kinds[key]),
            StructField(MICROS, LongType()),
            StructField(tie, kinds[tie]),
            StructField("admitted", BooleanType()),
        ]
    )
    bucket = F.when(F.col(key).isNull(), NULL_BUCKET).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    decided = (
        log.select(key, ts, tie, F.unix_micros(ts).alias(MICROS), bucket.alias(BUCKET))
        .withWatermark(ts, delay)
        .groupBy(BUCKET)
        .transformWithStateInPandas(
            Admission((key, MICROS, tie), (kinds[key], kinds[tie]), limit, seconds * 1_000_000), out, "Append", "EventTime"
        )
    )
    return decided.select(key, F.timestamp_micros(MICROS).cast(kinds[ts]).alias(ts), tie, "admitted")
