"""Streams: late rows, damaged messages, replays, state."""

import json
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from compare import TESTDATA
from parcelwise.plans.streams import SALE_CUTS, sale_messages, sliced_files
from parcelwise.scale import fresh_path
from parcelwise.streaming import ingest, monitors
from parcelwise.streaming.sources import MESSAGE_SCHEMA, LateRows, drain_to_files, file_messages, late_rows

START = datetime(2024, 1, 1)
LOG = "event_id BIGINT, client INT, ts TIMESTAMP, status INT, latency_ms DOUBLE"


def write_steps(spark, steps, schema, fmt="parquet"):
    """One file per step, in order."""
    path = fresh_path(spark, "steps")
    for rows in steps:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").format(fmt).save(path)
    return path


def read_steps(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def message(body, offset, minute=0):
    value = body if isinstance(body, str) or body is None else json.dumps(body)
    return (value, 0, offset, START + timedelta(minutes=minute))


VALID = {"property_id": "p", "square_feet": 900.0, "bedrooms": 2, "bathrooms": 1.0, "year_built": 1990}
MESSAGES = "value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def test_messages_are_routed(spark, tmp_path):
    steps = [
        [message(VALID, 0), message("{broken", 1), message({**VALID, "square_feet": -1.0}, 2)],
        [message(None, 3), message({**VALID, "extra": 1}, 4), message({"property_id": "q"}, 5)],
    ]
    path = write_steps(spark, steps, MESSAGES, "json")
    root = str(tmp_path / "out")
    for _ in range(2):
        ingest.start_ingest(file_messages(spark, path, 1), root, once=True).awaitTermination()
    features = spark.read.parquet(f"{root}/features")
    assert sorted(r["offset"] for r in features.collect()) == [0, 4]
    assert features.first()["property_age"] == 34
    refused = {r["offset"]: r["reasons"] for r in spark.read.parquet(f"{root}/quarantine").collect()}
    assert refused[1] == refused[3] == [ingest.MALFORMED]
    assert refused[2] == ["square_feet must be between 100 and 50000"] and len(refused[5]) == 4
    raw = spark.read.parquet(f"{root}/raw")
    assert sorted(r["offset"] for r in raw.collect()) == [0, 1, 2, 3, 4, 5]
    assert {r["batch_id"] for r in raw.select("batch_id").collect()} == {0, 1}


def test_redelivered_messages_are_dropped_across_batches(spark):
    steps = [[message("a", 1), message("a", 1), message("b", 2)], [message("a", 1, 5), message("c", 3, 6)]]
    path = write_steps(spark, steps, MESSAGES, "json")
    rows, _ = drain_to_files(ingest.dedup_messages(file_messages(spark, path, 1)).select("offset"), "dedup")
    assert sorted(r["offset"] for r in rows.collect()) == [1, 2, 3]


def test_late_requests_are_counted(spark):
    def call(i, minute, status=200, latency=20.0):
        return (i, 1, START + timedelta(minutes=minute), status, latency)

    # A batch is filtered by the watermark of the batch before it, so lateness shows one batch later.
    steps = [[call(1, 0), call(2, 1, 500)], [call(3, 60)], [call(4, 70)], [call(5, 2), call(6, 71)], [call(7, 200)]]
    path = write_steps(spark, steps, LOG)
    windows = monitors.windowed_requests(read_steps(spark, path, LOG), size="5 minutes", slide="5 minutes")
    listener = LateRows()
    spark.streams.addListener(listener)
    rows, query = drain_to_files(windows, "late")
    found = {r["window_start"]: (r["n"], r["errors"]) for r in rows.collect()}
    at = {m: START + timedelta(minutes=m) for m in (60, 70)}
    assert found == {START: (2, 1), at[60]: (1, 0), at[70]: (2, 0)}
    assert late_rows(query) == 1
    for _ in range(100):
        if listener.counts[str(query.runId)]:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert listener.counts[str(query.runId)] == 1


def test_admission_state_crosses_batches(spark):
    """Calls come out of order within the delay; a late call is decided in its place, one behind the watermark is dropped."""
    seconds = {0: 0, 1: 10, 2: 20, 3: 59, 4: 61, 5: 75, 6: 200}

    def call(i, s=None, client=1):
        return (i, client, START + timedelta(seconds=seconds[i] if s is None else s), 200, 1.0)

    marks = [(None, None, START + timedelta(days=d), None, None) for d in (1, 2)]
    steps = [[call(4), call(0)], [call(5), call(2), call(1)], [call(6), call(3)], marks[:1], [call(9, 30), call(8, 100_000, 2)], marks[1:]]
    path = write_steps(spark, steps, LOG)
    decided = monitors.stream_admissions(read_steps(spark, path, LOG), "client", "ts", "event_id", 2, 60)
    rows, _ = drain_to_files(decided, "admit")
    found = [r for r in rows.collect() if r["event_id"] is not None]
    assert {r["event_id"]: r["admitted"] for r in found} == {
        0: True, 1: True, 2: False, 3: False, 4: True, 5: True, 6: True, 8: True
    }
    assert {r["event_id"]: r["ts"] for r in found}[3] == START + timedelta(seconds=59)


def test_keys_of_one_bucket_are_admitted_apart(spark):
    """All keys share a state here, the null key has one of its own; each is walked on its own."""
    def call(i, client, s):
        return (i, client, START + timedelta(seconds=s), 200, 1.0)

    steps = [
        [call(1, 1, 0), call(2, 2, 5), call(3, None, 1)],
        [call(4, 1, 10), call(5, 2, 70), call(6, None, 2), call(7, None, 3)],
        [call(8, 1, 20), call(9, 2, 71), call(10, 2, 72), call(11, 1, 61)],
        [(None, None, START + timedelta(days=1), None, None)],
    ]
    path = write_steps(spark, steps, LOG)
    decided = monitors.stream_admissions(read_steps(spark, path, LOG), "client", "ts", "event_id", 2, 60, buckets=1)
    rows, _ = drain_to_files(decided, "admit")
    found = {r["event_id"]: (r["client"], r["admitted"]) for r in rows.collect() if r["event_id"] is not None}
    assert found == {
        1: (1, True), 2: (2, True), 3: (None, True), 4: (1, True), 5: (2, True), 6: (None, True),
        7: (None, False), 8: (1, False), 9: (2, True), 10: (2, False), 11: (1, True),
    }


def test_message_slices_are_compressed_and_whole(spark):
    """Plain JSON made up most of the bytes that the message queries write."""
    messages = sale_messages(spark, f"{TESTDATA}/sf0.001")
    slices = sliced_files(messages, "timestamp", SALE_CUTS, "json")
    files = spark.read.format("binaryFile").load(slices.path).select("path", "length").collect()
    assert len(files) == slices.files * (len(SALE_CUTS) + 1)
    plain = messages.agg(F.sum(F.octet_length("value"))).first()[0]
    assert all(f["path"].endswith(".json.gz") for f in files) and sum(f["length"] for f in files) < plain / 3
    back = spark.read.schema(MESSAGE_SCHEMA).json(slices.path)
    assert back.exceptAll(messages.select(back.columns)).count() == 0 and back.count() == messages.count()


def test_latest_features_survive_compaction(spark, tmp_path):
    schema = "k STRING, ts TIMESTAMP_NTZ, v INT"
    steps = [[("a", START, 1), ("b", START, 1)], [("a", START + timedelta(days=2), 2)], [("a", START + timedelta(days=1), 9), ("c", START, 3)]]
    path = write_steps(spark, steps, schema)
    root = str(tmp_path / "latest")
    stream = read_steps(spark, path, schema)
    for _ in range(2):
        ingest.start_latest_features(stream, "k", ["ts"], root, once=True).awaitTermination()
    shape = spark.createDataFrame([], schema).schema
    expected = {"a": 2, "b": 1, "c": 3}

    def found(**kw):
        return {r["k"]: r["v"] for r in ingest.latest_features(spark, root, shape, "k", ["ts"], **kw).collect()}

    assert found() == expected
    ingest.compact_latest(spark, root, shape, "k", ["ts"], upto=0)
    assert found(snapshot=0) == expected
    ingest.compact_latest(spark, root, shape, "k", ["ts"], upto=2, since=0)
    assert found(snapshot=2) == expected
    assert spark.read.parquet(f"{root}/snapshot/upto=2").agg(F.count(F.lit(1))).first()[0] == 3
