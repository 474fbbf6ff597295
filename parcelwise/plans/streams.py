"""Streams over the provided tables. Each drains a file stream and returns what it wrote."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.models.estimators import fit_spread
from parcelwise.operators.admission import admissions
from parcelwise.operators.drift import fit_drift_bins
from parcelwise.plans.catalog import (
    DIRTY,
    HISTORY,
    REQUESTS,
    near,
    query,
    rnd,
    with_sales,
)
from parcelwise.plans.modeling import _forest, model_rows
from parcelwise.plans.quality import DRIFT_BASE, DRIFTED, REASON_SQL, _bucket_quantile_sql
from parcelwise.scale import fresh_path, written
from parcelwise.schemas import LATENCY_BOUNDS, REQUEST_SCHEMA
from parcelwise.sources.sample_tables import feature_history, request_log, sales, sales_dirty, table
from parcelwise.streaming import ingest, monitors
from parcelwise.streaming.sources import drain_to_files, file_messages

ROWS_PER_FILE = 250_000
"""Compressed messages are read by one task per file."""


@dataclass(frozen=True)
class Slices:
    """A folder of files; a stream that reads `files` of them per batch sees one slice after the other."""

    path: str
    files: int


def sliced_files(
    rows: DataFrame, ts: str, cuts: Sequence, kind: str, closing: timedelta | None = None, arrival: Column | None = None
) -> Slices:
    """Write rows as consecutive slices by `arrival` (by `ts` without it), all of as many files.

    With `closing`, a last slice holds one row that is empty but for a time that much later, which
    moves the watermark past all others."""
    rows = written(rows.withColumn("__arrival", F.col(ts) if arrival is None else arrival), "rows")
    path = fresh_path(rows.sparkSession, "slices")
    count, newest = rows.agg(F.count(F.lit(1)), F.max(ts)).first()
    files = max(2, -(-count // (ROWS_PER_FILE * (len(cuts) + 1))))
    bounds = [None, *cuts, None]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        part = rows
        if low is not None:
            part = part.filter(F.col("__arrival") >= F.lit(low))
        if high is not None:
            part = part.filter(F.col("__arrival") < F.lit(high))
        parts.append(part.repartition(files))
    if closing is not None and newest is not None:
        empty = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields}
        last = rows.sparkSession.range(1).select(*[c.alias(name) for name, c in empty.items()])
        parts.append(last.withColumn(ts, F.lit(newest + closing).cast(rows.schema[ts].dataType)).coalesce(1))
    for part in parts:
        writer = part.drop("__arrival").write.mode("append").format(kind)
        if kind == "json":
            # Messages repeat their field names, so that plain text is many times as long.
            writer = writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("compression", "gzip")
        writer.save(path)
    return Slices(path, files)


def file_stream(spark, slices: Slices, like: DataFrame) -> DataFrame:
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", slices.files).parquet(slices.path)


def messages_in(spark, slices: Slices) -> DataFrame:
    return file_messages(spark, slices.path, slices.files)


EVENT_CUTS = [datetime(2024, 1, 11), datetime(2024, 1, 21)]
SALE_CUTS = [datetime(1998, 1, 1), datetime(2000, 1, 1)]


def event_messages(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props")).alias("value"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def sale_messages(spark, folder) -> DataFrame:
    """Dirty sales as scoring requests; every 97th message is cut off in the middle."""
    rows = sales_dirty(spark, folder)
    payload = F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA.fields]))
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return rows.select(
        F.when(k % 97 == 0, F.substring(payload, 1, 20)).otherwise(payload).alias("value"),
        F.col("l_linenumber").alias("partition"),
        F.col("l_orderkey").alias("offset"),
        F.col("sale_date").cast("timestamp").alias("timestamp"),
    )


def _ntz(col: str):
    return F.col(col).cast("timestamp_ntz").alias(col)


@query(
    "k1_message_source",
    """SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset", ts AS "timestamp", event_id,
         event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def k1(spark, folder):
    slices = sliced_files(event_messages(spark, folder), "timestamp", EVENT_CUTS, "json")
    body = F.from_json("value", "event_id BIGINT, event_type STRING, value DOUBLE, props STRING").alias("m")
    rows, _ = drain_to_files(messages_in(spark, slices).select("partition", "offset", "timestamp", body), "k1")
    return rows.select(
        "partition", "offset", _ntz("timestamp"), "m.event_id", "m.event_type", "m.value",
        F.from_json("m.props", "k INT")["k"].alias("k"),
    )


BROKEN = "(l_orderkey + l_linenumber) % 97 = 0"
MESSAGE_REASONS = f"CASE WHEN {BROKEN} THEN ['Malformed message'] ELSE {REASON_SQL} END"
PLACE = 'l_linenumber AS "partition", l_orderkey AS "offset"'


@query(
    "k2_parse_and_validate",
    with_sales(
        f"SELECT {PLACE}, array_to_string({MESSAGE_REASONS}, '; ') AS reasons FROM dirty", DIRTY
    ),
)
def k2(spark, folder):
    slices = sliced_files(sale_messages(spark, folder), "timestamp", SALE_CUTS, "json")
    parsed = ingest.parse_messages(messages_in(spark, slices))
    rows, _ = drain_to_files(parsed.select("partition", "offset", "reasons"), "k2")
    return rows.withColumn("reasons", F.concat_ws("; ", "reasons"))


@query(
    "k3_idempotent_sinks",
    with_sales(
        f"""SELECT 'raw' AS sink, count(*) AS n FROM dirty
            UNION ALL SELECT 'quarantine', count(*) FILTER (WHERE len({MESSAGE_REASONS}) > 0) FROM dirty
            UNION ALL SELECT 'features', count(*) FILTER (WHERE len({MESSAGE_REASONS}) = 0) FROM dirty""",
        DIRTY,
    ),
)
def k3(spark, folder):
    slices = sliced_files(sale_messages(spark, folder), "timestamp", SALE_CUTS, "json")
    root = fresh_path(spark, "ingest-out")
    messages = messages_in(spark, slices)
    ingest.start_ingest(messages, root, once=True).awaitTermination()
    # A second run with a new checkpoint replays the same batches and must not add rows.
    ingest.start_ingest(messages, root, once=True).awaitTermination()
    parts = [
        spark.read.parquet(f"{root}/{sink}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(sink).alias("sink"), "n")
        for sink in ("raw", "quarantine", "features")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "k5_message_dedup",
    """SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset", ts AS "timestamp" FROM events""",
)
def k5(spark, folder):
    messages = event_messages(spark, folder)
    slices = sliced_files(messages.unionByName(messages), "timestamp", EVENT_CUTS, "json")
    unique = ingest.dedup_messages(messages_in(spark, slices), "30 days")
    rows, _ = drain_to_files(unique.select("partition", "offset", "timestamp"), "k5")
    return rows.select("partition", "offset", _ntz("timestamp"))


CUMULATIVE_SQL = ", ".join(
    [f"count(*) FILTER (WHERE latency_ms / 1000 <= CAST({b} AS DOUBLE))" for b in LATENCY_BOUNDS] + ["count(*)"]
)


@query(
    "k6_windowed_requests",
    f"""WITH {REQUESTS}, slid AS (
          SELECT *, date_trunc('minute', ts) - to_minutes(CAST(k AS INTEGER)) AS window_start
          FROM log, (SELECT unnest(range(5)) AS k)),
        counted AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n,
               count(*) FILTER (WHERE status BETWEEN 500 AND 599) AS errors,
               {rnd("count(*) FILTER (WHERE status BETWEEN 500 AND 599) / CAST(count(*) AS DOUBLE)", 6)} AS error_ratio,
               array_to_string([{CUMULATIVE_SQL}], ',') AS cumulative
        FROM slid GROUP BY window_start),
        quantiles AS ({_bucket_quantile_sql("(SELECT window_start, latency_ms / 1000 AS v FROM slid)", "window_start", 0.95)})
        SELECT counted.*, q.quantile FROM counted LEFT JOIN quantiles q USING (window_start)""",
)
def k6(spark, folder):
    log = request_log(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    slices = sliced_files(log, "ts", EVENT_CUTS, "parquet", timedelta(days=1))
    rows, _ = drain_to_files(monitors.windowed_requests(file_stream(spark, slices, log)), "k6")
    return rows.select(
        _ntz("window_start"),
        _ntz("window_end"),
        "n",
        "errors",
        near("error_ratio", 6).alias("error_ratio"),
        F.concat_ws(",", F.transform("cumulative", lambda v: v.cast("string"))).alias("cumulative"),
        near("quantile", 8).alias("quantile"),
    )


ADMISSION_SQL = f"""WITH RECURSIVE {REQUESTS},
  calls AS (SELECT client, ts, event_id, row_number() OVER (PARTITION BY client ORDER BY ts, event_id) AS rn FROM log),
  walk AS (
    SELECT client, CAST(0 AS BIGINT) AS rn, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS event_id,
           CAST([] AS TIMESTAMP[]) AS live, CAST(NULL AS BOOLEAN) AS admitted
    FROM (SELECT DISTINCT client FROM log)
    UNION ALL
    SELECT client, rn, ts, event_id, CASE WHEN len(kept) < 3 THEN list_append(kept, ts) ELSE kept END, len(kept) < 3
    FROM (SELECT c.client, c.rn, c.ts, c.event_id, [x for x in w.live if x > c.ts - INTERVAL 6 HOUR] AS kept
          FROM walk w JOIN calls c ON c.client = w.client AND c.rn = w.rn + 1))
  SELECT client, ts, event_id, admitted FROM walk WHERE rn > 0"""
LIMIT, SIX_HOURS = 3, 6 * 3600


@query("k7_admissions_table", ADMISSION_SQL)
def k7_table(spark, folder):
    return admissions(request_log(spark, folder), "client", "ts", "event_id", LIMIT, SIX_HOURS)


@query("k7_admissions_stream", ADMISSION_SQL)
def k7_stream(spark, folder):
    """Calls arrive up to two days after they were made, so slices overlap in time and are in no order."""
    log = request_log(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    arrival = F.col("ts") + F.make_dt_interval(hours=F.xxhash64("event_id") % 25 + 24)
    cuts = [datetime(2024, 1, day) for day in (8, 15, 22, 29)]
    slices = sliced_files(log, "ts", cuts, "parquet", timedelta(days=9), arrival)
    decided = monitors.stream_admissions(
        file_stream(spark, slices, log), "client", "ts", "event_id", LIMIT, SIX_HOURS, "3 days"
    )
    rows, _ = drain_to_files(decided, "k7")
    return rows.select("client", _ntz("ts"), "event_id", "admitted")


@query("k8_stream_scoring")
def k8(spark, folder):
    model = fit_spread(_forest(), model_rows(spark, folder))
    slices = sliced_files(sale_messages(spark, folder), "timestamp", SALE_CUTS, "json")
    parsed = ingest.parse_messages(messages_in(spark, slices))
    valid = parsed.filter(F.size("reasons") == 0).drop("reasons", "value")
    scored = monitors.stream_scores(valid, model).select("partition", "offset", "property_id", "prediction")
    return drain_to_files(scored, "k8")[0]


LATEST = ["event_timestamp", "created_timestamp", "order_id"]


@query(
    "k9_latest_features",
    f"""WITH {HISTORY} SELECT * FROM history QUALIFY row_number() OVER (
          PARTITION BY entity_id ORDER BY event_timestamp DESC, created_timestamp DESC, order_id DESC) = 1""",
)
def k9(spark, folder):
    history = feature_history(spark, folder)
    slices = sliced_files(history, "event_timestamp", SALE_CUTS, "parquet")
    root = fresh_path(spark, "latest-out")
    ingest.start_latest_features(
        file_stream(spark, slices, history), "entity_id", LATEST, root, once=True
    ).awaitTermination()
    ingest.compact_latest(spark, root, history.schema, "entity_id", LATEST, upto=1)
    return ingest.latest_features(spark, root, history.schema, "entity_id", LATEST, snapshot=1)


@query(
    "k10_stream_drift",
    with_sales(
        " UNION ALL ".join(
            f"""SELECT day, '{c}' AS feature_name, CAST(max(t) AS BIGINT) AS n,
                  {rnd("sum((s - r) * ln(s / r))", 6)} AS drift_score, sum((s - r) * ln(s / r)) > 0.2 AS drifted
                FROM (SELECT d.day, d.t, f.bin, f.r, greatest(coalesce(k.n, 0) / CAST(d.t AS DOUBLE), 1e-4) AS s
                      FROM (SELECT date_trunc('day', sale_date) AS day, count(*) AS t FROM bins_{c} GROUP BY day) d
                      CROSS JOIN ref_{c} f
                      LEFT JOIN (SELECT date_trunc('day', sale_date) AS day, bin, count(*) AS n FROM bins_{c} GROUP BY ALL) k
                        ON k.day = d.day AND k.bin = f.bin)
                GROUP BY day"""
            for c in DRIFTED
        ),
        *DRIFT_BASE,
    ),
)
def k10(spark, folder):
    rows = sales(spark, folder)
    fit = fit_drift_bins(rows.filter(F.col("sale_date") < F.lit("1998-06-01").cast("timestamp_ntz")), DRIFTED)
    stream_rows = rows.select(F.col("sale_date").cast("timestamp").alias("ts"), *DRIFTED)
    slices = sliced_files(stream_rows, "ts", SALE_CUTS, "parquet", timedelta(days=9))
    scores, _ = drain_to_files(monitors.daily_drift(file_stream(spark, slices, stream_rows), fit), "k10")
    return scores.withColumns({"day": _ntz("day"), "drift_score": near("drift_score", 6)})
