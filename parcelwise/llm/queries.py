"""Registered queries of this folder: each applies one operator to its whole table.

`QUERIES` maps names to functions of a session and a folder of tables, `SQL` holds counterparts
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import (
    bpe,
    editprint,
    hosts,
    language,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    spelling,
    substrings,
    tokencounts,
    whitening,
)
from parcelwise.llm.tables import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


@query("op1_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    encoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode_documents(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_histogram_shards")
def histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    digests = docs.withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return sharding.shard_by_bytes(digests, 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def packed_digests(docs: DataFrame, **options) -> DataFrame:
    """Pieces of `docs` with the checksum of their ids in place of the ids, packed."""
    import public_tokenizers

    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), **options).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op4_grouped_packing")
def grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(documents(spark, sf_dir))


@query("op5_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op9_repeated_phrases")
def repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op7_language_backoff")
def language_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    model = language.count_tables(docs.where("not held_out"))
    return language.identify(docs, model, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")


@query("op8_quality_regression")
def quality_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "probability",
    )


@query("op3_context_mixing")
def context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score_documents(documents(spark, sf_dir), language.held_out(folds=7))


HOST = r"translate(regexp_extract({0}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _host_rank_sql() -> str:
    """The rounds of the propagation, one common table each."""
    out = []
    for name, edges, columns in (("f", "forward", ("trust", "base")), ("b", "backward", ("distrust",))):
        for step in range(1, hosts.ROUNDS + 1):
            before = "seeds" if step == 1 else f"{name}{step - 1}"
            came = ", ".join(f"{hosts.DAMPING} * share * {c} AS {c}" for c in columns)
            start = ", ".join(f"{1 - hosts.DAMPING} * {c}" for c in columns)
            sums = ", ".join(f"sum({c}) AS {c}" for c in columns)
            out.append(
                f"{name}{step} AS (SELECT host, {sums} FROM (SELECT dst AS host, {came} FROM {edges} JOIN {before}"
                f" ON src = {before}.host UNION ALL SELECT host, {start} FROM seeds) GROUP BY host)"
            )
    return ",\n".join(out)


@query(
    "op6_host_trust",
    f"""WITH split AS (
  SELECT page_id, html, coalesce({HOST.format("url")}, '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM split),
given AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END
  AS fixed FROM ruled),
seeds AS (SELECT host, count(*) FILTER (fixed = 'allow')::DOUBLE AS trust,
  count(*) FILTER (fixed = 'block')::DOUBLE AS distrust, count(*)::DOUBLE AS base FROM given WHERE host <> '' GROUP BY host),
hrefs AS (SELECT host AS src, unnest(list_distinct(regexp_extract_all(html,
  'href\\s*=\\s*["'']?([a-z][a-z0-9+.-]*://[^"''\\s>]*)', 1, 'i'))) AS href FROM split),
up AS (SELECT DISTINCT host AS src, regexp_extract(host, '^[^.]+\\.([^.]+\\..+)$', 1) AS dst FROM split),
edges AS (SELECT src, dst, count(*)::DOUBLE AS n FROM (
  SELECT src, {HOST.format("href")} AS dst FROM hrefs UNION ALL SELECT src, dst FROM up UNION ALL SELECT dst, src FROM up)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
forward AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM edges),
backward AS (SELECT dst AS src, src AS dst, n / sum(n) OVER (PARTITION BY dst) AS share FROM edges),
{_host_rank_sql()},
blocked AS (SELECT host FROM f{hosts.ROUNDS} JOIN b{hosts.ROUNDS} USING (host)
  WHERE round(distrust - trust - {hosts.THRESHOLD} * base, 6) > 0)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN host IN (FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM given""",
)
def host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query("op10_edit_embedding")
def edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edited_pairs(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query("op12_pretoken_counts")
def pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return tokencounts.count_tokens(documents(spark, sf_dir), tokenizer, public_tokenizers.PATTERN)


@query("op13_variable_grams")
def variable_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


@query("op11_spectral_whitening")
def spectral_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
