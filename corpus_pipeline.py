"""A training corpus from `documents`: language, quality, near copies, repeated passages, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame that is
written as Parquet and read again as the next one's `docs`. All but the last keep the columns of
`documents`. Each stage fits what it fits on its own input.

Defined cases, for every stage: an empty table gives no rows; texts of any length are taken whole; columns beside those
of `documents`, also such that are named like something a stage computes, are kept as they are. A null text or one
without a letter has no language and goes in the first stage; after it, a null or empty text fails the quality rules.
Rows with a null id are documents like others: they are judged, compared and packed by their text, and only the
repeated-phrase stage leaves them uncut. Rows that repeat id and text are one document for the near-duplicate stage,
which keeps one of them; of ties, the smallest id and then the smallest hash of the text stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import language, quality, simhash, substrings
from parcelwise.llm.queries import packed_digests
from parcelwise.llm.tables import compressed, documents, uncompressed
from parcelwise.scale import lookup_side, written

MIN_LANGUAGE_SCORE = 0.5
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language that the model finds more likely than not."""
    found = language.judged(docs, language.count_tables(docs.where(~language.held_out()).select("text", "lang")))
    clear = (F.col("lang_pred") != language.UNDECIDED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(clear).select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rules or the regression reject."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).where("kept").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that with the smallest id."""
    return simhash.one_per_component(docs, simhash.near_duplicates(docs))


def repeated_phrase_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; texts without any stay as they are, no row is dropped.

    Of different texts under one id, all but that with the smallest hash count as documents of their
    own behind all others."""
    docs = docs.withColumn("__mark", F.xxhash64("text"))
    shared = docs.where("doc_id is not null").groupBy("doc_id")
    shared = shared.agg(F.min("__mark").alias("__first"), F.max("__mark").alias("__last")).where("__first < __last")
    named = docs.join(lookup_side(shared.select("doc_id", "__first")), "doc_id", "left")
    further = F.shiftrightunsigned(F.xxhash64("doc_id", "__mark"), 2).bitwiseOR(F.lit(1 << 62))
    named = named.withColumn("__row", F.when(F.col("__mark") != F.col("__first"), further).otherwise(F.col("doc_id")))
    cut = written(substrings.remove_repeats(named, "__row").where("n_removed > 0"), "cut-texts")
    cut = cut.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("__row"), compressed(F.col("kept")).alias("__cut"))
    # Texts are exchanged compressed.
    framed = named.withColumns({"__none": F.col("text").isNull(), "__frame": compressed(F.col("text"))}).drop("text")
    joined = framed.join(cut, "__row", "left")
    is_cut, whole = F.col("__cut").isNotNull(), uncompressed(F.coalesce("__cut", "__frame"))
    joined = joined.withColumn("text", F.when(is_cut | ~F.col("__none"), whole))
    length = F.when(is_cut, F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(docs.drop("__mark").columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_digests(docs)


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("substring_dedup", repeated_phrase_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
