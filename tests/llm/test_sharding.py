import zlib

from parcelwise.llm import sharding
from parcelwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def check_laws(rows, shards, largest):
    total = sum(r.size for r in rows)
    by_shard = {s: [] for s in range(shards)}
    for r in rows:
        by_shard[r.shard].append(r)
    for s, own in by_shard.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= largest + 0.001 * total / shards + 1
    return by_shard


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = QUERIES["op2_histogram_shards"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
    check_laws(out, 24, max(r.size for r in out))


def test_hot_text_is_split_between_shards(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    by_shard = check_laws(sharding.shard_by_bytes(docs, 24).collect(), 24, 20)
    hot = [s for s, own in by_shard.items() if any(r.text == "same text" for r in own)]
    assert len(hot) >= 15
    # Other texts lie beside the group: copies fill consecutive shards.
    assert max(hot) - min(hot) + 1 == len(hot)


def test_small_blocks_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    out = sharding.shard_by_bytes(docs, 5, block_bytes=20_000, probes=16).collect()
    check_laws(out, 5, max(r.size for r in out))


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, None, 2), (1, "", 3), (2, "é" * 9000, 4), (3, "b", 5), (3, "b", 5), (4, "b", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sharding.shard_by_bytes(docs, 24).collect()
    assert len(out) == len(rows)
    assert {r.size for r in out if not r.text} == {8}
    for s in {r.shard for r in out}:
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own)))
    assert sharding.shard_by_bytes(docs.limit(0), 24).count() == 0
    assert [r.slot for r in sharding.shard_by_bytes(docs.limit(1), 24).collect()] == [0]
