import base64
import hashlib

import public_tokenizers
import tiktoken

from parcelwise.llm import bpe
from parcelwise.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SMALL = "/root/testdata/sf0.001"


def plain_encoder():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_parts_give_the_ids_of_the_whole_text():
    encoder = plain_encoder()
    texts = ["it's 12 o'clock   now\n\n ok", "a1b2c3" * 50, "x" * 300, " " * 90 + "end", "né à l'école 3.14 <|endoftext|> " * 20]
    for text in texts:
        whole = encoder.encode_ordinary(text)
        for n in (1, 2, 3, 7, 50):
            parts = list(bpe.safe_parts(text, n))
            assert "".join(parts) == text
            assert [i for p in parts for i in encoder.encode_ordinary(p)] == whole


def test_odd_rows_round_trip(spark):
    texts = [None, "", "a", "a", "\u0000\U0001f600 <|endoftext|>", "word " * 40_000, "\r\n \t", "z" * 3000]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    out = bpe.decode_documents(
        bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN
    ).collect()
    encoder = plain_encoder()
    for row in out:
        assert row.ids == encoder.encode_ordinary(texts[row.doc_id] or "")
        assert bytes(row.decoded).decode() == (texts[row.doc_id] or "")
    assert len(out) == len(texts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_query_equals_the_library(spark):
    encoder = plain_encoder()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = QUERIES["op1_byte_bpe"](spark, SMALL).collect()
    assert len(out) == len(texts)
    for row in out:
        ids = encoder.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()
