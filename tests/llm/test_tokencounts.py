import public_tokenizers
import regex
from tokenizers import Tokenizer

from parcelwise.llm import tokencounts
from parcelwise.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    texts = [r.text or "" for r in docs]
    counts = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    want = {r.doc_id: (len(t.encode()), n, n > 1024) for r, t, n in zip(docs, texts, counts)}
    got = QUERIES["op12_pretoken_counts"](spark, folder).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == want


def test_odd_rows(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [
        None,
        "",
        "a<|endoftext|> b<|endoftext|><|endoftext|>",
        "<|endof text|> <|endoftext|",
        "word's  don't\n\n  x   y 3.14 a1b2 " * 3000,
        "՛՘ ౜a࢏₏ \U00010940x \x1c\x85 ’tis 中文あ",
        "same",
        "same",
        "x" * 200_000,
    ]
    rows = [(None if n == 1 else n // 2, t, 7, "clash", "n") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, vocabulary string, chunk string")
    got = tokencounts.count_tokens(docs.repartition(3), PATH, PATTERN, chunk_bytes=100).collect()
    want = [(r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted((a or -1, b, c) for a, b, c in want)
    assert tokencounts.count_tokens(docs.limit(0), PATH, PATTERN).count() == 0


def test_both_engines_agree_on_the_characters_of_the_fast_path():
    split = Tokenizer.from_file(PATH).pre_tokenizer.pre_tokenize_str
    pieces = regex.compile(PATTERN)
    fast = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)]) if not tokencounts.UNLIKE.search(c)]
    assert len(fast) > 20_000
    for at in range(0, len(fast), 500):
        text = "".join(f"a{c}{c}1{c} !{c}\n{c}" for c in fast[at : at + 500])
        assert [text[a:b] for _, (a, b) in split(text)] == pieces.findall(text)


def test_numbers_survive_narrowing():
    import numpy as np

    for values in ([], [0], [255, 256, 7], [1 << 31, 3]):
        assert tokencounts._wide(tokencounts._narrow(np.array(values, np.int64)), len(values)).tolist() == values
