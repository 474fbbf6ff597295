import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelwise.llm import packing
from parcelwise.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def check_packed(rows, capacity=4096):
    """Sequences are gapless and not too long; returns how many there are."""
    own = defaultdict(list)
    for r in rows:
        own[r.sequence_id].append((r.offset, r.length))
    for parts in own.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(own)


def test_query(spark):
    tokenizer = Tokenizer.from_file(PATH)
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op4_grouped_packing"](spark, folder).collect()
    pieces = defaultdict(dict)
    for r in rows:
        assert r.piece not in pieces[r.doc_id]
        pieces[r.doc_id][r.piece] = r
    total = 0
    for doc_id, text in docs.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        total += len(ids)
        cuts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        assert sorted(pieces[doc_id]) == list(range(len(cuts)))
        for n, cut in enumerate(cuts):
            r = pieces[doc_id][n]
            crc = zlib.crc32(np.array(cut, "<u4").tobytes())
            assert (r.start, r.length, r.ids_crc32) == (4096 * n, len(cut), crc)
    used = check_packed(rows)
    assert used <= 1.03 * -(-total // 4096) + 2, (used, total / 4096)


def ids_of(text):
    return np.frombuffer(packing.word_encoder(PATH)(text.encode()), "<u4").tolist()


def test_words_give_the_ids_of_the_text():
    tokenizer = Tokenizer.from_file(PATH)
    for text in (
        "It's  ÁprÈs 'ReΣΣ 3.14 x y\n\nİ ́a <|endoftext|> Word. WORD, x., 3. 's. H\u0331. don't !!?? ẛ̣ \x1fz",
        "hello <|startoftext|> world",
        "a<|startoftext|>B <|endoftext|>. <|endoftext|>é, <|endoftext|><|startoftext|> <|endoftext |> <|ENDOFTEXT|>",
        "ÀÖØÞßàöøÿ ×÷ Straße, ÉTÉ. çà; e\u0301. n'est l'été. 1.5, 2!: a.b. µ. ªº Ω. ĲSSEL. ﬁn.",
        "\u00a0x\u2003y\u3000z\x85w\x1cv",
    ):
        assert ids_of(text) == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert ids_of("hello <|startoftext|> world") == [3306, 49406, 1002]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n.,;:!?'-09azAZéÉßÿ×İΣς\u0301\u0308あ<|>"), max_size=24), st.sampled_from(["", "<|endoftext|>"]))
def test_any_text_gives_the_ids_of_the_tokenizer(text, special):
    text = text[:7] + special + text[7:]
    assert ids_of(text) == PLAIN.encode(text, add_special_tokens=False).ids


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "word " * 9000, "c"), (3, "word " * 9000, "c"), (None, "x", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    out = packing.pack(packing.token_pieces(docs, PATH))
    got = out.collect()
    assert Counter(r.doc_id for r in got) == {1: 1, 2: 1, 3: 6, None: 1}
    check_packed(got)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(out).collect()}
    for r in got:
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack(packing.token_pieces(docs.limit(0), PATH)).count() == 0


@pytest.mark.parametrize("kind", ["hot", "spread", "large", "small"])
def test_any_histogram_is_packed(spark, kind):
    rng = np.random.default_rng(5)
    lengths = {
        "hot": np.where(rng.random(3000) < 0.5, 1500, rng.integers(1, 4097, 3000)),
        "spread": rng.integers(1, 4097, 3000),
        "large": rng.integers(1025, 4097, 2000),
        "small": rng.integers(1, 300, 5000),
    }[kind]
    rows = [(i, 0, int(n)) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long").repartition(5)
    got = packing.pack(pieces).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted((a, c) for a, _, c in rows)
    used = check_packed(got)
    # Best fit decreasing, one piece at a time.
    space: list[int] = []
    for n in sorted(lengths.tolist(), reverse=True):
        fitting = [(s, at) for at, s in enumerate(space) if s >= n]
        if fitting:
            space[min(fitting)[1]] -= n
        else:
            space.append(4096 - n)
    assert used <= 1.03 * len(space) + 3, (used, len(space))


def test_configurations_solve_a_known_case():
    # 7 of 2048 and 6 of 1365 fill 3.5 and 2 sequences.
    plan = packing.configurations([2048, 1365], [8, 6], 4096)
    assert sum(n for n, _ in plan) <= 6
    assert all(sum(a * b for a, b in zip([2048, 1365], c)) <= 4096 for _, c in plan)
