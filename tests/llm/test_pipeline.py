import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_packing import check_packed
from test_simhash import brute_components, plain_print
from test_substrings import brute
from tokenizers import Tokenizer

from parcelwise.llm import language, quality
from parcelwise.scale import written

SMALL = "/root/testdata/sf0.001"
TABLE = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = written(stage(spark, docs, SMALL), name)
        after = {r.doc_id: r for r in out.collect()}
        if name != "best_fit_packing":
            assert out.columns == columns and set(after) <= set(before)
        if name == "language_id":
            own = language.Scorer(language.learn(docs.where(~language.held_out()).select("text", "lang")))
            found = {i: own.best(r.text) for i, r in before.items()}
            assert set(after) == {i for i, (lang, score) in found.items() if lang != "und" and score >= 0.5}
        elif name == "quality_rules":
            model = quality.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert set(after) == {r.doc_id for r in quality.judge(docs, model).collect() if r.kept}
        elif name == "simhash_near_dedup":
            assert set(after) == set(brute_components([(i, plain_print(r.text)) for i, r in before.items()]).values())
        elif name == "substring_dedup":
            expected = brute([(i, r.text) for i, r in before.items()])
            assert {i: r.text for i, r in after.items()} == {
                i: expected[i][2] if expected[i][1] else r.text for i, r in before.items()
            }
        kept.append(len(after))
        docs = out
    assert kept[0] > 0.9 * 200 and kept[2] > 0.5 * 200
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    rows = docs.collect()
    check_packed(rows)
    for r in rows:
        pieces[r.doc_id].append(r)
    for i, r in before.items():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        got = [(p.start, p.length, p.ids_crc32) for p in sorted(pieces[i], key=lambda p: p.piece)]
        cuts = [ids[at : at + 4096] for at in range(0, len(ids), 4096)]
        assert got == [(4096 * n, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for n, c in enumerate(cuts)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows_in_every_stage(spark, name, stage):
    text = " ".join(f"word{n % 61} of {n}" for n in range(400))
    rows = [
        (1, text, "en", "a", 5),
        (1, text, "en", "a", 5),
        (2, None, None, None, None),
        (None, text + " x", "en", "b", 1),
        (4, "", "de", "b", 0),
    ]
    docs = spark.createDataFrame(rows, TABLE).selectExpr("*", "1 AS kept", "'x' AS __found", "2 AS n_words")
    assert stage(spark, docs, SMALL).count() >= 1
    assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert check_packed(rows) > 0


def test_texts_under_one_id_are_cut_on_their_own(spark):
    passage = " ".join(f"passage{n}" for n in range(60))
    texts = [" ".join(f"{w}{n}" for n in range(70)) for w in ("alpha", "beta", "gamma")]
    rows = [(1, texts[0] + " " + passage), (3, texts[1] + " " + passage), (3, texts[2])]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], TABLE)
    stage = dict(corpus_pipeline.STAGES)["substring_dedup"]
    assert sorted(r.text for r in stage(spark, docs, SMALL).collect()) == sorted([rows[0][1], texts[1], texts[2]])


def test_python_steps_give_memory_back(spark, monkeypatch):
    """Idle Python workers count against their executor's memory, whatever stage they last worked for."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from parcelwise.llm import packing, simhash, tables

    steps, freed, real = [], [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda fn: steps.append(fn) or real(kind)(fn))
    for module in (packing, quality, simhash, tables):
        monkeypatch.setattr(module, "give_back", lambda: freed.append(1))
    docs = spark.createDataFrame([], "doc_id long, text string")
    docs.select(simhash.fingerprint(F.col("text")), tables.uncompressed(tables.compressed(F.col("text"))))
    quality.judge(docs, None)
    packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array(["one two three", None, ""])
    frames = pa.array([tables.packer()(b"one"), tables.packer()(b"")], pa.binary())
    assert len(steps) == 5
    for step in steps:
        assert list(step(iter([frames if step.__name__ == "unpack" else texts])))
    assert len(freed) == 5
