import zlib

from parcelwise.llm import language
from parcelwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_language_backoff"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred in {*lang.values(), "und"} and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_backoff_uses_shorter_grams(spark):
    rows = [("aa", "vlokar vlokin"), ("bb", "smeter smetil"), ("aa", None), (None, "zzz"), ("bb", "")]
    model = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    own = language.Scorer(model)
    assert model.languages == ["aa", "bb"]
    assert own.best("vlokar")[0] == "aa" and own.best("smetil SMETER")[0] == "bb"
    assert own.best("vlokest")[0] == "aa" and own.best("xxmet")[0] == "bb"
    assert own.best("v")[0] == "aa"
    # Nothing known: equal scores go to the first language.
    assert own.best("QQQ")[0] == "aa" and abs(own.best("QQQ")[1] - 0.5) < 1e-9
    for text in (None, "", " \n", "123 ½ _ !?", "١٢"):
        assert own.best(text) == ("und", 0.0)


def test_plain_scores(spark):
    import math

    rows = [("aa", "x x y"), ("bb", "y z")]
    own = language.Scorer(language.learn(spark.createDataFrame(rows, "lang string, text string")))
    a = math.log((2 + 0.5) / (3 + 1.5)) + math.log((1 + 0.5) / (3 + 1.5))
    b = math.log((0 + 0.5) / (2 + 1.5)) + math.log((1 + 0.5) / (2 + 1.5))
    lang, score = own.best("x, Y!")
    assert lang == "aa" and abs(score - 1 / (1 + math.exp(b - a))) < 1e-6


def test_capacity_keeps_the_most_frequent(spark):
    rows = [("aa", f"w{chr(97 + n)}", 100 - n) for n in range(26)]
    counts = spark.createDataFrame(rows, "lang string, token string, n long")
    kept = {r.token for r in language.most_frequent(counts, 10).collect()}
    assert 0 < len(kept) <= 10 and kept == {f"w{chr(97 + n)}" for n in range(len(kept))}


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "le " * 90_000, 6), (2, "le", 7)], "doc_id long, text string, score int")
    nothing = language.learn(docs.selectExpr("text", "cast(null as string) as lang"))
    assert [(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()] == [("und", 0.0)] * 3
    model = language.learn(spark.createDataFrame([("fr", "le la"), ("en", "the")], "lang string, text string"))
    assert [r.lang_pred for r in language.identify(docs, model).orderBy("doc_id").collect()] == ["und", "fr", "fr"]
    assert language.identify(docs.limit(0), model).count() == 0


def test_no_word_is_cut_from_the_tables(spark, monkeypatch):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    whole = language.Scorer(language.learn(docs.where(~language.held_out()).select("text", "lang"), 10**9))
    monkeypatch.setattr(language.learn, "__defaults__", (50,))
    expected = {r.doc_id: whole.best(r.text) for r in docs.collect()}
    got = {r.doc_id: r for r in QUERIES["op7_language_backoff"](spark, small).collect()}
    assert set(got) == set(expected)
    for i, (lang, score) in expected.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-6


def test_tables_back_off_like_the_model(spark):
    rows = [("aa", "vlokar vlokin"), ("bb", "smeter smetil"), ("aa", None), (None, "zzz"), ("bb", "")]
    training = spark.createDataFrame(rows, "lang string, text string")
    own = language.Scorer(language.learn(training))
    texts = ["vlokar", "smetil SMETER", "vlokest", "xxmet", "v", "QQQ", None, "", "123 ½ _ !?", "vlokar, x-met vlo"]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, score int")
    got = {r.text: (r.lang_pred, r.score) for r in language.identify(docs, language.count_tables(training)).collect()}
    for text in texts:
        lang, score = own.best(text)
        assert got[text][0] == lang and abs(got[text][1] - score) < 1e-6
    nothing = language.count_tables(training.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0), nothing).count() == 0


def test_tables_with_long_repeated_and_clashing_rows(spark):
    training = spark.createDataFrame([("fr", "le la les"), ("en", "the a of")], "lang string, text string")
    own = language.Scorer(language.learn(training))
    texts = ["le the " * 100_000 + "le", "the of", "the of", None, "", "la"]
    rows = [(None if i == 5 else i // 2, t, i, "c", f"r{i}", 1.0, b"f", True) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, row int, chunk string, rest string, score double, frame binary, held_out boolean"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    found = language.identify(docs, language.count_tables(training))
    assert set(found.columns) == {*docs.columns, "lang_pred"}
    got = {r.row: r for r in found.collect()}
    assert sorted(got) == list(range(6))
    for i, text in enumerate(texts):
        r, (lang, score) = got[i], own.best(text)
        assert (r.text, r.chunk, r.rest, bytes(r.frame), r.lang_pred) == (text, "c", f"r{i}", b"f", lang)
        assert abs(r.score - score) < 1e-6


def test_many_chunks_and_buckets_back_off_like_the_model(spark, monkeypatch):
    """The training texts are dealt to fewer buckets than the judged ones, so the lists are dealt again."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    training = docs.where("doc_id % 9 = 0").select("text", "lang")
    own = language.Scorer(language.learn(training, 10**9))
    monkeypatch.setattr(language, "BUCKET_BYTES", 20_000)
    tables = language.count_tables(training)
    judged = language.judged(docs, tables, chunk_bytes=30_000)
    assert tables.bits > 0 and language.bucket_bits(docs.selectExpr("sum(octet_length(text))").first()[0]) > tables.bits
    rows = judged.select("row.*", "lang_pred", "score").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    for r in rows:
        lang, score = own.best(r.text)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6


def test_texts_that_are_not_wanted_are_not_written(spark, monkeypatch):
    """Copies of texts, exchanged and written, were most of the disk."""
    import os
    import tempfile

    from parcelwise import scale

    folder = tempfile.mkdtemp(prefix="language-")
    monkeypatch.setattr(scale, "shared_folder", lambda spark: folder)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    tables = language.count_tables(docs.where(~language.held_out()).select("text", "lang"))
    found = language.identify(docs, tables, keep_text=False)
    assert found.columns == ["doc_id", "lang", "lang_pred", "score"]
    assert found.count() == docs.count()
    files = [os.path.join(at, f) for at, _, names in os.walk(folder) for f in names]
    assert 0 < sum(map(os.path.getsize, files)) < 0.55 * size
