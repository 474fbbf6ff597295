"""Language identification: known words first, then ever shorter character n-grams.

A word of the vocabulary scores its log frequency in each language. Any other word backs off: the
longest character n-grams (5 down to 1, with word edges) of which the tables know one decide by
their mean log frequency. A text scores the sum over its words; the probability of the best
language, with equal priors, is the score.

All words of all training rows are counted, and all counts stay in tables (`count_tables`): compressed lists of
tokens with their counts per language, one per bucket of tokens. Documents are read once and kept as chunks of sorted
word numbers. Each chunk sends its distinct words, compressed per bucket, and gets their counts back, or for words
that no training row has the mean log frequencies of their n-grams; no table is broadcast, no word is left out, and
texts move only if they are wanted in the result. `learn` is the same model in memory, cut to the most frequent words
and n-grams up to `capacity` each.

Defined cases: a null text or one without a letter is `und` with score 0, and so is every text when
nothing could be learned; a word of which no n-gram is known says nothing; equal scores go to the
first language in alphabetical order; training rows without language or text are skipped; repeated
rows count as often as they come; an empty table gives no rows. Extra columns are kept, those named
like the results are replaced.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.llm.mixing import WordNumbers, bucket_of, runs, squeezed, unsqueezed, word_hashes
from parcelwise.llm.tables import freeing, packer, stored, text_bytes, uncompressed, unpacker
from parcelwise.scale import written

LETTERS = regex.compile(r"\p{L}+")
GRAMS = (5, 4, 3, 2, 1)
MARKS = ".,;:!?"
"""Marks around a token that are no letters; a token without them scores the same."""
CAPACITY = 100_000
SMOOTHING = 0.5
UNDECIDED = "und"
KEPT_COUNTS = 500_000
"""Distinct (language, token) counts a task holds before it passes them on."""
KEPT_TOKENS = 200_000
"""Scored tokens a worker keeps."""
CHUNK_ROWS, CHUNK_BYTES = 100_000, 6 * 1024**2
"""Texts that share a list of words; a worker holds all their tokens with some arrays as long."""
BUCKET_BYTES = 16 * 1024**2
"""Text whose words share a bucket, on average."""


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of the word between its edges; single characters without them."""
    edged = f"<{word}>" if n > 1 else word
    return [edged[i : i + n] for i in range(len(edged) - n + 1)]


def _counted(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs = [lang for lang, own in counts.items() for _ in own]
    tokens = [token for own in counts.values() for token in own]
    n = [n for own in counts.values() for n in own.values()]
    columns = [pa.array(langs, pa.string()), pa.array(tokens, pa.string()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "token", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """(lang, token, n) of all words of `training` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: dict[str, Counter] = defaultdict(Counter)

        def words() -> pa.RecordBatch:
            out: dict[str, Counter] = defaultdict(Counter)
            for lang, own in raw.items():
                for token, n in own.items():
                    for word in LETTERS.findall(token):
                        out[lang][word] += n
            raw.clear()
            return _counted(out)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw[lang].update(text.as_py().lower().split())
                if sum(map(len, raw.values())) > KEPT_COUNTS:
                    yield words()
        yield words()

    rows = training.where("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(freeing(count), "lang string, token string, n long").groupBy("lang", "token").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, token, n): in how many distinct words of the language each n-gram occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out[lang].update({g for n in GRAMS for g in grams(word, n)})
            if sum(map(len, out.values())) > KEPT_COUNTS:
                yield _counted(out)
                out.clear()
        yield _counted(out)

    counted = words.select("lang", "token").mapInArrow(freeing(count), "lang string, token string, n long")
    return counted.groupBy("lang", "token").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, capacity: int) -> DataFrame:
    """Rows of the most frequent tokens, `capacity` tokens at most: all above one common count.

    The count is found from a histogram in steps of a twentieth, so nothing is sorted."""
    tokens = counts.groupBy("token").agg(F.sum("n").alias("total"))
    step = F.floor(F.log(1.05, F.col("total") + 0.5)).alias("step")
    sizes = {r.step: (r.n, r.least) for r in tokens.groupBy(step).agg(F.count("*").alias("n"), F.min("total").alias("least")).collect()}
    kept, least = 0, None
    for at in sorted(sizes, reverse=True):
        kept += sizes[at][0]
        if kept > capacity:
            break
        least = sizes[at][1]
    if least is None:
        return counts.limit(0)
    return counts.join(tokens.where(F.col("total") >= least).select("token"), "token", "left_semi")


@dataclass
class Model:
    """Log frequencies per token (rows) and language (columns); bounded by the capacity."""

    languages: list[str]
    words: pa.Array
    word_logs: np.ndarray
    grams: pa.Array
    gram_logs: np.ndarray


def _logs(table: pa.Table, totals: dict, languages: list[str], kind) -> tuple[pa.Array, np.ndarray]:
    """Tokens and their smoothed log frequencies; `kind` says which total a token belongs to."""
    tokens = table.column("token").combine_chunks().dictionary_encode()
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    names = tokens.dictionary
    counts = np.zeros((len(names), len(languages)))
    column = {lang: at for at, lang in enumerate(languages)}
    where = np.array([column[lang] for lang in table.column("lang").to_pylist()], int)
    np.add.at(counts, (tokens.indices.to_numpy(), where), table.column("n").to_numpy())
    kinds = [kind(t) for t in names.to_pylist()]
    size = Counter(kinds)
    total = np.array([[totals.get((k, lang), 0) + SMOOTHING * size[k] for lang in languages] for k in kinds])
    return names, np.log((counts + SMOOTHING) / total.reshape(counts.shape)).astype(np.float32)


def learn(training: DataFrame, capacity: int = CAPACITY) -> Model:
    """Model of the rows of `training` (text, lang)."""
    counts = written(word_counts(training), "word-counts")
    word_totals = {("w", r.lang): r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(lang for _, lang in word_totals)
    pieces = written(gram_counts(counts), "gram-counts")
    size = F.length("token")
    # An n-gram's length is that of its token: single characters have no edges.
    gram_totals = {
        (r.k, r.lang): r.n for r in pieces.groupBy("lang", size.alias("k")).agg(F.sum("n").alias("n")).collect()
    }
    words, word_logs = _logs(most_frequent(counts, capacity).toArrow(), word_totals, languages, lambda t: "w")
    names, gram_logs = _logs(most_frequent(pieces, capacity).toArrow(), gram_totals, languages, len)
    return Model(languages, words, word_logs, names, gram_logs)


LISTS = "bucket int, words binary, langs array<string>, counts binary"
SUMMED = f"{LISTS}, sizes array<long>, sums array<array<long>>"


def words_in(token: str) -> list[str]:
    bare = token.strip(MARKS)
    return [bare] if bare.isascii() and bare.isalpha() else LETTERS.findall(bare)


def packed_counts(counts: np.ndarray, pack) -> bytes:
    """64-bit numbers, lowest bytes first, compressed."""
    return pack(counts.ravel().astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked_counts(data: bytes, rows: int, unpack) -> np.ndarray:
    whole = np.ascontiguousarray(np.frombuffer(unpack(data), np.uint8).reshape(8, -1).T)
    return whole.view("<i8").reshape(rows, -1)


def word_lists(words: list[str], bits: int, pack) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(bucket, places, list) of distinct words: those of each bucket in the order of their spelling."""
    raw = [w.encode() for w in words]
    spelled = np.array(sorted(range(len(raw)), key=raw.__getitem__), np.int64)
    bucket = bucket_of(word_hashes(raw), bits)
    order = spelled[np.argsort(bucket[spelled], kind="stable")]
    for a, b in runs(bucket[order]):
        own = order[a:b]
        yield int(bucket[own[0]]), own, pack(b"\n".join([raw[i] for i in own.tolist()]))


def _lists(counts: dict[str, Counter], bits: int, pack) -> pa.RecordBatch:
    """Rows of LISTS of some counts per language."""
    places, langs = WordNumbers(), sorted(counts)
    at = [np.fromiter(map(places.__getitem__, counts[lang]), np.int64, len(counts[lang])) for lang in langs]
    total = np.zeros((len(langs), len(places)), np.int64)
    for row, own, lang in zip(total, at, langs, strict=True):
        row[own] = np.fromiter(counts[lang].values(), np.int64, len(own))
    return _rows_of([(b, blob, total[:, own]) for b, own, blob in word_lists(list(places), bits, pack)], langs, pack)


def _rows_of(found: list[tuple[int, bytes, np.ndarray]], langs: list[str], pack) -> pa.RecordBatch:
    buckets, words, counts = zip(*found, strict=True) if found else ((), (), ())
    columns = [
        pa.array(buckets, pa.int32()),
        pa.array(words, pa.binary()),
        pa.array([langs] * len(found), pa.list_(pa.string())),
        pa.array([packed_counts(c, pack) for c in counts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "words", "langs", "counts"])


def listed_counts(training: DataFrame, bits: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Words of `training` (lang, text) with their counts per language: a row of LISTS per chunk of texts and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, size, raw = packer(), 0, defaultdict(Counter)

        def flush() -> pa.RecordBatch:
            out: dict[str, Counter] = defaultdict(Counter)
            for lang, own in raw.items():
                words = out[lang]
                for token, n in own.items():
                    for word in words_in(token):
                        words[word] += n
            raw.clear()
            return _lists({lang: own for lang, own in out.items() if own}, bits, pack)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = text.as_py()
                raw[lang].update(whole.lower().split())
                size += len(whole)
                if size >= chunk_bytes:
                    yield flush()
                    size = 0
        yield flush()

    rows = training.where("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(freeing(count), LISTS)


def _merged(lists: pa.Table, unpack) -> tuple[list[bytes], list[str], np.ndarray]:
    """Distinct words of some rows of LISTS, their languages, and the sums of their counts."""
    places = WordNumbers()
    langs = sorted({lang for own in lists.column("langs").to_pylist() for lang in own})
    row, found = {lang: at for at, lang in enumerate(langs)}, []
    for words, own, counts in zip(*(lists.column(c).to_pylist() for c in ("words", "langs", "counts")), strict=True):
        names = unpack(words).split(b"\n")
        at = np.fromiter(map(places.__getitem__, names), np.int64, len(names))
        found.append((at, own, unpacked_counts(counts, len(own), unpack)))
    total = np.zeros((len(langs), len(places)), np.int64)
    for at, own, counts in found:
        for lang, values in zip(own, counts, strict=True):
            total[row[lang], at] += values
    return list(places), langs, total


def grams_of(word: str) -> list[str]:
    """All n-grams of the word."""
    edged = f"<{word}>"
    return [*word, *(edged[i : i + n] for n in GRAMS[:-1] for i in range(len(edged) - n + 1))]


def _summed(key: int, lists: pa.Table, lengths: bool, unpack, pack) -> tuple[pa.Table, list[str], list[str], np.ndarray]:
    """The row of SUMMED of a bucket, with its words, languages and counts; sizes and sums are by length if wanted."""
    raw, langs, total = _merged(lists, unpack)
    words = [w.decode() for w in raw]
    order = np.array(sorted(range(len(raw)), key=raw.__getitem__), np.int64)
    k = np.fromiter(map(len, words), np.int64, len(words)) if lengths else np.zeros(len(words), np.int64)
    width = len(GRAMS) + 1
    sums = [[int(own[k == n].sum()) for own in total] for n in range(width)]
    row = _rows_of([(key, pack(b"\n".join([raw[i] for i in order.tolist()])), total[:, order])], langs, pack)
    columns = [pa.array([np.bincount(k, minlength=width).tolist()], pa.list_(pa.int64())), pa.array([sums], pa.list_(pa.list_(pa.int64())))]
    return pa.table([*row.columns, *columns], [*row.schema.names, "sizes", "sums"]), words, langs, total


def merged_words(lists: DataFrame, gram_bits: int) -> DataFrame:
    """One row of SUMMED per bucket of words, `gram` false; and rows of its n-grams, `gram` true, which count in how
    many distinct words of a language an n-gram occurs."""

    def merge(key: tuple, own: pa.Table) -> pa.Table:
        pack, unpack = packer(), unpacker()
        table, words, langs, total = _summed(key[0].as_py(), own, False, unpack, pack)
        grams: dict[str, Counter] = {}
        for lang, counts in zip(langs, total, strict=True):
            found = grams[lang] = Counter()
            for at in np.flatnonzero(counts).tolist():
                found.update({*grams_of(words[at])})
        rows = _lists(grams, gram_bits, pack)
        rest = [pa.nulls(len(rows), table.schema.field(c).type) for c in ("sizes", "sums")]
        both = pa.concat_tables([table, pa.table([*rows.columns, *rest], table.schema.names)])
        return both.append_column("gram", pa.array([False] + [True] * len(rows)))

    return lists.groupBy("bucket").applyInArrow(freeing(merge), f"{SUMMED}, gram boolean")


def merged_grams(lists: DataFrame) -> DataFrame:
    """One row of SUMMED per bucket of n-grams."""

    def merge(key: tuple, own: pa.Table) -> pa.Table:
        return _summed(key[0].as_py(), own, True, unpacker(), packer())[0]

    return lists.groupBy("bucket").applyInArrow(freeing(merge), SUMMED)


def bucket_bits(texts: int) -> int:
    return max(0, (texts // BUCKET_BYTES).bit_length())


@dataclass
class Tables:
    """Counts of all words and n-grams, one row of SUMMED per bucket.

    `totals` and `sizes` hold all counts per (length, language) and the distinct tokens per length; words
    have length 0. The first `bits` and `gram_bits` bits of a token's hash are its bucket."""

    languages: list[str]
    words: DataFrame
    grams: DataFrame
    totals: dict[tuple[int, str], int]
    sizes: dict[int, int]
    bits: int
    gram_bits: int


def count_tables(training: DataFrame) -> Tables:
    """Whole model of the rows of `training` (text, lang)."""
    bits = bucket_bits(text_bytes(training))
    gram_bits = (bits + 1) // 2
    both = stored(merged_words(listed_counts(training, bits), gram_bits), "word-lists")
    words = both.where("not gram").drop("gram")
    grams = stored(merged_grams(both.where("gram").select("bucket", "words", "langs", "counts")), "gram-lists")
    totals, sizes = {}, {}
    for table, lengths in ((words, {0}), (grams, {*GRAMS})):
        by_length = table.select("langs", F.posexplode("sums").alias("k", "own"))
        by_lang = by_length.select("k", F.explode(F.arrays_zip("langs", "own")).alias("x"))
        for r in by_lang.groupBy("k", F.col("x.langs").alias("lang")).agg(F.sum("x.own").alias("n")).collect():
            if r.k in lengths and r.n:
                totals[r.k, r.lang] = r.n
        for r in table.select(F.posexplode("sizes").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
            if r.k in lengths:
                sizes[r.k] = r.n
    return Tables(sorted(lang for k, lang in totals if k == 0), words, grams, totals, sizes, bits, gram_bits)


def dealt_again(table: DataFrame, bits: int) -> DataFrame:
    """Rows of LISTS of more buckets than `table` has."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = packer(), unpacker()
        for batch in batches:
            for row in range(batch.num_rows):
                own = pa.Table.from_batches([batch.slice(row, 1)])
                raw, langs, total = _merged(own, unpack)
                yield _rows_of([(b, blob, total[:, at]) for b, at, blob in word_lists([w.decode() for w in raw], bits, pack)], langs, pack)

    return table.select("bucket", "words", "langs", "counts").mapInArrow(freeing(deal), LISTS)


def parsed(rows: DataFrame, chunk_bytes: int, bits: int, keep_text: bool) -> DataFrame:
    """Documents (rest, text) as sorted word numbers.

    Per document (chunk, rest, at, frame), the frame its compressed text if wanted; per chunk and bucket the distinct
    `words`; and per chunk the `stream` of all documents' word numbers, by falling frequency, with how many each
    document has in `sizes` and how often each word comes in `often`, in the order of the buckets' lists."""
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("rest", rows.schema["rest"].dataType),
            T.StructField("at", T.IntegerType()),
            T.StructField("frame", T.BinaryType()),
            T.StructField("bucket", T.IntegerType()),
            *(T.StructField(c, T.BinaryType()) for c in ("words", "stream", "sizes", "often")),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, part, serial, types = packer(), TaskContext.get().partitionId(), 0, None
        numbers, streams, size = WordNumbers(), [], 0

        def rows_of(n: int, **columns) -> pa.RecordBatch:
            chunk = pa.array(np.full(n, part << 32 | serial, np.int64))
            arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in types]
            return pa.RecordBatch.from_arrays([chunk, *arrays], ["chunk", *(f.name for f in types)])

        def flush() -> Iterator[pa.RecordBatch]:
            words, own, have = WordNumbers(), [], []
            for token in numbers:
                found = words_in(token)
                have.append(len(found))
                own.extend(map(words.__getitem__, found))
            own, have = np.array(own, np.int64), np.array(have, np.int64)
            # Each token becomes its words.
            token = np.concatenate(streams)
            times, doc = have[token], np.repeat(np.arange(len(streams)), list(map(len, streams)))
            first = np.cumsum(have) - have
            at = np.arange(int(times.sum())) + np.repeat(first[token] - (np.cumsum(times) - times), times)
            word, doc = own[at], np.repeat(doc, times)
            often = np.bincount(word, minlength=len(words))
            place, count = [], 0
            for bucket, listed, blob in word_lists(list(words), bits, pack):
                yield rows_of(1, bucket=[bucket], words=[blob])
                place.append(listed)
            place = np.concatenate([np.zeros(0, np.int64), *place])
            number = np.empty(len(words), np.int64)
            number[place[np.argsort(-often[place], kind="stable")]] = np.arange(len(words))
            width = max(1, len(words))
            key = np.sort(doc * width + number[word]) if len(word) else np.zeros(0, np.int64)
            doc, key = key // width, key % width
            step = np.diff(key, prepend=0)
            new = np.flatnonzero(np.diff(doc, prepend=-1))
            step[new] = key[new]
            sizes = np.bincount(doc, minlength=len(streams))
            blobs = {"stream": step, "sizes": sizes, "often": often[place]}
            yield rows_of(1, **{name: [squeezed(values, pack)] for name, values in blobs.items()})

        for batch in batches:
            if types is None:
                kinds = {"at": pa.int32(), "frame": pa.binary(), "bucket": pa.int32()}
                blobs = ("words", "stream", "sizes", "often")
                types = [batch.schema.field("rest"), *(pa.field(*k) for k in kinds.items()), *(pa.field(b, pa.binary()) for b in blobs)]
            rest, texts = batch.column("rest"), batch.column("text")
            begin, frames = 0, []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                tokens = text.lower().split()
                streams.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)))
                frames.append(pack(text.encode()) if keep_text else None)
                size += len(text)
                full = size >= chunk_bytes or len(streams) >= CHUNK_ROWS
                if full or i + 1 == batch.num_rows:
                    places = np.arange(len(streams) - len(frames), len(streams))
                    yield rows_of(len(frames), rest=rest[begin : i + 1], at=places, frame=frames)
                    begin, frames = i + 1, []
                if full:
                    yield from flush()
                    serial, numbers, streams, size = serial + 1, WordNumbers(), [], 0
        if streams:
            yield from flush()

    return rows.mapInArrow(freeing(parse), schema)


ASKED = "chunk long, bucket int, counts binary, places binary, of int, words binary"


def asked_words(lists: DataFrame, tables: Tables, words: DataFrame) -> DataFrame:
    """Per chunk and bucket the `counts` of the chunk's words per language, and the `places` of unknown ones, without
    counts, among those of the bucket; per bucket its unknown `words` (`of` is null) and per bucket of n-grams `of` the
    n-grams of these."""
    row = {lang: at for at, lang in enumerate(tables.languages)}
    gram_bits = tables.gram_bits

    def ask(key: tuple, own: pa.Table, known: pa.Table) -> pa.Table:
        pack, unpack = packer(), unpacker()
        if not len(own):
            return pa.table([pa.nulls(0, k) for k in ASKED_TYPES.values()], list(ASKED_TYPES))
        names, langs, total = _merged(known, unpack)
        at = {name: i for i, name in enumerate(names)}
        counts = np.zeros((len(row), len(names) + 1), np.int64)
        counts[[row[lang] for lang in langs], : len(names)] = total
        new, bucket, out = WordNumbers(), own.column("bucket")[0].as_py(), []
        for chunk, blob in zip(own.column("chunk").to_pylist(), own.column("words").to_pylist(), strict=True):
            found = unpack(blob).split(b"\n")
            place = np.fromiter((at.get(w, -1) for w in found), np.int64, len(found))
            unknown = [new[found[i]] for i in np.flatnonzero(place < 0).tolist()]
            out.append((chunk, bucket, packed_counts(counts[:, place], pack), squeezed(np.array(unknown, np.int64), pack), None, None))
        if new:
            out.append((None, bucket, None, None, None, pack(b"\n".join(new))))
            pieces = {g for w in new for g in grams_of(w.decode())}
            out += [(None, bucket, None, None, of, blob) for of, _, blob in word_lists(list(pieces), gram_bits, pack)]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), ASKED_TYPES.values(), strict=True)]
        return pa.table(columns, list(ASKED_TYPES))

    return lists.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(freeing(ask), ASKED)


ASKED_TYPES = {
    "chunk": pa.int64(),
    "bucket": pa.int32(),
    "counts": pa.binary(),
    "places": pa.binary(),
    "of": pa.int32(),
    "words": pa.binary(),
}


def backed_off(asked: DataFrame, tables: Tables) -> DataFrame:
    """(chunk, bucket, logs): the log frequencies of each chunk's unknown words, in the order of its list."""
    row = {lang: at for at, lang in enumerate(tables.languages)}
    total = {
        k: np.array([tables.totals.get((k, lang), 0) + SMOOTHING * n for lang in tables.languages])
        for k, n in tables.sizes.items()
    }

    def look_up(key: tuple, own: pa.Table, known: pa.Table) -> pa.Table:
        pack, unpack, out = packer(), unpacker(), []
        names, langs, counts = _merged(known, unpack)
        at = {name: i for i, name in enumerate(names)}
        for bucket, blob in zip(own.column("bucket").to_pylist(), own.column("words").to_pylist(), strict=True):
            found = [w for w in unpack(blob).split(b"\n") if w in at]
            if found:
                own_counts = np.zeros((len(row), len(found)), np.int64)
                own_counts[[row[lang] for lang in langs]] = counts[:, [at[w] for w in found]]
                out.append((bucket, pack(b"\n".join(found)), packed_counts(own_counts, pack)))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "grams", "counts"])

    def score(key: tuple, own: pa.Table, known: pa.Table) -> pa.Table:
        pack, unpack = packer(), unpacker()
        is_chunk = own.column("chunk").is_valid()
        chunks, new = own.filter(is_chunk), own.filter(pc.invert(is_chunk))
        if not len(new):
            return pa.table([pa.nulls(0, k) for k in (pa.int64(), pa.int32(), pa.binary())], ["chunk", "bucket", "logs"])
        at, logs = {}, [np.zeros((1, len(row)))]
        for blob, counts in zip(known.column("grams").to_pylist(), known.column("counts").to_pylist(), strict=True):
            names = unpack(blob).decode().split("\n")
            at.update(zip(names, range(len(at), len(at) + len(names)), strict=True))
            of = np.array([total[len(g)] for g in names])
            logs.append(np.log((unpacked_counts(counts, len(row), unpack).T + SMOOTHING) / of))
        logs, found, size = np.concatenate(logs[1:] + logs[:1]), [], []
        for word in unpack(new.column("words")[0].as_py()).decode().split("\n"):
            for n in GRAMS:
                own_grams = [at[g] for g in grams(word, n) if g in at]
                if own_grams:
                    break
            # A word of which nothing is known says nothing: the last row is zero.
            own_grams = own_grams or [len(logs) - 1]
            found += own_grams
            size.append(len(own_grams))
        size = np.array(size)
        mean = np.add.reduceat(logs[found], np.cumsum(size) - size) / size[:, None]
        out = [pack(mean[unsqueezed(p, unpack)].astype(np.float32).tobytes()) for p in chunks.column("places").to_pylist()]
        return pa.table([chunks.column("chunk"), chunks.column("bucket"), pa.array(out, pa.binary())], ["chunk", "bucket", "logs"])

    pieces = asked.where("of is not null").select("of", "bucket", "words")
    grams_table = tables.grams.select(F.col("bucket").alias("of"), "words", "langs", "counts")
    known = pieces.groupBy("of").cogroup(grams_table.groupBy("of"))
    known = known.applyInArrow(freeing(look_up), "bucket int, grams binary, counts binary")
    new = asked.where("of is null").where("words is not null or places is not null").select("chunk", "bucket", "places", "words")
    return new.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(freeing(score), "chunk long, bucket int, logs binary")


REPLIES = "chunk long, bucket int, counts binary, logs binary"


def replies(lists: DataFrame, tables: Tables, bits: int) -> DataFrame:
    """(chunk, bucket, counts, logs): the counts of each chunk's words, and the log frequencies of its unknown ones."""
    if not tables.languages:
        return lists.sparkSession.createDataFrame([], REPLIES)
    known = tables.words if bits == tables.bits else dealt_again(tables.words, bits)
    asked = stored(asked_words(lists, tables, known.select("bucket", "words", "langs", "counts")), "asked-words")
    none = F.lit(None).cast("binary")
    counts = asked.where("chunk is not null").select("chunk", "bucket", "counts", none.alias("logs"))
    return counts.union(backed_off(asked, tables).select("chunk", "bucket", none.alias("counts"), "logs"))


def judged(docs: DataFrame, tables: Tables, text: str = "text", chunk_bytes: int = CHUNK_BYTES, keep_text: bool = True) -> DataFrame:
    """(row, lang_pred, score) of every row of `docs`; `row` holds its columns, on request without the text."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Texts are kept compressed; the other columns are kept beside them.
    none = F.col(f"row.`{text}`").isNull()
    split = rows.select(F.col("row").withField("__none", none).dropFields(text).alias("rest"), F.col(f"row.`{text}`").alias("text"))
    bits = max(tables.bits, bucket_bits(text_bytes(split)))
    parts = stored(parsed(split, chunk_bytes, bits, keep_text), "parsed-texts")
    back = replies(parts.where("words is not null").select("chunk", "bucket", "words"), tables, bits)
    languages = tables.languages
    total = np.array([tables.totals[0, lang] + SMOOTHING * tables.sizes[0] for lang in languages])

    def judge(own: pa.Table, found: pa.Table) -> pa.Table:
        unpack = unpacker()
        rows = own.filter(own.column("at").is_valid()).sort_by("at")
        chunk = own.filter(own.column("stream").is_valid())
        step, sizes, often = (unsqueezed(chunk.column(c)[0].as_py(), unpack).astype(np.int64) for c in ("stream", "sizes", "often"))
        lang_pred, score = np.full(len(rows), UNDECIDED, object), np.zeros(len(rows))
        if len(step) and languages:
            found = found.sort_by("bucket")
            seen = [unpacked_counts(c, len(languages), unpack) for c in found.column("counts").drop_null().to_pylist()]
            values = np.log((np.concatenate(seen, axis=1).T + SMOOTHING) / total).astype(np.float32)
            unknown = ~np.concatenate([c.any(axis=0) for c in seen])
            if unknown.any():
                blobs = found.column("logs").drop_null().to_pylist()
                values[unknown] = np.concatenate([np.frombuffer(unpack(b), np.float32) for b in blobs]).reshape(-1, len(languages))
            values = values[np.argsort(-often, kind="stable")]
            first = np.flatnonzero(sizes)
            begin = (np.cumsum(sizes) - sizes)[first]
            number = np.cumsum(step)
            number -= np.repeat(number[begin] - step[begin], sizes[first])
            doc = np.repeat(np.arange(len(first)), sizes[first])
            sums = np.stack([np.bincount(doc, own_logs[number], len(first)) for own_logs in values.T.astype(np.float64)], axis=1)
            best = sums.argmax(axis=1)
            lang_pred[first] = np.array(languages, object)[best]
            score[first] = 1 / np.exp(sums - sums.max(axis=1)[:, None]).sum(axis=1)
        columns = [pa.array(lang_pred, pa.string()), pa.array(score, pa.float64())]
        return pa.table([rows.column("rest"), rows.column("frame"), *columns], ["rest", "frame", "lang_pred", "score"])

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([parts.schema["rest"], parts.schema["frame"], *fields])
    own = parts.where("stream is not null or at is not null").select("chunk", "rest", "at", "frame", "stream", "sizes", "often")
    found = own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(freeing(judge), schema)
    whole = F.when(~F.col("rest.__none"), uncompressed(F.col("frame")))
    columns = [whole.alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if keep_text or c != text]
    return found.select(F.struct(*columns).alias("row"), "lang_pred", "score")


class Scorer(dict):
    """Row of each token's scores in `scores`, filled as tokens come."""

    def __init__(self, model: Model):
        super().__init__()
        self.languages = model.languages
        self.words = dict(zip(model.words.to_pylist(), model.word_logs.tolist(), strict=True))
        self.grams = dict(zip(model.grams.to_pylist(), model.gram_logs.tolist(), strict=True))
        self.silent = [0.0] * len(model.languages)
        self.scores = np.zeros((1024, len(model.languages)), np.float64)
        self.filled = 0

    def word(self, word: str) -> list[float]:
        known = self.words.get(word)
        if known is not None:
            return known
        for n in GRAMS:
            found = [self.grams[g] for g in grams(word, n) if g in self.grams]
            if found:
                return [sum(c) / len(found) for c in zip(*found, strict=True)]
        return self.silent

    def __missing__(self, token: str) -> int:
        bare = token.strip(MARKS)
        if bare != token:
            at = self[token] = self[bare]
            return at
        at = self.filled
        if at == len(self.scores):
            self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
        words = [token] if token.isascii() and token.isalpha() else LETTERS.findall(token)
        if words:
            self.scores[at] = self.word(words[0]) if len(words) == 1 else np.sum([self.word(w) for w in words], axis=0)
        else:
            self.scores[at] = self.silent
        self.filled += 1
        self[token] = at
        return at

    def best(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not LETTERS.search(text):
            return UNDECIDED, 0.0
        if len(self) > KEPT_TOKENS:
            self.clear()
            self.filled = 0
        tokens = text.lower().split()
        rows = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        total = self.scores[rows].sum(axis=0)
        at = int(total.argmax())
        return self.languages[at], float(1 / np.exp(total - total[at]).sum())


def language_of(text: Column, model: Model) -> Column:
    """struct(lang_pred, score) of a text column."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # One store per task: it is bounded, and workers that go on to other work do not keep it.
        own = Scorer(model)
        for texts in batches:
            found = [own.best(t.as_py()) for t in texts]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

    return predict(text)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """True for rows that are not learned from; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, model: Model | Tables, text: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with `lang_pred` and `score`, on request without the text."""
    if isinstance(model, Tables):
        found = judged(docs, model, text, keep_text=keep_text)
        kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != text)]
        return found.select(*kept, "lang_pred", "score")
    found = docs.withColumn("__found", language_of(F.col(text), model))
    found = found.withColumns({"lang_pred": F.col("__found.lang_pred"), "score": F.col("__found.score")}).drop("__found")
    return found if keep_text else found.drop(text)
