"""Token counts per document: each distinct pre-token is encoded once, and counts are joined back.

A pre-tokenizer's pieces are encoded independently of each other, so a document's tokens are the sum,
over its distinct pre-tokens, of how often they come times how many pieces they give.

1. Documents are read once, in chunks of about `chunk_bytes` of text. A chunk gives its vocabulary, one
   row, and for each document the numbers of its distinct pre-tokens in that vocabulary with their
   frequencies. No text and no id is written.
2. The vocabularies meet by pre-token. Each distinct one is encoded once, and only its length is kept.
3. Lengths go back to their chunks, where they are summed times the frequencies.

What is shuffled are vocabularies (one row per chunk and pre-token, so the most common word of all
documents comes once per chunk) and frequency vectors. No table is broadcast.

Texts are first split at the special strings of the tokenizer, which count as one token each, then by
the pre-tokenizer's pattern. The pattern is run by the regex module on characters that it and the
tokenizer class alike; a text with any other character is split by the tokenizer's own pre-tokenizer.
Long texts are split in parts at places no match spans.

Defined cases: a null text is empty, and an empty text has 0 bytes and 0 tokens; null and repeated ids
and rows are counted row by row; an empty table gives no rows. Extra columns are not carried.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.bpe import safe_parts
from parcelwise.llm.tables import stored

CHUNK_BYTES = 48 * 1024**2
UNLIKE = regex.compile(r"[^\u0000-\u0557\u2000-\u2070\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5]")
"""Characters outside ranges in which both pattern engines know the same letters, digits and blanks."""


class Splitter:
    """Pre-tokens of texts, as the tokenizer of a file makes them, and the special strings on the way."""

    def __init__(self, tokenizer_path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as file:
            self.special = {t["content"] for t in json.load(file)["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.pieces = regex.compile(pattern).findall

    def add(self, text: str, counts: Counter) -> None:
        """Counts the pre-tokens and special strings of a text."""
        start = 0
        for mark in self.marks.finditer(text):
            self._plain(text[start : mark.start()], counts)
            counts[mark.group()] += 1
            start = mark.end()
        self._plain(text[start:] if start else text, counts)

    def _plain(self, text: str, counts: Counter) -> None:
        if not text.isascii() and UNLIKE.search(text):
            counts.update(text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))
            return
        for part in safe_parts(text):
            counts.update(self.pieces(part))

    def lengths(self, tokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]


@lru_cache(maxsize=2)
def splitter(tokenizer_path: str, pattern: str) -> Splitter:
    return Splitter(tokenizer_path, pattern)


SCHEMA = "chunk long, doc_id long, n_bytes long, n int, words binary, times binary, vocabulary array<string>"
ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n", pa.int32()),
        ("words", pa.binary()),
        ("times", pa.binary()),
        ("vocabulary", pa.list_(pa.string())),
    ]
)


def _narrow(values: np.ndarray) -> bytes:
    """Little-endian numbers, plane by plane: all lowest bytes first, without planes that are all zero."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    used = 4
    while used > 1 and not planes[used - 1].any():
        used -= 1
    return planes[:used].tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, n) if n else np.zeros((0, 0), np.uint8)
    out = np.zeros(n, np.int64)
    for at, plane in enumerate(planes):
        out |= plane.astype(np.int64) << (8 * at)
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def frequencies(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document (chunk, doc_id, n_bytes, n, words, times), and one row per chunk with its `vocabulary`.

    `words` are the numbers of the document's `n` distinct pre-tokens in the vocabulary, `times` their
    frequencies. A number of a common pre-token is small, since vocabularies are in order of arrival."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(tokenizer_path, pattern)
        part, n, size = TaskContext.get().partitionId(), 0, 0
        number: dict[str, int] = {}

        def chunk() -> int:
            return (part << 32) | n

        def vocabulary() -> pa.RecordBatch:
            return _batch([(chunk(), None, None, None, None, None, list(number))])

        for batch in batches:
            out = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                value = value.as_py() or ""
                counts: Counter = Counter()
                own.add(value, counts)
                words = np.fromiter((number.setdefault(w, len(number)) for w in counts), np.int64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                order = words.argsort()
                n_bytes = len(value) if value.isascii() else len(value.encode())
                out.append((chunk(), name, n_bytes, len(counts), _narrow(words[order]), _narrow(times[order]), None))
                size += n_bytes
                if size >= chunk_bytes:
                    yield _batch(out)
                    yield vocabulary()
                    out, n, size, number = [], n + 1, 0, {}
            if out:
                yield _batch(out)
        if number:
            yield vocabulary()

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(split, SCHEMA)


def with_lengths(words: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """(of, number, n): how many pieces the pre-token of each row of `words` (of, number, token) gives.

    Rows are sorted by pre-token, so that each is encoded once, where its rows meet."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(tokenizer_path, pattern)
        last: tuple[str | None, int] = None, 0
        for batch in batches:
            coded = batch.column("token").dictionary_encode()
            tokens = coded.dictionary.to_pylist()
            if not tokens:
                continue
            known = tokens[0] == last[0]
            n = ([last[1]] if known else []) + own.lengths(tokens[known:])
            last = tokens[-1], n[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("of"), batch.column("number"), pa.array(n, pa.int32()).take(coded.indices)], ["of", "number", "n"]
            )

    met = words.select("of", "number", "token").repartition("token").sortWithinPartitions("token")
    return met.mapInArrow(count, "of long, number int, n int")


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    limit: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row of `docs`."""
    parts = stored(frequencies(docs, tokenizer_path, pattern, doc_id, text, chunk_bytes), "frequencies")
    vocabularies = parts.where("vocabulary is not null")
    words = vocabularies.select(F.col("chunk").alias("of"), F.posexplode("vocabulary").alias("number", "token"))
    back = with_lengths(words, tokenizer_path, pattern)
    rows = parts.where("vocabulary is null").drop("vocabulary")

    def total(own: pa.Table, known: pa.Table) -> pa.Table:
        size = np.zeros(len(known), np.int64)
        size[known.column("number").to_numpy()] = known.column("n").to_numpy()
        columns = (own.column(c).to_pylist() for c in ("n", "words", "times"))
        sums = [int((size[_wide(words, n)] * _wide(times, n)).sum()) for n, words, times in zip(*columns, strict=True)]
        columns = [own.column("doc_id"), own.column("n_bytes"), pa.array(sums, pa.int64())]
        return pa.table(columns, ["doc_id", "n_bytes", "n_tokens"])

    counted = rows.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(
        total, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
