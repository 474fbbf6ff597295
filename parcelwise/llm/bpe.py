"""Byte-level BPE: whole texts to token ids with a local rank file, and ids back to bytes.

Texts are encoded by the tiktoken library. Long ones are first cut at places that every match of
the pre-splitting pattern respects: between a letter or digit and a blank or newline, or between a
letter and a digit. No alternative of the pattern spans such a place and none looks back, so the
ids of the parts, joined, are the ids of the text. A text without such a place is encoded whole.

Defined cases: a null text counts as empty, an empty text has no ids and decodes to no bytes; null
ids decode to no bytes. Rows are independent, so repeated rows, ties and extra columns (also ones
named like the results, which are replaced) change nothing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_CHARS = 1 << 16
"""Texts above this length are cut into parts of about this length."""

SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


def safe_parts(text: str, part_chars: int = PART_CHARS) -> Iterator[str]:
    """The text in parts, cut at safe places only."""
    start = 0
    while len(text) - start > part_chars:
        cut = SAFE.search(text, start + part_chars)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str):
    """The encoder of a rank file, loaded once per Python worker."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _offsets(sizes: list[int]) -> pa.Array:
    total, ends = 0, [0]
    for n in sizes:
        total += n
        ends.append(total)
    return pa.array(ends, pa.int32())


def encode(text: Column, ranks_path: str, pattern: str, part_chars: int = PART_CHARS) -> Column:
    """Token ids of a text column, as an array of int."""

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        encoder = encoding(ranks_path, pattern)
        for texts in batches:
            sizes, parts = [], [np.zeros(0, np.uint32)]
            for text in texts:
                n = 0
                for part in safe_parts(text.as_py() or "", part_chars):
                    ids = encoder.encode_to_numpy(part, disallowed_special=())
                    parts.append(ids)
                    n += len(ids)
                sizes.append(n)
            yield pa.ListArray.from_arrays(_offsets(sizes), pa.array(np.concatenate(parts).astype(np.int32)))

    return ids_of(text)


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """Raw bytes of a column of id arrays; a token may hold part of a character."""

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoding(ranks_path, pattern)
        for rows in batches:
            yield pa.array(
                [encoder.decode_bytes(row.values.to_numpy().tolist()) if row.is_valid else b"" for row in rows],
                pa.binary(),
            )

    return bytes_of(ids)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """`docs` with `ids`, the token ids of the text."""
    return docs.withColumn("ids", encode(F.col(text), ranks_path, pattern))


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`encoded` with `decoded`, the bytes of its column `ids`."""
    return encoded.withColumn("decoded", decode(F.col("ids"), ranks_path, pattern))
