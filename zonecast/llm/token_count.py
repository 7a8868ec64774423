"""Token counts (operator 3).

Method: an Arrow function encodes texts in batches and returns lengths only;
ids never leave the worker. The texts of an Arrow batch are cut into segments
at safe boundaries where they are long, the segments are put into batches of
about equal UTF-8 bytes, each batch is encoded by one call of the encoder's
batch form, and the lengths are added up per text.

A boundary is safe before a single space between two characters that are not
white space: each pre-token either starts at such a space or ends before it,
so the counts of the segments add up to the count of the text. A run without
such a place stays whole.

Cases: null and empty texts count 0 tokens and 0 bytes; special-token strings
count as the library's default has them; output columns replace input columns
of the same name, everything else is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import bytebpe

SEGMENT_CHARS = 1 << 15   # longer texts are cut into segments of about this size
BATCH_BYTES = 1 << 18     # of one encoder batch

_safe = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, size: int = SEGMENT_CHARS) -> list[str]:
    """``text`` cut at safe boundaries into parts of ``size`` characters or a
    little more; joined they are the text."""
    out, start = [], 0
    while len(text) - start > size and (m := _safe.search(text, start + size)):
        out.append(text[start:m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def _batches(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(row of each segment, segments) in batches of about equal bytes."""
    rows, parts, held = [], [], 0
    for i, t in enumerate(texts):
        for s in segments(t) if t else ():
            rows.append(i)
            parts.append(s)
            held += len(s.encode())
            if held >= BATCH_BYTES:
                yield rows, parts
                rows, parts, held = [], [], 0
    yield rows, parts


def count_tokens(df: DataFrame, text_col: str = "text", out_col: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Add ``out_col`` long: the number of tokens of the whole text under the
    tokenizers file ``path`` (unset: each executor's installed file)."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = bytebpe.load(path)
        for texts in batches:
            total = np.zeros(len(texts), np.int64)
            for rows, parts in _batches(texts.to_pylist()):
                np.add.at(total, rows, bpe.counts(parts))
            yield pa.array(total)

    return df.withColumn(out_col, count(F.col(text_col)))


def with_budget(df: DataFrame, limit: int = 512, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Add n_bytes (UTF-8 length), n_tokens and over_limit (n_tokens > limit)."""
    out = count_tokens(df, text_col, "n_tokens", path)
    return out.withColumns({"n_bytes": F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long"),
                            "over_limit": F.col("n_tokens") > limit})
