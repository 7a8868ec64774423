"""Language identification by prediction by partial matching (operator 9).

Method: for each language a byte context tree of orders 0 to ``ORDER`` is
filled from a bounded sample of labelled texts and then frozen. The code
length of a byte is exact under these statistics: the longest context of the
tree is tried first (escape method C: n/(N+d) for a byte seen n times, d/(N+d)
for the escape, with N bytes and d different ones seen), each escape goes to
the context one byte shorter with the bytes already tried excluded, and below
order 0 the bytes left are equally likely. A text gets the language that codes
it in the fewest bits; the score is the posterior of that language under equal
priors.

Text is lower-cased, ASCII characters other than letters count as spaces, and
each text is coded as if ``ORDER`` spaces stood before it.

Code lengths of the (ORDER + 1)-grams that occur are kept in a bounded direct-
mapped table per worker; a gram that is not there is worked out anew, so the
table bounds memory and changes no result.

Cases: null texts and texts without a letter are ``und`` with score 0; equal
code lengths go to the smaller language name; without any labelled text all
rows are ``und``. Output columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import hashed, sample_texts, work_name

ORDER = 4              # bytes of the longest context
SAMPLE_DOCS = 400      # labelled texts of a language that are learnt, at most
SAMPLE_BYTES = 1 << 20 # and bytes of a language, at most
SLOTS = 1 << 19        # of the table of code lengths
BLOCK = 1 << 17         # bytes coded together
UNKNOWN = "und"

_letters = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def prepare(text: str) -> bytes:
    return text.lower().encode().translate(_letters)


def _grams(data: bytes) -> np.ndarray:
    """Each byte of a prepared text with the ORDER bytes before it, uint64."""
    raw = np.frombuffer(b" " * ORDER + data, np.uint8).astype(np.uint64)
    n = len(data)
    out = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        out = out << np.uint64(8) | raw[k:k + n]
    return out


class _Level:
    """Counts of one context order: the bytes seen behind each context."""

    def __init__(self, grams: np.ndarray, order: int):
        mask = np.uint64((1 << 8 * (order + 1)) - 1)
        self.mask, self.order = mask, order
        self.gram, self.n = np.unique(grams & mask, return_counts=True)
        self.context, start = np.unique(self.gram >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(self.n, start) if len(start) else np.zeros(0, np.int64)
        self.different = np.diff([*start, len(self.gram)])

    def seen(self, grams: np.ndarray) -> np.ndarray:
        """How often the last byte came behind its context."""
        key = grams & self.mask
        at = np.minimum(np.searchsorted(self.gram, key), len(self.gram) - 1)
        return np.where(self.gram[at] == key, self.n[at], 0)

    def at_context(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, known) of contexts."""
        at = np.minimum(np.searchsorted(self.context, contexts), len(self.context) - 1)
        return at, self.context[at] == contexts


class ContextTree:
    """The frozen statistics of one language."""

    def __init__(self, texts: list[bytes]):
        grams = np.concatenate([_grams(t) for t in texts])
        self.levels = [_Level(grams, k) for k in range(ORDER + 1)]
        # For a context of order k + 1, what excluding its bytes takes away
        # from the context one byte shorter.
        self.excluded = [np.zeros(0)]
        for low, high in zip(self.levels, self.levels[1:]):
            of = np.repeat(np.arange(len(high.context)), high.different)
            self.excluded.append(np.bincount(of, weights=low.seen(high.gram), minlength=len(high.context)))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram behind the others."""
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))          # grams still to be coded
        less_n = np.zeros(len(grams))          # excluded: counts,
        less_d = np.zeros(len(grams))          # and different bytes
        for level, taken in zip(reversed(self.levels), reversed(self.excluded)):
            g = grams[open_]
            at, known = level.at_context((g & level.mask) >> np.uint64(8))
            n = np.where(known, level.total[at] - less_n[open_], 0)
            d = np.where(known, level.different[at] - less_d[open_], 0)
            count = level.seen(g)
            hit = known & (count > 0)
            out[open_[hit]] += np.log2((n[hit] + d[hit]) / count[hit])
            miss = known & ~hit & (d > 0)
            out[open_[miss]] += np.log2((n[miss] + d[miss]) / d[miss])
            if level.order:
                less_n[open_] = np.where(known, taken[at], 0)
                less_d[open_] = np.where(known, level.different[at], 0)
            else:
                out[open_[~hit]] += np.log2(256 - len(level.gram))
            open_ = open_[~hit]
        return out


class Identifier:
    """The trees of all languages with a table of code lengths."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.names = sorted(samples)
        self.trees = [ContextTree(samples[n]) for n in self.names]
        self.key = np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.length = np.zeros((SLOTS, len(self.names)), np.float32)

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """(grams, languages) bits."""
        slot = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)
        out = self.length[slot]
        if len(miss := np.flatnonzero(self.key[slot] != grams)):
            new, back = np.unique(grams[miss], return_inverse=True)
            bits = np.stack([t.bits(new) for t in self.trees], axis=1).astype(np.float32)
            out[miss] = bits[back]
            self.key[slot[miss]] = grams[miss]
            # slots that several new grams share hold the one written last
            self.length[slot[miss]] = bits[back]
        return out

    def total_bits(self, data: list[bytes]) -> np.ndarray:
        """(texts, languages) bits of prepared texts."""
        total = np.zeros((len(data), len(self.names)))
        ends = np.cumsum([len(d) for d in data])
        # one run of bytes, each text behind ORDER spaces
        grams = _grams((b" " * ORDER).join(data)) if data else np.zeros(0, np.uint64)
        starts = ends - [len(d) for d in data] + ORDER * np.arange(len(data))
        for a in range(0, len(grams), BLOCK):
            bits = self.code_lengths(grams[a:a + BLOCK])
            first, last = np.searchsorted(ends + ORDER * np.arange(len(data)), [a, a + BLOCK], side="right")
            for t in range(first, min(last + 1, len(data))):
                b, e = max(starts[t] - a, 0), min(starts[t] + len(data[t]) - a, BLOCK)
                if b < e:
                    total[t] += bits[b:e].sum(axis=0, dtype=np.float64)
        return total

    def identify(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, posterior, bits a byte) of each text."""
        rows = [i for i, t in enumerate(texts) if t and self.names and any(map(str.isalpha, t))]
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        data = [prepare(texts[i]) for i in rows]
        for i, d, bits in zip(rows, data, self.total_bits(data)):
            best = int(bits.argmin())
            score = 1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()
            out[i] = self.names[best], float(score), float(bits[best] / len(d))
        return out


def _by_size(texts: pa.Array, size: int = 1 << 21) -> Iterator[list[str | None]]:
    """The texts of an Arrow batch in lists of about ``size`` characters."""
    part, held = [], 0
    for t in texts.to_pylist():
        part.append(t)
        held += len(t or "")
        if held >= size:
            yield part
            part, held = [], 0
    yield part


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", docs: int = SAMPLE_DOCS, size: int = SAMPLE_BYTES) -> dict[str, list[bytes]]:
    """The prepared sample of each language: up to ``docs`` different whole
    texts of up to ``size`` bytes together (the first always)."""
    known = hashed(df.select(F.col(lang_col).alias("label"), F.col(text_col).alias("text")))
    return {lang: [prepare(t) for t in texts] for lang, texts in sample_texts(known, known, docs, size).items()}


_ready: dict[int, tuple[object, Identifier]] = {}


def with_language(df: DataFrame, samples: dict[str, list[bytes]], text_col: str = "text", out_col: str = "language") -> DataFrame:
    """Add ``out_col``, a struct of lang_pred, score (posterior, 0 to 1) and
    bits_per_byte of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(samples)

    @F.arrow_udf("struct<lang_pred:string,score:double,bits_per_byte:double>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if shared.value and id(shared.value) not in _ready:
            _ready.clear()
            _ready[id(shared.value)] = (shared.value, Identifier(shared.value))
        known = _ready[id(shared.value)][1] if shared.value else Identifier({})
        for texts in batches:
            rows = [r for part in _by_size(texts) for r in known.identify(part)]
            lang, score, bits = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())], ["lang_pred", "score", "bits_per_byte"])

    return df.withColumn(out_col, find(F.col(text_col)))


def identify(df: DataFrame, samples: dict[str, list[bytes]], text_col: str = "text") -> DataFrame:
    """Add lang_pred, score and bits_per_byte as columns; input columns of
    these names are replaced."""
    found = work_name(df, "found")
    cols = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("lang_pred", "score", "bits_per_byte")]
    return with_language(df, samples, text_col, found).select(*cols, f"{found}.*")
