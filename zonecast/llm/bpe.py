"""BPE encoding and decoding (operator 1).

Method: contiguous rank arrays. The part ids of a short word lie in one row
of an array and the ranks of its adjacent pairs in another; each step scans
the row for its smallest rank, deletes the boundary behind it from both rows
and looks up the two neighbouring ranks again. All words of a batch take the
step together, one row each. Words of more than ``SHORT_WORD`` bytes keep the
same order of merges with a heap over a linked list, since the scan is
quadratic in the word length.

Text is cut at white space first: in this family of tokenizers white space is
dropped and no token spans it, so the ids of a text are the ids of its chunks
in order. A per-worker cache, bounded in bytes, answers the short chunks seen
before; longer ones (scripts without spaces) are encoded anew.

Cases: null text is encoded as the empty text (no ids, empty decoded text);
null ids decode to null; ids outside the vocabulary are left out of the
decoded text; special-token strings in a text become their special ids, as
the library's default has it. Output columns replace input columns of the
same name; all other columns, repeated rows and row count are kept.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import work_name

SHORT_WORD = 32          # bytes; longer words merge through a heap
CACHE_BYTES = 80 << 20   # of chunks, and of words, a worker remembers before it starts afresh
CACHED = 64              # characters; longer chunks and words are not remembered
ENTRY = 200              # bytes that an entry takes besides its characters and ids
ROWS = 1 << 15           # words merged together
NO_RANK = np.int32(1 << 30)


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters stand for themselves, the other bytes for the code points from
    256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Cache(dict[str, bytes]):
    """Ids by chunk or word, of at most ``CACHE_BYTES``; it starts afresh
    when the next entries would not fit."""

    held = 0

    def remember(self, found: dict[str, bytes]) -> None:
        short = {c: ids for c, ids in found.items() if len(c) <= CACHED}
        size = sum(ENTRY + 4 * len(c) + len(ids) for c, ids in short.items())
        if self.held + size > CACHE_BYTES:
            self.clear()
            self.held = 0
        if size <= CACHE_BYTES:
            self.update(short)
            self.held += size


class WordBpe:
    """Encoder and decoder for a tokenizers file with word-end BPE: NFC,
    white space folded, lower case, words split by the file's pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"] or steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a lower-case word-end BPE without a decoder")
        end, vocab = model["end_of_word_suffix"], model["vocab"]
        # A line feed never is part of a chunk; it ends each chunk of a batch.
        self.pattern = regex.compile(split["pattern"]["Regex"] + r"|\n")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._at_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + end] for s in symbols], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.keys, self.ranks = np.unique(keys, return_index=True)  # the first rank of a pair counts
        self.ranks = self.ranks.astype(np.int32)
        self._pairs: dict[int, int] = {}
        self._special_ids = {s: np.array([i], "<i4").tobytes() for s, i in self.special.items()}
        self._words = Cache()
        self._chunks = Cache()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word, as little-endian int32."""
        data = [w.encode("utf-8") for w in words]
        size = np.array([len(d) for d in data])
        short = np.flatnonzero(size <= SHORT_WORD)
        out: list[bytes] = [b""] * len(words)
        short = short[np.argsort(size[short], kind="stable")]
        for a in range(0, len(short), ROWS):
            rows = short[a:a + ROWS]
            for i, ids in zip(rows.tolist(), self._merge([data[i] for i in rows.tolist()], size[rows])):
                out[i] = ids
        for i in np.flatnonzero(size > SHORT_WORD).tolist():
            out[i] = np.array(self._long_word(data[i]), "<i4").tobytes()
        return iter(out)

    def _merge(self, data: list[bytes], size: np.ndarray) -> Iterator[bytes]:
        """Ids of short words, all merged a step at a time."""
        n, width = len(data), int(size.max())
        col = np.arange(width)
        used = col < size[:, None]
        raw = np.zeros((n, width), np.uint8)
        raw[used] = np.frombuffer(b"".join(data), np.uint8)
        parts = np.where(used, self.inner[raw], -1)
        row = np.arange(n)
        parts[row, size - 1] = self.last[raw[row, size - 1]]
        parts = np.concatenate([parts, np.full((n, 1), -1, parts.dtype)], axis=1)
        ranks = np.where(parts[:, 1:] >= 0, self._rank(parts[:, :-1], parts[:, 1:]), NO_RANK)
        size = size.copy()
        live = row
        p, r = parts.copy(), ranks
        while len(live):
            at = r.argmin(axis=1)
            low = r[np.arange(len(live)), at]
            go = low < NO_RANK
            if not go.all():
                parts[live[~go]] = p[~go]
                live, p, r, at, low = live[go], p[go], r[go], at[go], low[go]
                if not len(live):
                    break
            i = np.arange(len(live))
            p[i, at] = self.merged[low]
            # delete boundary at+1: all that lies behind moves one place left
            take = np.minimum(np.arange(width + 1) + (np.arange(width + 1) > at[:, None]), width)
            p = np.take_along_axis(p, take, axis=1)
            p[:, -1] = -1
            take = np.minimum(col + (col > at[:, None]), width - 1)
            r = np.take_along_axis(r, take, axis=1)
            r[:, -1] = NO_RANK
            size[live] -= 1
            r[i, at] = np.where(p[i, at + 1] >= 0, self._rank(p[i, at], p[i, at + 1]), NO_RANK)
            b = np.flatnonzero(at > 0)
            r[b, at[b] - 1] = self._rank(p[b, at[b] - 1], p[b, at[b]])
        flat = parts[parts >= 0].astype("<i4").tobytes()
        ends = np.cumsum(size * 4).tolist()
        return (flat[a:b] for a, b in zip([0, *ends], ends))

    def _long_word(self, data: bytes) -> list[int]:
        """The same merges, lowest rank and leftmost first, from a heap."""
        parts = [*self.inner[np.frombuffer(data[:-1], np.uint8)].tolist(), int(self.last[data[-1]])]
        n = len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        first = self._rank(np.array(parts[:-1]), np.array(parts[1:])).tolist()
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first) if r < NO_RANK]
        heapq.heapify(heap)
        if not self._pairs:
            self._pairs.update(zip(self.keys.tolist(), self.ranks.tolist()))

        def push(i: int) -> None:
            j = after[i]
            if j < n and (r := self._pairs.get(parts[i] << 20 | parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j] = int(self.merged[r]), False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [p for p, here in zip(parts, alive) if here]

    def _split(self, chunks: list[str]) -> list[str]:
        """The words of chunks, a line feed behind each chunk."""
        text = unicodedata.normalize("NFC", "\n".join([*chunks, ""])).replace("Σ", "σ").lower()
        if text.isascii() or not _doubtful.search(text):
            return self.pattern.findall(text)
        # Characters that only newer Unicode tables assign count as symbols.
        masked = _doubtful.sub(lambda m: _SYMBOL if unicodedata.category(m[0]) == "Cn" else m[0], text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(masked)]

    def learn(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """Ids of each run without white space; the short ones are remembered."""
        chunks = list(chunks)
        words = self._split(chunks)
        need = {*words} - {"\n"}
        # known words that this call needs are held before any is forgotten
        ids_of = {w: known for w in need if (known := self._words.get(w)) is not None}
        new = list(need - ids_of.keys())
        fresh = dict(zip(new, self.words(new)))
        self._words.remember(fresh)
        ids_of.update(fresh)
        ids_of["\n"] = b"\n"
        out: dict[str, bytes] = {}
        ids: list[bytes] = []
        at = 0
        for w in map(ids_of.__getitem__, words):
            if w == b"\n":
                out[chunks[at]] = ids[0] if len(ids) == 1 else b"".join(ids)
                ids, at = [], at + 1
            else:
                ids.append(w)
        self._chunks.remember(out)
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian int32."""
        cut = [self._cut(t) for t in texts]
        need = {c for chunks in cut for c in chunks} - self._special_ids.keys()
        own = {c: known for c in need if (known := self._chunks.get(c)) is not None}
        if new := need - own.keys():
            own.update(self.learn(new))
        own.update(self._special_ids)
        return [b"".join(map(own.__getitem__, chunks)) for chunks in cut]

    def _cut(self, text: str) -> list[str]:
        # str.split also cuts at four control characters that are not white
        # space to the tokenizer; texts that hold one go by its own class.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            chunks = regex.findall(r"[^\t-\r \x85\p{Z}]+", text)
        else:
            chunks = text.split()
        if any(s in text for s in self.special):
            return [p for c in chunks for p in self._at_special.split(c) if p]
        return chunks

    def decode(self, ids: np.ndarray) -> str:
        n = len(self.tokens)
        return " ".join([t for i in ids.tolist() if 0 <= i < n and (t := self.tokens[i])])


_SYMBOL = chr(0xE000)  # neither letter, number nor space
_doubtful = regex.compile(r"[^\x00-՗]")
_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer of a file, read once per worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _by_size(texts: pa.Array, size: int = 2 << 20) -> Iterator[list[str]]:
    """The texts of an Arrow batch in lists of about ``size`` characters."""
    part, held = [], 0
    for t in texts:
        part.append(t.as_py() or "")
        held += len(part[-1])
        if held >= size:
            yield part
            part, held = [], 0
    yield part


def _lists(coded: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(coded) + 1, np.int32)
    np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None, path: str | None = None) -> DataFrame:
    """Add ``ids_col`` array<int>: the ids of the whole text; with
    ``decoded_col`` also the text that these ids decode to, in the same
    worker. ``path`` must be readable on every executor; unset, each takes
    its installed file."""
    kind = "struct<ids:array<int>,decoded:string>" if decoded_col else "array<int>"

    @F.arrow_udf(kind)
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path or default_path())
        for texts in batches:
            for part in _by_size(texts):
                coded = bpe.encode_batch(part)
                if decoded_col:
                    said = pa.array([bpe.decode(np.frombuffer(c, "<i4")) for c in coded], pa.string())
                    yield pa.StructArray.from_arrays([_lists(coded), said], ["ids", "decoded"])
                else:
                    yield _lists(coded)

    if not decoded_col:
        return df.withColumn(ids_col, ids(F.col(text_col)))
    both = work_name(df, "coded")
    out = df.withColumn(both, ids(F.col(text_col)))
    return out.withColumns({ids_col: F.col(both)["ids"], decoded_col: F.col(both)["decoded"]}).drop(both)


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """Add ``text_col``: the text that the ids stand for."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path or default_path())
        for ids in batches:
            flat, offsets, null = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy(), ids.is_null().to_pylist()
            yield pa.array([None if x else bpe.decode(flat[a:b]) for a, b, x in zip(offsets[:-1], offsets[1:], null)], pa.string())

    return df.withColumn(text_col, text(F.col(ids_col)))
