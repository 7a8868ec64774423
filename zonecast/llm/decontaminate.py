"""Benchmark decontamination (operator 12).

The documents are the training side: the words of a batch of them are put into
shards of at most ``SHARD_WORDS`` words, and of each shard a suffix array is
built. Every suffix of every benchmark item is then searched in every shard:
binary searches narrow the range of training suffixes word by word, until the
range is empty (its depth is the longest verbatim match) or, for windows, as
deep as the window. The range left holds all its places. Words of the documents
inside any of them are hit, and documents with a hit can be removed.

The words are codes of the items' vocabulary; a word that no item has is a
separator like the end of a document, for no match runs across it. Suffixes are
ordered as deep as a search goes (a window, or the longest item) by prefix
doubling, which sorts only what is still tied: one 64-bit sort of (rank, rank
of the next half, place) a round.

A document of more words than a shard goes to several, which overlap by as
much, so that no match is cut. Items are searched in blocks of about
``BLOCK_BYTES``: each is broadcast, and extends what the blocks before found,
so neither side is copied to the other as a whole.

Cases: a null text, and one without words, has no words and no hits; an item
without words has no windows, one of fewer words than a window is a window
itself. Repeated items count once per id; a null item id is the id ''. Repeated
documents are searched each; an empty table gives an empty table, an empty
benchmark no hits. Output columns replace columns of the same name, everything
else is kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import stage, work_name

WINDOW = 10
SHARD_WORDS = 1 << 20      # of one suffix array; places and ranks take BITS bits
BITS = 21
BLOCK_BYTES = 8 << 20      # item text searched in one pass over the documents
CHUNK_BYTES = 4 << 20      # of a text split into words at a time

#: Bytes that words hold keep their place (A-Z in lower case), others are spaces.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, A-Z in lower case."""
    return text.translate(_WORDS).split()


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of the ranges [low, high), one range after the other."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)


class Items:
    """Benchmark items as codes of their vocabulary, 0 between two items."""

    def __init__(self, rows: list[tuple[str, bytes]], window: int = WINDOW):
        self.ids = [i for i, _ in rows]
        self.vocabulary: dict[bytes, int] = {}
        parts, self.longest = [], 0
        for _, text in rows:
            parts.append([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)])
            self.longest = max(self.longest, len(parts[-1]))
        length = np.array([len(p) for p in parts], np.int64)
        self.codes = np.array([c for p in parts for c in (*p, 0)] + [0], np.int64)
        start = np.cumsum(length + 1) - (length + 1)
        #: place and item of every suffix, and the words of the window that starts there (0: none)
        self.place, self.item = _ranges(start, start + length), np.repeat(np.arange(len(parts)), length)
        left = (start + length)[self.item] - self.place
        self.need = np.where(left >= window, window, np.where((left == length[self.item]), left, 0))

    def encode(self, text: bytes | None) -> np.ndarray:
        """The codes of a text's words, 0 for a word that no item has."""
        text, out, start = (text or b"").translate(_WORDS), [], 0
        while start < len(text):
            end = text.find(b" ", start + CHUNK_BYTES)
            part = text[start:end if end >= 0 else len(text)].split()
            out.append(np.fromiter(map(self.vocabulary.get, part, repeat(0)), np.int32, len(part)))
            start += CHUNK_BYTES if end < 0 else end - start
        return np.concatenate(out) if out else np.zeros(0, np.int32)


class SuffixArray:
    """The suffixes of ``codes`` that start with a known word, ordered by
    their first ``depth`` words as far as the next separator."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.codes = np.concatenate([codes, np.zeros(depth + 1, codes.dtype)]).astype(np.int64)
        place = np.flatnonzero(codes)
        stops = np.append(np.flatnonzero(codes == 0), len(codes))
        run = stops[np.searchsorted(stops, place)] - place
        values, rank = np.unique(self.codes[place], return_inverse=True)
        ranks = np.zeros(len(self.codes), np.int64)
        ranks[place] = rank + 1
        runs = np.zeros(len(self.codes), np.int64)
        runs[place] = run
        # slot: where the suffixes being sorted stand in the array
        slot, active, h = np.arange(len(place)), place, 1
        self.order = np.empty(len(place), np.int64)
        low = (1 << BITS) - 1
        while len(active):
            if len(place) < low:
                key = np.sort((ranks[active] << BITS | ranks[active + h]) << BITS | np.arange(len(active)))
                active = active[key & low]
                key >>= BITS
                first = np.concatenate([[True], key[1:] != key[:-1]])
            else:  # an item of a million words makes longer shards
                active = active[np.lexsort((ranks[active + h], ranks[active]))]
                mine, half = ranks[active], ranks[active + h]
                first = np.concatenate([[True], (mine[1:] != mine[:-1]) | (half[1:] != half[:-1])])
            self.order[slot] = active
            group = np.cumsum(first) - 1
            ranks[active] = slot[first][group] + 1
            h *= 2
            if h >= depth:
                break
            tied = (np.bincount(group)[group] > 1) & (runs[active] >= h)
            active, slot = active[tied], slot[tied]
        self.first = self.codes[self.order]

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, code: np.ndarray, upper: bool) -> np.ndarray:
        """First suffix in [low, high) whose word at ``depth`` is not below
        (``upper``: is above) the code."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            word = self.codes[self.order[middle] + depth]
            less = word <= code[open_] if upper else word < code[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        return low

    def search(self, items: Items, windows: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(suffix of the items, words matched, low, high) with the range of
        training suffixes that match: of every suffix its longest match, or
        with ``windows`` those of its window."""
        q = np.flatnonzero(items.need) if windows else np.arange(len(items.place))
        code = items.codes[items.place[q]]
        low, high = np.searchsorted(self.first, code, "left"), np.searchsorted(self.first, code, "right")
        out, depth = [], 1
        q, low, high = (x[low < high] for x in (q, low, high))
        while len(q):
            code = items.codes[items.place[q] + depth]
            ends = items.need[q] == depth if windows else code == 0
            out.append((q[ends], np.full(ends.sum(), depth), low[ends], high[ends]))
            q, low, high, code = (x[~ends] for x in (q, low, high, code))
            below, above = (self._bound(low, high, depth, code, upper) for upper in (False, True))
            on = below < above
            if not windows:
                out.append((q[~on], np.full((~on).sum(), depth), low[~on], high[~on]))
            q, low, high, depth = q[on], below[on], above[on], depth + 1
        if not out:
            return (np.zeros(0, np.int64),) * 4
        return tuple(map(np.concatenate, zip(*out)))


def shards(codes: list[np.ndarray], overlap: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(codes with a separator behind each piece; row, first word and start in
    the shard of each piece) of shards of at most ``size`` words."""
    held, held_words = [], 0
    for row, doc in enumerate(codes):
        start = 0
        while True:
            piece = doc[start:start + max(size, 2 * overlap + 1)]
            if held and held_words + len(piece) > size:
                yield _shard(held)
                held, held_words = [], 0
            held.append((row, start, piece))
            held_words += len(piece) + 1
            if start + len(piece) >= len(doc):
                break
            start += len(piece) - overlap
    if held:
        yield _shard(held)


def _shard(held: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = np.array([len(p) + 1 for _, _, p in held])
    out = np.zeros(n.sum(), np.int64)
    at = np.cumsum(n) - n
    for (_, _, p), a in zip(held, at):
        out[a:a + len(p)] = p
    return out, np.array([r for r, _, _ in held]), np.array([s for _, s, _ in held]), at


def _merged(spans: np.ndarray) -> np.ndarray:
    """Spans (start, end) of one document, overlapping and adjoining ones made one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.column_stack([spans[first, 0], reach[np.append(np.flatnonzero(first)[1:] - 1, len(spans) - 1)]])


def hits(items: Items, codes: list[np.ndarray], size: int = SHARD_WORDS) -> tuple[dict[int, np.ndarray], dict[int, set[int]]]:
    """Of the documents with hits: spans of hit words, and the items."""
    spans: dict[int, list[np.ndarray]] = {}
    found: dict[int, set[int]] = {}
    deep = int(items.need.max(initial=0))
    for shard, row, start, at in shards(codes, max(0, deep - 1), size) if deep else ():
        array = SuffixArray(shard, deep)
        q, n, low, high = array.search(items, windows=True)
        if not len(q):
            continue
        # equal windows have one range: (range, item) pairs, and each range once
        _, first, window = np.unique(low << 32 | n, return_index=True, return_inverse=True)
        pairs = np.unique(window.astype(np.int64) << 32 | items.item[q])
        of_window, item = pairs >> 32, pairs & 0xFFFFFFFF
        starts = np.searchsorted(of_window, np.arange(len(first) + 1))
        places = array.order[_ranges(low[first], high[first])]
        window = np.repeat(np.arange(len(first)), (high - low)[first])
        piece = np.searchsorted(at, places, "right") - 1
        for p, w in zip(*np.divmod(np.unique(piece.astype(np.int64) << 32 | window), 1 << 32)):
            found.setdefault(int(row[p]), set()).update(item[starts[w]:starts[w + 1]].tolist())
        # hit words: one more window open at each place, one fewer behind it
        change = np.zeros(len(shard) + 1, np.int64)
        np.add.at(change, places, 1)
        np.add.at(change, places + n[first][window], -1)
        hit = np.flatnonzero(np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        of = np.searchsorted(at, hit[:, 0], "right") - 1
        hit += (start - at)[of][:, None]
        for p, span in zip(of, hit):
            spans.setdefault(int(row[p]), []).append(span)
    return {r: _merged(np.array(s)) for r, s in spans.items()}, found


_cache: dict[str, Items] = {}


def _items(sent: Broadcast) -> Items:
    """The items of a block, prepared once per worker."""
    key, rows, window = sent.value
    if key not in _cache:
        _cache.clear()
        _cache[key] = Items(rows, window)
    return _cache[key]


FOUND = "struct<n_words:long,spans:array<struct<start:long,end:long>>,items:array<string>>"


def _find(sent: Broadcast):
    """An Arrow function of (text, what earlier blocks found)."""
    size = SHARD_WORDS

    @F.arrow_udf(FOUND)
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        items = _items(sent)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
        for texts, before in batches:
            codes = [items.encode(t) for t in texts.cast(pa.binary()).to_pylist()]
            spans, found = hits(items, codes, size)
            out = []
            for r, (known, doc) in enumerate(zip(before.to_pylist(), codes)):
                said, ids = spans.get(r, np.zeros((0, 2), np.int64)), {items.ids[i] for i in found.get(r, ())}
                if known and known["spans"]:
                    said = _merged(np.concatenate([said, [(s["start"], s["end"]) for s in known["spans"]]]).astype(np.int64))
                    ids |= set(known["items"])
                out.append({"n_words": len(doc), "spans": [{"start": a, "end": b} for a, b in said.tolist()], "items": sorted(ids)})
            yield pa.array(out, kind)

    return find


def _blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[int, DataFrame]:
    """Number of blocks, and the different items with their block."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    rows = stage(rows, "items")
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("id")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    return blocks, rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))


def _send(rows: DataFrame, block: int, window: int) -> Broadcast:
    """The items of one block (about ``BLOCK_BYTES``) for every worker."""
    part = sorted((r["id"], r["text"].encode()) for r in rows.where(F.col("block") == block).select("id", "text").collect())
    return rows.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, part, window))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", out_col: str = "found") -> DataFrame:
    """Add ``out_col``: n_words, the spans of hit words (from the first word
    on, 0; the end is not in it) and the ids of the items whose windows occur."""
    blocks, rows = _blocks(items, item_id_col, item_text_col)
    earlier: Column = F.lit(None).cast(FOUND)
    for block in range(blocks):
        sent = _send(rows, block, window)
        docs = docs.withColumn(out_col, _find(sent)(F.col(text_col), earlier))
        if blocks > 1:
            docs = stage(docs, "contamination")
            sent.unpersist()
        earlier = F.col(out_col)
    return docs


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without any hit word, as they are."""
    mark = work_name(docs, "found")
    found = contamination(docs, items, window, text_col, item_id_col, item_text_col, mark)
    return found.where(F.size(F.col(mark)["spans"]) == 0).drop(mark)


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Of each item that shares a word with a document its longest verbatim
    match: item_id, item_start, n_words, and where it is, ``id_col`` and
    start (of several matches the smallest id, null last, then the smallest
    start, then the first place in the item). Each task passes on one match an
    item."""
    blocks, rows = _blocks(items, item_id_col, item_text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType
    parts = []
    for block in range(blocks):
        parts.append(_longest(texts, _send(rows, block, WINDOW), kind.simpleString()))
        if blocks > 1:
            parts[-1] = stage(parts[-1], "longest")
    best = parts[0]
    for p in parts[1:]:
        best = best.union(p)
    order = F.struct(-F.col("n_words"), F.col("id").isNull(), "id", "start", "item_start")
    top = best.groupBy("item_id").agg(F.min_by(F.struct("item_start", "n_words", F.col("id").alias(id_col), "start"), order).alias("m"))
    return top.select("item_id", "m.*")


def _longest(texts: DataFrame, sent: Broadcast, kind: str) -> DataFrame:
    size = SHARD_WORDS

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(sent)
        best: dict[int, tuple] = {}
        id_kind = None
        for b in batches:
            id_kind, ids = b["id"].type, b["id"]
            rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64) if len(ids) else np.zeros(0, np.int64)
            codes = [items.encode(t) for t in b["text"].cast(pa.binary()).to_pylist()]
            for shard, row, start, at in shards(codes, max(0, items.longest - 1), size):
                array = SuffixArray(shard, items.longest)
                q, n, low, high = array.search(items, windows=False)
                # of each item the deepest ranges
                most = np.array([-best[i][0] if i in best else 0 for i in range(len(items.ids))], np.int64)
                np.maximum.at(most, items.item[q], n)
                where: dict[tuple[int, int], tuple] = {}
                for i in np.flatnonzero(n == most[items.item[q]]):
                    span = (int(low[i]), int(high[i]))
                    if span not in where:
                        places = array.order[slice(*span)]
                        piece = np.searchsorted(at, places, "right") - 1
                        word = places - at[piece] + start[piece]
                        k = np.lexsort((word, rank[row[piece]]))[0]
                        where[span] = ids[int(row[piece[k]])].as_py(), int(word[k])
                    doc, word_at = where[span]
                    item = int(items.item[q[i]])
                    first = int(np.searchsorted(items.item, item))
                    new = (-int(n[i]), doc is None, doc, word_at, int(q[i]) - first)
                    old = best.get(item)
                    if old is None or new[:2] < old[:2] or (new[:2] == old[:2] and (new[3:] < old[3:] if doc is None or doc == old[2] else doc < old[2])):
                        best[item] = new
        if best:
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array([items.ids[i] for i in best], pa.string()), "item_start": pa.array([v[4] for v in best.values()], pa.int64()),
                "n_words": pa.array([-v[0] for v in best.values()], pa.int64()), "id": pa.array([v[2] for v in best.values()], id_kind),
                "start": pa.array([v[3] for v in best.values()], pa.int64())})

    return texts.mapInArrow(search, f"item_id string, item_start long, n_words long, id {kind}, start long")
