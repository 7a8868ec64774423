"""Best-fit packing into fixed-length sequences (operator 5).

Method: bin completion with branch and bound. Each sequence is opened by the
largest piece left and completed by an undominated filling: a set of pieces,
of any number, such that no piece can be added to it or exchanged for a larger
one. Bit sets of the sums that the pieces left can make give the fillings in
order of waste, those of larger pieces first, without dead ends. The better of
best-fit decreasing and a descent that takes the first filling of each opener
is the incumbent. It is improved by parts: the pieces of the sequences with
the most room, and of some others, are searched for a packing in one sequence
fewer; parts grow up to the whole group. A branch is cut once its waste can no
longer lead to fewer sequences, and the search ends at the lower bound or
after ``MAX_STEPS`` looks at a filling, of which a part has ``OPENER_STEPS``
for each of its sequences. That bounds effort, never pieces.

Scale: pieces of a full sequence need no partner. The others are dealt by a
hash into groups of about ``GROUP`` pieces, and every group is packed on its
own, in one task: a group costs less than one sequence of waste beyond the
bound, so the loss against one common packing is under one sequence in some
ten thousand pieces.

Cases: null and empty texts are one piece of one token (the end token);
repeated rows are packed each on its own; an empty table gives an empty
result. Documents of any length are kept whole: only those longer than a
sequence are cut, the first piece takes the remainder, the others are full.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import bytebpe
from zonecast.llm.common import stage, work_name

GROUP = 16_384     # pieces packed together
MAX_STEPS = 60_000 # looks at a filling in one group
OPENER_STEPS = 16  # of them for each sequence of a part
PART = 8           # sequences in the first parts, beside those with the most room
TRIES = 4          # parts of one size
KEPT = 256         # openers whose bit sets stay in memory; others are made anew


# ---- packing one group -----------------------------------------------------

class _Stock:
    """How many pieces of each length are left, with bit sets of the lengths
    for constant-time questions about sums."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        self.count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.bits = self.mirror = self.steps = 0
        for n, c in enumerate(self.count):
            if c:
                self._flip(n)

    def _flip(self, n: int) -> None:
        self.bits ^= 1 << n
        self.mirror ^= 1 << (self.capacity - n)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self._flip(n)

    def back(self, n: int) -> None:
        if not self.count[n]:
            self._flip(n)
        self.count[n] += 1

    def largest(self, at_most: int) -> int:
        """The largest length left up to ``at_most``; 0 if there is none."""
        return max(0, (self.bits & ((2 << at_most) - 1)).bit_length() - 1) if at_most > 0 else 0

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two pieces of together ``total``, the larger as large as can be."""
        if total < 2:
            return None
        # bit a is set if a and total - a are both left
        both = self.bits & (self.mirror >> (self.capacity - total)) & ((1 << total) - 1)
        while both:
            a = both.bit_length() - 1
            if 2 * a < total:
                return None
            if 2 * a > total or self.count[a] > 1:
                return a, total - a
            both ^= 1 << a
        return None

    def sums(self, room: int) -> tuple[list[int], list[int]]:
        """The lengths left up to ``room``, ascending, and for each the bit
        set of sums up to ``room`` that pieces of at most that length make."""
        every = (2 << room) - 1
        lengths, reach, made, bits = [], [], 1, self.bits & every
        while bits:
            n = (bits & -bits).bit_length() - 1
            bits &= bits - 1
            left, copies = min(self.count[n], room // n), 1
            while left and made != every:
                copies = min(copies, left)
                made |= made << n * copies & every
                left -= copies
                copies *= 2
            lengths.append(n)
            reach.append(made)
        return lengths, reach

    def exact(self, total: int, lengths: list[int], reach: list[int], last: int) -> Iterator[tuple[int, ...]]:
        """Sets of pieces of together ``total``, of the lengths up to index
        ``last``, the largest pieces first."""
        if not total:
            yield ()
            return
        for i in range(min(last, bisect_right(lengths, total) - 1), -1, -1):
            n, below = lengths[i], reach[i - 1] if i else 1
            for k in range(min(self.count[n], total // n), 0, -1):
                if below >> (total - k * n) & 1:
                    for rest in self.exact(total - k * n, lengths, reach, i - 1):
                        yield (n,) * k + rest
            if not below >> total & 1:
                return

    def dominated(self, pieces: tuple[int, ...], lost: int) -> bool:
        """Whether a piece left can be added or take the place of a smaller one."""
        for n in {0, *pieces}:
            larger = self.bits >> (n + 1) & ((1 << lost) - 1)
            while larger:
                m = n + larger.bit_length()
                if self.count[m] > pieces.count(m):
                    return True
                larger ^= 1 << (m - n - 1)
        return False

    def fillings(self, room: int, waste: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(waste, pieces) of undominated fillings, the least waste first. The
        stock must be as it was whenever the next one is asked for."""
        if waste < 0:
            return
        self.steps += 1
        first = (room,) if room and self.count[room] else self.pair(room)
        if first:
            yield 0, first
        lengths, reach = self.sums(room)
        sums = reach[-1] if reach else 1
        while sums:
            total = sums.bit_length() - 1
            lost = room - total
            if lost > waste:
                return
            sums ^= 1 << total
            # one piece of the same sum dominates all other sets
            sets = ((total,),) if total and self.count[total] else self.exact(total, lengths, reach, len(lengths) - 1)
            for pieces in sets:
                self.steps += 1
                if pieces != first and not (lost and self.dominated(pieces, lost)):
                    yield lost, pieces


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the incumbent of the search."""
    stock, bins = _Stock(lengths, capacity), []
    while n := stock.largest(capacity):
        stock.take(n)
        bins.append([n])
        room = capacity - n
        while m := stock.largest(room):
            stock.take(m)
            bins[-1].append(m)
            room -= m
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences needed at least: by volume, with the pieces over a threshold
    set apart (Martello and Toth's second bound), and by number (Fekete and
    Schepers' dual feasible functions: at most k pieces over 1 / (k + 1) of a
    sequence go into one)."""
    count = np.bincount(lengths, minlength=capacity + 1)
    number, volume = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    best = -(-int(volume[-1]) // capacity)
    half = capacity // 2
    for k in range(1, half + 1):
        alone = int(number[capacity] - number[capacity - k])
        large = int(number[capacity - k] - number[half])
        small = int(volume[half] - volume[k - 1])
        room = large * capacity - int(volume[capacity - k] - volume[half])
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    n = np.arange(capacity + 1)
    for k in range(1, min(capacity, 100)):
        share = np.where((k + 1) * n % capacity == 0, k * n, (k + 1) * n // capacity * capacity)
        best = max(best, -(-int((count * share).sum()) // (k * capacity)))
    return best


def descend(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Each opener with its first filling, the one of the least waste."""
    stock, bins = _Stock(lengths, capacity), []
    while opener := stock.largest(capacity):
        stock.take(opener)
        _, pieces = next(stock.fillings(capacity - opener, capacity))
        for p in pieces:
            stock.take(p)
        bins.append([opener, *pieces])
    return bins


def search(lengths: np.ndarray, capacity: int, most: int, max_steps: int) -> tuple[list[list[int]] | None, int]:
    """(bins, looks): a packing in at most ``most`` sequences by branch and
    bound over all undominated fillings, None if there is none or the looks
    run out."""
    stock = _Stock(lengths, capacity)
    spare = most * capacity - int(lengths.sum())   # waste that is left
    # opener, filling, spare before, fillings tried, more fillings
    path: list[tuple[int, tuple[int, ...], int, int, Iterator | None]] = []
    while stock.steps <= max_steps:
        opener = stock.largest(capacity)
        if not opener:
            return [[o, *p] for o, p, *_ in path], stock.steps
        stock.take(opener)
        path.append((opener, (), spare, 0, None))
        if len(path) > KEPT:
            path[-1 - KEPT] = (*path[-1 - KEPT][:4], None)
        while path:
            opener, pieces, before, tried, options = path[-1]
            for p in pieces:
                stock.back(p)
            options = options or islice(stock.fillings(capacity - opener, before), tried, None)
            if stock.steps <= max_steps and (step := next(options, None)):
                waste, pieces = step
                for p in pieces:
                    stock.take(p)
                path[-1] = (opener, pieces, before, tried + 1, options)
                spare = before - waste
                break
            stock.back(opener)
            path.pop()
        if not path:
            break
    return None, stock.steps


def complete(lengths: np.ndarray, capacity: int, max_steps: int = MAX_STEPS) -> list[list[int]]:
    """Bins of piece lengths: the best found by bin completion."""
    bins, bound = best_fit(lengths, capacity), lower_bound(lengths, capacity)
    if len(bins) <= bound:
        return bins
    bins = min(descend(lengths, capacity), bins, key=len)
    steps, size, tries, rng = max_steps - len(bins), PART, 0, random.Random(0)
    while len(bins) > bound and steps > 0:
        bins.sort(key=sum)
        # one sequence fewer takes at least a sequence of room
        room = np.cumsum([capacity - sum(b) for b in bins])
        worst = int(np.searchsorted(room, capacity)) + 1
        if worst > len(bins):
            break
        chosen = {*range(worst), *rng.sample(range(worst, len(bins)), min(size, len(bins) - worst))}
        part = [bins[i] for i in chosen]
        whole = len(part) == len(bins)
        pieces = np.array([n for b in part for n in b])
        found, looks = None, 1
        if lower_bound(pieces, capacity) < len(part):
            found, looks = search(pieces, capacity, len(part) - 1, steps if whole else min(steps, OPENER_STEPS * len(part)))
        steps -= looks
        if found:
            bins = [b for i, b in enumerate(bins) if i not in chosen] + found
            size, tries = PART, 0
        elif whole:
            break
        else:
            tries += 1
            size, tries = (2 * size, 0) if tries == TRIES else (size, tries)
    return bins


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece of a group."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bins = complete(lengths, capacity)
    flat = np.array([n for b in bins for n in b])
    of = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    at = np.concatenate([np.cumsum([0, *b[:-1]]) for b in bins])
    rows, slots = np.argsort(lengths, kind="stable"), np.argsort(flat, kind="stable")
    group, offset = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    group[rows], offset[rows] = of[slots], at[slots]
    return group, offset


# ---- Spark -----------------------------------------------------------------

PIECE = "piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, path: str | None = None) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32. Ids
    are those of the tokenizers file, with ``end_id`` behind each document."""

    @F.arrow_udf(f"array<struct<{PIECE.replace(' ', ':').replace(',:', ',')}>>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = bytebpe.load(path)
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
        for texts in batches:
            out = []
            for t in texts.to_pylist():
                ids = np.append(bpe.ids(t or ""), end_id).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity)]
                out.append([(k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))])
            yield pa.array([[dict(zip(("piece", "start", "length", "ids_crc32"), p)) for p in d] for d in out], kind)

    made = df.select(F.col(id_col), pieces(F.col(text_col)).alias("_pieces"))
    # every document has a piece; inline would first filter by a second run of the function
    return made.select(id_col, F.inline_outer("_pieces"))


def pack(pieces: DataFrame, capacity: int = 1024, group: int = GROUP, length_col: str = "length") -> DataFrame:
    """Add sequence_id and offset to a table of pieces of 1 to ``capacity``
    tokens. All columns are kept; ``sequence_id`` and ``offset`` replace
    columns of the same name. The input is read twice (count, then pack):
    give a written table, not an expensive plan."""
    pieces = pieces.drop("sequence_id", "offset")
    n = pieces.where(F.col(length_col) < capacity).count()
    groups = max(1, -(-n // group))
    # Full pieces are spread too, so that no group has more than its share.
    mark = work_name(pieces, "group")
    dealt = pieces.withColumn(mark, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = pieces.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint"

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows.drop(columns=mark)
        lengths = own[length_col].to_numpy()
        full = lengths >= capacity
        bins, offset = pack_group(lengths[~full], capacity)
        seq, off = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        seq[~full], off[~full] = bins, offset
        used = int(bins.max()) + 1 if len(bins) else 0
        seq[full] = used + np.arange(full.sum())
        return own.assign(sequence_id=seq + (int(key[0]) << 32), offset=off)

    return dealt.groupBy(mark).applyInPandas(packed, schema)


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Tokenize, cut and pack all documents of ``df``."""
    return pack(stage(tokenize_pieces(df, id_col, text_col, capacity, end_id, path), "pieces"), capacity)
