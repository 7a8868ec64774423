"""SimHash near-duplicates (operator 8).

Method: fingerprints are linked through BK-trees, whose children are keyed by
their integer Hamming distance to the parent; a search follows only edges
within the radius. The distinct fingerprints are dealt into shards, one tree
each, such that every pair within the radius meets in a shard: of ``radius +
1`` blocks of the fingerprint one is equal in both, and the same holds again
for the bits outside that block, which gives (radius + 1)^2 keys of a block
and a sub-block (28 of 64 bits at radius 3). Shards stay small however many
fingerprints there are, and a hot block is cut further by its sub-blocks.

The method's broadcast of shard trees is replaced by this shuffle: trees over
all fingerprints have no bound on their size, and gathering them on the
driver is what a cluster cannot do.

A shard passes on a spanning forest of its links (at most one row for each
member), not all pairs: within a component every link is then implied, and
no dense group can square. Components over all shards come from alternating
large-star and small-star rounds.

Cases: null text has no words, its fingerprint is zero and it is linked like
any other; repeated rows keep their own row; a null id takes part but is
never the smallest id of its component unless all are null; an empty table
gives an empty result. Output columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import stage, work_name

BATCH_SEARCH = 48   # shards of more members search their tree in batches


# ---- fingerprints ----------------------------------------------------------

def fingerprint_of(data: bytes, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    import xxhash
    words = data.lower().split()   # of bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = np.array([digest(s, 42) for s in map(join, zip(*[words[i:] for i in range(shingle)]))], np.uint64)
    bits = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 4096):
        part = hashes[a:a + 4096]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of the whole text as a long with the same 64 bits."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(np.array([fingerprint_of((t or "").encode(), shingle) for t in texts.to_pylist()], np.uint64).view(np.int64))

    return simhash(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- BK-trees --------------------------------------------------------------

class BkTree:
    """A tree over distinct fingerprints; node 0 is the root."""

    def __init__(self, members: list[int]):
        self.members = members
        self.children: list[dict[int, int]] = [{} for _ in members]
        for i in range(1, len(members)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        at, own = 0, self.members[i]
        while True:
            d = (own ^ self.members[at]).bit_count()
            below = self.children[at].get(d)
            if below is None:
                self.children[at][d] = i
                return
            at = below

    def near(self, query: int, radius: int) -> list[int]:
        """Nodes within ``radius`` of one fingerprint."""
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            d = (query ^ self.members[at]).bit_count()
            if d <= radius:
                out.append(at)
            todo += [c for e, c in self.children[at].items() if -radius <= e - d <= radius]
        return out

    def all_near(self, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, members within ``radius`` of it), all searches at once: each
        edge is followed by the queries that are within the radius of it."""
        fps = np.array(self.members, np.uint64)
        todo = [(0, np.arange(len(fps)))]
        while todo:
            at, queries = todo.pop()
            d = np.bitwise_count(fps[queries] ^ fps[at]).astype(np.int16)
            yield at, queries[d <= radius]
            for e, c in self.children[at].items():
                if len(follow := queries[np.abs(d - e) <= radius]):
                    todo.append((c, follow))


def forest(members: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, smallest member of its component) of a shard, for members
    that are not the smallest."""
    root = list(range(len(members)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    tree = BkTree(members)
    if len(members) <= BATCH_SEARCH:
        links = ((i, tree.near(m, radius)) for i, m in enumerate(members))
    else:
        links = ((i, near.tolist()) for i, near in tree.all_near(radius))
    for i, near in links:
        a = find(i)
        for j in near:
            b = find(j)
            if a != b:
                a, b = min(a, b), max(a, b)
                root[b] = a
    return [(m, members[find(i)]) for i, m in enumerate(members) if find(i) != i]


def _cuts(bits: int, parts: int) -> list[tuple[int, int]]:
    """(shift, width) of blocks that cover ``bits`` bits."""
    ends = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def shard_keys(fps: np.ndarray, radius: int) -> list[np.ndarray]:
    """The (radius + 1)^2 shard keys of each fingerprint, uint64."""
    keys, parts = [], radius + 1
    for i, (shift, width) in enumerate(_cuts(64, parts)):
        low = np.uint64((1 << shift) - 1)
        block = fps >> np.uint64(shift) & np.uint64((1 << width) - 1)
        # the other bits, moved together
        rest = fps & low | (fps >> np.uint64(shift + width) << np.uint64(shift) if shift + width < 64 else np.uint64(0))
        for j, (at, size) in enumerate(_cuts(64 - width, parts)):
            sub = rest >> np.uint64(at) & np.uint64((1 << size) - 1)
            keys.append((np.uint64(i * parts + j) << np.uint64(58)) | block << np.uint64(size) | sub)
    return keys


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp`` long: links whose components are
    those of all links within ``radius`` bits (0 to 7)."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be 0 to 7")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_numpy(zero_copy_only=False)
            keys = shard_keys(own.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(own, len(keys)))], ["key", "fp"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shard by shard from a partition sorted by key."""
        key, own = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def done(key: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
            ends = [*(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)] if len(key) else []
            out = [p for a, b in zip([0, *ends], ends) if b - a > 1 for p in forest(np.sort(own[a:b].view(np.uint64)).tolist(), radius)]
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        for b in batches:
            key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
            own = np.concatenate([own, b.column(1).to_numpy(zero_copy_only=False)])
            if len(key) and key[0] != key[-1]:
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1
                yield done(key[:cut], own[:cut])
                key, own = key[cut:], own[cut:]
        yield done(key, own)

    shards = fps.select("fp").mapInArrow(keyed, "key long, fp long")
    return shards.repartition("key").sortWithinPartitions("key").mapInArrow(linked, "a long, b long").distinct()


# ---- components ------------------------------------------------------------

def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of ``edges``, root the smallest node of its
    component. Alternating stars: large-star hangs the larger neighbours of a
    node on its smallest neighbour, small-star the smaller ones; the rounds
    end when the edges no longer change."""
    edges = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")

    def fingerprint_of_edges(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    mark = fingerprint_of_edges(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stage(small, "edges")
        now = fingerprint_of_edges(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _classes(own: DataFrame, id_col: str, radius: int) -> DataFrame:
    """(fp, root, component_id) of each distinct ``fp`` of ``own``."""
    first = stage(own.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    roots = components(links(first, radius))
    rooted = first.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``id_col``, fingerprint (hex) and component_id (the smallest id that
    can be reached over links) for each row."""
    own = stage(df.select(F.col(id_col), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    return own.join(_classes(own, id_col, radius), "fp").select(F.col(id_col), as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each component: that of the smallest id (a null id comes
    last), then of the smallest hash of its columns; of equal rows one."""
    mark, rank = work_name(df, "row"), work_name(df, "rank")
    # a row is known by its id and 128 bits of its columns
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = F.concat_ws("-", F.xxhash64(*cols), F.xxhash64(F.lit("row"), *cols), F.col(id_col))
    own = stage(df.select(F.col(id_col).alias("id"), hashed.alias("row"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    chosen = own.join(_classes(own, "id", radius), "fp").groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("w"))
    rows = df.withColumn(mark, hashed).join(chosen.select(F.col("w.row").alias(mark)).distinct(), mark, "left_semi")
    one = Window.partitionBy(mark).orderBy(F.lit(0))
    return rows.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
