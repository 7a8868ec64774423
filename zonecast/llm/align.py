"""Cross-tokenizer alignment (operator 13).

Each text is encoded by two tokenizers: A, a byte-level BPE, on a space and
the text, and B, a sentencepiece model that adds that space itself. Both lists
of byte offsets where a token ends are intersected by galloping: the shorter
list drives, each of its ends starts at a guessed place of the longer list,
doubles its step until the end is bracketed, and a binary search finishes (all
ends of a batch step together). Offsets that both lists hold cut the tokens
into groups; the differences of the ranks of neighbouring common offsets, in
A's list and in B's, are the tokens of the group, and every A token of a group
is linked with every B token of it.

Corpus-wide, an id pair counts the documents that hold it linked. Alignments
are written once as narrow rows of (a, b, links) arrays; the counts are an
aggregate of their pairs, and go back to the documents as a broadcast table
if there are at most ``BROADCAST_PAIRS`` of them, else by a salted join.

Long texts are cut at places that are safe for both tokenizers (before one
space between two characters that are not white space): A's pre-tokens and
B's pieces start there. B encodes word by word, with a cache, as long as none
of its pieces holds a space behind another character and it normalizes nothing;
other models encode whole texts.

Cases: null and empty texts, and texts whose bytes B does not give back
(U+2581, for one), have no tokens: zeros and the text '' for the digest.
Special strings inside texts are ordinary text. Repeated rows are aligned and
counted each; a null id is kept; an empty table gives an empty table. Output
columns replace input columns of the same name; the text is not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm import bytebpe
from zonecast.llm.common import slices, stage, work_name
from zonecast.llm.token_count import segments

SEGMENT_CHARS = 1 << 18      # longer texts are cut at safe places
BATCH_CHARS = 1 << 19        # aligned at a time
PAIR_ROWS = 1 << 21          # links expanded at a time
BROADCAST_PAIRS = 4_000_000  # pairs (17 bytes each) sent to every executor; more are joined
SALTS = 16

class Pieces:
    """The sentencepiece side: ids, and the bytes that an id stands for."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model_pb2
        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token_bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.sizes = np.array([len(b) for b in self.token_bytes])
        spec = model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        plain = norm.add_dummy_prefix and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        self.space = self.model.piece_to_id("▁")
        self.cuts = plain and not self.model.is_unknown(self.space) and not any("▁" in p.lstrip("▁") for p in names)

    def ids(self, part: str) -> list[int] | None:
        """Ids of a part that starts with the space that the model adds
        itself; None if their bytes are not the part."""
        ids = self.model.encode(part[1:]) if part != " " else [self.space]  # the model adds no space to an empty text
        return ids if b"".join(map(self.token_bytes.__getitem__, ids)) == part.encode() else None


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the index of the first value of ``long``
    that is not below it. Both ascend, the last of ``long`` is not below the
    last of ``short``; ``guess`` is where each search starts."""
    low, high = guess - 1, guess.copy()
    below = np.flatnonzero(long[guess] < short)
    step = 1
    while len(below):
        low[below] = high[below]
        high[below] = np.minimum(high[below] + step, len(long) - 1)
        below = below[long[high[below]] < short[below]]
        step *= 2
    above = np.flatnonzero(low >= 0)
    above = above[long[low[above]] >= short[above]]
    step = 1
    while len(above):
        high[above] = low[above]
        low[above] = np.maximum(low[above] - step, -1)
        above = above[low[above] >= 0]
        above = above[long[low[above]] >= short[above]]
        step *= 2
    wide = np.flatnonzero(high - low > 1)
    while len(wide):
        middle = (low[wide] + high[wide]) >> 1
        less = long[middle] < short[wide]
        low[wide[less]] = middle[less]
        high[wide[~less]] = middle[~less]
        wide = wide[high[wide] - low[wide] > 1]
    return high


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in A's and in B's list of the offsets that both hold. The lists
    run through the documents of a batch; the shorter list of each document
    drives the search in the other."""
    n_a, n_b = np.bincount(doc_a, minlength=docs), np.bincount(doc_b, minlength=docs)
    ranks = []
    for shorter, s_ends, s_doc, n_s, l_ends, l_doc, n_l in ((n_a <= n_b, ends_a, doc_a, n_a, ends_b, doc_b, n_b),
                                                           (n_a > n_b, ends_b, doc_b, n_b, ends_a, doc_a, n_a)):
        s, long = np.flatnonzero(shorter[s_doc]), np.flatnonzero(shorter[l_doc])
        n_s, n_l = n_s * shorter, n_l * shorter
        of = s_doc[s]
        place = np.arange(len(s)) - (np.cumsum(n_s) - n_s)[of]
        guess = (np.cumsum(n_l) - n_l)[of] + place * n_l[of] // np.maximum(n_s[of], 1)
        at = gallop(s_ends[s], l_ends[long], guess)
        same = np.flatnonzero(l_ends[long[at]] == s_ends[s])
        ranks.append((s[same], long[at[same]]))
    (a1, b1), (b2, a2) = ranks
    a, b = np.concatenate([a1, a2]), np.concatenate([b1, b2])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and how often each is there."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def _merge(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal codes added up; quick where the codes are nearly in order."""
    if not len(codes):
        return codes, n
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(n, first)


def linked_pairs(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, doc: np.ndarray, n_ids: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(code of document and pair, links) of groups that end before ``end_a``
    in ids ``a`` and before ``end_b`` in ``b``. The code is (document * A ids +
    A id) * B ids + B id; codes come in order."""
    start_a, start_b = np.concatenate([[0], end_a[:-1]]), np.concatenate([[0], end_b[:-1]])
    n_a, n_b = end_a - start_a, end_b - start_b
    total = np.cumsum(n_a * n_b)
    out, g = [], 0
    while g < len(doc):
        if n_a[g] * n_b[g] > PAIR_ROWS:
            # a very large group: different ids with their repeats
            ids_a, c_a = _counted(a[start_a[g]:end_a[g]])
            ids_b, c_b = _counted(b[start_b[g]:end_b[g]])
            code = (doc[g] * n_ids[0] + ids_a)[:, None] * n_ids[1] + ids_b[None, :]
            out.append((code.ravel(), (c_a[:, None] * c_b[None, :]).ravel()))
            g += 1
            continue
        before = total[g - 1] if g else 0
        stop = max(g + 1, int(np.searchsorted(total, before + PAIR_ROWS, "right")))
        n = (n_a * n_b)[g:stop]
        of = np.repeat(np.arange(g, stop), n)
        within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        wide = n_b[of]
        code = (doc[of] * n_ids[0] + a[start_a[of] + within // wide]) * n_ids[1] + b[start_b[of] + within % wide]
        out.append(_counted(code))
        g = stop
    if not out:
        return (np.zeros(0, np.int64),) * 2
    return out[0] if len(out) == 1 else _merge(*map(np.concatenate, zip(*out)))


class Aligner:
    """Alignment of batches of texts under the two tokenizer files."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = bytebpe.load(path_a), Pieces(path_b)
        n = self.a.encoding.n_vocab
        self.sizes_a = np.array([len(self.a.encoding.decode_single_token_bytes(i)) for i in range(n)])
        # what a token says in the digest's text: A's ids end in "," or "|", B's in "," or ";"
        m = len(self.b.sizes)
        said = [f"{i}{end}".encode() for ends, size in ((",|", n), (",;", m)) for end in ends for i in range(size)]
        self.width = np.array([len(w) for w in said])
        self.said = np.array(said).view(np.uint8).reshape(len(said), -1)

    def parts(self, text: str) -> list[str]:
        return segments(" " + text, SEGMENT_CHARS) if self.b.cuts else [" " + text]

    def batch(self, ids_a: list[np.ndarray], ids_b: list[list[int]]) -> tuple[np.ndarray, np.ndarray, list[bytes], tuple[np.ndarray, np.ndarray]]:
        """Per part of a batch: groups, links, the groups as text (each ended
        by ";"); and the codes of parts and linked pairs with their links."""
        parts = len(ids_a)
        doc_a = np.repeat(np.arange(parts), [len(i) for i in ids_a])
        doc_b = np.repeat(np.arange(parts), [len(i) for i in ids_b])
        a, b = np.concatenate(ids_a).astype(np.int64), np.fromiter(chain.from_iterable(ids_b), np.int64, len(doc_b))
        # the parts' bytes are the same on both sides, so offsets can run on
        rank_a, rank_b = common_ends(np.cumsum(self.sizes_a[a]), np.cumsum(self.b.sizes[b]), doc_a, doc_b, parts)
        end_a, end_b, doc = rank_a + 1, rank_b + 1, doc_a[rank_a]
        n_a, n_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        groups = np.bincount(doc, minlength=parts)
        links = np.zeros(parts, np.int64)
        np.add.at(links, doc, n_a * n_b)
        # tokens in the order group by group, A's before B's
        of = np.arange(len(doc))
        at_a = np.arange(len(a)) + (end_b - n_b)[np.repeat(of, n_a)]
        at_b = np.arange(len(b)) + end_a[np.repeat(of, n_b)]
        say = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[rank_a], last_b[rank_b] = 1, 1
        n, m = len(self.sizes_a), len(self.b.sizes)
        say[at_a], say[at_b] = a + n * last_a, 2 * n + b + m * last_b
        letters = self.said[say]
        flat = letters[letters != 0].tobytes()
        cuts = np.cumsum(np.bincount(doc_a, minlength=parts) + np.bincount(doc_b, minlength=parts))
        cuts = np.append(0, np.cumsum(self.width[say]))[cuts].tolist()
        texts = [flat[i:j] for i, j in zip([0, *cuts], cuts)]
        return groups, links, texts, linked_pairs(a, b, end_a, end_b, doc, (n, m))

    def rows(self, texts: list[str | None]) -> dict[str, list]:
        """The columns of ``ALIGNED`` for some texts."""
        rows = len(texts)
        n_a, n_b, groups, links = (np.zeros(rows, np.int64) for _ in range(4))
        n_pairs = len(self.sizes_a) * len(self.b.sizes)
        sums, lost, found = [hashlib.sha256() for _ in texts], np.zeros(rows, bool), []
        open_end = [b""] * rows

        def flush(held: list[tuple[int, np.ndarray, list[int]]]) -> None:
            of = np.array([r for r, _, _ in held])
            g, k, said, (code, n) = self.batch([i for _, i, _ in held], [i for _, _, i in held])
            np.add.at(groups, of, g)
            np.add.at(links, of, k)
            for (r, i, j), text in zip(held, said):
                n_a[r] += len(i)
                n_b[r] += len(j)
                sums[r].update(open_end[r] + text[:-1])
                open_end[r] = text[-1:]
            part, pair = np.divmod(code, n_pairs)
            found.append(_merge(of[part] * n_pairs + pair, n))

        held, size = [], 0
        for r, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                ids_b = self.b.ids(part)
                if ids_b is None:
                    lost[r] = True
                    break
                held.append((r, self.a.ids(part, special=False), ids_b))
                size += len(part)
                if size >= BATCH_CHARS:
                    flush(held)
                    held, size = [], 0
        if held:
            flush(held)
        code, n = _merge(*map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64),) * 2
        kept = ~lost[code // n_pairs]
        code, n = code[kept], n[kept]
        row, pair = np.divmod(code, n_pairs)
        pair_a, pair_b = np.divmod(pair, len(self.b.sizes))
        for counts in (n_a, n_b, groups, links):
            counts[lost] = 0
        return {"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links,
                "groups_sha256": [s.hexdigest() if k else "" for s, k in zip(sums, n_a.tolist())],
                "offsets": np.searchsorted(row, np.arange(rows + 1)), "pair_a": pair_a, "pair_b": pair_b, "pair_links": n}


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@cache
def load(path_a: str | None = None, path_b: str | None = None) -> Aligner:
    """The aligner of two files, made once per worker."""
    a, b = default_paths()
    return Aligner(path_a or a, path_b or b)


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair_a array<int>, pair_b array<int>, pair_links array<long>"


def groups(df: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The columns of ``ALIGNED`` in place of the text: counts, the digest of
    the groups, and the linked id pairs with their links in the document."""
    kind = pa.struct([*[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()),
                      ("pair_a", pa.list_(pa.int32())), ("pair_b", pa.list_(pa.int32())), ("pair_links", pa.list_(pa.int64()))])

    @F.arrow_udf(f"struct<{ALIGNED.replace(', ', ',')}>".replace(" ", ":").replace("struct:", "struct"))
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        aligner = load(path_a, path_b)
        for batch in batches:
            for (texts,) in slices((batch,)):
                got = aligner.rows(texts.to_pylist())
                offsets = pa.array(got.pop("offsets"), pa.int32())
                cols = [pa.ListArray.from_arrays(offsets, pa.array(got[f.name], f.type.value_type)) if pa.types.is_list(f.type) else pa.array(got[f.name], f.type) for f in kind]
                yield pa.StructArray.from_arrays(cols, fields=list(kind))

    mark = work_name(df, "aligned")
    fields = [f.name for f in kind]
    kept = [c for c in df.columns if c != text_col and c.lower() not in fields]
    return df.select(*kept, aligned(F.col(text_col)).alias(mark)).select(*kept, f"{mark}.*")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n_docs (documents that hold the pair linked) and best (whether no
    other pair of the A id has more)."""
    pairs = aligned.select(F.inline(F.arrays_zip(F.col("pair_a").alias("a"), F.col("pair_b").alias("b"))))
    counted = stage(pairs.groupBy("a", "b").agg(F.count("*").alias("n_docs")), "pairs")
    most = counted.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counted.join(most, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by a broadcast table of at most
    ``BROADCAST_PAIRS`` pairs."""
    table = counts.toPandas()
    key = table["a"].to_numpy(np.int64) << 32 | table["b"].to_numpy(np.int64)
    order = np.argsort(key)
    sent = aligned.sparkSession.sparkContext.broadcast((key[order], table["n_docs"].to_numpy(np.int64)[order], table["best"].to_numpy(bool)[order]))

    @F.arrow_udf("struct<n_best:long,count_sum:long>")
    def totals(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        keys, docs, best = sent.value
        for a, b, links in batches:
            row = np.repeat(np.arange(len(a)), a.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            at = np.searchsorted(keys, a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy())
            n = links.flatten().to_numpy()
            sums = np.zeros((2, len(a)), np.int64)
            np.add.at(sums[0], row, n * best[at])
            np.add.at(sums[1], row, n * docs[at])
            yield pa.StructArray.from_arrays([pa.array(sums[0]), pa.array(sums[1])], ["n_best", "count_sum"])

    mark = work_name(aligned, "totals")
    return aligned.withColumn(mark, totals("pair_a", "pair_b", "pair_links")).select(*aligned.columns, f"{mark}.*")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by a join on the pair. Frequent pairs are salted:
    the counts are repeated for each salt, the documents' pairs dealt to them.
    ``aligned`` is a written table, whose rows keep their places."""
    mark = work_name(aligned, "row")
    rows = aligned.withColumn(mark, F.monotonically_increasing_id())
    salt: Column = F.pmod(F.xxhash64(mark), F.lit(SALTS))
    pairs = rows.select(F.col(mark).alias("row"), salt.alias("salt"), F.inline(F.arrays_zip(
        F.col("pair_a").alias("a"), F.col("pair_b").alias("b"), F.col("pair_links").alias("links"))))
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    sums = pairs.join(salted, ["a", "b", "salt"]).groupBy(F.col("row").alias(mark)).agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n_docs")).alias("count_sum"))
    return rows.join(sums, mark, "left").drop(mark).fillna(0, ["n_best", "count_sum"])


def align(df: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The columns of ``ALIGNED`` and, over the whole table, n_best (links
    whose pair no other of its A id outnumbers) and count_sum (documents of
    its pair, over all links), in place of the text."""
    aligned = stage(groups(df, text_col, path_a, path_b).drop("n_best", "count_sum"), "aligned")
    counts = stage(pair_counts(aligned), "pair-counts")
    few = counts.count() <= BROADCAST_PAIRS
    return _looked_up(aligned, counts) if few else _joined(aligned, counts)
