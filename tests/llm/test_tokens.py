"""BPE, token counts and packing against the tokenizers library."""
import hashlib
import time
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.functions import lit as spark_lit
from tokenizers import Tokenizer

from zonecast.llm import bpe, bytebpe, packing, token_count
from zonecast.llm import queries as q

SF = "/root/testdata/sf0.001"
word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
byte = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ours = bpe.WordBpe(bpe.default_path())
mixed = st.text(st.one_of(st.sampled_from(" \n\t'aAbéÉßΣσςİ1½²'s!#|<>\x1c\x85  日本😀́"), st.characters(max_codepoint=0x24F)), max_size=60)


@settings(max_examples=300, deadline=None)
@given(mixed)
def test_word_bpe_equals_library(text):
    ids = word.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(ours.encode_batch([text])[0], "<i4")
    assert got.tolist() == ids
    assert ours.decode(got) == word.decode(ids, skip_special_tokens=False)


def test_word_bpe_long_words_and_specials():
    texts = ["a" * 500, "abc" * 3_000 + "!" * 99, "é" * 200, "<|startoftext|>Hi<|endoftext|><|endoftext|> x", "", " ", "<|ENDOFTEXT|>"]
    for t, got in zip(texts, ours.encode_batch(texts)):
        assert np.frombuffer(got, "<i4").tolist() == word.encode(t, add_special_tokens=False).ids


def test_long_words_cost_near_their_length():
    start = time.process_time()
    text = "".join(chr(97 + i * i % 26) for i in range(300_000))
    assert np.frombuffer(ours.encode_batch([text])[0], "<i4").tolist() == word.encode(text, add_special_tokens=False).ids
    assert time.process_time() - start < 20  # of both


def test_cache_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 5 * 256)
    small = bpe.WordBpe(bpe.default_path())
    texts = ["one two three four five six seven eight", "nine ten one two", "three <|endoftext|> four", "x" * 5_000 + " one"]
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(small.encode_batch([t])[0], "<i4").tolist() == word.encode(t, add_special_tokens=False).ids
            assert max(small._chunks.held, small._words.held) <= bpe.CACHE_BYTES
            assert all(len(c) <= bpe.CACHED for c in [*small._chunks, *small._words])
        for t, got in zip(texts, small.encode_batch(texts)):
            assert np.frombuffer(got, "<i4").tolist() == word.encode(t, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(mixed)
def test_byte_bpe_equals_library(text):
    assert bytebpe.load().ids(text).tolist() == byte.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(mixed, st.integers(1, 20))
def test_segments_are_safe(text, size):
    parts = token_count.segments(text, size)
    assert "".join(parts) == text
    assert sum(len(bytebpe.load().ids(p)) for p in parts) == len(byte.encode(text, add_special_tokens=False).ids)


def test_op1_and_op3_queries(spark):
    texts = {r.doc_id: r.text or "" for r in q.documents(spark, SF).collect()}
    for r in q.op1_bpe(spark, SF).collect():
        e = word.encode(texts[r.doc_id], add_special_tokens=False)
        assert r.n_tokens == len(e.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(word.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
    for r in q.op3_token_count(spark, SF).collect():
        n = len(byte.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_tricky_rows(spark, tricky):
    got = bpe.decode(bpe.encode(tricky), text_col="decoded").collect()
    assert len(got) == 10
    both = bpe.encode(tricky, ids_col="Score", decoded_col="source")   # these two are replaced
    assert sorted((r.Score, r.source) for r in both.collect()) == sorted((r.ids, r.decoded) for r in got)
    assert all(r.ids == [] and r.decoded == "" for r in got if not (r.text or "").strip())
    counts = token_count.with_budget(tricky).collect()
    assert len(counts) == 10 and all(r.n_tokens == len(byte.encode(r.text or "", add_special_tokens=False).ids) for r in counts)
    assert all(r.n_tokens == 0 and r.n_bytes == 0 for r in counts if not r.text)
    empty = tricky.limit(0)
    assert bpe.decode(bpe.encode(empty)).count() == token_count.with_budget(empty).count() == packing.pack_documents(empty).count() == 0


def fewest(lengths, capacity):
    """The fewest bins by exhaustive search."""
    best = [len(lengths)]

    def place(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        for i, r in enumerate(rooms):
            if r >= rest[0] and r not in rooms[:i]:
                place(rest[1:], [*rooms[:i], r - rest[0], *rooms[i + 1:]])
        place(rest[1:], [*rooms, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bin_completion(lengths):
    n = np.array(lengths)
    bins = packing.complete(n, 20)
    assert sorted(x for b in bins for x in b) == sorted(lengths) and all(sum(b) <= 20 for b in bins)
    assert packing.lower_bound(n, 20) <= fewest(lengths, 20) <= len(bins) <= len(packing.best_fit(n, 20))


def test_bin_completion_beats_best_fit():
    """Sets that best-fit decreasing packs in one bin too many."""
    better = 0
    for seed in range(60):
        n = np.random.default_rng(seed).integers(15, 60, 30)
        better += len(packing.complete(n, 100)) < len(packing.best_fit(n, 100))
    assert better > 0


def test_five_pieces_a_sequence():
    """Pieces of 180 to 225 tokens, five of which fit: best-fit decreasing
    puts four large ones together."""
    for n in (500, 4_000, 16_384):
        x = np.random.default_rng(n).integers(180, 226, n)
        bins = packing.complete(x, 1024)
        assert sorted(v for b in bins for v in b) == sorted(x.tolist()) and max(map(sum, bins)) <= 1024
        volume = -(-int(x.sum()) // 1024)
        # five pieces at most make one sequence in five pieces the least
        assert len(bins) == max(volume, -(-n // 5)) <= 1.02 * volume < 1.05 * volume < len(packing.best_fit(x, 1024))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9), st.integers(1, 30))
def test_fillings_are_all_undominated_sets(lengths, room):
    """Against all subsets: no set of a larger sum can be had by adding or
    exchanging one piece, and of one sum a single piece stands for all sets."""
    stock = packing._Stock(np.array(lengths), 40)
    got = list(stock.fillings(room, room))
    assert [w for w, _ in got] == sorted(w for w, _ in got) and len({p for _, p in got}) == len(got)
    sets = {tuple(sorted((lengths[i] for i in c), reverse=True)) for k in range(len(lengths) + 1) for c in combinations(range(len(lengths)), k)}
    want = set()
    for s in (s for s in sets if sum(s) <= room):
        left = list(lengths)
        for v in s:
            left.remove(v)
        lost = room - sum(s)
        better = any(0 < q - p <= lost for q in left for p in (0, *s))
        if not better and (len(s) < 2 or sum(s) not in lengths):
            want.add((lost, s))
    assert set((w, tuple(sorted(p, reverse=True))) for w, p in got) == want


def test_search_is_the_same_when_bit_sets_are_made_anew(monkeypatch):
    for seed in range(40):
        n = np.random.default_rng(seed).integers(8, 40, 16)
        most = len(packing.best_fit(n, 100)) - 1
        monkeypatch.setattr(packing, "KEPT", 256)
        want = packing.search(n, 100, most, 10**6)[0]
        monkeypatch.setattr(packing, "KEPT", 1)
        assert packing.search(n, 100, most, 10**6)[0] == want


def test_pack_documents(spark, tricky):
    for docs, rows in ((q.documents(spark, SF), None), (tricky.select("doc_id", "text"), 10)):
        texts = [(r.doc_id, r.text or "") for r in docs.collect()]
        got = packing.pack_documents(docs).collect()
        ids = {k: [*byte.encode(t, add_special_tokens=False).ids, 2] for k, t in texts}
        want = sorted((str(k), i, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, _ in texts for i, p in enumerate(pieces(ids[k])))
        assert sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in got) == want
        places = {}
        for r in got:
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for p in places.values():
            p.sort()
            assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(p[-1]) <= 1024
        assert len(places) <= 1.03 * sum(r.length for r in got) / 1024 + 2


def pieces(ids, capacity=1024):
    first = (len(ids) - 1) % capacity + 1
    return [ids[:first], *[ids[i:i + capacity] for i in range(first, len(ids), capacity)]]


def test_groups_keep_all_pieces(spark, monkeypatch):
    rows = [(i, 0, 0, (i * 37) % 1024 + 1, i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df, group=500).collect()
    assert len(got) == 3_000 and len({r.sequence_id >> 32 for r in got}) > 3
    assert max(r.offset + r.length for r in got) <= 1024
    assert len({(r.sequence_id, r.offset) for r in got}) == 3_000


# ---- very long runs ----------------------------------------------------------

def _library(text):
    return byte.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("run", [" ", "\t", "\n", "  \n\x85"])
@pytest.mark.parametrize("n", [1_000, bytebpe.LONG_RUN - 1, bytebpe.LONG_RUN, bytebpe.LONG_RUN + 1, 1_000_000])
def test_long_white_space_equals_library(run, n):
    r = (run * n)[:n]
    for text in (r, r + "ab", "ab" + r, "ab" + r + "cd" + r + "!", r + "<|endoftext|>" + r, "x" + r + "\x1c" + r):
        want = _library(text)
        assert bytebpe.load().ids(text).tolist() == want
        assert sum(bytebpe.load().counts(token_count.segments(text))) == len(want)


def test_three_million_spaces():
    text = "a" + " " * 3_000_000 + "b"
    assert bytebpe.load().ids(text).tolist() == _library(text)


def test_long_runs_in_counts_and_packing(spark):
    texts = [" " * 1_000_000, "x" + "\n" * 200_000 + " y", "word " * 3, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = {i: len(_library(t or "")) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_count.with_budget(df).collect()} == want
    total = {}
    for r in packing.pack_documents(df).collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: n + 1 for i, n in want.items()}


def test_batches_of_about_equal_bytes(monkeypatch):
    monkeypatch.setattr(token_count, "BATCH_BYTES", 100)
    texts = ["é" * 30 + " a", "b" * 10, None, "", "c d " * 60]
    batches = list(token_count._batches(texts))
    assert [s for _, parts in batches for s in parts] == [s for t in texts if t for s in token_count.segments(t)]
    assert all(sum(len(s.encode()) for s in parts[:-1]) < 100 for _, parts in batches)


def test_equal_rows_spread_over_groups(spark, tmp_path):
    """Equal pieces, in a table with a column of the work column's name."""
    spark.range(40).select(spark_lit(1).alias("doc_id"), spark_lit(300).cast("long").alias("length"), spark_lit(0).alias("_group")) \
        .coalesce(1).write.parquet(str(tmp_path / "p"))
    got = packing.pack(spark.read.parquet(str(tmp_path / "p")), group=4).collect()
    groups = {}
    for r in got:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert len(got) == 40 and len(groups) > 4 and max(groups.values()) < 20 and "_group" in got[0].asDict()
