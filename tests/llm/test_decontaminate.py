"""Benchmark decontamination against plain loops over words."""
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import decontaminate as d
from zonecast.llm import queries as q
from zonecast.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, size=10):
    """(n_words, spans of hit words, item ids) of each text."""
    windows = {}
    for i, text in items:
        w = WORD.findall(lower(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add("" if i is None else str(i))
    lengths = sorted({len(w) for w in windows})
    out = []
    for text in docs:
        w = WORD.findall(lower(text))
        hit, ids = [False] * (len(w) + 1), set()
        for k in range(len(w)):
            for n in lengths:
                if (found := windows.get(tuple(w[k:k + n]))) and k + n <= len(w):
                    ids |= found
                    hit[k:k + n] = [True] * n
        edges = [k for k in range(len(w) + 1) if hit[k] != (k > 0 and hit[k - 1])]
        out.append((len(w), list(zip(edges[::2], edges[1::2])), sorted(ids)))
    return out


letters = st.lists(st.sampled_from(["a", "B", "c", "é", "9", "-", "x"]), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(letters, max_size=6), st.lists(letters, max_size=4), st.integers(1, 4), st.sampled_from([4, 30, 1 << 20]))
def test_hits_equal_plain_loops(docs, items, window, shard):
    probe = d.Items([(str(i), t.encode()) for i, t in enumerate(items)], window)
    codes = [probe.encode(t.encode()) for t in docs]
    spans, found = d.hits(probe, codes, shard)
    for r, (n, s, ids) in enumerate(plain(docs, list(enumerate(items)), window)):
        assert len(codes[r]) == n
        assert [tuple(x) for x in spans.get(r, np.zeros((0, 2))).tolist()] == s
        assert sorted(probe.ids[i] for i in found.get(r, ())) == ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 20))
def test_suffixes_are_ordered(codes, depth):
    codes = np.array(codes, np.int64)
    got = d.SuffixArray(codes, depth).order

    def head(p):
        part = codes[p:p + depth].tolist()
        return part[:part.index(0)] if 0 in part else part
    assert sorted(got.tolist()) == np.flatnonzero(codes).tolist()
    heads = [head(p) for p in got]
    assert heads == sorted(heads)


def test_words_of_a_long_text(monkeypatch):
    monkeypatch.setattr(d, "CHUNK_BYTES", 7)
    probe = d.Items([("1", b"one two three four")])
    text = "One, two; zz three-four  é9 " * 20
    assert len(probe.encode(text.encode())) == len(WORD.findall(text))
    assert probe.encode(text.encode()).tolist() == [probe.vocabulary.get(w.encode(), 0) for w in WORD.findall(lower(text))]


@pytest.mark.parametrize("block,shard", [(d.BLOCK_BYTES, d.SHARD_WORDS), (4000, 5000)])
def test_query_equals_plain_loops(spark, monkeypatch, block, shard):
    monkeypatch.setattr(d, "BLOCK_BYTES", block)
    monkeypatch.setattr(d, "SHARD_WORDS", shard)
    docs = [(r["doc_id"], r["text"]) for r in q.documents(spark, SF).collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    want = sorted((i, n, sum(b - a for a, b in s), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(s))
                  for (i, _), (n, s, ids) in zip(docs, plain([t for _, t in docs], items)))
    got = sorted(tuple(r) for r in q.op12_decontaminate(spark, SF).collect())
    assert got == want
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_cases(spark, tricky):
    items = spark.createDataFrame([(1, "The CAT sat on the mat and the dog ran"), (1, "The CAT sat on the mat and the dog ran"), (2, None), (None, "x" * 20_000),
                                   (3, "!!!"), (4, "numéro endoftext fin"), (5, "word " * 12)], "item_id long, text string")
    docs = tricky.withColumn("_found", tricky.SCORE)
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], n, [tuple(x) for x in s], ids) for r, (n, s, ids) in zip(rows, plain([r["text"] for r in rows], [tuple(i) for i in items.collect()]))), key=str)
    got = d.contamination(docs, items)
    assert sorted(((r["doc_id"], r["found"]["n_words"], [tuple(x) for x in r["found"]["spans"]], r["found"]["items"]) for r in got.collect()), key=str) == want
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted([(i,) for i, _, s, _ in want if not s], key=str)
    assert d.decontaminate(docs.limit(0), items).count() == 0
    assert d.decontaminate(docs, items.limit(0)).count() == docs.count()


@pytest.mark.parametrize("shard", [3, 1 << 20])
def test_longest_matches(spark, monkeypatch, shard):
    monkeypatch.setattr(d, "SHARD_WORDS", shard)
    docs = spark.createDataFrame([(3, "a b c d e f g"), (1, "x c d e y"), (2, "c d e f"), (None, "a b c d e f g"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([("p", "q C d e f z"), ("r", "x"), ("s", "nothing"), ("t", "a b c d e f g")], "item_id string, text string")
    got = sorted(tuple(r) for r in d.longest_matches(docs, items).collect())
    assert got == [("p", 1, 4, 2, 0), ("r", 0, 1, 1, 0), ("t", 0, 7, 3, 0)]
