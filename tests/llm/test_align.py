"""Cross-tokenizer alignment against plain loops over the two libraries."""
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zonecast.llm import align
from zonecast.llm import queries as q
from zonecast.llm.bpe import _byte_symbols

SF = "/root/testdata/sf0.001"
tok_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
tok_a.encode_special_tokens = True
tok_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
byte_of = {s: b for b, s in enumerate(_byte_symbols())}
parts = [*" \n\t'aAbcéÉß12½²!#|<>\x1c\x85\u2005\u3000日本😀▁\0", "the", " of", "  ", "<|endoftext|>", "<s>", "<0x41>", "<unk>", "ing "]
mixed = st.lists(st.sampled_from(parts), max_size=40).map("".join)


def plain(text):
    """Ids of A and B and the groups as (A ids, B ids), from whole texts."""
    if not text:
        return [], [], []
    whole = (" " + text).encode()
    a = tok_a.encode(" " + text, add_special_tokens=False).ids
    b = tok_b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in tok_a.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(tok_b.id_to_piece(i)[3:5], 16)]) if tok_b.is_byte(i) else tok_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], []
    out, i, j, at_a, at_b, ga, gb = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a) and (at_a < at_b or not ga):
            at_a += len(bytes_a[i])
            ga.append(a[i])
            i += 1
        else:
            at_b += len(bytes_b[j])
            gb.append(b[j])
            j += 1
        if at_a == at_b:
            out.append((ga, gb))
            ga, gb = [], []
    return a, b, out


def brute(texts):
    done = [plain(t) for t in texts]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, _, g in done]
    docs = Counter(p for k in links for p in k)
    top = {}
    for (x, _), n in docs.items():
        top[x] = max(top.get(x, 0), n)
    rows = []
    for (a, b, g), k in zip(done, links):
        said = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        rows.append((len(a), len(b), len(g), sum(k.values()), sum(n for p, n in k.items() if docs[p] == top[p[0]]),
                     sum(n * docs[p] for p, n in k.items()), hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return rows


COLS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@settings(max_examples=300, deadline=None)
@given(st.lists(mixed, max_size=4))
def test_groups_equal_plain_loops(texts):
    got = align.load().rows(texts)
    for i, (n_a, n_b, g, links, _, _, digest) in enumerate(brute(texts)):
        assert (got["n_a"][i], got["n_b"][i], got["n_groups"][i], got["n_links"][i], got["groups_sha256"][i]) == (n_a, n_b, g, links, digest)


@given(st.sets(st.integers(1, 300), min_size=1), st.sets(st.integers(1, 300), min_size=1), st.randoms())
def test_gallop_equals_searchsorted(x, y, rng):
    short, long = np.array(sorted(x | {301})), np.array(sorted(y | {301}))
    guess = np.array([rng.randrange(len(long)) for _ in short])
    assert (align.gallop(short, long, guess) == np.searchsorted(long, short)).all()


def test_small_cuts_change_nothing(monkeypatch):
    texts = ["one two  three four\nfive <s> six seven " * 30, "日本 the 日本語 of " * 40, "x" * 300 + " y" * 50, "a▁b " * 9]
    whole = align.load().rows(texts)
    for name, size in (("SEGMENT_CHARS", 20), ("BATCH_CHARS", 50), ("PAIR_ROWS", 2)):
        monkeypatch.setattr(align, name, size)
    cut = align.Aligner(*align.default_paths()).rows(texts)
    for name in whole:
        assert list(whole[name]) == list(cut[name]), name
    assert whole["n_a"][3] == 0 and whole["groups_sha256"][3] == ""


@pytest.mark.parametrize("pairs", [align.BROADCAST_PAIRS, 0])
def test_query_equals_plain_loops(spark, monkeypatch, pairs):
    monkeypatch.setattr(align, "BROADCAST_PAIRS", pairs)
    docs = [(r["doc_id"], r["text"]) for r in q.documents(spark, SF).collect()]
    want = sorted((d, *r) for (d, _), r in zip(docs, brute([t for _, t in docs])))
    got = sorted(tuple(r) for r in q.op13_align(spark, SF).select("doc_id", *COLS).collect())
    assert got == want


def test_cases(spark, tricky):
    docs = [tuple(r) for r in tricky.withColumn("N_BEST", tricky.SCORE).select("doc_id", "text").collect()]
    want = sorted(((d, *r) for (d, _), r in zip(docs, brute([t for _, t in docs]))), key=str)
    made = align.align(tricky.withColumn("N_BEST", tricky.SCORE).withColumn("_row", tricky.SCORE))
    assert "SCORE" in made.columns and "text" not in made.columns
    assert sorted((tuple(r) for r in made.select("doc_id", *COLS).collect()), key=str) == want
    assert align.align(tricky.limit(0)).count() == 0


def test_long_white_space():
    text = "a" + " \n" * 40_000 + "b"
    a, b, g = plain(text)
    got = align.load().rows([text])
    assert (got["n_a"][0], got["n_b"][0], got["n_groups"][0]) == (len(a), len(b), len(g))
