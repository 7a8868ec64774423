"""SimHash, SpotSigs and nearest neighbours against brute force."""
import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from zonecast.llm import queries as q
from zonecast.llm import simhash, spotsigs, srs

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=3):
    """Smallest id that can be reached, for (id, fingerprint) rows."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    ids = {}
    for i, (k, _) in enumerate(fps):
        if k is not None:
            ids[find(i)] = min(k, ids.get(find(i), k))
    return [ids.get(find(i)) for i in range(len(fps))]


def test_fingerprints():
    for t in ("", None, "one", "one two", "One\x0bTWO three", "É a b C d", "a b c " * 9_000, "a b c d"):
        assert simhash.fingerprint_of((t or "").encode(), 3) == brute_fingerprint(t)


def test_op8_query(spark):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in q.documents(spark, SF).collect()]
    want = {k: (f"{f:016x}", c) for (k, f), c in zip(rows, brute_components(rows))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in q.op8_simhash(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_links_give_all_components(spark, radius):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(40)} | {0, 2**64 - 1, 2**63}
    for f in list(fps)[:25]:                      # chains and dense balls
        for _ in range(8):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, radius)).collect()}
    want = brute_components(list(enumerate(fps)), radius)
    groups = {}
    for f, c in zip(fps, want):
        signed = int(np.uint64(f).astype(np.int64))
        groups.setdefault(c, set()).add(roots.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values()) and len({*map(frozenset, groups.values())}) == len(groups)


def test_bk_tree_searches_agree():
    rng = random.Random(5)
    base = rng.getrandbits(64)
    members = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(400)})
    tree = simhash.BkTree(members)
    batch = {i: sorted(near.tolist()) for i, near in tree.all_near(3)}
    for i, m in enumerate(members):
        want = [j for j, o in enumerate(members) if (m ^ o).bit_count() <= 3]
        assert sorted(tree.near(m, 3)) == want == batch[i]


def test_keep_first(spark, tricky):
    kept = simhash.keep_first(tricky)
    assert kept.columns == tricky.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    # 2, 3 and 4 have no word; 1 is there twice
    assert ids == sorted(["1", "2", "None", "6", "7", "8", "9"])
    assert simhash.keep_first(tricky.limit(0)).count() == simhash.near_duplicates(tricky.limit(0)).count() == 0


# ---- SpotSigs --------------------------------------------------------------

def brute_signatures(text):
    """Signatures as tuples, by a plain loop."""
    import regex
    words = [w for w in regex.split(r"[^\p{L}]+", (text or "").lower()) if w]
    content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    chains = []
    for i, w in enumerate(words):
        behind = tuple(words[j] for j in content if j > i)[:spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and behind:
            chains.append((w, *behind))
    if words and not chains:
        chains = [("", *[words[j] for j in content[k:k + spotsigs.CHAIN]]) for k in range(len(content))]
    return frozenset(chains) or frozenset([("whole", text or "")])


def test_op2_query(spark):
    rows = sorted(((r.doc_id, r.text or "") for r in q.documents(spark, SF).collect()), reverse=True)
    got = {r.doc_id: r for r in q.op2_spotsigs(spark, SF).collect()}
    assert len(got) == len(rows)
    names = {}
    for (k, text), (_, following) in zip(rows, [*rows[1:], rows[0]]):
        f = len(text) // 3
        edited = text[:len(text) - f] + following[:f]
        a, b, c = brute_signatures(text), brute_signatures(edited), brute_signatures(following)
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(r.near_edited, len(a & b) / len(a | b)) and math.isclose(r.near_next, len(a & c) / len(a | c))
        for s, name in ((a, r.fingerprint), (b, r.edited_fingerprint)):
            assert names.setdefault(s, name) == name
    assert len({*names.values()}) == len(names)


def test_next_document_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 7)
    ids = [*range(0, 50, 3), 10**12, -5]
    df = spark.createDataFrame([(i, f"the text{i} word") for i in ids], "doc_id long, text string")
    order = sorted(ids, reverse=True)
    got = {r.doc_id: r.edited for r in spotsigs.edited_fingerprints(df).collect()}
    assert len(got) == len(ids)
    for k, following in zip(order, [*order[1:], order[0]]):
        a, b = f"the text{k} word", f"the text{following} word"
        f = len(a) // 3
        assert got[k] == a[:len(a) - f] + b[:f]


@pytest.mark.parametrize("ids", [[*range(0, 50, 3)], [], [4]])
@pytest.mark.parametrize("nulls", [1, 9])
def test_next_document_around_null_ids(spark, monkeypatch, ids, nulls):
    """Null ids come last, by their text's hash, and the first follows them."""
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 3)
    rows = [*((i, f"the text{i} word") for i in ids), *((None, f"a null{i} id") for i in range(nulls))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = df.select("doc_id", "text", spotsigs.F.xxhash64("text").alias("h")).collect()
    order = [r.text for r in sorted(placed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h))]
    got = sorted(r.edited for r in spotsigs.edited_fingerprints(df).collect())
    assert got == sorted(a[:len(a) - len(a) // 3] + b[:len(a) // 3] for a, b in zip(order, [*order[1:], order[0]]))


def test_spotsigs_tricky(spark, tricky):
    got = spotsigs.edited_fingerprints(tricky).collect()
    assert len(got) == 10 and all(r.signatures and r.edited_signatures and r.next_signatures for r in got)
    assert spotsigs.edited_fingerprints(tricky.limit(0)).count() == 0
    members, links = spotsigs.similar_classes(tricky.limit(0))
    assert members.count() == links.count() == 0


def test_similar_classes(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "and"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    texts = []
    for _ in range(25):
        t = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        texts.append(t)
        for _ in range(4):
            u = list(t)
            for _ in range(rng.randint(0, 3)):
                u[rng.randrange(len(u))] = rng.choice(vocabulary)
            texts.append(u)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    members, links = spotsigs.similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    of = {r.doc_id: r["class"] for r in members.collect()}
    found = {(r.a, r.b): r.likeness for r in links.collect()}
    sigs = [brute_signatures(t) for _, t in rows]
    want = {}
    for i in range(len(rows)):
        for j in range(i):
            s = len(sigs[i] & sigs[j]) / len(sigs[i] | sigs[j])
            if sigs[i] != sigs[j] and s >= 0.8:
                want[tuple(sorted((of[i], of[j])))] = s
            assert (of[i] == of[j]) == (sigs[i] == sigs[j])
    assert want and found.keys() == want.keys() and all(math.isclose(found[k], want[k]) for k in want)


# ---- nearest neighbours ----------------------------------------------------

def brute_nearest(vectors, queries, k):
    out = {}
    for qi, qv in queries:
        d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, qv))), i) for i, v in vectors if i != qi)
        out[qi] = d[:k]
    return out


def test_op10_recall(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = brute_nearest(vectors, [v for v in vectors if v[0] % 100 == 0], 10)
    got = {}
    for r in q.op10_nearest(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for k, rows in want.items():
        rows_got = sorted(got[k])
        assert [r for r, _, _ in rows_got] == list(range(1, 11))
        assert [(s, i) for _, i, s in rows_got] == sorted((s, i) for _, i, s in rows_got)
        exact = {i: d for d, i in brute_nearest(vectors, [(k, dict(vectors)[k])], len(vectors))[k]}
        assert all(math.isclose(s, exact[i]) for _, i, s in rows_got)
        hits += len({i for _, i in rows} & {i for _, i, _ in rows_got})
    assert hits >= 0.9 * 10 * len(want)


def test_nearest_ties_and_useless_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0], "a") for i in range(30)] + [(100, [0.0, 1.0, 0.0], "q"), (101, None, None), (102, [0.0, 0.0, 0.0], "z"),
            (103, [float("nan"), 0.0, 1.0], "n"), (104, [1.0, None, 0.0], "n"), (105, [float("inf"), 1.0, 0.0], "i"), (None, [1.0, 2.0, 3.0], "x"),
            (106, [], "e"), (107, [1.0, 2.0], "short"), (200, [-0.0, 1.0, 0.0], "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in srs.nearest(df, df.where("vec_id % 100 = 0"), k=5).orderBy("query_id", "rank").collect()]
    near = math.sqrt(2)
    assert [r[:3] for r in got if r[0] == 0] == [(0, i + 1, i + 1) for i in range(5)]
    assert [r[2] for r in got if r[0] == 100] == [200, 0, 1, 2, 3] and [r[2] for r in got if r[0] == 200] == [100, 0, 1, 2, 3]
    assert [round(r[3], 12) for r in got if r[0] == 100] == [0.0] + [round(near, 12)] * 4
    assert {r[0] for r in got} == {0, 100, 200}
    assert srs.nearest(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id in (0, 100)")
    assert [tuple(r)[:3] for r in srs.nearest(few, few).orderBy("query_id").collect()] == [(0, 1, 100), (100, 1, 0)]
