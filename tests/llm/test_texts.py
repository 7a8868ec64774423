"""Toxicity, language ID, HTML, chats and the pipeline."""
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonecast.llm import chat, common, html_extract, lang_ppm, packing, simhash, toxicity
from zonecast.llm import queries as q

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def crc(key, n):
    return zlib.crc32(str(key).encode()) % n


# ---- toxicity --------------------------------------------------------------

def corpus(n, seed=1):
    """(text, label) of invented prose; toxic ones hold invented insults."""
    rng = random.Random(seed)
    syllables = ["ba", "re", "ti", "on", "the", "er", "an", "lo", "mi", "su", "ka", "po"]
    usual = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(1500)]
    bad = ["zquorf", "wexulp", "gryndik", "fjompel"]
    out = []
    for i in range(n):
        words = rng.choices(usual, k=rng.randint(5, 300))
        if i % 4 == 0:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "s", "ig"]))
        out.append((" ".join(words), int(i % 4 == 0)))
    return out


def test_toxicity_on_unseen_texts():
    rows = corpus(1200)
    model = toxicity.train([t for t, l in rows[:800] if l], [t for t, l in rows[:800] if not l])
    scorer = toxicity.Scorer(model)
    right = sum((scorer.score(t) >= 0.5) == bool(l) for t, l in rows[800:])
    assert right >= 0.97 * 400
    assert scorer.score("") == scorer.score(None) == scorer.score("!!! 123") < 0.5
    assert 0 <= scorer.score("zquorf " * 5_000) <= 1


def test_toxicity_without_labels_and_tricky_rows(spark, tricky):
    nothing = toxicity.learn(tricky, tricky.select("doc_id", F.lit(None).cast("int").alias("toxic")))
    assert {r.score for r in toxicity.score(tricky, nothing).collect()} == {0.0}
    rows = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(corpus(200))], "doc_id long, text string, toxic int")
    docs = rows.select("doc_id", "text").unionByName(rows.select("doc_id", F.lit(None).cast("string").alias("text")))
    model = toxicity.learn(docs, rows.select("doc_id", "toxic").unionByName(rows.select("doc_id", F.lit(None).cast("int").alias("toxic"))))
    assert model.logistic
    got = toxicity.score(tricky, model)
    assert got.columns == tricky.columns[:-1] + ["score"] and got.count() == 10   # the clashing column is replaced
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert toxicity.score(tricky.limit(0), model).count() == 0


def test_op4_query(spark):
    got = {r.doc_id: r for r in q.op4_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic is not null").collect()
    assert len(got) == 10_000
    assert all(r.held_out == (crc(k, 5) == 0) and r.predicted == int(r.score >= 0.5) for k, r in got.items())
    held = [(got[r.doc_id].score, r.toxic) for r in labels if got[r.doc_id].held_out]
    ranks = {s: i for i, s in enumerate(sorted({s for s, _ in held}))}
    good = [ranks[s] for s, t in held if t]
    bad = [ranks[s] for s, t in held if not t]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9


# ---- language --------------------------------------------------------------

def brute_bits(samples, text, order=lang_ppm.ORDER):
    """Code length of a text by plain dictionaries, PPM with escape method C
    and exclusion."""
    counts = {}
    for s in samples:
        s = b" " * order + s
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts.setdefault(s[i - k:i], Counter())[s[i]] += 1
    text = b" " * order + text
    bits = 0.0
    for i in range(order, len(text)):
        gone = set()
        for k in range(order, -1, -1):
            c = counts.get(text[i - k:i])
            if c is None:
                continue
            left = {b: n for b, n in c.items() if b not in gone}
            total = sum(left.values()) + len(left)
            if text[i] in left:
                bits += math.log2(total / left[text[i]])
                break
            if left:
                bits += math.log2(total / len(left))
            gone |= c.keys()
        else:
            bits += math.log2(256 - len(gone))
    return bits


def test_code_lengths_are_exact():
    samples = {"en": [b"the cat and the dog", b"then they went away"], "de": ["der hund und die katze für".encode()]}
    model = lang_ppm.Identifier(samples)
    texts = [b"the hund", "für zq\x01 thx".encode(), b"", b"a", b"the the the " * 30]
    for t, got in zip(texts, model.total_bits(texts)):
        assert np.allclose(got, [brute_bits(samples[n], t) for n in model.names], rtol=1e-5)


def test_small_table_and_blocks_change_nothing(monkeypatch):
    samples = {"a": [b"abc abd xyz " * 9], "b": [b"zyx cba dba " * 9]}
    texts = [b"abc zyx " * 50, b"x", b"", b"cba " * 77]
    want = lang_ppm.Identifier(samples).total_bits(texts)
    monkeypatch.setattr(lang_ppm, "SLOTS", 16)
    monkeypatch.setattr(lang_ppm, "BLOCK", 13)
    assert np.allclose(lang_ppm.Identifier(samples).total_bits(texts), want, rtol=1e-6)


def test_language_tricky_rows(spark, tricky):
    got = lang_ppm.identify(tricky, lang_ppm.learn(tricky)).collect()
    assert len(got) == 10
    for r in got:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1
    assert {r.lang_pred for r in got} <= {"en", "fr", "de", "und"}
    assert {r.lang_pred for r in lang_ppm.identify(tricky, {}).collect()} == {"und"}
    assert lang_ppm.identify(tricky.limit(0), lang_ppm.learn(tricky.limit(0))).count() == 0


def test_op9_query(spark):
    lang = {r.doc_id: r.lang for r in common.table(spark, SF01, "documents").collect()}
    got = q.op9_language(spark, SF01).collect()
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) for r in got) and len(got) == len(lang)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.97


# ---- HTML ------------------------------------------------------------------

LONG = "The words of this paragraph are what the reader came for, and it is the main text of the page, so that all of it is kept. " * 2
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style></head><body><header><h1>Site</h1><p>{LONG}</p></header>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice"><p>{LONG}</p></div>%s
<div id="comments"><p>First! {LONG}</p></div><aside><p>{LONG}</p></aside><form><p>Name {LONG}</p></form>
<script>var a = "<p>no</p>";</script><footer><p>&copy; {LONG}</p></footer></body></html>"""
BODY = f"<h2>A title</h2><p>{LONG}<br>a&amp;b &#233;&nbsp;x</p><p>Short.</p><!-- <p>no</p> --><p><b>{LONG}</p>"
TEXT = f"A title\n{LONG.strip()} a&b é x\nShort.\n{LONG.strip()}"


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", "<div id=content>%s</div>", "<article>%s", "<main><div class=sidebar><p>Side</p></div><article>%s</article></main>"])
def test_article_is_found(around):
    page = PAGE % (around % BODY)
    if around == "<article>%s":   # left open: the rest has names of its own
        assert html_extract.main_text(page) == TEXT
    else:
        assert html_extract.main_text(page) == TEXT


def test_link_lists_and_ambiguous_blocks():
    links = "<div>" + "".join(f"<p><a href=x>Read more about number {i} of them all</a></p>" for i in range(5)) + "</div>"
    assert html_extract.main_text(f"<p>{LONG}</p><p>In between.</p><p>{LONG}</p>{links}<p>After.</p>{links}") == f"{LONG.strip()}\nIn between.\n{LONG.strip()}"


@pytest.mark.parametrize("page", ["", None, "<p", "<!-- x", "<script>x", "<p attr='x", "</p></div>", "<a b='" * 3_000, "<div>" * 5_000])
def test_broken_pages(page):
    assert html_extract.main_text(page) == ""


def test_signs_that_are_text():
    assert html_extract.main_text("<article>" + "<" * 20_000) == "<" * 20_000
    assert html_extract.main_text("1 < 2 & 3 &am") == "1 < 2 & 3 &am"


def test_op7_query(spark, tricky):
    import html
    import re
    got = {r.page_id: r for r in q.op7_html(spark, SF).collect()}
    pages = {r.page_id: r.html for r in common.table(spark, SF, "pages").collect()}
    assert got.keys() == pages.keys()
    for k, page in pages.items():
        body = page[page.index("<article>") + 9:]
        body = body[:body.find("</article>")] if "</article>" in body else body
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[k].text == "\n".join(p for p in parts if p) and got[k].n_chars == len(got[k].text)
    rows = html_extract.extract(tricky, "text", "SCORE").collect()
    assert len(rows) == 10 and all(r.SCORE is not None for r in rows)
    assert html_extract.extract(tricky.limit(0), "text").count() == 0


def test_blocks_decide_without_the_article_tag(spark):
    """Block rules alone: the same pages with the article renamed."""
    import re
    df = common.table(spark, "/root/testdata/sf0.01", "pages")
    stops = html_extract.learn_stops(df)
    assert len(stops - html_extract.STOPS) <= html_extract.STOP_WORDS and {"de", "the"} <= stops
    scores = []
    for (page,) in df.select("html").collect():
        want = html_extract.main_text(page, stops).split("\n")
        got = html_extract.main_text(re.sub(r"(</?)(article|main)\b", r"\1div", page), stops).split("\n")
        scores.append(2 * len(set(want) & set(got)) / (len(set(want)) + len(set(got))))
    assert np.mean(scores) >= 0.95


def test_stop_words_are_learnt_from_the_pages(spark):
    rows = [(f"<p>qux zul{chr(97 + i)} the <b>qux</b></p><script>var hidden</script><!-- note --><i class=cls>",) for i in range(10)] + [(None,), ("",)]
    learnt = html_extract.learn_stops(spark.createDataFrame(rows, "html string"))
    assert learnt - html_extract.STOPS == {"qux"}
    assert html_extract.learn_stops(spark.createDataFrame([], "html string")) == html_extract.STOPS


@pytest.mark.parametrize("tag", ["button", "select", "object", "canvas", "video", "audio", "noscript", "svg", "template"])
def test_elements_left_open_hide_nothing(tag):
    assert html_extract.main_text(f"<article><p>{LONG}</p><{tag} x=1><p>{LONG}</p>") == f"{LONG.strip()}\n{LONG.strip()}"
    assert html_extract.main_text(f"<article><p>{LONG}</p><{tag} x=1><p>Hidden</p></{tag}><p>{LONG}</p>") == f"{LONG.strip()}\n{LONG.strip()}"


def test_long_pages_take_linear_time():
    import time
    start = time.process_time()
    assert html_extract.main_text("".join(f"<p>short {i}</p>" for i in range(50_000))).count("\n") == 49_999
    html_extract.main_text("<nav><button><form>x" * 20_000 + "</p>")
    assert time.process_time() - start < 10


# ---- chats -----------------------------------------------------------------

def test_snapshots_collapse(spark):
    base = [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", None), ("assistant", ""), (None, "end")]
    other = [("user", "hi"), ("assistant", "hello")]
    logged = {10: base[:1], 3: base[:2], 11: base[:4], 12: base, 13: base, 14: other, 15: base[:3] + [("user", "else")], 16: base[:3], None: other[:1]}
    rows = [(c, t * 2, r, x, 0) for c, turns in logged.items() for t, (r, x) in enumerate(turns)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    want = {}
    for c, turns in logged.items():
        bigger = any(len(o) > len(turns) and o[:len(turns)] == turns for o in logged.values())
        first = min((k for k, o in logged.items() if o == turns), key=lambda k: (k is not None, k))
        if not bigger and first == c:
            want[c] = (len(turns), sum(o == turns for o in logged.values()), sum(o == turns[:len(o)] for o in logged.values()),
                       "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in turns))
    assert {k: (r.n_turns, r.n_copies, r.n_snapshots, r.text) for k, r in got.items()} == want
    assert chat.format_chats(df.limit(0)).count() == 0


def test_snapshots_rows_without_id_and_hot_prefixes(spark):
    # a first turn that all share, a third of the rows copies of one
    # conversation, equal and other rows without an id
    turns = {c: [("user", "hi"), ("assistant", f"answer {c % 7}"), ("user", f"bye {c}")] for c in range(40)}
    turns |= {c: [("user", "hi"), ("assistant", "the same")] for c in range(100, 140)}
    turns |= {200: [("user", "hi")], 201: [("user", "hi"), ("assistant", "answer 3")], 202: [("user", "alone")]}
    rows = [(c, t, r, x) for c, said in turns.items() for t, (r, x) in enumerate(said)]
    rows += [(None, t, "user", "hi") for t in range(5)] + [(None, 1, "user", "lost")] * 3 + [(None, 1, None, None), (None, 2, "user", "alone")]
    held = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    want = {(c, f"bye {c}"): (1, 1 + 6 + (c % 7 == 3)) for c in range(40)}
    want |= {(100, "the same"): (40, 40 + 6), (202, "alone"): (2, 2), (None, "lost"): (3, 3), (None, None): (1, 1)}
    for hot in (chat.HOT, 0.05, 2.0):
        got = {(r["conv_id"], r["turns"][-1]["text"]): (r["n_copies"], r["n_snapshots"]) for r in chat.maximal(held, hot).collect()}
        assert got == want


def test_op6_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = sorted(map(tuple, con.sql(q.ORACLE["op6_chat"]).fetchall()))
    assert sorted(map(tuple, q.op6_chat(spark, SF).collect())) == want and want


# ---- pipeline --------------------------------------------------------------

def test_pipeline_against_plain_stages(spark):
    """Each stage against a brute-force version on its own input."""
    docs = common.table(spark, SF, "documents")
    inputs = []
    for name, apply in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = common.stage(apply(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == inputs[0].columns
    toxic_in, lang_in, sim_in, pack_in = [[tuple(r) for r in d.collect()] for d in inputs]
    scorer = toxicity.Scorer(q.toxicity_model(spark, SF))
    assert sorted(lang_in) == sorted(r for r in toxic_in if scorer.score(r[1]) < 0.5)
    model = lang_ppm.Identifier(q.language_sample(spark, SF))
    said = model.identify([r[1] for r in lang_in])
    assert sorted(sim_in) == sorted(r for r, (lang, _, bits) in zip(lang_in, said) if lang != "und" and bits < 8)
    from test_pairs import brute_components, brute_fingerprint
    classes = brute_components([(r[0], brute_fingerprint(r[1])) for r in sim_in])
    assert sorted(pack_in) == sorted(r for r, c in zip(sim_in, classes) if r[0] == c)
    got = docs.collect()
    assert {r.doc_id for r in got} == {r[0] for r in pack_in}
    assert corpus_pipeline.run(spark, SF).count() == len(got)


def test_stages_on_tricky_documents(spark, tricky):
    docs = tricky.drop("SCORE").withColumn("lang_pred", F.lit("x")).withColumn("Score", F.lit(2)).withColumn("_toxic", F.lit(3))
    rows = Counter(tuple(r) for r in docs.collect())
    kept = []
    for name, apply in corpus_pipeline.STAGES[:3]:
        out = apply(spark, docs, SF)
        assert out.columns == docs.columns and apply(spark, docs.limit(0), SF).count() == 0
        docs = out
        got = out.collect()
        assert not Counter(tuple(r) for r in got) - rows   # values are left as they are
        kept.append(sorted(str(r.doc_id) for r in got))
    assert kept[0] == sorted(["1", "1", "2", "3", "4", "None", "6", "7", "8", "9"])
    # no letter: 2, 3, 4, 6; 8 is 20,000 times one letter, in no language
    assert kept[1] == sorted(["1", "1", "None", "7", "9"])
    assert kept[2] == sorted(["1", "None", "7", "9"])
    packed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {1, None, 7, 9}
    assert corpus_pipeline.STAGES[3][1](spark, docs.limit(0), SF).count() == 0


def test_sample_is_bounded_and_whole(spark):
    rows = [("a", f"text {i % 50}") for i in range(400)] + [("b", "same")] * 300 + [("c", "x" * 100), ("c", "yy"), (None, "z"), ("d", ""), ("d", None)]
    known = common.hashed(spark.createDataFrame(rows, "label string, text string"))
    got = common.sample_texts(known, known, 10, 1000)
    assert got.keys() == {"a", "b", "c"} and len(set(got["a"])) == len(got["a"]) == 10
    assert got["b"] == ["same"] and sorted(got["c"]) == ["x" * 100, "yy"]
    assert common.sample_texts(known, known, {"a": 3}, 10)["a"] and common.sample_texts(known, known, 5, 50)["c"] == ["yy"]
    assert common.sample_texts(known.limit(0), known, 5, 50) == {}


def test_long_texts_do_not_displace_others(spark):
    """Forty texts of nearly the budget, as many of half of it and some over
    it, whatever their hashes."""
    rows = [(k, f"{i} " + "x" * n) for k in "ab" for n, m in ((20, 300), (9_000, 40), (4_900, 40), (10_001, 40)) for i in range(m)]
    rows += [("c", f"{i} " + "y" * n) for n, m in ((7_000, 5), (2_000, 3)) for i in range(m)]
    known = common.hashed(spark.createDataFrame(rows, "label string, text string"))
    got = common.sample_texts(known, known, 100, 10_000)
    assert all(len(got[k]) == 100 and sum(map(len, got[k])) <= 10_000 and max(map(len, got[k])) < 30 for k in "ab")
    # all are long: what fits behind the first is still taken
    assert len(got["c"]) > 1 and sum(map(len, got["c"])) <= 10_000
    few = common.sample_texts(known, known, {"a": 100}, 10_000)
    assert few.keys() == {"a"} and few["a"] == got["a"]
    # where the short ones are a few in a thousand, they are drawn by their own number
    many = [("a", f"{i} " + "x" * 2_000) for i in range(3_000)] + [("a", f"{i}") for i in range(60)]
    known = common.hashed(spark.createDataFrame(many, "label string, text string"))
    assert sum(len(t) < 10 for t in common.sample_texts(known, known, 20, 4_000)["a"]) == 20
