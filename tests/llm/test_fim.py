"""Fill-in-middle against a plain version on whole texts."""
import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import fim
from zonecast.llm import queries as q

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
texts = st.lists(st.sampled_from(["abc", "Z", " ", "é", "日本", "😀", "<", "P>", "<P", "S", ">", "\n", "12", "<M>", "x" * 9]), max_size=25).map("".join)


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hex_ = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hex_[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, out = "plain", text
    elif h4 % 100 < 20:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    chars = (None, None) if form == "plain" else (len(prefix), len(middle))
    return n, form, *chars, out


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=500, deadline=None)
@given(texts, st.integers(1, 12), st.data())
def test_frames_of_any_size(text, size, data):
    s = fim.store(text.encode(), size)
    units = UNIT.findall(text)
    assert (s.units[-1], s.chars[-1], s.sizes[-1]) == (len(units), len(text), len(text.encode()))
    assert s.marked == any(m in text for m in ("<P>", "<S>", "<M>"))
    a, b = sorted(data.draw(st.tuples(*[st.integers(0, len(units))] * 2)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    for form, want in (("plain", text), ("psm", f"<P>{prefix}<S>{suffix}<M>{middle}"), ("spm", f"<S>{suffix}<P>{prefix}<M>{middle}")):
        out, n_prefix, n_middle = fim.arrange(s, form, a, b)
        assert fim.joined(out).decode() == want
        assert fim.digest(out) == sha(want)
        if form == "plain":
            assert n_prefix is None and n_middle is None
        else:
            assert (n_prefix, n_middle) == (len(prefix), len(middle))
        if form == "plain" or not s.marked:
            assert fim.joined(fim.restore(out, form)).decode() == text
            # any other frames of the same output give the same text
            again = fim.store(want.encode(), size).data
            assert fim.joined(fim.restore(again, form)).decode() == text


def test_only_cut_frames_are_read(monkeypatch):
    text = ("some words and 12 numbers, " * 4000).encode()
    s = fim.store(text, 1000)
    read = []
    unpack = fim._unpack
    monkeypatch.setattr(fim, "_unpack", lambda d: read.append(1) or unpack(d))
    out, _, _ = fim.arrange(s, "psm", s.units[-1] // 3, s.units[-1] // 2)
    assert len(s.data) > 100 and len(read) <= 12
    assert sum(f in set(s.data) for f in out) >= len(s.data) - 2


def test_output_without_markers_is_an_error():
    with pytest.raises(ValueError):
        fim.restore([fim._pack(b"no markers")], "psm")


@pytest.mark.parametrize("size", [fim.FRAME_BYTES, 100])
def test_query_equals_plain(spark, monkeypatch, size):
    monkeypatch.setattr(fim, "FRAME_BYTES", size)
    rows = q.documents(spark, SF).collect()
    want = sorted((r["doc_id"], *(p := plain(r["doc_id"], r["text"]))[:4], sha(p[4]), sha(r["text"])) for r in rows)
    got = sorted(tuple(r) for r in q.op11_fim(spark, SF).collect())
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_cases(spark, tricky):
    docs = tricky.withColumn("FORM", tricky.SCORE).withColumn("_frames", tricky.SCORE)
    more = spark.createDataFrame([(i, t, "en", "a", 1, 0.5, 0.5, 0.5) for i, t in ((20, "a <P> b"), (21, "<S"), (22, "M>x<"), (23, "z" * 500_000))], docs.schema)
    docs = docs.union(more)
    rows = docs.select("doc_id", "text").collect()
    made = fim.transform(docs).withColumn("said", fim.frames_text(fim.F.col("output"))).withColumn("back", fim.frames_text(fim.restored_frames(fim.F.col("output"), fim.F.col("form"))))
    stored = fim.transform(fim.with_frames(docs, out_col="kept"), frames_col="kept")
    assert stored.select("doc_id", "n", "form", "output").exceptAll(made.select("doc_id", "n", "form", "output")).count() == 0
    assert "SCORE" in made.columns and "_frames" in made.columns
    got = sorted((tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "said", "back").collect()), key=str)
    assert got == sorted(((r["doc_id"], *plain(r["doc_id"], r["text"]), r["text"] or "") for r in rows), key=str)
    assert fim.transform(docs.limit(0)).count() == 0
