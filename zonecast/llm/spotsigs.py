"""Document fingerprints by SpotSigs (operator 2), in DataFrame functions.

Method: each common word (anchor) followed by a chain of content words gives
a signature; the fingerprint is the set of a text's signatures. Likeness is
the Jaccard similarity of two sets. For the join, sets are partitioned by
their length so that sets too different in length never meet, prefixes of the
rarest signatures give the candidates within a partition and its neighbour,
and the Jaccard test is pruned by the lengths first.

A text is lower-cased and cut into runs of letters. An anchor's chain is the
next ``CHAIN`` content words, whatever anchors stand between; a chain cut off
by the end of the text counts as it is, with one word at least. Texts without
an anchor take the chain of every content word instead, and texts without a
letter or a content word a single signature of the whole text, so that none is without one.

Cases: null text counts as empty; the empty text has one signature of its
own; equal texts have equal sets; repeated rows are kept. Output columns
replace input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import stage, work_name

#: Anchors: frequent short words of English, German, French and Spanish.
ANCHORS = tuple(dict.fromkeys("""
    the of and to in a is that for it with as be on by this are or an at from was which not have has but they his her
    der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie
    de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son ou
    de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este
""".split()))
CHAIN = 2           # content words behind an anchor
MARK = "\x01"       # stands before an anchor; not a letter, so in no word
BUCKET_ROWS = 256   # rows ordered together
MAX_BUCKETS = 20_000


# ---- signatures ------------------------------------------------------------

def with_signatures(df: DataFrame, text_col: str = "text", out_col: str = "signatures") -> DataFrame:
    """Add ``out_col`` array<bigint>: the sorted distinct signatures."""
    groups, words, zipped = (work_name(df, s) for s in ("groups", "words", "zipped"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    runs = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), " ")
    marked = F.array_join(F.transform(runs, lambda w: F.when(w.isin(*ANCHORS), F.concat(F.lit(MARK), w)).otherwise(w)), " ")
    # each group is a content word with the anchors behind it
    out = df.withColumn(groups, F.transform(F.split(F.concat(F.lit("^ "), marked), f" (?=[^{MARK}])"), lambda g: F.split(g, f" {MARK}")))
    out = out.withColumn(words, F.transform(groups, lambda g: g[0]))
    behind = [F.slice(F.col(words), 2 + k, F.size(words)).alias(f"w{k}") for k in range(CHAIN)]
    out = out.withColumn(zipped, F.arrays_zip(F.col(groups).alias("g"), *behind))

    def spots(z: Column) -> Column:
        chain = [z[f"w{k}"] for k in range(CHAIN)]
        return F.when((F.size(z["g"]) > 1) & z["w0"].isNotNull(), F.transform(F.slice(z["g"], 2, 1 << 30), lambda a: F.xxhash64(a, *chain)))

    found = F.flatten(F.filter(F.transform(zipped, spots), lambda s: s.isNotNull()))
    every = F.transform(F.filter(zipped, lambda z: z["w0"].isNotNull()), lambda z: F.xxhash64(F.lit(MARK), *[z[f"w{k}"] for k in range(CHAIN)]))
    out = out.withColumn(out_col, found)
    no_word = ~text.rlike(r"\p{L}")
    whole = F.array(F.xxhash64(F.lit(MARK), text))
    own = F.when(no_word, whole).when(F.size(out_col) > 0, F.col(out_col)).when(F.size(every) > 0, every).otherwise(whole)
    return out.withColumn(out_col, F.array_sort(F.array_distinct(own))).drop(groups, words, zipped)


def digest(signatures: Column) -> Column:
    """A short name of a signature set: its size and an MD5 of its members."""
    return F.concat_ws("-", F.size(signatures), F.md5(F.array_join(signatures.cast("array<string>"), ",")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets."""
    both = F.size(F.array_intersect(a, b))
    return (both / (F.size(a) + F.size(b) - both)).cast("double")


# ---- the next document -----------------------------------------------------

def _bounds(df: DataFrame, id_col: str) -> list[int]:
    """The largest id of each bucket of about ``BUCKET_ROWS`` rows, from the
    ids alone; all are ids of rows."""
    n = df.where(F.col(id_col).isNotNull()).count()
    parts = min(MAX_BUCKETS, -(-n // BUCKET_ROWS))
    if not parts:
        return []
    ids = df.agg(F.percentile_approx(id_col, [i / parts for i in range(1, parts)] or [1.0], max(10_000, 4 * parts)).alias("q"), F.max(id_col).alias("m")).first()
    return sorted({*ids["q"], ids["m"]})


def _bucket(key: Column, bounds: list[int]) -> Column:
    """The first bucket whose bound is not below the key, by binary search."""
    if not bounds:
        return F.lit(0)
    held = F.lit(bounds)
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(len(bounds))) + 1)))
    state = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds) - 1).alias("hi"))

    def half(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        return F.when(s["lo"] >= s["hi"], s).when(key <= F.get(held, mid), F.struct(s["lo"].alias("lo"), mid.alias("hi"))).otherwise(F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))

    # null keys come behind the smallest
    return F.when(key.isNull(), F.lit(0)).otherwise(F.aggregate(steps, state, half)["lo"])


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: ``id_col``, ``text_col`` length n_chars, edited (the text with its last
    floor(n/3) code points replaced by the first of the next document),
    signatures, edited_signatures and next_signatures.

    The next document is that of the next smaller id, after the last the
    first; rows of one id are ordered by their text's hash, null ids come
    last. Rows are dealt into buckets by ranges of the id, and the top row of
    each bucket is also given to the bucket above it (that of the largest id
    to the lowest), so no window spans more than a bucket.
    """
    bounds = _bounds(df, id_col)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # without any id the first text by its hash follows the last
    top = F.array_position(F.lit(bounds), F.col("id")) > 0 if bounds else F.xxhash64("text") == rows.agg(F.min(F.xxhash64("text"))).scalar()
    rows = rows.withColumn("bucket", _bucket(F.col("id"), bounds))
    above = F.pmod(F.col("bucket") + 1, F.lit(max(1, len(bounds))))
    copies = F.when(F.coalesce(top, F.lit(False)), F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("ghost")), F.struct(above.alias("at"), F.lit(True).alias("ghost")))) \
              .otherwise(F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("ghost"))))
    dealt = rows.withColumn("copy", F.explode(copies)).select("id", "text", F.col("copy.at").alias("at"), F.col("copy.ghost").alias("ghost"))
    order = Window.partitionBy("at").orderBy("ghost", F.col("id").desc_nulls_last(), F.xxhash64("text"))
    n, part = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    said = dealt.withColumn("following", F.coalesce(F.lead("text").over(order), F.lit("")))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - part), F.substring(F.col("following"), F.lit(1), part))
    said = said.select("at", "ghost", "id", F.xxhash64("text").alias("tie"), "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    said = with_signatures(with_signatures(said, "text", "signatures"), "edited", "edited_signatures").drop("text")
    order = Window.partitionBy("at").orderBy("ghost", F.col("id").desc_nulls_last(), "tie")
    said = said.withColumn("next_signatures", F.lead("signatures").over(order))
    return said.where(~F.col("ghost")).select(F.col("id").alias(id_col), "n_chars", "edited", "signatures", "edited_signatures", "next_signatures")


# ---- near duplicates -------------------------------------------------------

def similar_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has ``id_col`` and class (the digest of its
    signature set) for each row; links has a, b, likeness for each pair of
    classes (a < b) of at least ``threshold``.

    Only distinct sets are compared. A set of n signatures can only be that
    like a set of threshold * n to n / threshold signatures, so a class goes
    to the partition of its length and meets its own and the next one below;
    and two such sets share one of the first n - ceil(threshold * n) + 1
    signatures, the rarest first.
    """
    signed = stage(with_signatures(df.select(id_col, text_col), text_col, "sig").select(id_col, "sig").withColumn("class", digest(F.col("sig"))), "signed")
    classes = stage(signed.groupBy("class").agg(F.first("sig").alias("sig")), "classes")
    each = classes.select("class", F.size("sig").alias("n"), F.explode("sig").alias("s"))
    rare = each.join(each.groupBy("s").agg(F.count("*").alias("df")), "s")
    rank = F.row_number().over(Window.partitionBy("class").orderBy("df", "s"))
    prefix = rare.withColumn("r", rank).where(F.col("r") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1)
    # partition p holds lengths from (1 / threshold)^p on
    part = F.floor(F.log(F.col("n")) / math.log(1 / threshold) + 1e-9) if threshold < 1 else F.col("n")
    prefix = prefix.select("class", "s", "n", part.alias("p"))
    near = prefix.withColumn("p", F.explode(F.array(F.col("p"), F.col("p") - 1)))
    a, b = prefix.alias("a"), near.alias("b")
    long_enough = F.least("a.n", "b.n") >= F.lit(threshold) * F.greatest("a.n", "b.n") - 1e-9
    pairs = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.p") == F.col("b.p")) & long_enough & (F.col("a.class") != F.col("b.class")))
    pairs = pairs.select(F.least("a.class", "b.class").alias("a"), F.greatest("a.class", "b.class").alias("b")).distinct()
    left, right = classes.select(F.col("class").alias("a"), F.col("sig").alias("sa")), classes.select(F.col("class").alias("b"), F.col("sig").alias("sb"))
    links = pairs.join(left, "a").join(right, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
    return signed.select(id_col, "class"), links.where(F.col("likeness") >= threshold - 1e-9)
