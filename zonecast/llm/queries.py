"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import align, bpe, chat, decontaminate, fim, html_extract, lang_ppm, packing, simhash, spotsigs, srs, token_count, toxicity
from zonecast.llm.common import crc_bucket, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document, then the text that they decode to, as digests."""
    coded = bpe.encode(documents(spark, sf_dir), decoded_col="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited text, and the likeness to
    the edited text and to the next document."""
    said = spotsigs.edited_fingerprints(documents(spark, sf_dir))
    own = F.col("signatures")
    return said.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       spotsigs.digest(own).alias("fingerprint"), spotsigs.digest(F.col("edited_signatures")).alias("edited_fingerprint"),
                       spotsigs.likeness(own, F.col("edited_signatures")).alias("near_edited"),
                       spotsigs.likeness(own, F.col("next_signatures")).alias("near_next"))


@register
def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.with_budget(documents(spark, sf_dir), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learnt from the label rows whose crc32 bucket of five is not 0."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(crc_bucket(F.col("doc_id"), 5) != 0)
    return toxicity.learn(documents(spark, sf_dir), labels)


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@register
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    chats = chat.format_chats(table(spark, sf_dir, "conversations"))
    return chats.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", "n_snapshots", "text")


ORACLE["op6_chat"] = """
WITH turns AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations),
said AS (
  SELECT conv_id, k, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line,
         coalesce(length(role) || ':' || role, '-') || coalesce(length(text) || ':' || text, '-') AS part FROM turns),
prefixes AS (
  SELECT conv_id, k, string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM said),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(line, '' ORDER BY k) AS text, string_agg(part, '' ORDER BY k) AS body
  FROM said GROUP BY conv_id),
proper AS (
  SELECT DISTINCT p.prefix FROM prefixes p JOIN whole w USING (conv_id) WHERE p.k < w.n_turns),
copies AS (
  SELECT body, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY body),
kept AS (
  SELECT c.*, w.n_turns, w.text FROM copies c JOIN whole w USING (conv_id) WHERE c.body NOT IN (SELECT prefix FROM proper))
SELECT k.conv_id, k.n_turns, k.n_copies, CAST(sum(c.n_copies) AS BIGINT) AS n_snapshots, k.text
FROM kept k JOIN prefixes p USING (conv_id) JOIN copies c ON c.body = p.prefix
GROUP BY k.conv_id, k.n_turns, k.n_copies, k.text
"""


@register
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=3)


def language_sample(spark: SparkSession, sf_dir: str) -> dict[str, list[bytes]]:
    """What language ID may learn from: documents whose crc32 bucket of three
    is not 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lang_ppm.learn(docs.where(crc_bucket(F.col("doc_id"), 3) != 1))


@register
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_ppm.identify(documents(spark, sf_dir), language_sample(spark, sf_dir))
    return found.select("doc_id", (crc_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@register
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return srs.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@register
def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle outputs of each document and the texts rebuilt from
    them, as digests."""
    made = fim.transform(documents(spark, sf_dir))
    sums = made.withColumn("sums", fim.digests(F.col("output"), F.col("form")))
    return sums.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "sums.*")


@register
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside verbatim windows of benchmark items."""
    found = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    spans, items = F.col("found")["spans"], F.col("found")["items"]
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", F.col("found")["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size(spans) > 0).alias("contaminated"))


@register
def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens that two tokenizers end together, and how common
    their linked id pairs are in the corpus."""
    made = align.align(documents(spark, sf_dir))
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
