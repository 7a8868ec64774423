"""Corpus pipeline: documents -> sequences, in stages that each keep or pack
all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. Filtering
stages return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import lang_ppm, packing, simhash, toxicity
from zonecast.llm.common import stage, table, work_name
from zonecast.llm.queries import language_sample, toxicity_model

#: A text that no learnt language codes in fewer bits than bytes taken at
#: random is in none of them.
RANDOM_BITS = 8.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents scored 0.5 or more go."""
    mark = work_name(docs, "toxic")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), score_col=mark)
    return scored.where(F.col(mark) < 0.5).drop(mark)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents without a letter, or that no learnt language
    codes better than chance, go."""
    mark = work_name(docs, "language")
    found = lang_ppm.with_language(docs, language_sample(spark, sf_dir), out_col=mark)
    known = (F.col(mark)["lang_pred"] != lang_ppm.UNKNOWN) & (F.col(mark)["bits_per_byte"] < RANDOM_BITS)
    return found.where(known).drop(mark)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group stays, that of the smallest id."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: pieces of what is left, packed into sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("language", drop_unknown_language),
          ("simhash", drop_near_duplicates), ("packing", pack_sequences)]

#: Learnt scores and searches cannot be said in SQL; tests/llm hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
