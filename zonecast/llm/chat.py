"""Chat formatting with cumulative-snapshot collapse (operator 6).

Method: logs hold a conversation anew after every turn. The turns of each
conversation are hashed one on top of the other, so that every prefix of it
has one rolling hash; a conversation whose hash is that of a proper prefix of
another one is a snapshot, and an anti-join leaves the maximal conversations,
which are then rendered. Of equal conversations the one with the smallest id
is kept.

Scale: copies of one conversation are combined before they are shuffled, and
the one that is kept is fetched by its hash and id together, so that a large
group of copies never meets in a task. Snapshots are counted by a join on
prefix hashes; prefixes that hold a ``HOT`` part of its rows or more (a first
turn that many share) are joined by broadcast, at most ``1 / HOT`` of them,
the others by a shuffle.

Cases: turns are ordered by turn number, those of one number by role and
text (nulls first); null roles and texts are values of their own to the hash
and render as the empty text; equal rows of a conversation are turns of their
own; a row without a conversation id is a conversation of one turn, named
after no id (equal ones are copies of each other, and an id comes before
none); an empty table gives an empty result. Columns other than the four
named take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import stage

#: Marks around a turn, as chat models use them.
START, END = "<|im_start|>", "<|im_end|>"
HOT = 1 / 1_000  # part of the prefix rows from which a prefix is joined by broadcast


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, n (logged copies: 1, or the number of equal rows without an
    id), turns (ordered array of role, text) and prefixes (rolling SHA-256
    after each turn), one row per conversation."""
    rows = df.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).alias("t"))
    named = rows.where("conv_id is not null").groupBy("conv_id").agg(F.lit(1).cast("long").alias("n"), F.array_sort(F.collect_list("t")).alias("turns"))
    # equal rows without an id are counted, never gathered
    loose = rows.where("conv_id is null").groupBy(F.col("t.role").alias("role"), F.col("t.text").alias("text")).agg(F.count("*").alias("n"), F.min("t.turn").alias("turn"), F.first("conv_id").alias("conv_id"))
    held = named.unionByName(loose.select("conv_id", "n", F.array(F.struct("turn", "role", "text")).alias("turns")))

    def tagged(c: Column) -> Column:
        # the length in front keeps the parts of a turn apart; null has none
        return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    none = F.array().cast("array<string>")

    def step(before: Column, t: Column) -> Column:
        last = F.coalesce(F.get(before, F.size(before) - 1), F.lit(""))
        return F.concat(before, F.array(F.sha2(F.concat(last, tagged(t["role"]), tagged(t["text"])), 256)))

    return held.withColumn("prefixes", F.aggregate("turns", none, step))


def maximal(held: DataFrame, hot: float = HOT) -> DataFrame:
    """The conversations that are no proper prefix of another one, one of
    each set of equal ones, with n_copies (how many were equal) and
    n_snapshots (how many logged conversations it stands for: itself, its
    copies, and those that are prefixes of it alone or of others too)."""
    named = held.withColumn("hash", F.element_at("prefixes", -1))
    proper = named.select(F.explode(F.slice("prefixes", 1, F.greatest(F.size("prefixes") - 1, F.lit(0)))).alias("hash")).distinct()
    ids = named.groupBy("hash").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_copies"))
    kept = ids.join(proper, "hash", "left_anti")
    # one key of hash and id: by the hash alone all copies would meet
    key = F.concat("hash", F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit("-"))).alias("key")
    kept = kept.select(key, "hash", "n_copies")
    # each hash that was logged counts for every maximal conversation over it
    over = named.select(key, "prefixes").join(kept.select("key", "hash"), "key").select("hash", F.explode(F.array_distinct("prefixes")).alias("p"))
    over = stage(over, "prefixes")
    uses = over.groupBy("p").agg(F.count("*").alias("uses"))
    logged = ids.select(F.col("hash").alias("p"), F.col("n_copies").alias("n"))
    # at most 1 / hot prefixes can hold that part of the rows
    many = uses.where(F.col("uses") >= F.lit(hot) * over.agg(F.count("*")).scalar()).select("p")
    often = over.join(F.broadcast(logged.join(F.broadcast(many), "p")), "p")
    seldom = over.join(F.broadcast(many), "p", "left_anti").join(logged, "p")
    stands = often.unionByName(seldom).groupBy("hash").agg(F.sum("n").alias("n_snapshots"))
    return named.select(key, "conv_id", "turns", "prefixes").join(kept.join(stands, "hash"), "key").drop("key")


def render(turns: Column, start: str = START, end: str = END) -> Column:
    """One text of the turns, each between its marks."""
    def said(t: Column) -> Column:
        return F.concat(F.lit(start), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(end), F.lit("\n"))

    return F.array_join(F.transform(turns, said), "")


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, n_turns, n_copies, n_snapshots and text of each maximal
    conversation."""
    held = stage(conversations(df, conv_col, turn_col, role_col, text_col), "chats")
    return maximal(held).select("conv_id", F.size("turns").alias("n_turns"), "n_copies", "n_snapshots", render(F.col("turns")).alias("text"))
