"""Chat formatting: logged snapshots of a growing conversation collapse to the longest one, then are rendered.

A conversation is the turns of one id, ordered by turn number, role and text (nulls first); equal rows are
one turn. Its prefix hashes roll over the turns: each is the digest of the one before and the turn's own
digest. A conversation whose last hash is an inner prefix hash of another one is a snapshot of it and goes; of
equal ones the smallest id stays. Both steps are joins on one hash of each different conversation.

Everything is DataFrame functions. Rows without id take no part; a null role is rendered as 'unknown', a
null text as empty; an id alone with nulls is a conversation of one turn. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.session import materialize

START, END = "<|im_start|>", "<|im_end|>"


def with_prefix_hashes(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns, hashes): one row for each conversation."""
    own = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    listed = turns.where(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id")).agg(F.array_sort(F.collect_set(own)).alias("turns"))
    listed = listed.withColumn("turns", F.sort_array("turns"))
    digest = F.transform("turns", lambda t: F.sha2(F.to_json(F.struct(t["role"], t["text"])), 256))
    rolled = F.aggregate(
        digest,
        F.array().cast("array<string>"),
        lambda done, d: F.concat(done, F.array(F.sha2(F.concat(F.coalesce(F.get(done, F.size(done) - 1), F.lit("")), d), 256))),
    )
    return listed.withColumn("hashes", rolled)


def collapse(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns, copies): maximal conversations, and how many equal ones were logged."""
    listed, _ = materialize(with_prefix_hashes(turns, conv_id, turn, role, text), "conversations")
    whole = F.element_at("hashes", -1)
    different = listed.select("conv_id", whole.alias("hash")).groupBy("hash").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = listed.select(F.explode(F.slice("hashes", 1, F.size("hashes") - 1)).alias("hash")).distinct()
    maximal = different.join(inner, "hash", "left_anti").select("conv_id", "copies")
    return listed.select("conv_id", "turns").join(maximal, "conv_id")


def render(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, rendered) of collapsed conversations."""
    shown = F.transform(
        "turns",
        lambda t: F.concat(F.lit(START), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(END + "\n")),
    )
    return conversations.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "copies", F.array_join(shown, "").alias("rendered"))
