"""Picking tokens by rank and pairs of tokens to compare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.operators.vocabulary import top_tokens
from repoquarry.schemas import token_frequency_columns

# Size of the candidate list and of a selection from it.
CANDIDATES = 50
SELECTION = 20


def ranked_top(frequency: DataFrame, n: int = CANDIDATES) -> DataFrame:
    """(rank, token, frequency) of the top ``n`` tokens; the array that is numbered has ``n`` entries."""
    top = top_tokens(token_frequency_columns(frequency), n)
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("frequency")).alias("f"), F.col("token"))))
    numbered = top.agg(ordered.alias("rows")).select(F.posexplode("rows").alias("pos", "row"))
    return numbered.select(
        (F.col("pos") + 1).alias("rank"),
        F.col("row.token").alias("token"),
        (-F.col("row.f")).alias("frequency"),
    )


def check_ranks(ranks: Sequence[int], count: int, candidates: int = CANDIDATES) -> None:
    if len(ranks) != count:
        raise ValueError(f"exactly {count} ranks are needed, got {len(ranks)}")
    if len(set(ranks)) != count:
        raise ValueError("a rank may be chosen only once")
    if any(r < 1 or r > candidates for r in ranks):
        raise ValueError(f"ranks run from 1 to {candidates}")


def select_tokens(
    frequency: DataFrame, ranks: Sequence[int], count: int = SELECTION, candidates: int = CANDIDATES
) -> DataFrame:
    """(idx, rank, token, frequency) of the chosen ranks, ``idx`` in the order they were chosen."""
    check_ranks(ranks, count, candidates)
    chosen = F.array_position(F.array(*map(F.lit, ranks)), F.col("rank")) - 1
    picked = ranked_top(frequency, candidates).filter(F.col("rank").isin(list(ranks)))
    return picked.select(chosen.cast("int").alias("idx"), "rank", "token", "frequency")


def related_pairs(pairs: DataFrame) -> DataFrame:
    """Chosen (token_a, token_b) pairs; a token is not related to itself."""
    return pairs.select("token_a", "token_b").filter(F.col("token_a") != F.col("token_b"))
