"""Moving vectors of tokens with similar spelling towards each other."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.functions.text import character_set, characters
from repoquarry.operators.pairs import (
    BLOCK_ROWS,
    DIGITS,
    _group_similarities,
    _own_pairs,
    _pair_frame,
    _sides,
    by_block_pair,
    pair_listing,
    pair_schema,
)
from repoquarry.operators.token_vectors import VECTOR_SIZE
from repoquarry.session import materialize

# Step towards the partner, and the overlap from which two tokens are related.
LEARNING_RATE = 0.05
MIN_OVERLAP = 0.40

_SLOTS_PER_TASK = 8


def _group_overlaps(group: pd.DataFrame) -> np.ndarray:
    """Overlap of each row of one block with each of the other: shared characters by the smaller set."""
    sizes = group["characters"].map(len).to_numpy()
    flat = np.concatenate([*group["characters"], np.zeros(0, object)]).astype(str)
    _, code = np.unique(flat, return_inverse=True)
    member = np.zeros((len(group), code.max(initial=-1) + 1), np.float32)
    member[np.repeat(np.arange(len(group)), sizes), code] = 1
    rows, columns = _sides(group)
    shared = (member[rows] @ member[columns].T).astype(np.float64)
    smaller = np.minimum.outer(sizes[rows], sizes[columns])
    return np.divide(shared, smaller, out=np.zeros_like(shared), where=smaller > 0)


def _with_characters(tokens: DataFrame) -> DataFrame:
    return tokens.select("idx", "token", character_set(F.col("token")).alias("characters"))


def overlapping_pairs(
    tokens: DataFrame, minimum: float = MIN_OVERLAP, blocks: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(idx_1, idx_2, token_1, token_2, character_overlap) of related tokens.

    A set-similarity join by blocks: the sets of two blocks become rows of a table of characters, and one
    matrix product counts what all their pairs share. Only related pairs leave a group.
    """

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        overlaps = _group_overlaps(group)
        a, b, i, j = _own_pairs(group, overlaps >= minimum)
        return _pair_frame(group, i, j, [overlaps[a, b]], ["character_overlap"])

    schema = pair_schema(tokens, ["character_overlap"])
    return by_block_pair(_with_characters(tokens), blocks, ["characters"], kernel, schema, block_rows)


def overlap_degrees(
    tokens: DataFrame, minimum: float = MIN_OVERLAP, blocks: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(idx, token, related, average_overlap): how many tokens each is related to, where it is to any.

    For vocabularies whose related pairs are too many to be listed. Tokens of the same characters are related to
    the same tokens, so blocks hold each set of characters once, with the number of its tokens, and a group
    passes on one row a set. Runs jobs.
    """

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        overlaps = _group_overlaps(group)
        hits = overlaps >= minimum
        values = np.where(hits, overlaps, 0.0)
        rows, columns = _sides(group)
        held = group["words"].to_numpy(np.float64)
        related, total = hits @ held[columns], values @ held[columns]
        if group["_low"].iat[0] == group["_high"].iat[0]:  # a token is not related to itself
            related, total = related - hits.diagonal(), total - values.diagonal()
            met = rows
        else:
            related = np.concatenate([related, held[rows] @ hits])
            total = np.concatenate([total, held[rows] @ values])
            met = np.concatenate([rows, columns])
        own = related > 0
        return pd.DataFrame({"letters": group["token"].to_numpy()[met[own]], "related": related[own].astype(np.int64), "total": total[own]})

    letters = F.array_join(F.array_sort("characters"), "").alias("letters")
    held, _ = materialize(_with_characters(tokens).select("idx", "token", letters), "letters")
    sets = held.groupBy("letters").agg(F.count(F.lit(1)).alias("words"))
    sets = sets.select(F.col("letters").alias("idx"), F.col("letters").alias("token"), characters(F.col("letters")).alias("characters"), "words")
    schema = "letters STRING, related BIGINT, total DOUBLE"
    parts = by_block_pair(sets, blocks, ["characters", "words"], kernel, schema, block_rows)
    of_set = parts.groupBy("letters").agg(F.sum("related").alias("related"), F.sum("total").alias("total"))
    summed = held.join(of_set, "letters").groupBy("idx", "token").agg(F.sum("related").alias("related"), F.sum("total").alias("total"))
    return summed.select("idx", "token", "related", (F.col("total") / F.col("related")).alias("average_overlap"))


def nudge(
    vectors: DataFrame, pairs: DataFrame, rate: float = LEARNING_RATE, size: int = VECTOR_SIZE
) -> DataFrame:
    """Apply the pairs in (idx_1, idx_2) order; later pairs see the vectors moved by earlier ones.

    The move is the same for every vector slot and slots do not mix, so the matrix is turned: each
    group holds a few slots of all selected tokens plus the pair list, and folds the list over them.
    """
    slots = vectors.select("idx", F.posexplode("vec").alias("slot", "value"))
    matrix = slots.withColumn("_task", F.floor(F.col("slot") / _SLOTS_PER_TASK).cast("int"))
    last_task = (size - 1) // _SLOTS_PER_TASK
    replayed = pairs.select(
        "idx_1", "idx_2", F.explode(F.sequence(F.lit(0), F.lit(last_task))).alias("_task")
    )

    def fold(values: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        table = values.pivot(index="idx", columns="slot", values="value")
        place = {idx: n for n, idx in enumerate(table.index)}
        moved = table.to_numpy(dtype=np.float64).copy()
        ordered = steps.sort_values(["idx_1", "idx_2"])
        for one, two in zip(ordered["idx_1"], ordered["idx_2"]):
            i, j = place[one], place[two]
            a, b = moved[i].copy(), moved[j].copy()
            moved[i] = (1 - rate) * a + rate * b
            moved[j] = (1 - rate) * b + rate * a
        return (
            pd.DataFrame(moved, index=table.index, columns=table.columns)
            .rename_axis(columns="slot")
            .stack()
            .rename("value")
            .reset_index()[["idx", "slot", "value"]]
        )

    folded = (
        matrix.groupBy("_task")
        .cogroup(replayed.groupBy("_task"))
        .applyInPandas(fold, "idx INT, slot INT, value DOUBLE")
    )
    ordered = F.array_sort(F.collect_list(F.struct("slot", "value")))
    rows = folded.groupBy("idx").agg(F.transform(ordered, lambda x: x["value"]).alias("improved"))
    return vectors.join(rows, "idx").select("idx", "token", "vec", "improved")


def nudge_together(vectors: DataFrame, pairs: DataFrame, rate: float = LEARNING_RATE) -> DataFrame:
    """One step of all pairs at once: each vector moves towards its partners as they were before.

    The scale mode of ``nudge``: nothing depends on the order of the pairs, so it is a join with the
    partners and a sum per token and slot, partial before the shuffle. Tokens without partners stay.
    """
    ends = pairs.select(F.col("idx_1").alias("idx"), F.col("idx_2").alias("_partner"))
    ends = ends.unionByName(pairs.select(F.col("idx_2").alias("idx"), F.col("idx_1").alias("_partner")))
    partners = vectors.select(F.col("idx").alias("_partner"), F.col("vec").alias("_theirs"))
    met = ends.join(partners, "_partner").select("idx", F.posexplode("_theirs").alias("slot", "theirs"))
    pulls = met.groupBy("idx", "slot").agg(F.sum("theirs").alias("theirs"), F.count(F.lit(1)).alias("n"))
    own = vectors.select("idx", F.posexplode("vec").alias("slot", "value"))
    n, theirs = F.coalesce("n", F.lit(0)), F.coalesce("theirs", F.lit(0.0))
    moved = own.join(pulls, ["idx", "slot"], "left").select(
        "idx", "slot", ((1 - rate * n) * F.col("value") + rate * theirs).alias("value")
    )
    ordered = F.array_sort(F.collect_list(F.struct("slot", "value")))
    rows = moved.groupBy("idx").agg(F.transform(ordered, lambda x: x["value"]).alias("improved"))
    return vectors.join(rows, "idx").select("idx", "token", "vec", "improved")


def change_summary(improved: DataFrame, blocks: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(pairs, averages before, after and of the change) over all pairs; a group passes on four numbers."""

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        _, _, (before, after) = _group_similarities(group, ["vec", "improved"])
        sums = {"n": [len(before)], "before": [before.sum()], "after": [after.sum()]}
        return pd.DataFrame(sums)

    schema = "n BIGINT, before DOUBLE, after DOUBLE"
    parts = by_block_pair(improved, blocks, ["vec", "improved"], kernel, schema, block_rows)
    sums = parts.agg(*[F.sum(c).alias(c) for c in ("n", "before", "after")])
    return sums.select(
        F.coalesce("n", F.lit(0)).alias("total_pairs_analyzed"),
        F.try_divide("before", "n").alias("average_similarity_before"),
        F.try_divide("after", "n").alias("average_similarity_after"),
        F.try_divide(F.col("after") - F.col("before"), F.col("n")).alias("average_similarity_change"),
    )


def similarity_change(improved: DataFrame, blocks: int | None = None) -> DataFrame:
    """Similarity of every pair before and after, and the change."""
    names: Sequence[str] = ("original_similarity", "improved_similarity")
    listing = pair_listing(improved, blocks, ("vec", "improved"), names)
    return listing.withColumn("change", F.col("improved_similarity") - F.col("original_similarity"))


def top_improvements(changes: DataFrame, n: int = 10) -> DataFrame:
    return changes.orderBy(F.round("change", DIGITS).desc(), "idx_1", "idx_2").limit(n)


def improvement_statistics(pairs: DataFrame, changes: DataFrame) -> DataFrame:
    """Number of related and of all pairs, averages before and after, in one row."""
    related = pairs.agg(F.count(F.lit(1))).scalar()
    averages = changes.agg(
        F.count(F.lit(1)).alias("total_pairs_analyzed"),
        F.avg("original_similarity").alias("average_similarity_before"),
        F.avg("improved_similarity").alias("average_similarity_after"),
        F.avg("change").alias("average_similarity_change"),
    )
    return averages.select(related.alias("related_pairs_detected"), "*")
