"""Neighbour contexts of tokens and the structural vectors made from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry.functions.arrays import open_array
from repoquarry.functions.text import PYTHON_SPACE
from repoquarry.functions.vectors import l2_normalize
from repoquarry.operators.token_vectors import VECTOR_SIZE, hash_vector

# Fixed value: neighbours taken on either side.
CONTEXT_WINDOW = 2

_CACHED_VECTORS = 1 << 16  # of a generation; two are kept
_CONTEXTS_AT_ONCE = 1_024  # their vectors stay in a processor's cache


def _found(tokens: str, selected: Sequence[str], window: int) -> Column:
    """Array of (pos, token, left, right) for selected tokens, cut out of the sequence in place.

    Working inside the row means that a long sequence is never copied once per token.
    """
    all_tokens = F.col(tokens)
    places = F.filter(
        F.transform(all_tokens, lambda t, i: F.when(t.isin(list(selected)), i)), lambda i: i.isNotNull()
    )
    return F.transform(
        places,
        lambda i: F.struct(
            i.alias("pos"),
            F.get(all_tokens, i).alias("token"),
            F.slice(all_tokens, F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window))).alias("left"),
            F.slice(all_tokens, i + 2, F.lit(window)).alias("right"),
        ),
    )


def token_contexts(
    sequences: DataFrame,
    selected: Sequence[str],
    keep: Sequence[str] = (),
    tokens: str = "tokens",
    window: int = CONTEXT_WINDOW,
) -> DataFrame:
    """One row per occurrence of a selected token with its neighbours, clipped at the sequence ends."""
    found = _found(tokens, selected, window)
    return open_array(sequences, found, "c", keep).select(*keep, "c.*")


def context_text(contexts: DataFrame) -> DataFrame:
    """Neighbours as space-joined text."""
    return contexts.withColumn("left_context", F.concat_ws(" ", "left")).withColumn(
        "right_context", F.concat_ws(" ", "right")
    )


def require_contexts(contexts: DataFrame) -> DataFrame:
    """Fail if no selected token occurs at all. Runs a job that stops at the first row."""
    if not contexts.limit(1).collect():
        raise ValueError("none of the selected tokens occurs in the sequences")
    return contexts


class _RoleVectors:
    """Hashed vectors of tokens under their roles, remembered up to a fixed number.

    Of the vectors that were looked up last one generation is kept when the next one begins, so that frequent tokens stay.
    """

    def __init__(self, size: int, most: int = _CACHED_VECTORS):
        self.size, self.most = size, most
        self.known: dict[str, np.ndarray] = {}
        self.before: dict[str, np.ndarray] = {}

    def _vector(self, key: str) -> np.ndarray:
        vector = self.known.get(key)
        if vector is None:
            if len(self.known) >= self.most:
                self.known, self.before = {}, self.known
            vector = self.before.get(key)
            if vector is None:
                vector = hash_vector(key, self.size)
            self.known[key] = vector
        return vector

    def coded(self, role: str, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of the different tokens, each looked up once, and the row of every token."""
        coded = tokens.dictionary_encode()
        table = [self._vector(f"{role}::{t}") for t in coded.dictionary.to_pylist()]
        return np.array(table).reshape(-1, self.size), coded.indices.to_numpy(zero_copy_only=False)


@lru_cache(maxsize=1)
def _role_vectors(size: int) -> _RoleVectors:
    """One for all tasks of a worker, so that a vector is not made again by each of them."""
    return _RoleVectors(size)


def _places(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each list in the flattened array, and its length."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths


def _partial_sums(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roles = _role_vectors(size)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            center, which = roles.coded("CENTER", batch.column("token"))
            sides = [(*roles.coded(role, batch.column(c).flatten()), *_places(batch.column(c))) for role, c in (("LEFT", "left"), ("RIGHT", "right"))]
            tokens = batch.column("token").dictionary_encode().dictionary.to_pylist()
            total = np.zeros((len(tokens), size))
            for a in range(0, batch.num_rows, _CONTEXTS_AT_ONCE):
                own = which[a : a + _CONTEXTS_AT_ONCE]
                vectors = center[own]
                for table, rows, first, lengths in sides:
                    start, length = first[a : a + len(own)], lengths[a : a + len(own)]
                    summed = np.zeros_like(vectors)
                    for k in range(length.max(initial=0)):
                        longer = np.flatnonzero(length > k)
                        summed[longer] += table[rows[start[longer] + k]]
                    vectors += summed
                vectors /= np.sqrt(np.einsum("ij,ij->i", vectors, vectors)).clip(1e-300)[:, None]
                order = np.argsort(own, kind="stable")
                found, at = np.unique(own[order], return_index=True)
                total[found] += np.add.reduceat(vectors[order], at, axis=0)
            for token, part in zip(tokens, total, strict=True):
                sums[token] = sums[token] + part if token in sums else part
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"token": pa.array(list(sums)), "part": pa.array([v.tolist() for v in sums.values()])}
            )

    return run


def _separate(neighbours: str) -> Column:
    """Neighbours travel as space-joined text, so whitespace inside a token separates."""
    blank = F.exists(neighbours, lambda t: (t == "") | t.rlike(f"[{PYTHON_SPACE}]"))
    parts = F.filter(F.split(F.concat_ws(" ", neighbours), f"[{PYTHON_SPACE}]+"), lambda t: t != "")
    return F.when(blank, parts).otherwise(F.col(neighbours))


def structural_vectors(selected: DataFrame, contexts: DataFrame, size: int = VECTOR_SIZE) -> DataFrame:
    """Unit mean of the context vectors of each selected token, the zero vector without any context.

    A context vector is the unit mean of the hashed vectors of the token, its left and its right
    neighbours, each hashed under its role. Every task sends one partial sum per token, so contexts are
    not shuffled and a token with very many occurrences does not fill one task.
    """
    texts = contexts.select("token", _separate("left").alias("left"), _separate("right").alias("right"))
    parts = texts.mapInArrow(_partial_sums(size), "token STRING, part ARRAY<DOUBLE>")
    slots = parts.select("token", F.posexplode("part").alias("slot", "value"))
    sums = slots.groupBy("token", "slot").agg(F.sum("value").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "value")))
    summed = sums.groupBy("token").agg(F.transform(ordered, lambda x: x["value"]).alias("_sum"))
    zero = F.array_repeat(F.lit(0.0), size)
    joined = selected.select("idx", "token").join(summed, "token", "left")
    return joined.withColumn("_sum", F.coalesce("_sum", zero)).select(
        "idx", "token", l2_normalize(F.col("_sum")).alias("vec")
    )
