"""Character, word and subword vocabularies with sequence statistics.

A profile holds one row per token: its frequency, plus the share of the sequence statistics that
was met along with it. Vocabulary and statistics both follow from it, so the corpus is read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repoquarry.functions import text as tx
from repoquarry.operators.ranking import rank_ids, top_n
from repoquarry.schemas import text_column

# Fixed value: width of the embedding matrix a vocabulary would need.
EMBEDDING_DIMENSION = 128

_CODE_POINTS = 0x110000
_WINDOW = 8 << 20  # bytes of text decoded at once
_PROFILE_SCHEMA = (
    "token STRING, frequency BIGINT, sequences BIGINT, filled BIGINT, shortest BIGINT, longest BIGINT"
)


def documents(df: DataFrame, skip_blank: bool = False) -> DataFrame:
    """One column ``text`` from source_code, code or file_path."""
    texts = df.select(text_column(df).alias("text"))
    return texts.filter(~tx.is_blank(F.col("text"))) if skip_blank else texts


def cut_points(offsets: np.ndarray, most: int) -> list[int]:
    """Rows at which to cut a batch with these 64-bit offsets so that a piece has at most ``most`` bytes, or one row."""
    cuts = [0]
    while cuts[-1] < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[cuts[-1]] + most, side="right")) - 1
        cuts.append(max(end, cuts[-1] + 1))
    return cuts


def _pieces(batch: pa.RecordBatch, column: int, most: int = _WINDOW) -> Iterator[pa.RecordBatch]:
    """A batch cut into pieces by the bytes of a text column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    cuts = cut_points(offsets, most)
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _code_points(column: pa.Array) -> np.ndarray:
    """Characters of all texts of a piece, one after the other."""
    whole = "".join(s or "" for s in column.to_pylist())
    return np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")


class _FirstPlaces:
    """Smallest (position, place) at which each character was met."""

    def __init__(self):
        self.places: dict[int, tuple] = {}

    def add(self, piece: pa.RecordBatch) -> None:
        ordered = piece.take(pc.sort_indices(piece.column(1), null_placement="at_start"))
        lengths = pc.fill_null(pc.utf8_length(ordered.column(0)), 0).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        codes, at = np.unique(_code_points(ordered.column(0)), return_index=True)
        row = np.searchsorted(starts, at, side="right") - 1
        positions = ordered.column(1).take(pa.array(row)).to_pylist()
        for code, position, place in zip(codes.tolist(), positions, (at - starts[row]).tolist(), strict=True):
            new = (position is not None, position, place)  # no position comes first, as in Spark's order
            old = self.places.get(code)
            if old is None or (new[0], new[1:] if new[0] else new[2]) < (old[0], old[1:] if old[0] else old[2]):
                self.places[code] = new


def _character_counter(with_places: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_CODE_POINTS, dtype=np.int64)
        first = _FirstPlaces()
        sequences = filled = longest = 0
        shortest = position_type = None
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
            if len(lengths):
                sequences += len(lengths)
                filled += int((lengths > 0).sum())
                least = int(lengths.min())
                shortest = least if shortest is None else min(shortest, least)
                longest = max(longest, int(lengths.max()))
            for piece in _pieces(batch, 0):
                found = np.bincount(_code_points(piece.column(0)))
                counts[: len(found)] += found
                if with_places:
                    first.add(piece)
            position_type = batch.schema.field(1).type if with_places else None
        used = np.nonzero(counts)[0]
        if sequences:
            tokens = [chr(c) for c in used] + [None]
            none = [None] * len(used)
            columns = {
                "token": pa.array(tokens, pa.string()),
                "frequency": pa.array([*counts[used].tolist(), 0], pa.int64()),
                "sequences": pa.array([*none, sequences], pa.int64()),
                "filled": pa.array([*none, filled], pa.int64()),
                "shortest": pa.array([*none, shortest], pa.int64()),
                "longest": pa.array([*none, longest], pa.int64()),
            }
            if with_places:
                places = [first.places[c] for c in used.tolist()]
                columns["position"] = pa.array([*(p[1] for p in places), None], position_type)
                columns["place"] = pa.array([*(p[2] for p in places), None], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return count


def _merge_profile(parts: DataFrame) -> DataFrame:
    first = [F.min(F.struct("position", "place")).alias("first")] if "place" in parts.columns else []
    return parts.groupBy("token").agg(
        F.sum("frequency").alias("frequency"),
        F.sum("sequences").alias("sequences"),
        F.sum("filled").alias("filled"),
        F.min("shortest").alias("shortest"),
        F.max("longest").alias("longest"),
        *first,
    )


def character_profile(texts: DataFrame, position: str | None = None) -> DataFrame:
    """Each task counts its characters in one array and sends a row per character it met.

    ``position`` names a number or text that orders the texts; with it the profile has ``first``, the
    smallest (position, place in the text) of each character.
    """
    if position is None:
        return _merge_profile(texts.select("text").mapInArrow(_character_counter(False), _PROFILE_SCHEMA))
    placed = texts.select("text", F.col(position).alias("position"))
    kind = placed.schema["position"].dataType.simpleString()
    schema = f"{_PROFILE_SCHEMA}, position {kind}, place BIGINT"
    return _merge_profile(placed.mapInArrow(_character_counter(True), schema))


def token_profile(sequences: DataFrame, tokens: Column | str = "tokens", position: str | None = None) -> DataFrame:
    """Profile of an ARRAY<STRING> column. An empty sequence is one row without a token.

    With ``position``, a column that orders the sequences, the profile has ``first`` as for characters.
    """
    array = F.col(tokens) if isinstance(tokens, str) else tokens
    order = [F.col(position).alias("position")] if position else []
    sized = sequences.select(array.alias("tokens"), *order).withColumn("n", F.size("tokens").cast("bigint"))
    rows = sized.select("n", *(["position"] if position else []), F.posexplode_outer("tokens").alias("pos", "token"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    one = F.lit(1).cast("bigint")
    length = F.when(first, F.col("n"))
    place = F.struct("position", F.col("pos").cast("bigint").alias("place")) if position else None
    return rows.groupBy("token").agg(
        F.count("token").alias("frequency"),
        F.sum(F.when(first, one)).alias("sequences"),
        F.sum(F.when(F.col("pos") == 0, one)).alias("filled"),
        F.min(length).alias("shortest"),
        F.max(length).alias("longest"),
        *([F.min(place).alias("first")] if position else []),
    )


def word_profile(texts: DataFrame, position: str | None = None) -> DataFrame:
    return token_profile(texts, tx.word_tokens(F.col("text")), position)


def frequencies(profile: DataFrame) -> DataFrame:
    """(token, frequency), and ``first`` where the profile has it."""
    first = ["first"] if "first" in profile.columns else []
    return profile.filter(F.col("token").isNotNull()).select("token", "frequency", *first)


def vocabulary(frequency: DataFrame, ties: str = "token") -> DataFrame:
    """(token, token_id, frequency): ids from 1 by falling frequency. Runs a job.

    Equal frequencies are ordered by token, or with ``ties="first_seen"`` by the place of ``first``.
    """
    if ties not in ("token", "first_seen"):
        raise ValueError(f"ties are broken by token or first_seen, not by {ties}")
    second = "token" if ties == "token" else "first"
    ranked = rank_ids(frequency.select("token", "frequency", *({second} - {"token"})), [F.desc("frequency"), F.asc(second)])
    return ranked.select("token", "token_id", "frequency")


def top_tokens(frequency: DataFrame, n: int = 50) -> DataFrame:
    return top_n(frequency.select("token", "frequency"), [F.desc("frequency"), F.asc("token")], n)


def sequence_statistics(
    profile: DataFrame, tokenizer: str, vocabulary_size: int | None = None
) -> DataFrame:
    """One row of statistics. The average is over sequences that hold tokens, the extremes over all.

    ``vocabulary_size`` is given where the vocabulary is larger than the set of tokens met.
    """
    zero = F.lit(0).cast("bigint")
    met = F.count("token")
    size = F.lit(vocabulary_size).cast("bigint") if vocabulary_size is not None else F.col("tokens_observed")
    totals = profile.agg(
        met.alias("tokens_observed"),
        F.coalesce(F.sum("sequences"), zero).alias("total_sequences"),
        F.coalesce(F.sum("frequency"), zero).alias("total_tokens"),
        F.coalesce(F.sum("filled"), zero).alias("_filled"),
        F.coalesce(F.min("shortest"), zero).alias("min_sequence_length"),
        F.coalesce(F.max("longest"), zero).alias("max_sequence_length"),
    )
    average = F.when(F.col("_filled") > 0, F.col("total_tokens") / F.col("_filled")).otherwise(F.lit(0.0))
    return totals.select(
        F.lit(tokenizer).alias("tokenizer"),
        size.alias("vocabulary_size"),
        "total_sequences",
        "total_tokens",
        "tokens_observed",
        average.alias("average_sequence_length"),
        "min_sequence_length",
        "max_sequence_length",
        F.lit(EMBEDDING_DIMENSION).cast("bigint").alias("embedding_dimension"),
        (size * EMBEDDING_DIMENSION).alias("embedding_parameters"),
    )


def with_character_ids(
    df: DataFrame, vocabulary_table: DataFrame, text: str = "text", name: str = "token_ids"
) -> DataFrame:
    """Add the character ids of a text as ARRAY<INT>, 0 for characters outside the vocabulary.

    The lookup table has one slot per Unicode code point (4.5 MB whatever the corpus), so it goes to
    every task and no text is shuffled. Batches are worked on in pieces of a few megabytes. Runs a job.
    """
    table = np.zeros(_CODE_POINTS, dtype=np.int32)
    for row in vocabulary_table.select("token", "token_id").filter(F.length("token") == 1).collect():
        table[ord(row["token"])] = row["token_id"]
    shared = df.sparkSession.sparkContext.broadcast(table)
    kept = df.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    place = kept.columns.index(text)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch, place):
                column = piece.column(place)
                lengths = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
                offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(shared.value[_code_points(column)]))
                yield pa.RecordBatch.from_arrays([*piece.columns, found], names=schema.names)

    return kept.mapInArrow(ids, schema)
