"""Token vectors from frequency, position and hashing."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry import session
from repoquarry.functions import vectors as vx
from repoquarry.functions.arrays import open_places
from repoquarry.operators.ranking import rank_ids
from repoquarry.session import materialize

VECTOR_SIZE = 128
PART_SLOTS = 1_024  # slots of one row, where a vector has as many slots as there are repositories
# Weights of the mean, spread, first and last position in a position vector.
POSITION_WEIGHTS = (1.0, 0.20, 0.10, 0.10)
# Fixed value: spread of a random start vector.
RANDOM_SCALE = 0.1


def hash_vector(value: str, size: int = VECTOR_SIZE, unit: bool = True, scale: float = 1.0) -> np.ndarray:
    """Normal vector seeded by a string: first 8 bytes of its SHA-256, little end first."""
    seed = int.from_bytes(hashlib.sha256(value.encode("utf-8")).digest()[:8], "little")
    vector = np.random.default_rng(seed).normal(0.0, scale, size)
    length = np.linalg.norm(vector)
    return vector / length if unit and length > 0 else vector


def _hashed_column(values: pa.Array, size: int, unit: bool, scale: float) -> pa.Array:
    """Vectors of a batch; each different string is hashed once."""
    coded = values.dictionary_encode()
    rows = [hash_vector(str(v), size, unit, scale) for v in coded.dictionary.to_pylist()]
    table = np.array(rows, dtype=np.float64).reshape(len(rows), size)
    flat = table[coded.indices.to_numpy(zero_copy_only=False)].ravel()
    offsets = np.arange(len(values) + 1, dtype=np.int32) * size
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def hash_vectors(tokens: DataFrame, size: int = VECTOR_SIZE) -> DataFrame:
    """Unit vector per token, the same in every run and on every partition."""

    @F.arrow_udf("array<double>")
    def vector(values: pa.Array) -> pa.Array:
        return _hashed_column(values, size, True, 1.0)

    return tokens.withColumn("vec", vector(F.col("token")))


def random_vectors(tokens: DataFrame, size: int = VECTOR_SIZE, scale: float = RANDOM_SCALE) -> DataFrame:
    """Random start vector per token, seeded by the token and so independent of row order."""

    @F.arrow_udf("array<double>")
    def vector(values: pa.Array) -> pa.Array:
        return _hashed_column(values, size, False, scale)

    return tokens.withColumn("vec", vector(F.col("token")))


def repository_shares(files: DataFrame) -> DataFrame:
    """(repository, share of all rows)."""
    counts = files.filter(F.col("repository").isNotNull()).groupBy("repository").count()
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("repository", (F.col("count") / total).alias("share"))


def token_frequencies(selected: DataFrame, frequency: DataFrame) -> DataFrame:
    """Frequency of each selected token, 0 where the table does not know it."""
    known = frequency.select("token", F.col("frequency").cast("double").alias("frequency"))
    joined = selected.select("idx", "token").join(known, "token", "left")
    return joined.select("idx", "token", F.coalesce("frequency", F.lit(0.0)).alias("frequency"))


def frequency_features(selected: DataFrame) -> DataFrame:
    """Add frequency relative to the largest selected one (at least 1), and its logarithm."""
    top = selected.agg(F.greatest(F.max("frequency"), F.lit(1.0))).scalar()
    return selected.withColumn("normalized_frequency", F.col("frequency") / top).withColumn(
        "log_frequency", F.log1p("frequency")
    )


def share_parts(files: DataFrame, part_slots: int = PART_SLOTS) -> DataFrame:
    """(part, shares): the shares of all repositories in name order, so many to a row. Runs a job."""
    ranked = rank_ids(repository_shares(files), [F.asc("repository")], "_slot", start=0)
    part = F.floor(F.col("_slot") / part_slots).cast("int").alias("part")
    ordered = F.array_sort(F.collect_list(F.struct("_slot", "share")))
    return ranked.groupBy(part).agg(F.transform(ordered, lambda s: s["share"]).alias("shares"))


def frequency_parts(selected: DataFrame, files: DataFrame, part_slots: int = PART_SLOTS) -> DataFrame:
    """Unit vectors (relative frequency, log frequency, relative frequency x share per repository) in parts.

    ``selected`` has (idx, token, frequency) rows; repositories are in name order. Part -1 holds the first
    two slots, part p the shares from p x part_slots on. Tokens are listed under each part's number and joined
    with the parts, so no row or group holds all repositories, and lengths are sums over (token, part).
    The repository part is sized by repositories, not by how the tokens are spread over them. Runs jobs.
    """
    features, _ = materialize(frequency_features(selected).select("idx", "token", "normalized_frequency", "log_frequency"), "features")
    parts, _ = materialize(share_parts(files, part_slots), "shares")
    relative = F.col("normalized_frequency")
    last = parts.agg(F.coalesce(F.max("part"), F.lit(-1))).first()[0]
    head = features.select("idx", "token", F.lit(-1).alias("part"), F.array(relative, "log_frequency").alias("vec"))
    if last >= 0:
        listed = features.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last))))
        tail = listed.join(parts, "part").select(
            "idx", "token", "part", F.transform("shares", lambda s: relative * s).alias("vec")
        )
        head = head.unionByName(tail)
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    lengths = head.groupBy(F.col("idx").alias("_idx")).agg(F.sqrt(F.sum(squares)).alias("_length"))
    scaled = F.when(F.col("_length") > 0, F.transform("vec", lambda x: x / F.col("_length"))).otherwise(F.col("vec"))
    return head.join(lengths, F.col("idx") == F.col("_idx")).select("idx", "token", "part", scaled.alias("vec"))


def frequency_vectors(selected: DataFrame, files: DataFrame) -> DataFrame:
    """The same with each token's parts put together to one vector. Runs jobs.

    A vector has a slot per repository; ``frequency_parts`` and ``pairs.part_similarities`` do without the
    whole vectors where those are too many for one row.
    """
    features = frequency_features(selected)
    ordered = F.array_sort(F.collect_list(F.struct("part", "vec")))
    whole = frequency_parts(selected, files).groupBy("idx").agg(F.flatten(F.transform(ordered, lambda p: p["vec"])).alias("vec"))
    return features.join(whole, "idx").select("idx", "token", "frequency", "normalized_frequency", "log_frequency", "vec")


def frequency_components(selected: DataFrame, files: DataFrame, part_slots: int = PART_SLOTS) -> DataFrame:
    """The same vectors in long form (idx, token, slot, value), however many repositories there are."""
    opened = frequency_parts(selected, files, part_slots).select("idx", "token", "part", F.posexplode("vec").alias("_pos", "value"))
    before = F.when(F.col("part") < 0, F.lit(0)).otherwise(2 + F.col("part") * part_slots)
    return opened.select("idx", "token", (before + F.col("_pos")).alias("slot"), "value")


def position_features(selected: DataFrame, sequences: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Where the selected tokens stand in their sequences (0 first, 1 last, 0.5 if alone).

    The selection is written once, so its size is known: one of SELECTION_ROWS rows at most is broadcast, which
    drops all other tokens right after the arrays are opened. Partial averages are made before the
    shuffle. Tokens never met get 0.5 and no spread. Runs a job for the selection.
    """
    selected, _ = materialize(selected.select("idx", "token"), "selection")
    wanted = selected.select("token")
    if selected.count() <= session.SELECTION_ROWS:
        wanted = F.broadcast(wanted)
    opened = open_places(sequences, F.col(tokens), "token")
    place = F.when(F.col("n") == 1, F.lit(0.5)).otherwise(
        F.col("pos") / F.greatest(F.col("n") - 1, F.lit(1))
    )
    stats = (
        opened.join(wanted, "token")
        .groupBy("token")
        .agg(
            F.avg(place).alias("mean_position"),
            F.stddev_pop(place).alias("position_std"),
            F.min(place).alias("minimum_position"),
            F.max(place).alias("maximum_position"),
            F.count(F.lit(1)).alias("occurrences"),
        )
    )
    unseen = {"mean_position": 0.5, "position_std": 0.0, "minimum_position": 0.5, "maximum_position": 0.5}
    joined = selected.join(stats, "token", "left")
    return joined.select(
        "idx",
        "token",
        *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in unseen.items()],
        F.coalesce("occurrences", F.lit(0).cast("bigint")).alias("occurrences"),
    )


def position_vectors(features: DataFrame, size: int = VECTOR_SIZE) -> DataFrame:
    """Unit vector of the weighted sum of four sinusoidal encodings."""
    sources = [
        F.col("mean_position"),
        F.least(F.col("position_std"), F.lit(1.0)),
        F.col("minimum_position"),
        F.col("maximum_position"),
    ]
    vector = vx.sinusoidal(sources[0], size)
    for source, weight in zip(sources[1:], POSITION_WEIGHTS[1:]):
        vector = vx.add(vector, vx.sinusoidal(source, size), weight)
    summed = features.withColumn("_sum", vector)
    return summed.withColumn("vec", vx.l2_normalize(F.col("_sum"))).drop("_sum")
