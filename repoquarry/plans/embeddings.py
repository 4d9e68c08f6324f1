"""Stage four: four kinds of token vectors and how similar they find the same tokens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.operators import contexts as co
from repoquarry.operators import pairs as po
from repoquarry.operators import pieces as bo
from repoquarry.operators import selection as sel
from repoquarry.operators import skipgram
from repoquarry.operators import token_vectors as tv
from repoquarry.session import materialize, ship_package, spread


def embed_and_compare(
    files: DataFrame,
    frequency: DataFrame,
    model: bo.BpeModel,
    ranks: Sequence[int],
    partitions: int,
    epochs: int = skipgram.EPOCHS,
) -> dict[str, DataFrame]:
    """``files`` has (repository, file_path). Paths are encoded once, for all approaches. Runs jobs.

    ``partitions`` tasks train the skip-gram vectors, which depend on their number.
    """
    ship_package(files.sparkSession)
    chosen = sel.select_tokens(frequency, ranks, len(ranks)).select("idx", "token").collect()
    selected = files.sparkSession.createDataFrame(chosen, "idx INT, token STRING")
    tokens = [row["token"] for row in chosen]

    encoded = bo.with_path_tokens(spread(files.select("repository", "file_path")), model)
    sequences, _ = materialize(encoded, "sequences")

    contexts = co.require_contexts(co.token_contexts(sequences, tokens, keep=("file_path",)))
    words = skipgram.train(
        skipgram.training_sequences(sequences), partitions, epochs=epochs
    )
    features = tv.position_features(selected, sequences)
    vectors = {
        "Frequency": tv.frequency_vectors(tv.token_frequencies(selected, frequency), files),
        "Position": tv.position_vectors(features),
        "Word2Vec": skipgram.selected_vectors(selected, words),
        "Code2Vec": co.structural_vectors(selected, contexts),
    }
    listings = reduce(
        DataFrame.unionByName,
        [
            po.pair_listing(v.select("idx", "token", "vec")).withColumn("approach", F.lit(name))
            for name, v in vectors.items()
        ],
    )
    return {
        "selected": selected,
        "position_features": features,
        "contexts": co.context_text(contexts),
        "unknown_tokens": skipgram.unknown_tokens(selected, words),
        "similarity": listings,
        "most_similar": po.top_per_approach(listings),
        "comparison": po.compare_approaches(listings),
        **{f"{name.lower()}_vectors": v.select("idx", "token", "vec") for name, v in vectors.items()},
    }
