"""Stage three: texts to vocabularies, subword model, and the similarity experiment on its top tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.operators import nudge as no
from repoquarry.operators import pairs as po
from repoquarry.operators import pieces as bo
from repoquarry.operators import selection as sel
from repoquarry.operators import token_vectors as tv
from repoquarry.operators import vocabulary as vo
from repoquarry.session import materialize, ship_package, spread


def tokenizer_comparison(
    texts: DataFrame, vocabulary_size: int = bo.VOCABULARY_SIZE
) -> tuple[DataFrame, bo.BpeModel]:
    """One row of statistics per tokenizer. Subwords leave blank texts out, the others keep them."""
    filled = vo.documents(texts.withColumnRenamed("text", "source_code"), skip_blank=True)
    model = bo.train(filled, vocabulary_size)
    profiles = [
        vo.sequence_statistics(vo.character_profile(texts), "character"),
        vo.sequence_statistics(vo.word_profile(texts), "word"),
        vo.sequence_statistics(vo.token_profile(bo.with_tokens(filled, model)), "subword", len(model.vocab)),
    ]
    return reduce(DataFrame.unionByName, profiles), model


def tokenize_and_profile(
    df: DataFrame, vocabulary_size: int = bo.VOCABULARY_SIZE, top: int = sel.CANDIDATES
) -> dict[str, DataFrame | bo.BpeModel]:
    """All of stage three for a table with a source_code, code or file_path column. Runs jobs."""
    ship_package(df.sparkSession)
    texts = spread(vo.documents(df))
    comparison, model = tokenizer_comparison(texts, vocabulary_size)
    filled = vo.documents(texts.withColumnRenamed("text", "source_code"), skip_blank=True)
    subwords, _ = materialize(bo.token_frequency(bo.piece_counts(filled), model), "subwords")
    tokens = sel.ranked_top(subwords, top).select((F.col("rank") - 1).alias("idx"), "token")
    vectors = tv.random_vectors(tokens)
    related = no.overlapping_pairs(tokens)
    improved = no.nudge(vectors, related)
    changes = no.similarity_change(improved)
    return {
        "model": model,
        "comparison": comparison,
        "character_vocabulary": vo.vocabulary(vo.frequencies(vo.character_profile(texts))),
        "word_vocabulary": vo.vocabulary(vo.frequencies(vo.word_profile(texts))),
        "subword_frequency": subwords,
        "top_tokens": vo.top_tokens(subwords, top),
        "vectors": vectors,
        "most_similar": po.extreme_pairs(vectors, 10, most=True),
        "least_similar": po.extreme_pairs(vectors, 10, most=False),
        "improved": improved,
        "top_improvements": no.top_improvements(changes),
        "improvement_statistics": no.improvement_statistics(related, changes),
    }
