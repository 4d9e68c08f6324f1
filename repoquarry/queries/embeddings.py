"""Stage four over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.functions import text as tx
from repoquarry.functions import vectors as vx
from repoquarry.operators import contexts as co
from repoquarry.operators import pairs as po
from repoquarry.operators import pieces as bo
from repoquarry.operators import selection as sel
from repoquarry.operators import skipgram
from repoquarry.operators import skipgram_blocks as sb
from repoquarry.operators import token_vectors as tv
from repoquarry.operators import vocabulary as vo
from repoquarry.plans import embeddings as plan
from repoquarry.queries import inputs as q
from repoquarry.queries import tokens as qt
from repoquarry.session import materialize

SMALL_BLOCKS = 100  # vectors to a block, so that small tables have many blocks too
TRAINERS = 8  # tasks that train skip-gram vectors


def _selected(spark: SparkSession, sf: str) -> DataFrame:
    """(idx, rank, token, frequency) of 20 chosen words."""
    return sel.select_tokens(qt.word_frequency(spark, sf), qt.RANKS)


def _fixed(selected: DataFrame) -> tuple[DataFrame, list[str]]:
    """A selection (20 rows) written once, so that the corpus is not counted again for every use."""
    written, _ = materialize(selected, "selected")
    return written, [r["token"] for r in written.select("token").collect()]


def _word_sequences(spark: SparkSession, sf: str) -> DataFrame:
    docs = q.document_texts(spark, sf)
    return docs.select("doc_id", tx.word_tokens(F.col("text")).alias("tokens"))


def _slots(vectors: DataFrame, *keys: str) -> DataFrame:
    opened = vectors.select(*keys, F.posexplode("vec").alias("slot", "value"))
    return opened.withColumn("value", F.round("value", 6))


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    vec = F.col("embedding").cast("array<double>").alias("vec")
    return q.table(spark, sf, "embeddings").select("vec_id", "label", vec)


def l2_normalize(spark, sf):
    vectors = _embeddings(spark, sf)
    return _slots(vectors.withColumn("vec", vx.l2_normalize(F.col("vec"))), "vec_id")


def vector_mean(spark, sf):
    means = po.mean_vectors(_embeddings(spark, sf), "label")
    return _slots(means.withColumn("vec", vx.l2_normalize(F.col("vec"))), "label")


def label_similarity(spark, sf):
    """Similarity of the mean vectors of all labels."""
    means = po.mean_vectors(_embeddings(spark, sf), "label")
    vectors = means.select(F.col("label").alias("idx"), F.col("label").cast("string").alias("token"), "vec")
    pairs = po.pair_listing(vectors)
    return pairs.select("token_1", "token_2", F.round("similarity", 6).alias("similarity"))


def _numbered_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _embeddings(spark, sf).filter(F.col("vec").isNotNull())
    return vectors.select(F.col("vec_id").alias("idx"), F.col("vec_id").cast("string").alias("token"), "vec")


def closest_embeddings(spark, sf):
    """The most similar vectors of the whole table, by many pairs of blocks."""
    pairs = po.extreme_pairs(_numbered_embeddings(spark, sf), 10, most=True, block_rows=SMALL_BLOCKS)
    return pairs.select("idx_1", "idx_2", F.round("similarity", 6).alias("similarity"))


def farthest_embeddings(spark, sf):
    pairs = po.extreme_pairs(_numbered_embeddings(spark, sf), 10, most=False, block_rows=SMALL_BLOCKS)
    return pairs.select("idx_1", "idx_2", F.round("similarity", 6).alias("similarity"))


def embedding_similarity_summary(spark, sf):
    row = po.similarity_summary(_numbered_embeddings(spark, sf), block_rows=SMALL_BLOCKS)
    return row.select("pairs", *[F.round(c, 6).alias(c) for c in row.columns if c != "pairs"])


def token_positions(spark, sf):
    features = qt.word_positions(spark, sf, _selected(spark, sf))
    rounded = [F.round(c, 6).alias(c) for c in features.columns if c.endswith(("position", "std"))]
    return features.select("idx", "token", *rounded, "occurrences")


def position_embedding(spark, sf):
    features = qt.word_positions(spark, sf, _selected(spark, sf))
    return _slots(tv.position_vectors(features), "token")


def _frequency_vectors(spark: SparkSession, sf: str, selected: DataFrame) -> DataFrame:
    frequency = selected.select("token", "frequency")
    files = q.document_files(spark, sf).select("repository")
    return tv.frequency_vectors(tv.token_frequencies(selected, frequency), files)


def frequency_embedding(spark, sf):
    selected, _ = _fixed(_selected(spark, sf))
    return _slots(_frequency_vectors(spark, sf, selected), "token")


def frequency_components(spark, sf):
    selected, _ = _fixed(_selected(spark, sf))
    known = tv.token_frequencies(selected, selected.select("token", "frequency"))
    rows = tv.frequency_components(known, q.document_files(spark, sf).select("repository"))
    return rows.select("token", "slot", F.round("value", 6).alias("value"))


def frequency_similarity(spark, sf):
    """Pairs under frequency vectors that are kept in parts of a few repositories."""
    selected, _ = _fixed(_selected(spark, sf))
    known = tv.token_frequencies(selected, selected.select("token", "frequency"))
    parts, _ = materialize(tv.frequency_parts(known, q.document_files(spark, sf).select("repository"), part_slots=8), "parts")
    pairs = po.part_similarities(parts)
    return pairs.select("token_1", "token_2", F.round("similarity", 6).alias("similarity"))


def token_contexts(spark, sf):
    _, tokens = _fixed(_selected(spark, sf))
    found = co.token_contexts(_word_sequences(spark, sf), tokens, keep=("doc_id",))
    return co.context_text(found).select("doc_id", "pos", "token", "left_context", "right_context")


def _listings(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs under two kinds of vectors over the same chosen words."""
    selected, _ = _fixed(_selected(spark, sf))
    position = tv.position_vectors(qt.word_positions(spark, sf, selected))
    parts = [("Frequency", _frequency_vectors(spark, sf, selected)), ("Position", position)]
    listings = [
        po.pair_listing(v.select("idx", "token", "vec")).withColumn("approach", F.lit(name)) for name, v in parts
    ]
    return listings[0].unionByName(listings[1])


def similarity_comparison(spark, sf):
    """Two kinds of vectors compared."""
    out = po.compare_approaches(_listings(spark, sf))
    return out.select("approach", *[F.round(c, 6).alias(c) for c in out.columns if c != "approach"])


def top_pairs_per_approach(spark, sf):
    """The five most similar pairs under each kind of vectors."""
    top = po.top_per_approach(_listings(spark, sf))
    return top.select("approach", "rank", "token_1", "token_2", F.round("similarity", 6).alias("similarity"))


def hash_vectors(spark, sf):
    """A fixed vector for every different word."""
    return tv.hash_vectors(qt.word_frequency(spark, sf).select("token"))


def random_vectors(spark, sf):
    return tv.random_vectors(qt.top_words(spark, sf))


def structural_embedding(spark, sf):
    selected, tokens = _fixed(_selected(spark, sf))
    contexts = co.token_contexts(_word_sequences(spark, sf), tokens)
    return co.structural_vectors(selected, contexts)


def _path_model(spark: SparkSession, sf: str):
    files = q.page_files(spark, sf)
    texts = vo.documents(files, skip_blank=True)
    model = bo.train(texts)
    return files, bo.token_frequency(bo.piece_counts(texts), model), model


def word2vec_vectors(spark, sf):
    """Skip-gram vectors of the most frequent path tokens."""
    files, frequency, model = _path_model(spark, sf)
    sequences = skipgram.training_sequences(bo.with_path_tokens(files, model))
    selected = sel.ranked_top(frequency).select((F.col("rank") - 1).cast("int").alias("idx"), "token")
    return skipgram.selected_vectors(selected, skipgram.train(sequences, TRAINERS))


def context_totals(spark, sf):
    """How many different words stand near each frequent word, and how often: what skip-gram trains on."""
    sequences = _word_sequences(spark, sf).select("tokens")
    words, _ = materialize(sb.numbered_words(sequences, qt.FREQUENT), "words")
    pairs = sb.pair_weights(sequences, words)
    totals = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("contexts"), F.sum("weight").cast("bigint").alias("weight"))
    return totals.join(words, "word").select("token", "word", "contexts", "weight")


def skipgram_vectors(spark, sf):
    """Skip-gram vectors of all frequent words of the texts, trained block by block."""
    sequences = _word_sequences(spark, sf).select("tokens")
    return sb.train(sequences, min_count=qt.FREQUENT)


def usable_sequences(spark, sf):
    """Training sequences: those with two tokens or more."""
    opened = skipgram.training_sequences(_word_sequences(spark, sf)).select(F.size("tokens").alias("n"))
    return opened.groupBy("n").agg(F.count(F.lit(1)).alias("sequences"))


def stage_four(spark, sf):
    """The whole stage over paths: four kinds of vectors compared."""
    files, frequency, model = _path_model(spark, sf)
    return plan.embed_and_compare(files, frequency, model, list(range(1, 21)), TRAINERS)["comparison"]


QUERIES = {
    f.__name__: f
    for f in (
        l2_normalize,
        vector_mean,
        label_similarity,
        closest_embeddings,
        farthest_embeddings,
        embedding_similarity_summary,
        token_positions,
        position_embedding,
        frequency_embedding,
        frequency_components,
        frequency_similarity,
        token_contexts,
        similarity_comparison,
        top_pairs_per_approach,
        hash_vectors,
        random_vectors,
        structural_embedding,
        word2vec_vectors,
        context_totals,
        skipgram_vectors,
        usable_sequences,
        stage_four,
    )
}

# --- SQL ------------------------------------------------------------------------------------------

_SELECTED = f"""{q.WORDS_SQL},
selected AS (
  SELECT CAST(list_position({qt.RANKS}, rank) - 1 AS INTEGER) AS idx, token, frequency
  FROM word_rank WHERE rank IN ({", ".join(map(str, qt.RANKS))}))"""
_POSITION = f"{_SELECTED}, {qt.POSITIONS_SQL.format(selected='selected')}, {qt.VECTORS_SQL}"
_FREQUENCY = """profile AS (
  SELECT list(share ORDER BY source) AS shares
  FROM (SELECT source, count(*) / (SELECT count(*) FROM documents)::DOUBLE AS share FROM documents GROUP BY 1)),
frequency_raw AS (
  SELECT idx, token, list_concat([r, ln(1 + frequency::DOUBLE)],
    list_transform(shares, lambda s: r * s)) AS v
  FROM (SELECT *, frequency / greatest((SELECT max(frequency) FROM selected), 1)::DOUBLE AS r FROM selected),
    profile),
frequency_vectors AS (
  SELECT idx, token, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS vec FROM frequency_raw)"""
_EMBEDDING_PAIRS = """pairs AS (
  SELECT a.vec_id AS idx_1, b.vec_id AS idx_2, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s
  FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)"""
_MEANS = """means AS (
  SELECT label, list(m ORDER BY slot) AS v FROM (
    SELECT label, slot, avg(value::DOUBLE) AS m
    FROM (SELECT label, unnest(range(0, len(embedding))) AS slot, unnest(embedding) AS value FROM embeddings)
    GROUP BY ALL) GROUP BY label)"""


def _slots_sql(key: str, source: str) -> str:
    return (
        f"SELECT {key}, CAST(slot AS INTEGER) AS slot, round(value, 6) AS value FROM"
        f" (SELECT {key}, unnest(range(0, len(vec))) AS slot, unnest(vec) AS value FROM {source})"
    )


def _summary_sql(name: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS approach, round(max(s), 6) AS highest_similarity,"
        f" round(min(s), 6) AS lowest_similarity, round(avg(s), 6) AS average_similarity"
        f" FROM (SELECT list_cosine_similarity(a.vec, b.vec) AS s FROM {source} a JOIN {source} b ON a.idx < b.idx)"
    )


ORACLE = {
    "l2_normalize": f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS vec FROM v)
{_slots_sql("vec_id", "u")}""",
    "vector_mean": f"""WITH {_MEANS},
u AS (SELECT label, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS vec FROM means)
{_slots_sql("label", "u")}""",
    "label_similarity": f"""WITH {_MEANS}
SELECT CAST(a.label AS VARCHAR) AS token_1, CAST(b.label AS VARCHAR) AS token_2,
  round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM means a JOIN means b ON a.label < b.label""",
    "closest_embeddings": f"""WITH {_EMBEDDING_PAIRS}
SELECT idx_1, idx_2, round(s, 6) AS similarity FROM pairs ORDER BY round(s, 12) DESC, idx_1, idx_2 LIMIT 10""",
    "farthest_embeddings": f"""WITH {_EMBEDDING_PAIRS}
SELECT idx_1, idx_2, round(s, 6) AS similarity FROM pairs ORDER BY round(s, 12), idx_1, idx_2 LIMIT 10""",
    "embedding_similarity_summary": f"""WITH {_EMBEDDING_PAIRS}
SELECT count(*) AS pairs, round(max(s), 6) AS highest_similarity, round(min(s), 6) AS lowest_similarity,
  round(avg(s), 6) AS average_similarity FROM pairs""",
    "token_positions": f"""WITH {_POSITION}
SELECT idx, token, round(mean_position, 6) AS mean_position, round(position_std, 6) AS position_std,
  round(minimum_position, 6) AS minimum_position, round(maximum_position, 6) AS maximum_position, occurrences
FROM features""",
    "position_embedding": f"WITH {_POSITION} {_slots_sql('token', 'vectors')}",
    "frequency_embedding": f"WITH {_SELECTED}, {_FREQUENCY} {_slots_sql('token', 'frequency_vectors')}",
    "frequency_components": f"WITH {_SELECTED}, {_FREQUENCY} {_slots_sql('token', 'frequency_vectors')}",
    "frequency_similarity": f"""WITH {_SELECTED}, {_FREQUENCY}
SELECT a.token AS token_1, b.token AS token_2, round(list_cosine_similarity(a.vec, b.vec), 6) AS similarity
FROM frequency_vectors a JOIN frequency_vectors b ON a.idx < b.idx""",
    "context_totals": f"""WITH {q.WORDS_SQL},
words AS (SELECT token, rank - 1 AS word FROM word_rank WHERE frequency >= {qt.FREQUENT}),
places AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS i FROM word_docs),
known AS (SELECT doc_id, word, i FROM places JOIN words USING (token)),
near AS (
  SELECT a.word, b.word AS context, count(*) AS n FROM known a JOIN known b
    ON a.doc_id = b.doc_id AND b.i BETWEEN a.i - 5 AND a.i + 5 AND a.i != b.i GROUP BY 1, 2)
SELECT token, word, count(*) AS contexts, CAST(sum(n) AS BIGINT) AS weight FROM near JOIN words USING (word) GROUP BY 1, 2""",
    "usable_sequences": f"""WITH {q.WORDS_SQL}
SELECT CAST(len(tokens) AS INTEGER) AS n, count(*) AS sequences FROM word_docs WHERE len(tokens) >= 2 GROUP BY 1""",
    "token_contexts": f"""WITH {_SELECTED},
placed AS (SELECT doc_id, tokens, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS i FROM word_docs)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, token,
  array_to_string(tokens[greatest(i - 2, 1):i - 1], ' ') AS left_context,
  array_to_string(tokens[i + 1:i + 2], ' ') AS right_context
FROM placed WHERE token IN (SELECT token FROM selected)""",
    "top_pairs_per_approach": f"""WITH {_POSITION}, {_FREQUENCY},
listed AS (
  SELECT 'Frequency' AS approach, * FROM frequency_vectors
  UNION ALL SELECT 'Position', idx, token, vec FROM vectors),
compared AS (
  SELECT a.approach, a.idx AS idx_1, b.idx AS idx_2, a.token AS token_1, b.token AS token_2,
    list_cosine_similarity(a.vec, b.vec) AS s
  FROM listed a JOIN listed b ON a.approach = b.approach AND a.idx < b.idx)
SELECT approach, row_number() OVER w AS rank, token_1, token_2, round(s, 6) AS similarity FROM compared
WINDOW w AS (PARTITION BY approach ORDER BY s DESC, idx_1, idx_2) QUALIFY row_number() OVER w <= 5""",
    "similarity_comparison": f"""WITH {_POSITION}, {_FREQUENCY}
{_summary_sql("Frequency", "frequency_vectors")}
UNION ALL {_summary_sql("Position", "vectors")}""",
}
