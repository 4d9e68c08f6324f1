"""Stage three over the driver's tables. documents are the texts; page paths stand for file paths."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.functions import text as tx
from repoquarry.operators import nudge as no
from repoquarry.operators import pairs as po
from repoquarry.operators import pieces as bo
from repoquarry.operators import selection as sel
from repoquarry.operators import token_vectors as tv
from repoquarry.operators import vocabulary as vo
from repoquarry.plans import tokenization
from repoquarry.queries import inputs as q
from repoquarry.session import application_folder, materialize

FREQUENT = 5  # occurrences from which a word takes part where all frequent words are compared
NUDGED = 1_100  # a selection of more than one block
CANDIDATE_PAIRS, SEQUENCE_LENGTH = 64, 4
SMALL_VOCABULARY, MERGES = 320, 40  # of a model that SQL can follow merge by merge

# An example choice of 20 of the 50 most frequent tokens.
RANKS = [2, 4, 5, 8, 11, 14, 17, 21, 25, 28, 31, 34, 36, 39, 41, 43, 45, 47, 49, 50]


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return q.document_texts(spark, sf).select("text")


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    return vo.documents(q.page_files(spark, sf), skip_blank=True)


def word_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return vo.frequencies(vo.word_profile(_texts(spark, sf)))


def top_words(spark: SparkSession, sf: str) -> DataFrame:
    """(idx, token) of the 50 most frequent words."""
    ranked = sel.ranked_top(word_frequency(spark, sf))
    return ranked.select((F.col("rank") - 1).cast("int").alias("idx"), "token")


def word_positions(spark: SparkSession, sf: str, selected: DataFrame) -> DataFrame:
    words = q.document_texts(spark, sf).select(tx.word_tokens(F.col("text")).alias("tokens"))
    return tv.position_features(selected, words)


def top_word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return tv.position_vectors(word_positions(spark, sf, top_words(spark, sf))).select("idx", "token", "vec")


def char_vocab(spark, sf):
    return vo.vocabulary(vo.frequencies(vo.character_profile(_texts(spark, sf))))


def word_vocab(spark, sf):
    return vo.vocabulary(word_frequency(spark, sf))


def char_vocab_first_seen(spark, sf):
    """Character ids whose ties go to the character that was met first."""
    profile = vo.character_profile(q.document_texts(spark, sf), position="doc_id")
    return vo.vocabulary(vo.frequencies(profile), ties="first_seen")


def word_vocab_first_seen(spark, sf):
    profile = vo.word_profile(q.document_texts(spark, sf), position="doc_id")
    return vo.vocabulary(vo.frequencies(profile), ties="first_seen")


def char_ids(spark, sf):
    """Character ids of every text, joined to one string per document."""
    ids = vo.with_character_ids(q.document_texts(spark, sf), char_vocab(spark, sf))
    return ids.select("doc_id", F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("ids"))


def sequence_stats(spark, sf):
    texts = _texts(spark, sf)
    rows = vo.sequence_statistics(vo.character_profile(texts), "character").unionByName(
        vo.sequence_statistics(vo.word_profile(texts), "word")
    )
    return rows.withColumn("average_sequence_length", F.round("average_sequence_length", 4))


def tokenizer_comparison(spark, sf):
    """Characters, words and subwords side by side, over paths."""
    return tokenization.tokenizer_comparison(_paths(spark, sf))[0]


def top_tokens(spark, sf):
    return vo.top_tokens(word_frequency(spark, sf))


def select_tokens(spark, sf):
    return sel.select_tokens(word_frequency(spark, sf), RANKS)


def displayed_tokens(spark, sf):
    """Most frequent characters with line breaks and tabs written out."""
    top = vo.top_tokens(vo.frequencies(vo.character_profile(_texts(spark, sf))))
    return top.select(tx.display_token(F.col("token")).alias("shown"), "frequency")


def char_overlap_pairs(spark, sf):
    pairs = no.overlapping_pairs(top_words(spark, sf))
    return pairs.withColumn("character_overlap", F.round("character_overlap", 6))


def overlap_degrees(spark, sf):
    """How many other frequent words each of them shares letters with: pairs of many blocks, none listed."""
    frequent = word_frequency(spark, sf).filter(F.col("frequency") >= FREQUENT)
    words = vo.vocabulary(frequent).select(F.col("token_id").alias("idx"), "token")
    degrees = no.overlap_degrees(words)
    return degrees.select("idx", "token", "related", F.round("average_overlap", 6).alias("average_overlap"))


def bpe_pieces(spark, sf):
    return bo.byte_level_pieces(bo.piece_counts(_texts(spark, sf)))


def bpe_pair_counts(spark, sf):
    """The count a training round starts from: neighbouring byte symbols over all texts."""
    pieces = bpe_pieces(spark, sf).filter(F.length("piece") > 1)
    return bo.pair_counts(pieces)


def bpe_sequence_counts(spark, sf):
    """What a training round fetches: counted sequences of fixed length over the most frequent pairs."""
    pieces, _ = materialize(bpe_pieces(spark, sf).filter(F.length("piece") > 1), "pieces")
    first = bo.pair_counts(pieces).orderBy(F.desc("n"), F.asc("pair")).limit(CANDIDATE_PAIRS)
    return bo.sequence_counts(pieces, [r["pair"] for r in first.collect()], SEQUENCE_LENGTH)


def bpe_train(spark, sf):
    model = bo.train(_paths(spark, sf))
    vocab, merges = model.to_frames(spark)
    return vocab.select(F.lit("vocab").alias("part"), "id", "token").unionByName(
        merges.select(F.lit("merge").alias("part"), F.col("rank").alias("id"), F.concat_ws(" ", "left", "right").alias("token"))
    )


def bpe_train_texts(spark, sf):
    """The same over whole document texts."""
    vocab, _ = bo.train(_texts(spark, sf)).to_frames(spark)
    return vocab


def _small_model(spark: SparkSession, sf: str) -> bo.BpeModel:
    """The first merges over all document texts."""
    return bo.first_merges(bo.train(_texts(spark, sf), SMALL_VOCABULARY), MERGES)


def bpe_first_merges(spark, sf):
    _, merges = _small_model(spark, sf).to_frames(spark)
    return merges


def bpe_first_frequency(spark, sf):
    """How often each token of a small model occurs in all texts."""
    return bo.token_frequency(bo.piece_counts(_texts(spark, sf)), _small_model(spark, sf))


def bpe_first_encoded(spark, sf):
    """Every text encoded by a small model."""
    tokens = bo.with_tokens(q.document_texts(spark, sf), _small_model(spark, sf))
    return tokens.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(F.array_join("tokens", " ").cast("binary")).alias("tokens_md5"))


def bpe_reloaded(spark, sf):
    """The same by a model that was written and read again."""
    path = f"{application_folder(spark)}/model-{uuid.uuid4().hex}"
    bo.save_model(_small_model(spark, sf), spark, path)
    return bo.token_frequency(bo.piece_counts(_texts(spark, sf)), bo.load_model(spark, path))


def tokenizer_comparison_texts(spark, sf):
    """Characters, words and subwords side by side, over all document texts."""
    return tokenization.tokenizer_comparison(_texts(spark, sf))[0]


def bpe_encode(spark, sf):
    paths = q.page_files(spark, sf)
    model = bo.train(_paths(spark, sf))
    return bo.with_path_tokens(paths, model).select("page_id", F.array_join("tokens", " ").alias("tokens"))


def bpe_encoded_text(spark, sf):
    """The tokens of every document, spelled back: byte characters to bytes, bytes to text."""
    docs = q.document_texts(spark, sf)
    model = bo.train(_paths(spark, sf).unionByName(docs.select("text")))
    tokens = bo.with_tokens(docs, model)
    moved = [(b, c) for b, c in enumerate(tx.BYTE_ALPHABET) if chr(b) != c]
    one_per_byte = F.translate(
        F.array_join("tokens", ""), "".join(c for _, c in moved), "".join(chr(b) for b, _ in moved)
    )
    text = F.decode(F.encode(one_per_byte, "ISO-8859-1"), "UTF-8")
    return tokens.select("doc_id", text.alias("text"))


def bpe_token_frequency(spark, sf):
    texts = _paths(spark, sf)
    return bo.token_frequency(bo.piece_counts(texts), bo.train(texts))


def most_similar_pairs(spark, sf):
    pairs = po.extreme_pairs(top_word_vectors(spark, sf), 10, most=True)
    return pairs.select("token_1", "token_2", F.round("similarity", 6).alias("similarity"))


def least_similar_pairs(spark, sf):
    pairs = po.extreme_pairs(top_word_vectors(spark, sf), 10, most=False)
    return pairs.select("token_1", "token_2", F.round("similarity", 6).alias("similarity"))


def pair_similarity(spark, sf):
    pairs = po.pair_listing(top_word_vectors(spark, sf))
    return pairs.select("token_1", "token_2", F.round("similarity", 6).alias("similarity"))


def similarity_summary(spark, sf):
    row = po.similarity_summary(top_word_vectors(spark, sf))
    return row.select("pairs", *[F.round(c, 6).alias(c) for c in row.columns if c != "pairs"])


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    vec = F.col("embedding").cast("array<double>").alias("vec")
    return q.table(spark, sf, "embeddings").select(F.col("vec_id").alias("token"), vec, "label")


def pair_lookup(spark, sf):
    """Similarity of each vector to the next one, as a given list of pairs."""
    vectors = _vectors(spark, sf)
    pairs = vectors.select(F.col("token").alias("token_a"), (F.col("token") + 1).alias("token_b"))
    found = po.lookup_pairs(sel.related_pairs(pairs), vectors)
    return found.withColumn("cosine_similarity", F.round("cosine_similarity", 6))


def _nudged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors, _ = materialize(top_word_vectors(spark, sf), "vectors")
    related = no.overlapping_pairs(vectors.select("idx", "token"))
    return related, no.similarity_change(no.nudge(vectors, related))


def _nudged_together(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Related pairs and moved vectors of a selection of several blocks."""
    top = vo.vocabulary(word_frequency(spark, sf)).filter(F.col("token_id") <= NUDGED)
    words, _ = materialize(top.select((F.col("token_id") - 1).cast("int").alias("idx"), "token"), "words")
    positions = tv.position_vectors(word_positions(spark, sf, words)).select("idx", "token", "vec")
    vectors, _ = materialize(positions, "vectors")
    related, _ = materialize(no.overlapping_pairs(words), "related")
    improved, _ = materialize(no.nudge_together(vectors, related), "improved")
    return related, improved


def together_improvements(spark, sf):
    """Largest changes when all related words move at once."""
    _, improved = _nudged_together(spark, sf)
    top = no.top_improvements(no.similarity_change(improved))
    return top.select("token_1", "token_2", F.round("change", 6).alias("change"))


def together_statistics(spark, sf):
    related, improved = _nudged_together(spark, sf)
    row = no.change_summary(improved)
    averages = [F.round(c, 6).alias(c) for c in row.columns if c.startswith("average")]
    return row.select(related.agg(F.count(F.lit(1))).scalar().alias("related_pairs_detected"), "total_pairs_analyzed", *averages)


def nudged_similarity(spark, sf):
    _, changes = _nudged(spark, sf)
    names = ("original_similarity", "improved_similarity", "change")
    return changes.select("token_1", "token_2", *[F.round(c, 6).alias(c) for c in names])


def top_improvements(spark, sf):
    _, changes = _nudged(spark, sf)
    top = no.top_improvements(changes)
    return top.select("token_1", "token_2", F.round("change", 6).alias("change"))


def improvement_statistics(spark, sf):
    row = no.improvement_statistics(*_nudged(spark, sf))
    return row.select(
        *[F.round(c, 6).alias(c) if c.startswith("average") else F.col(c) for c in row.columns]
    )


def stage_three(spark, sf):
    """The whole stage over paths: its largest improvements."""
    out = tokenization.tokenize_and_profile(q.page_files(spark, sf).select("file_path"))
    return out["top_improvements"]


def stage_three_texts(spark, sf):
    """The whole stage over document texts: its two vocabularies without training."""
    out = tokenization.tokenize_and_profile(q.document_texts(spark, sf).select(F.col("text").alias("source_code")), SMALL_VOCABULARY)
    parts = [out[f"{kind}_vocabulary"].withColumn("kind", F.lit(kind)) for kind in ("character", "word")]
    return parts[0].unionByName(parts[1])


QUERIES = {
    f.__name__: f
    for f in (
        char_vocab,
        word_vocab,
        char_vocab_first_seen,
        word_vocab_first_seen,
        char_ids,
        sequence_stats,
        tokenizer_comparison,
        top_tokens,
        select_tokens,
        displayed_tokens,
        char_overlap_pairs,
        overlap_degrees,
        bpe_pieces,
        bpe_pair_counts,
        bpe_sequence_counts,
        bpe_train,
        bpe_train_texts,
        bpe_first_merges,
        bpe_first_frequency,
        bpe_first_encoded,
        bpe_reloaded,
        tokenizer_comparison_texts,
        bpe_encode,
        bpe_encoded_text,
        bpe_token_frequency,
        most_similar_pairs,
        least_similar_pairs,
        pair_similarity,
        similarity_summary,
        pair_lookup,
        nudged_similarity,
        top_improvements,
        improvement_statistics,
        together_improvements,
        together_statistics,
        stage_three,
        stage_three_texts,
    )
}

# --- SQL ------------------------------------------------------------------------------------------

_CHARS = """char_rows AS (SELECT unnest(regexp_extract_all(text, '(?s).')) AS token FROM documents),
char_freq AS (SELECT token, count(*) AS frequency FROM char_rows GROUP BY token),
char_rank AS (SELECT token, row_number() OVER (ORDER BY frequency DESC, token) AS token_id, frequency
  FROM char_freq)"""

SINUSOID = (
    "list_transform(range(0, 128), lambda k: CASE WHEN k % 2 = 0"
    " THEN sin({0} / pow(10000.0::DOUBLE, CAST(k AS DOUBLE) / 128))"
    " ELSE cos({0} / pow(10000.0::DOUBLE, CAST(k - 1 AS DOUBLE) / 128)) END)"
)

POSITIONS_SQL = """word_places AS (
  SELECT token, CASE WHEN n = 1 THEN 0.5 ELSE CAST(pos AS DOUBLE) / (n - 1) END AS place
  FROM (SELECT unnest(tokens) AS token, len(tokens) AS n, unnest(range(0, len(tokens))) AS pos FROM word_docs)),
features AS (
  SELECT s.idx, s.token, coalesce(m, 0.5) AS mean_position, coalesce(sd, 0.0) AS position_std,
    coalesce(lo, 0.5) AS minimum_position, coalesce(hi, 0.5) AS maximum_position,
    coalesce(n, 0) AS occurrences
  FROM {selected} s LEFT JOIN (
    SELECT token, avg(place) AS m, stddev_pop(place) AS sd, min(place) AS lo, max(place) AS hi, count(*) AS n
    FROM word_places GROUP BY token) USING (token))"""

VECTORS_SQL = f"""encoded AS (
  SELECT idx, token, {SINUSOID.format("mean_position")} AS a,
    {SINUSOID.format("least(position_std, 1.0)")} AS b,
    {SINUSOID.format("minimum_position")} AS c, {SINUSOID.format("maximum_position")} AS d FROM features),
summed AS (
  SELECT idx, token, list_transform(range(1, 129),
    lambda k: a[k] + b[k] * 0.2::DOUBLE + c[k] * 0.1::DOUBLE + d[k] * 0.1::DOUBLE) AS v FROM encoded),
vectors AS (
  SELECT idx, token, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS vec FROM summed)"""

_TOP_VECTORS = f"{q.WORDS_SQL}, {POSITIONS_SQL.format(selected='top50')}, {VECTORS_SQL}"
_PAIRS = """pairs AS (
  SELECT a.idx AS idx_1, b.idx AS idx_2, a.token AS token_1, b.token AS token_2,
    list_cosine_similarity(a.vec, b.vec) AS similarity
  FROM vectors a JOIN vectors b ON a.idx < b.idx)"""

_OVERLAP = """char_sets AS (
  SELECT idx, token, list_distinct(regexp_extract_all(lower(token), '(?s).')) AS cs FROM {selected}),
related AS (
  SELECT a.idx AS idx_1, b.idx AS idx_2, a.token AS token_1, b.token AS token_2,
    CAST(len(list_intersect(a.cs, b.cs)) AS DOUBLE) / least(len(a.cs), len(b.cs)) AS character_overlap
  FROM char_sets a JOIN char_sets b ON a.idx < b.idx
  WHERE CAST(len(list_intersect(a.cs, b.cs)) AS DOUBLE) / least(len(a.cs), len(b.cs)) >= 0.4)"""

_TOP_OVERLAP = _OVERLAP.format(selected="top50")
# Sets of characters as the bits of four numbers, 60 to each.
_MASKS = """letters AS (SELECT idx, token, unnest(cs) AS c FROM char_sets),
places AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS b FROM (SELECT DISTINCT c FROM letters)),
masks AS (
  SELECT idx, token, count(*) AS n, {0} FROM letters JOIN places USING (c) GROUP BY idx, token),
shared AS (
  SELECT a.idx AS idx_1, b.idx AS idx_2, a.token AS token_1, b.token AS token_2,
    CAST({1} AS DOUBLE) / least(a.n, b.n) AS character_overlap
  FROM masks a JOIN masks b ON a.idx < b.idx),
related AS (SELECT * FROM shared WHERE character_overlap >= 0.4)""".format(
    ", ".join(f"sum(CASE WHEN b // 60 = {i} THEN CAST(1 AS BIGINT) << (b % 60)::INT ELSE 0 END)::BIGINT AS m{i}" for i in range(4)),
    " + ".join(f"bit_count(a.m{i} & b.m{i})::BIGINT" for i in range(4)),
)
_SETS = """char_sets AS (
  SELECT idx, token, list_distinct(regexp_extract_all(lower(token), '(?s).')) AS cs FROM {selected})"""

_TOGETHER = f"""{q.WORDS_SQL},
chosen AS (SELECT CAST(rank - 1 AS INTEGER) AS idx, token FROM word_rank WHERE rank <= {NUDGED}),
{POSITIONS_SQL.format(selected="chosen")}, {VECTORS_SQL}, {_SETS.format(selected="chosen")}, {_MASKS},
ends AS (SELECT idx_1 AS idx, idx_2 AS other FROM related UNION ALL SELECT idx_2, idx_1 FROM related),
slots AS (SELECT idx, unnest(range(0, 128)) AS slot, unnest(vec) AS value FROM vectors),
pulls AS (SELECT e.idx, slot, sum(value) AS theirs, count(*) AS n FROM ends e JOIN slots s ON s.idx = e.other GROUP BY e.idx, slot),
improved AS (
  SELECT s.idx, list((1 - 0.05::DOUBLE * coalesce(n, 0)) * value + 0.05::DOUBLE * coalesce(theirs, 0) ORDER BY slot) AS vec
  FROM slots s LEFT JOIN pulls USING (idx, slot) GROUP BY s.idx),
changes AS (
  SELECT a.idx AS idx_1, b.idx AS idx_2, a.token AS token_1, b.token AS token_2,
    list_cosine_similarity(a.vec, b.vec) AS original_similarity,
    list_cosine_similarity(x.vec, y.vec) AS improved_similarity,
    list_cosine_similarity(x.vec, y.vec) - list_cosine_similarity(a.vec, b.vec) AS change
  FROM vectors a JOIN vectors b ON a.idx < b.idx JOIN improved x ON x.idx = a.idx JOIN improved y ON y.idx = b.idx)"""

_NUDGE = f"""{_TOP_VECTORS}, {_TOP_OVERLAP},
steps AS (SELECT row_number() OVER (ORDER BY idx_1, idx_2) AS step, idx_1 + 1 AS i, idx_2 + 1 AS j FROM related),
columns AS (
  SELECT slot, list(value ORDER BY idx) AS vals
  FROM (SELECT idx, unnest(range(1, 129)) AS slot, unnest(vec) AS value FROM vectors) GROUP BY slot),
moved AS (
  SELECT slot, CAST(0 AS BIGINT) AS step, vals FROM columns
  UNION ALL
  SELECT m.slot, s.step, list_transform(m.vals, lambda x, k:
    CASE WHEN k = s.i THEN 0.95::DOUBLE * x + 0.05::DOUBLE * m.vals[s.j]
         WHEN k = s.j THEN 0.95::DOUBLE * x + 0.05::DOUBLE * m.vals[s.i] ELSE x END)
  FROM moved m JOIN steps s ON s.step = m.step + 1),
improved AS (
  SELECT idx, list(value ORDER BY slot) AS vec
  FROM (SELECT slot, unnest(range(0, len(vals))) AS idx, unnest(vals) AS value FROM moved
    WHERE step = (SELECT coalesce(max(step), 0) FROM steps)) GROUP BY idx),
{_PAIRS},
changes AS (
  SELECT p.idx_1, p.idx_2, token_1, token_2, similarity AS original_similarity,
    list_cosine_similarity(a.vec, b.vec) AS improved_similarity,
    list_cosine_similarity(a.vec, b.vec) - similarity AS change
  FROM pairs p JOIN improved a ON a.idx = p.idx_1 JOIN improved b ON b.idx = p.idx_2)"""

# The engine has no look-ahead: a mark set before the last blank of a run ends the run there.
_MARK = chr(1)
_WS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PIECE = (
    r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}\x01]+|[" + _WS + "]+"
)


def _bytes_sql(column: str) -> str:
    """Byte-level spelling, byte by byte from the hexadecimal form."""
    letters = ", ".join("'" + c.replace("'", "''") + "'" for c in tx.BYTE_ALPHABET)
    return (
        f"array_to_string(list_transform(regexp_extract_all(hex(encode({column})), '..'),"
        f" lambda h: ([{letters}])[CAST('0x' || h AS INTEGER) + 1]), '')"
    )


_PIECES = f"""marked AS (
  SELECT regexp_replace(text, '([{_WS}])([^{_WS}])', chr(1) || '\\1\\2', 'g') AS t FROM documents),
raw_pieces AS (SELECT unnest(regexp_extract_all(t, '{_PIECE}')) AS p FROM marked),
counted AS (SELECT p, count(*) AS n FROM raw_pieces GROUP BY p),
pieces AS (SELECT {_bytes_sql("p")} AS piece, n FROM counted)"""



def _merge_by_merge(steps: int, pieces: str, keep: str = "") -> str:
    """pieces_k after k merges, best_k the pair merged then, known_k the texts of the symbols so far."""
    out = [pieces, "pieces_0 AS MATERIALIZED (SELECT * FROM pieces)", "known_0 AS (SELECT '' AS symbol, '' AS text WHERE false)"]
    for k in range(steps):
        out.append(f"""best_{k} AS MATERIALIZED (
  SELECT pair, left(pair, 1) AS l, right(pair, 1) AS r FROM (
    SELECT substr(piece, i, 2) AS pair, sum(n) AS n
    FROM (SELECT piece, n, unnest(range(1, length(piece))) AS i FROM pieces_{k}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)),
pieces_{k + 1} AS MATERIALIZED (SELECT {keep}replace(piece, pair, chr({0x1000 + k})) AS piece, n FROM pieces_{k}, best_{k}),
named_{k} AS MATERIALIZED (
  SELECT coalesce(a.text, l) AS "left", coalesce(b.text, r) AS "right"
  FROM best_{k} LEFT JOIN known_{k} a ON a.symbol = l LEFT JOIN known_{k} b ON b.symbol = r),
known_{k + 1} AS MATERIALIZED (SELECT * FROM known_{k} UNION ALL SELECT chr({0x1000 + k}), "left" || "right" FROM named_{k})""")
    return ",\n".join(out)


_MERGED = _merge_by_merge(MERGES, _PIECES)
_PIECES_OF_DOCUMENTS = f"""marked AS (
  SELECT doc_id, regexp_replace(text, '([{_WS}])([^{_WS}])', chr(1) || '\\1\\2', 'g') AS t FROM documents),
lists AS (SELECT doc_id, regexp_extract_all(t, '{_PIECE}') AS ps FROM marked),
raw_pieces AS (SELECT doc_id, unnest(ps) AS p, unnest(range(len(ps))) AS i FROM lists),
counted AS (SELECT p, count(*) AS n FROM raw_pieces GROUP BY p),
pieces AS (SELECT p, {_bytes_sql("p")} AS piece, n FROM counted)"""
_BPE_FREQUENCY = f"""WITH {_MERGED},
symbols AS (SELECT unnest(string_split(piece, '')) AS symbol, n FROM pieces_{MERGES})
SELECT coalesce(text, symbol) AS token, CAST(sum(n) AS BIGINT) AS frequency
FROM symbols LEFT JOIN known_{MERGES} USING (symbol) GROUP BY 1"""

ORACLE = {
    "bpe_first_merges": f"WITH {_MERGED} "
    + " UNION ALL ".join(f'SELECT {k}::INTEGER AS rank, "left", "right" FROM named_{k}' for k in range(MERGES)),
    "bpe_first_frequency": _BPE_FREQUENCY,
    "bpe_reloaded": _BPE_FREQUENCY,
    "bpe_first_encoded": f"""WITH {_merge_by_merge(MERGES, _PIECES_OF_DOCUMENTS, "p, ")},
spelled AS (
  SELECT p, list_transform(string_split(piece, ''), lambda s: coalesce(names[s], s)) AS tokens
  FROM pieces_{MERGES}, (SELECT map(list(symbol), list(text)) AS names FROM known_{MERGES}))
SELECT d.doc_id, coalesce(CAST(sum(len(tokens)) AS BIGINT), 0) AS n_tokens,
  md5(coalesce(string_agg(array_to_string(tokens, ' '), ' ' ORDER BY i), '')) AS tokens_md5
FROM documents d LEFT JOIN raw_pieces r ON d.doc_id = r.doc_id LEFT JOIN spelled USING (p) GROUP BY d.doc_id""",
    "char_vocab": f"WITH {_CHARS} SELECT * FROM char_rank",
    "word_vocab": f"WITH {q.WORDS_SQL} SELECT token, rank AS token_id, frequency FROM word_rank",
    "char_vocab_first_seen": """WITH placed AS (
  SELECT doc_id, unnest(cs) AS token, unnest(range(0, len(cs))) AS place
  FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS cs FROM documents)),
met AS (SELECT token, count(*) AS frequency, min((doc_id, place)) AS first FROM placed GROUP BY token)
SELECT token, row_number() OVER (ORDER BY frequency DESC, first) AS token_id, frequency FROM met""",
    "word_vocab_first_seen": f"""WITH {q.WORDS_SQL},
placed AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS place FROM word_docs),
met AS (SELECT token, count(*) AS frequency, min((doc_id, place)) AS first FROM placed GROUP BY token)
SELECT token, row_number() OVER (ORDER BY frequency DESC, first) AS token_id, frequency FROM met""",
    "char_ids": f"""WITH {_CHARS},
placed AS (SELECT doc_id, unnest(cs) AS token, unnest(range(0, len(cs))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS cs FROM documents)),
joined AS (SELECT doc_id, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY pos) AS ids
  FROM placed JOIN char_rank USING (token) GROUP BY doc_id)
SELECT doc_id, coalesce(ids, '') AS ids FROM documents LEFT JOIN joined USING (doc_id)""",
    "sequence_stats": f"""WITH {_CHARS}, {q.WORDS_SQL},
lengths AS (
  SELECT 'character' AS tokenizer, length(text) AS n FROM documents
  UNION ALL SELECT 'word', len(tokens) FROM word_docs),
sizes AS (
  SELECT 'character' AS tokenizer, count(*) AS v FROM char_freq UNION ALL SELECT 'word', count(*) FROM word_freq)
SELECT tokenizer, any_value(v) AS vocabulary_size, count(*) AS total_sequences,
  CAST(sum(n) AS BIGINT) AS total_tokens, any_value(v) AS tokens_observed,
  round(avg(CASE WHEN n > 0 THEN n END), 4) AS average_sequence_length,
  min(n) AS min_sequence_length, max(n) AS max_sequence_length,
  CAST(128 AS BIGINT) AS embedding_dimension, any_value(v) * 128 AS embedding_parameters
FROM lengths JOIN sizes USING (tokenizer) GROUP BY tokenizer""",
    "top_tokens": f"WITH {q.WORDS_SQL} SELECT token, frequency FROM top50",
    "select_tokens": f"""WITH {q.WORDS_SQL}
SELECT CAST(list_position({RANKS}, rank) - 1 AS INTEGER) AS idx, CAST(rank AS INTEGER) AS rank, token, frequency
FROM word_rank WHERE rank IN ({", ".join(map(str, RANKS))})""",
    "displayed_tokens": f"""WITH {_CHARS}
SELECT replace(replace(replace(token, chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') AS shown, frequency
FROM char_rank WHERE token_id <= 50""",
    "char_overlap_pairs": f"""WITH {q.WORDS_SQL}, {_TOP_OVERLAP}
SELECT * REPLACE (round(character_overlap, 6) AS character_overlap) FROM related""",
    "overlap_degrees": f"""WITH {q.WORDS_SQL},
frequent AS (SELECT rank AS idx, token FROM word_rank WHERE frequency >= {FREQUENT}),
{_SETS.format(selected="frequent")}, {_MASKS},
ends AS (
  SELECT idx_1 AS idx, token_1 AS token, character_overlap FROM related
  UNION ALL SELECT idx_2, token_2, character_overlap FROM related)
SELECT idx, token, count(*) AS related, round(avg(character_overlap), 6) AS average_overlap FROM ends GROUP BY idx, token""",
    "stage_three_texts": f"""WITH {_CHARS}, {q.WORDS_SQL}
SELECT 'character' AS kind, token, token_id, frequency FROM char_rank
UNION ALL SELECT 'word', token, rank, frequency FROM word_rank""",
    "bpe_pieces": f"WITH {_PIECES} SELECT * FROM pieces",
    "bpe_pair_counts": f"""WITH {_PIECES}
SELECT substr(piece, i, 2) AS pair, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT piece, n, unnest(range(1, length(piece))) AS i FROM pieces) GROUP BY 1""",
    "bpe_sequence_counts": f"""WITH {_PIECES},
long_pieces AS (SELECT piece, n FROM pieces WHERE length(piece) > 1),
placed AS (SELECT piece, n, unnest(range(1, length(piece))) AS i FROM long_pieces),
pair_n AS (SELECT substr(piece, i, 2) AS pair, sum(n) AS n FROM placed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {CANDIDATE_PAIRS}),
ok AS (SELECT piece, n, i FROM placed WHERE substr(piece, i, 2) IN (SELECT pair FROM pair_n)),
ends AS (
  SELECT piece, n, i, i - row_number() OVER (PARTITION BY piece ORDER BY i) AS run FROM ok),
runs AS (SELECT piece, any_value(n) AS n, min(i) AS a, count(*) + 1 AS symbols FROM ends GROUP BY piece, run),
cut AS (
  SELECT substr(piece, a, symbols) AS sequence, n FROM runs WHERE symbols <= {SEQUENCE_LENGTH}
  UNION ALL SELECT substr(piece, a + unnest(range(0, symbols - {SEQUENCE_LENGTH} + 1)), {SEQUENCE_LENGTH}), n
  FROM runs WHERE symbols > {SEQUENCE_LENGTH}
  UNION ALL SELECT substr(piece, a + unnest(range(1, symbols - {SEQUENCE_LENGTH} + 1)), {SEQUENCE_LENGTH} - 1), -n
  FROM runs WHERE symbols > {SEQUENCE_LENGTH})
SELECT sequence, CAST(sum(n) AS BIGINT) AS n FROM cut GROUP BY sequence HAVING sum(n) != 0""",
    "bpe_encoded_text": "SELECT doc_id, text FROM documents",
    "most_similar_pairs": f"""WITH {_TOP_VECTORS}, {_PAIRS}
SELECT token_1, token_2, round(similarity, 6) AS similarity FROM pairs
ORDER BY round(pairs.similarity, 12) DESC, idx_1, idx_2 LIMIT 10""",
    "least_similar_pairs": f"""WITH {_TOP_VECTORS}, {_PAIRS}
SELECT token_1, token_2, round(similarity, 6) AS similarity FROM pairs
ORDER BY round(pairs.similarity, 12), idx_1, idx_2 LIMIT 10""",
    "pair_similarity": f"""WITH {_TOP_VECTORS}, {_PAIRS}
SELECT token_1, token_2, round(similarity, 6) AS similarity FROM pairs""",
    "similarity_summary": f"""WITH {_TOP_VECTORS}, {_PAIRS}
SELECT count(*) AS pairs, round(max(similarity), 6) AS highest_similarity,
  round(min(similarity), 6) AS lowest_similarity, round(avg(similarity), 6) AS average_similarity FROM pairs""",
    "pair_lookup": """SELECT a.vec_id AS token_a, b.vec_id AS token_b,
  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine_similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "nudged_similarity": f"""WITH RECURSIVE {_NUDGE}
SELECT token_1, token_2, round(original_similarity, 6) AS original_similarity,
  round(improved_similarity, 6) AS improved_similarity, round(change, 6) AS change FROM changes""",
    "top_improvements": f"""WITH RECURSIVE {_NUDGE}
SELECT token_1, token_2, round(change, 6) AS change FROM changes
ORDER BY round(changes.change, 12) DESC, idx_1, idx_2 LIMIT 10""",
    "improvement_statistics": f"""WITH RECURSIVE {_NUDGE}
SELECT (SELECT count(*) FROM related) AS related_pairs_detected, count(*) AS total_pairs_analyzed,
  round(avg(original_similarity), 6) AS average_similarity_before,
  round(avg(improved_similarity), 6) AS average_similarity_after,
  round(avg(change), 6) AS average_similarity_change FROM changes""",
    "together_improvements": f"""WITH {_TOGETHER}
SELECT token_1, token_2, round(change, 6) AS change FROM changes
ORDER BY round(changes.change, 12) DESC, idx_1, idx_2 LIMIT 10""",
    "together_statistics": f"""WITH {_TOGETHER}
SELECT (SELECT count(*) FROM related) AS related_pairs_detected, count(*) AS total_pairs_analyzed,
  round(avg(original_similarity), 6) AS average_similarity_before,
  round(avg(improved_similarity), 6) AS average_similarity_after,
  round(avg(change), 6) AS average_similarity_change FROM changes""",
}
