"""Readers, writers and whole stages over files: the driver's tables are written as trees, logs and tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry import schemas, sinks
from repoquarry.operators import pairs as po
from repoquarry.operators import renames as ro
from repoquarry.operators import selection as sel
from repoquarry.operators import vocabulary as vo
from repoquarry.plans import integration as stage_two
from repoquarry.plans import mining as stage_one
from repoquarry.queries import inputs as q
from repoquarry.queries import integration as qi
from repoquarry.queries import mining as qm
from repoquarry.queries import tokens as qt
from repoquarry.session import application_folder
from repoquarry.sources import commit_log, tables, tree

RANGE_BYTES = 1_024  # so that ordinary texts are read in several ranges, as huge files are
COMMIT_LOG, CHANGE_LOG = "commits.log", "changes.log"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _trees(spark: SparkSession, sf: str) -> str:
    """documents as files of trees, one folder per source."""
    root = _folder(spark, "trees")
    files = q.document_files(spark, sf)
    sinks.write_files(files.select(F.concat_ws("/", "repository", "file_path").alias("path"), F.col("text").alias("content")), root)
    return root


def _commit_logs(spark: SparkSession, sf: str) -> str:
    root = _folder(spark, "commit_logs")
    lines = q.commit_lines(spark, sf)
    sinks.write_files(sinks.log_files(lines, [F.asc("seq")], COMMIT_LOG), root)
    return root


def _change_logs(spark: SparkSession, sf: str, changes: DataFrame) -> str:
    """One record per commit with its changes below; an order has at most a few of them."""
    root = _folder(spark, "change_logs")
    row = F.concat_ws("\t", "additions", "deletions", "file_path")
    rows = changes.groupBy("commit_hash").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    commits = q.commits(spark, sf).select("repository", "seq", "commit_hash", "author_date")
    joined = commits.join(rows, "commit_hash", "left")
    head = F.concat_ws("\t", F.lit("COMMIT"), "commit_hash", "author_date")
    below = F.coalesce(F.concat(F.lit("\n\n"), F.array_join("rows", "\n")), F.lit(""))
    lines = joined.select("repository", "seq", F.concat(head, below).alias("value"))
    sinks.write_files(sinks.log_files(lines, [F.asc("seq")], CHANGE_LOG), root)
    return root


def _metric_tables(spark: SparkSession, sf: str) -> str:
    """The untidy snapshot and history as CSV files, one folder per repository."""
    root = _folder(spark, "metrics")
    parts = [("file_metrics.csv", schemas.FILE_METRIC_COLUMNS, qi.untidy_snapshot(spark, sf)), ("git_history_metrics.csv", schemas.HISTORY_COLUMNS, qi.untidy_history(spark, sf))]
    for name, columns, table in parts:
        named = table.select(*[F.col(c) for c in ["repository", *columns]])
        lines = named.select(F.trim(F.btrim("repository", F.lit("\t "))).alias("repository"), F.to_csv(F.struct(*columns)).alias("value"))
        files = sinks.log_files(lines, [F.asc("value")], name, header=",".join(columns) + "\n")
        sinks.write_files(files.withColumn("path", F.concat("path", F.lit(".csv"))), root)
    return root


def scanned_files(spark, sf):
    """Trees written, listed folder by folder and measured in ranges."""
    root = _trees(spark, sf)
    listing = tree.files_of(tree.scan(spark, root))
    return tree.measure_sources(listing, root, RANGE_BYTES)


def logged_commits(spark, sf):
    """Commits read back from logs of several files."""
    commits = commit_log.read_commits(spark, f"{_commit_logs(spark, sf)}/*/{COMMIT_LOG}", COMMIT_LOG)
    return commits.select("repository", "commit_hash", "author", "month")


def _mined(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    changes = _change_logs(spark, sf, q.all_changes(spark, sf))
    return stage_one.mine_folders(
        spark,
        _trees(spark, sf),
        f"{_commit_logs(spark, sf)}/*/{COMMIT_LOG}",
        f"{changes}/*/{CHANGE_LOG}",
        log_names=(COMMIT_LOG, CHANGE_LOG),
    )


def mined_churn(spark, sf):
    """The whole first stage from files: churn of the newest commits."""
    return qm.rounded_churn(_mined(spark, sf)["churn"])


def mined_report(spark, sf):
    """The whole first stage from files: its report."""
    return _mined(spark, sf)["report"]


def integrated_folder(spark, sf):
    """The whole second stage from CSV files: the combined table."""
    rows = stage_two.integrate_folder(spark, _metric_tables(spark, sf))["combined"]
    return rows.withColumn("repository", F.upper("repository"))  # folder names become lower case


def integrated_statistics(spark, sf):
    """Statistics of the second stage, written as JSON lines and read again."""
    path = _folder(spark, "statistics")
    rows = stage_two.integrate_folder(spark, _metric_tables(spark, sf))["combined_statistics"]
    sinks.write_statistics_json(rows, path)
    return qi.rounded(spark.read.schema(rows.schema).json(path))


def combined_table(spark, sf):
    """The combined table written by repository and read again."""
    path = _folder(spark, "combined")
    sinks.write_combined(qi.combined(spark, sf), path)
    return spark.read.parquet(path).select(*schemas.COMBINED_COLUMNS)


def listed_words(spark, sf):
    """The full word listing as CSV files in order, read with the place of each row."""
    path = _folder(spark, "words")
    order = [F.desc("frequency"), F.asc("token")]
    sinks.write_sorted_csv(qt.word_frequency(spark, sf), path, ["token", "frequency"], order)
    return tables.read_token_frequency(spark, path)


def selected_from_listing(spark, sf):
    """Chosen ranks of the listing that was read from files."""
    return sel.select_tokens(listed_words(spark, sf), qt.RANKS)


def character_vocabulary_file(spark, sf):
    """Character ids as one JSON object, read again; it has at most as many entries as there are characters."""
    path = _folder(spark, "characters")
    entries = F.map_from_entries(F.collect_list(F.struct("token", F.col("token_id").cast("int"))))
    qt.char_vocab(spark, sf).agg(F.to_json(entries).alias("value")).write.text(path)
    return tables.read_vocabulary_json(spark, path)


def word_vocabulary_table(spark, sf):
    path = _folder(spark, "vocabulary")
    sinks.write_vocabulary(qt.word_vocab(spark, sf), path)
    return spark.read.schema(schemas.VOCAB_SCHEMA).parquet(path)


def aligned_embeddings(spark, sf):
    """Vectors written and read with a check against their tokens, then summed up."""
    path = _folder(spark, "vectors")
    sinks.write_embeddings(qt.top_word_vectors(spark, sf), path)
    vectors = tables.load_aligned_embeddings(spark, path, qt.top_words(spark, sf))
    row = po.similarity_summary(vectors)
    return row.select("pairs", *[F.round(c, 6).alias(c) for c in row.columns if c != "pairs"])


def text_fallback(spark, sf):
    """Texts from the first column that a table has; blank ones are left out where that is asked for."""
    files = q.document_files(spark, sf)
    code = files.select(F.when(F.length("text") % 7 == 0, F.lit(" \n\t")).otherwise(F.col("text")).alias("code"), "file_path")
    parts = [
        vo.documents(code, skip_blank=True).select(F.lit("code").alias("part"), F.length("text").alias("n")),
        vo.documents(code).select(F.lit("code, blank ones too").alias("part"), F.length("text").alias("n")),
        vo.documents(files.select("file_path")).select(F.lit("file_path").alias("part"), F.length("text").alias("n")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("characters"))


# --- renames ---------------------------------------------------------------------------------------


def _renaming_changes(spark: SparkSession, sf: str) -> DataFrame:
    """(repository, seq, file_path): line number 5 of an order renames a part to the next number of its ten."""
    line = q.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part, following = F.col("l_partkey"), F.col("l_partkey") + 1
    is_rename = (F.col("l_linenumber") == 5) & (part % 10 != 9)
    whole = F.concat(F.lit("part/"), part, F.lit(".py => part/"), following, F.lit(".py"))
    inside = F.concat(F.lit("part/{"), part, F.lit(".py => "), following, F.lit(".py}"))
    path = F.when(is_rename & (part % 2 == 0), whole).when(is_rename, inside).otherwise(F.concat(F.lit("part/"), part, F.lit(".py")))
    changes = line.select(F.col("l_orderkey").cast("string").alias("commit_hash"), path.alias("file_path"))
    return changes.join(q.commits(spark, sf).select("repository", "seq", "commit_hash"), "commit_hash")


def path_histories(spark, sf):
    """The last name of every path that was ever renamed."""
    return ro.path_histories(_renaming_changes(spark, sf), [F.col("seq")])


def renamed_change_counts(spark, sf):
    return ro.renamed_change_counts(_renaming_changes(spark, sf), [F.col("seq")])


def renamed_snapshot(spark, sf):
    """Files of the snapshot with the changes under all their names."""
    counts = ro.renamed_change_counts(_renaming_changes(spark, sf), [F.col("seq")])
    return qi.combined_with(spark, sf, counts)


QUERIES = {
    f.__name__: f
    for f in (
        scanned_files,
        logged_commits,
        mined_churn,
        mined_report,
        integrated_folder,
        integrated_statistics,
        combined_table,
        listed_words,
        selected_from_listing,
        character_vocabulary_file,
        word_vocabulary_table,
        aligned_embeddings,
        text_fallback,
        path_histories,
        renamed_change_counts,
        renamed_snapshot,
    )
}

# --- SQL ------------------------------------------------------------------------------------------

_RENAMES = f"""{q.COMMITS_SQL},
renaming AS (
  SELECT c.repository, -datediff('day', DATE '1970-01-01', c.day) AS place, l_orderkey, l_partkey AS p,
    l_linenumber = 5 AND l_partkey % 10 != 9 AS is_rename
  FROM lineitem l JOIN commits c ON l.l_orderkey = c.commit_hash),
edges AS (SELECT DISTINCT repository, p FROM renaming WHERE is_rename),
chains AS (SELECT *, p - row_number() OVER (PARTITION BY repository ORDER BY p) AS chain FROM edges),
members AS (SELECT repository, chain, p FROM chains UNION SELECT repository, chain, p + 1 FROM chains),
newest AS (
  SELECT e.repository, chain,
    first(e.p + 1 ORDER BY place, l_orderkey, 'part/' || (e.p + 1) || '.py') AS last
  FROM renaming e JOIN chains USING (repository, p) WHERE is_rename GROUP BY 1, 2),
histories AS (
  SELECT repository, 'part/' || p || '.py' AS path, 'part/' || last || '.py' AS file_path
  FROM members JOIN newest USING (repository, chain)),
counted AS (
  SELECT repository, 'part/' || (p + is_rename::INT) || '.py' AS path, count(*) AS n FROM renaming GROUP BY 1, 2),
renamed_counts AS (
  SELECT c.repository, coalesce(h.file_path, c.path) AS file_path, CAST(sum(n) AS BIGINT) AS change_count
  FROM counted c LEFT JOIN histories h USING (repository, path) GROUP BY 1, 2)"""

ORACLE = {
    "scanned_files": f"""WITH {q.FILES_SQL}
SELECT repository, file_path, size_bytes, loc FROM metrics""",
    "logged_commits": f"WITH {q.COMMITS_SQL} SELECT repository, commit_hash::VARCHAR AS commit_hash, author, month FROM commits",
    "mined_churn": qm.ORACLE["churn"],
    "mined_report": qm.ORACLE["report_rows"],
    "integrated_folder": qi.ORACLE["combined"],
    "integrated_statistics": qi.ORACLE["combined_stats"].replace(
        "SELECT s.*, coalesce", "SELECT s.* REPLACE (lower(s.repository) AS repository), coalesce"
    ),
    "combined_table": qi.ORACLE["combined"],
    "listed_words": f"WITH {q.WORDS_SQL} SELECT token, frequency FROM word_freq",
    "selected_from_listing": qt.ORACLE["select_tokens"],
    "character_vocabulary_file": "SELECT token, token_id::INTEGER AS id FROM ({}) AS v".format(qt.ORACLE["char_vocab"]),
    "word_vocabulary_table": qt.ORACLE["word_vocab"],
    "aligned_embeddings": qt.ORACLE["similarity_summary"],
    "text_fallback": f"""WITH {q.FILES_SQL},
code AS (SELECT CASE WHEN length(text) % 7 = 0 THEN 3 ELSE length(text) END AS n,
  length(text) % 7 = 0 OR NOT regexp_matches(text, '[^{q.SPACE}]') AS blank, file_path FROM doc_files)
SELECT 'code' AS part, count(*) AS texts, CAST(sum(n) AS BIGINT) AS characters FROM code WHERE NOT blank
UNION ALL SELECT 'code, blank ones too', count(*), CAST(sum(n) AS BIGINT) FROM code
UNION ALL SELECT 'file_path', count(*), CAST(sum(length(file_path)) AS BIGINT) FROM code""",
    "path_histories": f"WITH {_RENAMES} SELECT * FROM histories",
    "renamed_change_counts": f"WITH {_RENAMES} SELECT * FROM renamed_counts",
    "renamed_snapshot": f"""WITH {_RENAMES},
snapshot AS (
  SELECT (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[p_partkey % 5 + 1] AS repository,
    'part/' || p_partkey || '.py' AS file_path, 'Python' AS language, '.py' AS extension,
    CAST(p_size AS BIGINT) AS loc, CAST(floor(p_retailprice) AS BIGINT) AS size_bytes FROM part)
SELECT s.*, coalesce(r.change_count, 0) AS change_count, coalesce(r.change_count, 0) > 0 AS history_present
FROM snapshot s LEFT JOIN renamed_counts r USING (repository, file_path)""",
}
