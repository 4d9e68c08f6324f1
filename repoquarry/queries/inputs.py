"""The driver's tables seen as repository data, in Spark and in SQL.

documents are files (source = repository), pages.url are paths of a site's files, orders are commits
(priority = repository, customer = author), lineitem rows are the file changes of an order, part is a
snapshot of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.session import spread
from repoquarry.sources.commit_log import parse_commits

SUFFIXES = [".py", ".pyx", ".h", ".JS", ".md", ""]
REPOSITORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: list[str], number):
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """(repository, file_path, text)."""
    path = F.concat(F.lit("src/"), "lang", F.lit("/doc"), "doc_id", _pick(SUFFIXES, F.col("doc_id")))
    docs = table(spark, sf, "documents")
    return spread(docs.select(F.col("source").alias("repository"), path.alias("file_path"), "text"))


def document_texts(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


def page_files(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, repository, file_path) of page addresses without query and fragment."""
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("repository"),
        F.regexp_replace(F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1), "/+$", "").alias(
            "file_path"
        ),
    )


def commit_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(repository, seq, value): lines of a commit metadata log, newest first."""
    orders = table(spark, sf, "orders")
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date"))
    date = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        _pick(["+00:00", "-05:00", "+09:00"], F.col("o_orderkey")),
    )
    orders = spread(orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))
    return orders.select(
        F.col("o_orderpriority").alias("repository"),
        F.struct((-day).cast("bigint").alias("block"), F.col("o_orderkey").alias("row")).alias("seq"),
        F.concat_ws(
            "\t", F.col("o_orderkey").cast("string"), F.concat(F.lit("customer "), "o_custkey"), date
        ).alias("value"),
    )


def commits(spark: SparkSession, sf: str) -> DataFrame:
    return parse_commits(commit_lines(spark, sf))


def all_changes(spark: SparkSession, sf: str) -> DataFrame:
    """(commit_hash, additions, deletions, file_path); line number 7 stands for binary files."""
    line = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"))
    return line.select(
        F.col("l_orderkey").cast("string").alias("commit_hash"),
        F.when(F.col("l_linenumber") == 7, "-")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("additions"),
        F.col("l_linenumber").cast("string").alias("deletions"),
        F.concat(F.lit("part/"), "l_partkey", F.lit(".py")).alias("file_path"),
    )


def changes_of(commits_window: DataFrame, changes: DataFrame) -> DataFrame:
    return changes.join(commits_window.select("repository", "commit_hash"), "commit_hash")


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Untidy source rows, all text, in the order of ``_row``: part as files of five repositories."""
    part = table(spark, sf, "part")
    return part.select(
        F.concat(F.lit(" "), _pick(REPOSITORIES, F.col("p_partkey")), F.lit("\t")).alias(" Repository "),
        F.concat(F.lit("part\\"), "p_partkey", F.lit(".py")).alias("File_Path"),
        F.lit(" Python").alias("language"),
        F.lit(".py ").alias("extension"),
        F.col("p_size").cast("string").alias("loc"),
        F.concat(F.floor("p_retailprice").cast("string"), F.lit(".5")).alias("size_bytes"),
        F.col("p_partkey").alias("_row"),
    )


def untidy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as source rows with many copies of each key and numbers that are none."""
    line = spread(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
        )
    )
    n = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return line.select(
        F.concat(F.lit("\t"), "l_returnflag", F.lit(" ")).alias("repository"),
        F.concat(F.lit("part\\"), "l_partkey", F.lit(".py")).alias("file_path"),
        F.col("l_linestatus").alias("language"),
        F.lit(".py").alias("extension"),
        F.when(n == 1, F.concat(quantity, F.lit("d")))
        .when(n == 2, F.lit("inf"))
        .when(n == 3, F.concat(F.lit("-"), quantity))
        .when(n == 4, F.concat(quantity, F.lit(".75")))
        .otherwise(quantity)
        .alias("loc"),
        F.when(n == 5, F.lit("NaN")).otherwise(F.col("l_suppkey").cast("string")).alias("size_bytes"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_linestatus").alias("_row"),
    )


# --- the same in SQL ------------------------------------------------------------------------------

# White space, word alternatives and the languages of file suffixes, as in functions/text.py and paths.py.
SPACE = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORDS = (
    r"[A-Za-z_][A-Za-z0-9_]*|\p{Nd}+(?:\.\p{Nd}+)?|==|!=|<=|>=|->|=>|::|&&|\|\||[^" + SPACE + "]"
)

LANGUAGE_SQL = """CASE extension WHEN '.py' THEN 'Python' WHEN '.pyx' THEN 'Cython' WHEN '.pxd' THEN 'Cython'
  WHEN '.pxi' THEN 'Cython' WHEN '.c' THEN 'C' WHEN '.h' THEN 'C/C++' WHEN '.cpp' THEN 'C++'
  WHEN '.hpp' THEN 'C++' WHEN '.java' THEN 'Java' WHEN '.js' THEN 'JavaScript' WHEN '.ts' THEN 'TypeScript'
  WHEN '.rs' THEN 'Rust' WHEN '.go' THEN 'Go' WHEN '.f90' THEN 'Fortran' WHEN '.f' THEN 'Fortran' END"""

FILES_SQL = f"""doc_files AS (
  SELECT source AS repository,
    'src/' || lang || '/doc' || doc_id || (['.py', '.pyx', '.h', '.JS', '.md', ''])[doc_id % 6 + 1] AS file_path,
    text FROM documents),
listing AS (
  SELECT *, lower(regexp_extract(regexp_extract(file_path, '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1)) AS extension
  FROM doc_files),
metrics AS (
  SELECT repository, file_path, {LANGUAGE_SQL} AS language, extension,
    CAST(length(text) - length(replace(text, chr(10), ''))
      + CASE WHEN text <> '' AND right(text, 1) <> chr(10) THEN 1 ELSE 0 END AS BIGINT) AS loc,
    CAST(strlen(text) AS BIGINT) AS size_bytes
  FROM listing WHERE {LANGUAGE_SQL} IS NOT NULL)"""

COMMITS_SQL = """commits AS (
  SELECT o_orderpriority AS repository, o_orderkey AS commit_hash, 'customer ' || o_custkey AS author,
    strftime(o_orderdate, '%Y-%m') AS month, CAST(o_orderdate AS DATE) AS day FROM orders),
recent AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repository ORDER BY day DESC, commit_hash) AS rn
    FROM commits) WHERE rn <= 400),
changes AS (
  SELECT r.repository, l.l_orderkey AS commit_hash, 'part/' || l_partkey || '.py' AS file_path,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS additions,
    CAST(l_linenumber AS BIGINT) AS deletions
  FROM lineitem l JOIN recent r ON l.l_orderkey = r.commit_hash),
change_counts AS (
  SELECT repository, file_path, count(*) AS change_count FROM changes GROUP BY ALL)"""

COMBINED_SQL = (
    COMMITS_SQL
    + """,
source AS (
  SELECT (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[p_partkey % 5 + 1] AS repository,
    'part/' || p_partkey || '.py' AS file_path, 'Python' AS language, '.py' AS extension,
    CAST(p_size AS BIGINT) AS loc, CAST(floor(p_retailprice) AS BIGINT) AS size_bytes FROM part),
combined AS (
  SELECT s.*, coalesce(c.change_count, 0) AS change_count, coalesce(c.change_count, 0) > 0 AS history_present
  FROM source s LEFT JOIN change_counts c USING (repository, file_path))"""
)

PAGES_SQL = """page_files AS (
  SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS repository,
    regexp_replace(regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1), '/+$', '') AS file_path FROM pages)"""

WORDS_SQL = f"""word_docs AS (
  SELECT doc_id, regexp_extract_all(text, '{WORDS}') AS tokens FROM documents),
word_rows AS (SELECT unnest(tokens) AS token FROM word_docs),
word_freq AS (SELECT token, count(*) AS frequency FROM word_rows GROUP BY token),
word_rank AS (
  SELECT token, frequency, row_number() OVER (ORDER BY frequency DESC, token) AS rank FROM word_freq),
top50 AS (SELECT CAST(rank - 1 AS INTEGER) AS idx, token, frequency FROM word_rank WHERE rank <= 50)"""
