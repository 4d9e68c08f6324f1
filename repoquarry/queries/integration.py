"""Stage two over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from repoquarry.operators import files as fo
from repoquarry.operators import history as ho
from repoquarry.operators import integration as io
from repoquarry.operators import statistics as so
from repoquarry.queries import inputs as q


def untidy_history(spark, sf):
    """Untidy history rows: every change of the commit window counts 1."""
    recent = ho.latest_commits(q.commits(spark, sf))
    changes = q.changes_of(recent, q.all_changes(spark, sf))
    return changes.select(
        F.concat(F.lit(" "), "repository", F.lit("\t")).alias("repository"),
        F.replace("file_path", F.lit("/"), F.lit("\\")).alias("File_Path"),
        F.lit("1.0").alias("change_count"),
    )


def untidy_snapshot(spark, sf):
    """The snapshot under the plain column names, as a file of metrics has them."""
    table = q.snapshot(spark, sf).drop("_row")
    return table.toDF(*[c.strip().lower() for c in table.columns])


def combined_with(spark, sf, history):
    """The cleaned snapshot with the changes of (repository, file_path, change_count) rows."""
    return io.combine(io.clean_source(q.snapshot(spark, sf)), history)


def _combined(spark, sf):
    return combined_with(spark, sf, io.clean_history(untidy_history(spark, sf)))


def _metrics(spark, sf):
    return fo.file_metrics(fo.measure_text(q.document_files(spark, sf)))


def rounded(rows):
    return rows.withColumn("average", F.round("average", 6))


def clean_source(spark, sf):
    return io.clean_source(q.untidy_lines(spark, sf)).drop("_row")


def clean_history(spark, sf):
    return io.clean_history(
        q.untidy_lines(spark, sf).select("repository", "file_path", F.col("loc").alias("change_count"))
    )


def union_repositories(spark, sf):
    parts = [
        io.tag_repository(q.page_files(spark, sf).select("file_path"), " Pages "),
        io.tag_repository(q.document_files(spark, sf).select("file_path"), "Documents"),
    ]
    return io.union_repositories(parts)


def combined(spark, sf):
    return _combined(spark, sf)


def hotspots(spark, sf):
    return so.hotspots(_combined(spark, sf))


def largest_combined(spark, sf):
    return so.largest(_combined(spark, sf))


def source_stats(spark, sf):
    return rounded(so.source_statistics(_metrics(spark, sf)))


def history_stats(spark, sf):
    recent = ho.latest_commits(q.commits(spark, sf))
    counts = ho.change_counts(q.changes_of(recent, q.all_changes(spark, sf)))
    return rounded(so.history_statistics(counts))


def source_stats_untidy(spark, sf):
    """Statistics of rows as they come in: fractions count in full, texts that are no numbers do not."""
    return rounded(so.source_statistics(q.untidy_lines(spark, sf)))


def history_stats_untidy(spark, sf):
    rows = q.untidy_lines(spark, sf).select("repository", "file_path", F.col("loc").alias("change_count"))
    return rounded(so.history_statistics(rows))


def combined_stats(spark, sf):
    return rounded(so.combined_statistics(_combined(spark, sf)))


QUERIES = {
    f.__name__: f
    for f in (
        clean_source,
        clean_history,
        union_repositories,
        combined,
        hotspots,
        largest_combined,
        source_stats,
        history_stats,
        source_stats_untidy,
        history_stats_untidy,
        combined_stats,
    )
}


def _stats(parts: list[tuple[str, str, str, str]], source: str) -> str:
    """One SELECT per statistic: (section, key expression, kind, expression)."""
    selects = []
    for section, key, kind, expression in parts:
        amount = f"CAST(trunc(CAST({expression} AS DECIMAL(38, 2))) AS BIGINT)" if kind == "amount" else "NULL::BIGINT"
        average = f"round({expression}, 6)" if kind == "average" else "NULL::DOUBLE"
        group = "" if key == "''" else f" GROUP BY {key}"
        selects.append(
            f"SELECT '{section}' AS section, {key} AS key, {amount} AS amount, {average} AS average"
            f" FROM {source}{group}"
        )
    return "\nUNION ALL ".join(selects)


_SOURCE = [
    ("total_records", "''", "amount", "count(*)"),
    ("repositories", "''", "amount", "count(DISTINCT repository)"),
    ("source_files", "''", "amount", "count(DISTINCT file_path)"),
    ("languages", "language", "amount", "count(*)"),
    ("extensions", "extension", "amount", "count(*)"),
    ("records_per_repository", "repository", "amount", "count(*)"),
    ("total_loc", "''", "amount", "sum(loc)"),
    ("average_loc", "''", "average", "avg(loc)"),
    ("maximum_loc", "''", "amount", "max(loc)"),
    ("minimum_loc", "''", "amount", "min(loc)"),
    ("total_size_bytes", "''", "amount", "sum(size_bytes)"),
    ("average_size_bytes", "''", "average", "avg(size_bytes)"),
]
_HISTORY = [
    ("total_records", "''", "amount", "count(*)"),
    ("repositories", "''", "amount", "count(DISTINCT repository)"),
    ("unique_files", "''", "amount", "count(DISTINCT file_path)"),
    ("total_change_events", "''", "amount", "sum(change_count)"),
    ("average_change_count", "''", "average", "avg(change_count)"),
    ("maximum_change_count", "''", "amount", "max(change_count)"),
    ("minimum_change_count", "''", "amount", "min(change_count)"),
    ("records_per_repository", "repository", "amount", "count(*)"),
    ("changes_per_repository", "repository", "amount", "sum(change_count)"),
]
_COMBINED = [
    ("total_records", "''", "amount", "count(*)"),
    ("repositories", "''", "amount", "count(DISTINCT repository)"),
    ("total_loc", "''", "amount", "sum(loc)"),
    ("average_loc", "''", "average", "avg(loc)"),
    ("total_size_bytes", "''", "amount", "sum(size_bytes)"),
    ("average_size_bytes", "''", "average", "avg(size_bytes)"),
    ("total_change_count", "''", "amount", "sum(change_count)"),
    ("average_change_count", "''", "average", "avg(change_count)"),
    ("files_with_history", "''", "amount", "count(*) FILTER (history_present)"),
    ("files_without_history", "''", "amount", "count(*) FILTER (NOT history_present)"),
    ("languages", "language", "amount", "count(*)"),
    ("records_per_repository", "repository", "amount", "count(*)"),
]

_LINES = """lines AS (
  SELECT l_returnflag AS repository, 'part/' || l_partkey || '.py' AS file_path, l_linestatus AS language,
    '.py' AS extension, CAST(l_quantity AS BIGINT) AS loc, l_suppkey AS size_bytes, l_linenumber,
    l_orderkey, l_suppkey, l_quantity, l_linestatus FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3))"""

_UNTIDY = """untidy AS (
  SELECT chr(9) || l_returnflag || ' ' AS repository, 'part\\' || l_partkey || '.py' AS file_path,
    l_linestatus AS language, '.py' AS extension,
    CASE WHEN l_linenumber IN (1, 2) THEN NULL WHEN l_linenumber = 3 THEN -CAST(l_quantity AS INT)
      WHEN l_linenumber = 4 THEN CAST(l_quantity AS INT) + 0.75 ELSE CAST(l_quantity AS INT) END AS loc,
    CASE WHEN l_linenumber <> 5 THEN l_suppkey END AS size_bytes FROM lineitem),
untidy_history AS (SELECT repository, file_path, loc AS change_count FROM untidy)"""

ORACLE = {
    "clean_source": f"""WITH {_LINES}
SELECT repository, file_path, language, extension, loc, size_bytes FROM lines WHERE l_linenumber <> 5
QUALIFY row_number() OVER (PARTITION BY repository, file_path
  ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_linestatus) = 1""",
    "clean_history": f"""WITH {_LINES}
SELECT repository, file_path, CAST(sum(loc) AS BIGINT) AS change_count FROM lines GROUP BY ALL""",
    "union_repositories": f"""WITH {q.PAGES_SQL}, {q.FILES_SQL}
SELECT 'pages' AS repository, file_path FROM page_files
UNION ALL SELECT 'documents', file_path FROM doc_files""",
    "combined": f"WITH {q.COMBINED_SQL} SELECT * FROM combined",
    "hotspots": f"""WITH {q.COMBINED_SQL} SELECT repository, file_path, change_count FROM combined
ORDER BY change_count DESC, repository, file_path LIMIT 10""",
    "largest_combined": f"""WITH {q.COMBINED_SQL} SELECT repository, file_path, loc FROM combined
ORDER BY loc DESC, repository, file_path LIMIT 10""",
    "source_stats": f"WITH {q.FILES_SQL} {_stats(_SOURCE, 'metrics')}",
    "history_stats": f"WITH {q.COMMITS_SQL} {_stats(_HISTORY, 'change_counts')}",
    "source_stats_untidy": f"WITH {_UNTIDY} {_stats(_SOURCE, 'untidy')}",
    "history_stats_untidy": f"WITH {_UNTIDY} {_stats(_HISTORY, 'untidy_history')}",
    "combined_stats": f"WITH {q.COMBINED_SQL} {_stats(_COMBINED, 'combined')}",
}
