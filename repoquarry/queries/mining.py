"""Stage one over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.functions import paths
from repoquarry.operators import files as fo
from repoquarry.operators import history as ho
from repoquarry.operators.report import report_rows as build_report
from repoquarry.queries import inputs as q


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    return fo.file_metrics(fo.measure_text(q.document_files(spark, sf)))


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    return q.document_files(spark, sf).select("repository", "file_path")


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return ho.latest_commits(q.commits(spark, sf))


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return q.changes_of(_recent(spark, sf), q.all_changes(spark, sf))


def file_metrics(spark, sf):
    return _measured(spark, sf)


def extension_counts(spark, sf):
    return fo.extension_counts(q.page_files(spark, sf), keys=())


def repository_extension_counts(spark, sf):
    return fo.extension_counts(_listing(spark, sf))


def language_counts(spark, sf):
    return fo.language_counts(_measured(spark, sf))


def tree_totals(spark, sf):
    totals = fo.tree_totals(_listing(spark, sf), _measured(spark, sf))
    return totals.withColumn(
        "average_loc_per_source_file", F.round("average_loc_per_source_file", 6)
    )


def page_tree_totals(spark, sf):
    """Folder counts where the paths differ in depth."""
    files = q.page_files(spark, sf)
    return fo.folder_counts(files)


def largest_files(spark, sf):
    return fo.largest_files(_measured(spark, sf))


def contributors(spark, sf):
    return ho.contributors(q.commits(spark, sf))


def commits_per_month(spark, sf):
    return ho.commits_per_month(q.commits(spark, sf)).orderBy("repository", "month")


def commit_totals(spark, sf):
    return ho.commit_totals(q.commits(spark, sf))


def latest_commits(spark, sf):
    return _recent(spark, sf).select("repository", "commit_hash", "author", "month")


def latest_events(spark, sf):
    """The cut per key with many keys: three newest events of each user."""
    events = q.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    kept = ho.latest_commits(events, 3, [F.desc("ts"), F.asc("event_id")], ["user_id"])
    return kept.select("user_id", "event_id", "event_type")


def change_counts(spark, sf):
    return ho.change_counts(_changes(spark, sf))


def rounded_churn(out: DataFrame) -> DataFrame:
    return out.select(
        *[F.round(c, 6).alias(c) if c.startswith("average") else F.col(c) for c in out.columns]
    )


def churn(spark, sf):
    return rounded_churn(ho.churn(_recent(spark, sf), _changes(spark, sf)))


def top_changed_files(spark, sf):
    return ho.top_changed_files(ho.change_counts(_changes(spark, sf)))


def report_rows(spark, sf):
    listing, metrics = _listing(spark, sf), _measured(spark, sf)
    commits, recent, changes = q.commits(spark, sf), _recent(spark, sf), _changes(spark, sf)
    return build_report(
        fo.tree_totals(listing, metrics),
        fo.language_counts(metrics),
        fo.extension_counts(listing),
        fo.largest_files(metrics),
        ho.commit_totals(commits),
        ho.churn(recent, changes),
        ho.top_changed_files(ho.change_counts(changes)),
        ho.commits_per_month(commits),
    )


def repository_names(spark, sf):
    """Repository names from addresses, null for addresses that are none."""
    customer = q.table(spark, sf, "customer")
    hosts = F.array(*map(F.lit, ["https://github.com/", "http://WWW.GitHub.com/", "https://example.org/"]))
    host = F.get(hosts, (F.col("c_custkey") % 3).cast("int"))
    url = F.concat(host, F.lower("c_mktsegment"), F.lit("/"), F.replace("c_name", F.lit("#"), F.lit("-")), F.lit(".git/ "))
    return customer.select("c_custkey", paths.repository_from_url(url).alias("repository"))


QUERIES = {
    f.__name__: f
    for f in (
        file_metrics,
        extension_counts,
        repository_extension_counts,
        language_counts,
        tree_totals,
        page_tree_totals,
        largest_files,
        contributors,
        commits_per_month,
        commit_totals,
        latest_commits,
        latest_events,
        change_counts,
        churn,
        top_changed_files,
        report_rows,
        repository_names,
    )
}

_TOP10 = "row_number() OVER (PARTITION BY repository ORDER BY {} DESC, file_path) <= 10"
_FOLDERS = """folders AS (
  SELECT DISTINCT repository,
    unnest(list_transform(range(1, len(parts)), lambda i: array_to_string(parts[1:i], '/'))) AS folder
  FROM (SELECT repository, string_split(file_path, '/') AS parts FROM {}))"""
_TOTALS = """totals AS (
  SELECT a.repository, total_files, coalesce(source_code_files, 0) AS source_code_files,
    coalesce(directories, 0) AS directories, coalesce(total_loc, 0) AS total_loc,
    CASE WHEN coalesce(source_code_files, 0) > 0 THEN total_loc / source_code_files ELSE 0.0 END
      AS average_loc_per_source_file
  FROM (SELECT repository, count(*) AS total_files FROM listing GROUP BY 1) a
  LEFT JOIN (SELECT repository, count(*) AS source_code_files, CAST(sum(loc) AS BIGINT) AS total_loc
    FROM metrics GROUP BY 1) b USING (repository)
  LEFT JOIN (SELECT repository, count(*) AS directories FROM folders GROUP BY 1) c USING (repository))"""
_CHURN = """churn AS (
  SELECT w.*, total_files_changed, total_lines_added, total_lines_deleted,
    total_files_changed / months AS average_files_changed_per_month,
    total_lines_added / analyzed_commits AS average_added_lines_per_commit,
    total_lines_deleted / analyzed_commits AS average_deleted_lines_per_commit
  FROM (SELECT repository, count(*) AS analyzed_commits, count(DISTINCT month) AS months
    FROM recent GROUP BY 1) w
  JOIN (SELECT repository, count(*) AS total_files_changed, CAST(sum(additions) AS BIGINT) AS total_lines_added,
    CAST(sum(deletions) AS BIGINT) AS total_lines_deleted FROM changes GROUP BY 1) USING (repository))"""
_AUTHORS = """authors AS (SELECT repository, author, count(*) AS commit_count FROM commits GROUP BY ALL)"""

ORACLE = {
    "file_metrics": f"WITH {q.FILES_SQL} SELECT * FROM metrics",
    "extension_counts": f"""WITH {q.PAGES_SQL}
SELECT CASE WHEN e = '' THEN '[no extension]' ELSE e END AS extension, count(*) AS files
FROM (SELECT lower(regexp_extract(regexp_extract(file_path, '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1)) AS e
  FROM page_files) GROUP BY 1""",
    "repository_extension_counts": f"""WITH {q.FILES_SQL}
SELECT repository, CASE WHEN extension = '' THEN '[no extension]' ELSE extension END AS extension,
  count(*) AS files FROM listing GROUP BY ALL""",
    "language_counts": f"""WITH {q.FILES_SQL}
SELECT repository, language, count(*) AS files FROM metrics GROUP BY ALL""",
    "tree_totals": f"""WITH {q.FILES_SQL}, {_FOLDERS.format("listing")}, {_TOTALS}
SELECT * REPLACE (round(average_loc_per_source_file, 6) AS average_loc_per_source_file) FROM totals""",
    "page_tree_totals": f"""WITH {q.PAGES_SQL}, {_FOLDERS.format("page_files")}
SELECT repository, count(*) AS directories FROM folders GROUP BY 1""",
    "largest_files": f"""WITH {q.FILES_SQL}
SELECT repository, file_path, loc FROM metrics QUALIFY {_TOP10.format("loc")}""",
    "contributors": f"WITH {q.COMMITS_SQL}, {_AUTHORS} SELECT * FROM authors",
    "commits_per_month": f"""WITH {q.COMMITS_SQL}
SELECT repository, month, count(*) AS commits FROM commits GROUP BY ALL""",
    "commit_totals": f"""WITH {q.COMMITS_SQL}, {_AUTHORS}
SELECT repository, CAST(sum(commit_count) AS BIGINT) AS total_commits, count(*) AS number_of_contributors,
  first(author ORDER BY commit_count DESC, author) AS most_active_name,
  max(commit_count) AS most_active_commits FROM authors GROUP BY 1""",
    "latest_commits": f"""WITH {q.COMMITS_SQL}
SELECT repository, CAST(commit_hash AS VARCHAR) AS commit_hash, author, month FROM recent""",
    "latest_events": """SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 3""",
    "change_counts": f"WITH {q.COMMITS_SQL} SELECT * FROM change_counts",
    "churn": f"""WITH {q.COMMITS_SQL}, {_CHURN}
SELECT * REPLACE (round(average_files_changed_per_month, 6) AS average_files_changed_per_month,
  round(average_added_lines_per_commit, 6) AS average_added_lines_per_commit,
  round(average_deleted_lines_per_commit, 6) AS average_deleted_lines_per_commit) FROM churn""",
    "top_changed_files": f"""WITH {q.COMMITS_SQL}
SELECT * FROM change_counts QUALIFY {_TOP10.format("change_count")}""",
    "report_rows": f"""WITH {q.FILES_SQL}, {q.COMMITS_SQL}, {_FOLDERS.format("listing")}, {_TOTALS}, {_CHURN},
{_AUTHORS},
scalars AS (
  SELECT repository, '1 inventory' AS section, unnest([
    {{'ord': 1, 'key': 'total files', 'value': format('{{:,}}', total_files)}},
    {{'ord': 2, 'key': 'source-code files', 'value': format('{{:,}}', source_code_files)}},
    {{'ord': 3, 'key': 'directories', 'value': format('{{:,}}', directories)}},
    {{'ord': 4, 'key': 'total lines', 'value': format('{{:,}}', total_loc)}},
    {{'ord': 5, 'key': 'average lines per source file',
      'value': format('{{:,.2f}}', average_loc_per_source_file)}}]) AS e FROM totals
  UNION ALL
  SELECT repository, '5 history', unnest([
    {{'ord': 1, 'key': 'total commits', 'value': format('{{:,}}', commits)}},
    {{'ord': 2, 'key': 'contributors', 'value': format('{{:,}}', people)}},
    {{'ord': 3, 'key': 'most active contributor', 'value': leader}},
    {{'ord': 4, 'key': 'commits of the most active', 'value': format('{{:,}}', most)}},
    {{'ord': 5, 'key': 'commits analyzed for changes', 'value': format('{{:,}}', analyzed_commits)}},
    {{'ord': 6, 'key': 'average files changed per month',
      'value': format('{{:,.2f}}', average_files_changed_per_month)}},
    {{'ord': 7, 'key': 'average lines added per commit',
      'value': format('{{:,.2f}}', average_added_lines_per_commit)}},
    {{'ord': 8, 'key': 'average lines deleted per commit',
      'value': format('{{:,.2f}}', average_deleted_lines_per_commit)}}])
  FROM churn JOIN (SELECT repository, CAST(sum(commit_count) AS BIGINT) AS commits, count(*) AS people,
    first(author ORDER BY commit_count DESC, author) AS leader, max(commit_count) AS most
    FROM authors GROUP BY 1) USING (repository)),
counted AS (
  SELECT repository, '2 languages' AS section, language AS key, count(*) AS n FROM metrics GROUP BY ALL
  UNION ALL
  SELECT repository, '3 file types', CASE WHEN extension = '' THEN '[no extension]' ELSE extension END,
    count(*) FROM listing GROUP BY ALL
  UNION ALL
  SELECT repository, '4 largest files', file_path, loc FROM metrics QUALIFY {_TOP10.format("loc")}
  UNION ALL
  SELECT repository, '6 most changed files', file_path, change_count FROM change_counts
    QUALIFY {_TOP10.format("change_count")})
SELECT repository, section, CAST(e.ord AS BIGINT) AS ord, e.key AS key, e.value AS value FROM scalars
UNION ALL
SELECT repository, section, row_number() OVER (PARTITION BY repository, section ORDER BY n DESC, key), key,
  format('{{:,}}', n) FROM counted
UNION ALL
SELECT repository, '7 commits per month', row_number() OVER (PARTITION BY repository ORDER BY month), month,
  format('{{:,}}', n) FROM (SELECT repository, month, count(*) AS n FROM commits GROUP BY ALL)""",
    "repository_names": """SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN replace(c_name, '#', '-') END AS repository
FROM customer""",
}
