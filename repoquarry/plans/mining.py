"""Stage one: file trees and commit logs to metrics per repository."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.operators import files as fo
from repoquarry.operators import history as ho
from repoquarry.operators.renames import renamed_change_counts
from repoquarry.operators.report import report_rows
from repoquarry.session import materialize, ship_package
from repoquarry.sources import commit_log, tree


def mine(
    listing: DataFrame,
    sources: DataFrame,
    commits: DataFrame,
    recent: DataFrame,
    changes: DataFrame,
    folders: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Metrics of every repository at once.

    ``listing`` has all files, ``sources`` the measured source files, ``commits`` the commits of all
    refs, ``recent`` the commit window of the current branch and ``changes`` its changed files.
    ``folders`` lists folders where the export knows them, ``counts`` the changes per file where they are
    not simply counted by path.
    """
    metrics = fo.file_metrics(sources)
    counts = ho.change_counts(changes) if counts is None else counts
    out = {
        "file_metrics": metrics,
        "history_metrics": counts,
        "extension_counts": fo.extension_counts(listing),
        "language_counts": fo.language_counts(metrics),
        "tree_totals": fo.tree_totals(listing, metrics, folders=folders),
        "largest_files": fo.largest_files(metrics),
        "contributors": ho.contributors(commits),
        "commit_totals": ho.commit_totals(commits),
        "commits_per_month": ho.commits_per_month(commits),
        "churn": ho.churn(recent, changes),
        "top_changed_files": ho.top_changed_files(counts),
    }
    out["report"] = report_rows(
        out["tree_totals"],
        out["language_counts"],
        out["extension_counts"],
        out["largest_files"],
        out["commit_totals"],
        out["churn"],
        out["top_changed_files"],
        out["commits_per_month"],
    )
    return out


def mine_folders(
    spark: SparkSession,
    trees: str,
    commit_logs: str,
    change_logs: str,
    window: int = ho.HISTORY_WINDOW,
    follow_renames: bool = False,
    log_names: tuple[str | None, str | None] = (None, None),
) -> dict[str, DataFrame]:
    """The same from exports: <trees>/<repository>/..., and log files one folder per repository.

    With ``follow_renames`` the counts of a file's former names are part of its own. ``log_names`` are the
    names of the folders that hold the logs' part files, where a log is not one file.
    """
    ship_package(spark)
    recent, _ = materialize(ho.latest_commits(commit_log.read_changes(spark, change_logs, log_names[1]), window), "recent")
    entries = tree.scan(spark, trees)
    listing = tree.files_of(entries)
    sources, _ = materialize(tree.measure_sources(listing, trees), "sources")
    commits, _ = materialize(commit_log.read_commits(spark, commit_logs, log_names[0]), "commits")  # parsed once
    changes = ho.change_rows(recent, keep=["seq"])
    counts = renamed_change_counts(changes, [F.col("seq")]) if follow_renames else None
    return mine(listing, sources, commits, recent.drop("changes"), changes.drop("seq"), tree.folders_of(entries), counts)
