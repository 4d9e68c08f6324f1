"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from repoquarry.queries import QUERIES  # noqa: E402

HEADLINE = [
    "file_metrics",
    "tree_totals",
    "contributors",
    "commits_per_month",
    "commit_totals",
    "latest_commits",
    "change_counts",
    "churn",
    "clean_source",
    "clean_history",
    "combined",
    "hotspots",
    "source_stats",
    "combined_stats",
    "char_vocab",
    "word_vocab",
    "char_ids",
    "sequence_stats",
    "bpe_pieces",
    "bpe_train",
    "bpe_encode",
    "pair_similarity",
    "nudged_similarity",
    "token_positions",
    "token_contexts",
    "structural_embedding",
    "similarity_comparison",
    "report_rows",
    "bpe_train_texts",
    "word2vec_vectors",
    "stage_three",
    "stage_four",
    "word_vocab_first_seen",
    "closest_embeddings",
    "renamed_change_counts",
    "scanned_files",
    "integrated_folder",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["language_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    QUERIES["char_vocab"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
