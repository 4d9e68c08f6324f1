from pyspark.sql import functions as F

from repoquarry.operators import history, integration, ranking, statistics

SOURCE = [
    # repository, file_path, language, extension, loc, size_bytes, row
    (" r ", "a\\b.py", " Python", ".py", "10", "100", 1),
    ("r", "a/b.py\t", "Other", ".py", "99", "1", 0),
    ("r", "c.py", None, ".py", "3.7", "5.0", 2),
    ("r", "d.py", "Python", ".py", "12d", "1", 3),
    ("r", "e.py", "Python", ".py", "inf", "1", 4),
    ("r", "f.py", "Python", ".py", "NaN", "1", 5),
    ("r", "g.py", "Python", ".py", "-1", "1", 6),
    ("", "h.py", "Python", ".py", "1", "1", 7),
    ("r", "  ", "Python", ".py", "1", "1", 8),
    (None, None, None, None, None, None, 9),
]
SCHEMA = "` Repository ` STRING, File_Path STRING, language STRING, extension STRING, loc STRING, size_bytes STRING, _row INT"


def test_clean_source_keeps_first(spark):
    rows = integration.clean_source(spark.createDataFrame(SOURCE, SCHEMA)).collect()
    assert {(r.file_path, r.language, r.loc, r.size_bytes) for r in rows} == {
        ("a/b.py", "Other", 99, 1), ("c.py", "", 3, 5),
    }


def test_clean_history_sums_copies(spark):
    rows = [("r", "a\\b", "1"), (" r", "a/b", "2.9"), ("r", "x", "-1"), ("r", "y", "many"), (None, "z", "1")]
    got = integration.clean_history(spark.createDataFrame(rows, "repository STRING, file_path STRING, change_count STRING"))
    assert [tuple(r) for r in got.collect()] == [("r", "a/b", 3)]


def test_join_keeps_every_source_row(spark):
    source = spark.range(1000).select(
        F.lit("r").alias("repository"), F.col("id").cast("string").alias("file_path"), F.lit("L").alias("language"),
        F.lit(".x").alias("extension"), F.col("id").alias("loc"), F.col("id").alias("size_bytes"),
    )
    hist = spark.createDataFrame([("r", "7", 3), ("r", "none", 5)], "repository STRING, file_path STRING, change_count BIGINT")
    out = integration.combine(source, hist)
    assert out.count() == 1000
    assert out.filter("history_present").collect()[0].change_count == 3
    assert statistics.hotspots(out, 2).collect()[0].file_path == "7"


def test_statistics_skip_null_keys_and_average(spark):
    rows = [("a", "p", "Python", ".py", 1, 10), ("a", "q", None, ".py", 2, 20), ("b", "p", "C", ".c", 4, 60)]
    df = spark.createDataFrame(rows, "repository STRING, file_path STRING, language STRING, extension STRING, loc BIGINT, size_bytes BIGINT")
    got = {(r.section, r.key): (r.amount, r.average) for r in statistics.source_statistics(df).collect()}
    assert got[("total_records", "")] == (3, None)
    assert got[("languages", "Python")] == (1, None) and ("languages", None) not in got
    assert got[("repositories", "")] == (2, None) and got[("source_files", "")] == (2, None)
    assert got[("average_loc", "")] == (None, 7 / 3)
    assert got[("maximum_loc", "")] == (4, None) and got[("minimum_loc", "")] == (1, None)


def test_hot_key_is_cut_before_the_shuffle(spark, physical_plan):
    key = F.when(F.col("id") < 15000, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(20000).select(key.alias("k"), F.col("id").alias("v"))
    small = ranking.first_n_per_key(df, ["k"], [F.asc("v")], 5)
    assert "WindowGroupLimit" in physical_plan(small)
    big = ranking.first_n_per_key(df, ["k"], [F.asc("v")], 1500, rank="place")
    assert big.count() == 1500 + 5000
    rows = big.filter("k = 'hot'").orderBy("place").collect()
    assert [r.v for r in rows] == list(range(1500)) and rows[-1].place == 1500


def test_copies_of_one_row_are_cut_per_partition(spark):
    df = spark.range(0, 30000, 1, 6).select(F.lit("r").alias("k"), F.lit(7).alias("v"), (F.col("id") * 0).alias("z"))
    got = ranking.first_n_per_key(df.withColumn("k", F.concat("k", "z")), ["k"], [F.asc("v")], 1200)
    assert got.count() == 1200


def test_window_of_latest_commits(spark):
    rows = [("r", i, f"h{i}") for i in range(10)] + [("s", 1, "x")]
    df = spark.createDataFrame(rows, "repository STRING, seq INT, commit_hash STRING")
    got = {r.commit_hash for r in history.latest_commits(df, 3).collect()}
    assert got == {"h0", "h1", "h2", "x"}


def test_churn_without_changes(spark):
    commits = spark.createDataFrame([("r", "h", None)], "repository STRING, commit_hash STRING, month STRING")
    changes = spark.createDataFrame([], "repository STRING, commit_hash STRING, additions STRING, deletions STRING, file_path STRING")
    row = history.churn(commits, changes).first()
    assert row.total_files_changed == 0 and row.average_files_changed_per_month == 0.0


def test_rank_ids_are_a_permutation(spark, physical_plan):
    df = spark.range(5000).select(F.col("id").cast("string").alias("token"), (F.col("id") % 7).alias("frequency"))
    ids = ranking.rank_ids(df, [F.desc("frequency"), F.asc("token")])
    rows = ids.orderBy("token_id").collect()
    assert [r.token_id for r in rows] == list(range(1, 5001))
    assert rows == sorted(rows, key=lambda r: (-r.frequency, r.token))
    assert "Window" not in physical_plan(ids)
    assert ranking.rank_ids(df.limit(0), [F.asc("token")]).count() == 0


def test_top_n_needs_no_full_sort(spark, physical_plan):
    df = spark.range(100).select(F.lit("r").alias("repository"), F.col("id").cast("string").alias("file_path"), F.col("id").alias("change_count"))
    assert "TakeOrderedAndProject" in physical_plan(statistics.hotspots(df))


def test_statistics_of_fractions_are_cut_at_the_end(spark):
    from repoquarry.operators.statistics import source_statistics

    rows = [("r", "a.py", "Python", ".py", "3.7", "1"), ("r", "b.py", "Python", ".py", "3.7", "12d")]
    df = spark.createDataFrame(rows, "repository string, file_path string, language string, extension string, loc string, size_bytes string")
    got = {r["section"]: r for r in source_statistics(df).collect()}
    assert got["total_loc"]["amount"] == 7 and abs(got["average_loc"]["average"] - 3.7) < 1e-12
    assert got["maximum_loc"]["amount"] == 3 and got["total_size_bytes"]["amount"] == 1
