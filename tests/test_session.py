from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from repoquarry import session, sinks
from repoquarry.functions import arrays
from repoquarry.operators import vocabulary


def _fake(master, configured):
    conf = SimpleNamespace(get=lambda key, default: configured)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_shared_folder_comes_from_the_session():
    assert session.scratch_dir(_fake("spark://host", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        session.scratch_dir(_fake("spark://host", None))
    assert session.scratch_dir(_fake("local[2]", None)) == session.scratch_dir(_fake("local[2]", None))


def test_materialized_table_and_its_removal(spark):
    table, path = session.materialize(spark.range(10).withColumn("a", F.array("id")), "test")
    assert table.count() == 10 and table.schema["a"].dataType.simpleString() == "array<bigint>"
    session.drop_table(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_small_inputs_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    df = spark.read.parquet(str(tmp_path / "one"))
    assert session.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    huge = spark.range(10**13)
    assert session.spread(huge) is huge


def test_opening_computes_an_array_once(spark, physical_plan):
    df = spark.createDataFrame([("a b",), ("",), (None,)], "t STRING")
    split = F.filter(F.split("t", " "), lambda x: x != "")
    opened = arrays.open_array(df, split, "w")
    assert sorted(r.w for r in opened.collect()) == ["a", "b"]
    assert physical_plan(opened).split("Initial Plan")[-1].count("split(") == 1
    places = arrays.open_places(df, split, "w").collect()
    assert sorted((r.n, r.pos, r.w) for r in places) == [(2, 0, "a"), (2, 1, "b")]
    kept = arrays.keep_rows(df.withColumn("u", F.upper("t")), F.col("u") == "A B")
    assert [r.u for r in kept.collect()] == ["A B"] and kept.columns == ["t", "u"]
    assert physical_plan(kept).split("Initial Plan")[-1].count("upper(") == 1


def test_sorted_listing_and_vocabulary(spark, tmp_path):
    frequency = spark.createDataFrame([("a", 1), ('q"x', 5), ("b", 5)], "token STRING, frequency BIGINT")
    sinks.write_sorted_csv(
        frequency, str(tmp_path / "f"), ["token", "frequency"], [F.desc("frequency"), F.asc("token")]
    )
    lines = [
        line
        for part in sorted((tmp_path / "f").glob("part-*"))
        for line in part.read_text().splitlines()
        if line != "token,frequency"
    ]
    assert lines == ["b,5", '"q""x",5', "a,1"]
    sinks.write_vocabulary(vocabulary.vocabulary(frequency), str(tmp_path / "v"))
    rows = spark.read.parquet(str(tmp_path / "v")).collect()
    assert {r.token: r.token_id for r in rows} == {"b": 1, 'q"x': 2, "a": 3}
