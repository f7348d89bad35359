import gzip

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.functions import lineage
from tabloom.operators.rowid import add_row_id
from tabloom.sources import csv, fits, tables
from tabloom.operators.profile import raw_profile
from tabloom.streaming.profile import fold_arrivals, running_missing_counts, stored_profile


@pytest.fixture
def bad_lines(tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('a,b\n1,2\n3,4,5\n6\n"7","x"\n')
    return str(path)


def test_long_rows_dropped_short_rows_padded(spark, bad_lines):
    df = csv.read_csv_table(spark, bad_lines)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, "2"), (6, None), (7, "x")]
    assert csv.count_rows(spark, bad_lines) == 3
    assert csv.read_csv_table(spark, bad_lines, rows=2).count() == 2
    assert csv.read_csv_table(spark, bad_lines, columns=["b"]).columns == ["b"]


def test_csv_is_lossless(spark, tmp_path):
    rows = [
        (1, " lead ", 'he said "hi", ok', 1.5),
        (2, "two\nlines", "a\r\nb", None),
        (3, "", None, 2.0),
        (4, "NA", "\\n back\\", 3.0),
        (5, "x\ry", '"', 4.0),
    ]
    path, ddl = str(tmp_path / "t"), "a long, b string, c string, d double"
    csv.write_csv_table(spark.createDataFrame(rows, ddl), path)
    read = csv.read_csv_table(spark, path, schema=ddl, missing=())
    assert sorted((tuple(r) for r in read.collect()), key=lambda r: r[0]) == rows
    assert csv.count_rows(spark, path) == 5


def test_csv_as_pandas_reads_it(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,"he said ""hi"", ok",5\n2,"l1\nl2",NA\n3,x,4,9\n4\nnan,n/a,7.5\n')
    df = csv.read_csv_table(spark, str(path))
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    want = pd.read_csv(path, on_bad_lines="skip").astype(object)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns).astype(object)
    assert got.where(got.notna(), None).values.tolist() == want.where(want.notna(), None).values.tolist()
    assert dict(csv.read_csv_table(spark, str(path), rows=1).dtypes) == {"a": "bigint", "b": "string", "c": "bigint"}


def test_forced_types(spark, bad_lines):
    df = csv.read_csv_table(spark, bad_lines, schema="b double")
    assert {r["a"]: r["b"] for r in df.collect()} == {1: 2.0, 6: None, 7: None}


def test_gzip_and_dialect(spark, tmp_path):
    path = tmp_path / "t.csv.gz"
    with gzip.open(path, "wt", encoding="latin-1") as f:
        f.write("n;t\n1,5;é\n2,25;b\n")
    df = csv.read_csv_table(spark, str(path), sep=";", decimal=",", encoding="iso-8859-1", partitions=3)
    assert sorted(tuple(r) for r in df.collect()) == [(1.5, "é"), (2.25, "b")]
    assert df.rdd.getNumPartitions() == 3


def test_load_table(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,f,s\n1,1.5,x\n2,2.5,y\n")
    df = csv.load_table(spark, str(path), drop=["s", "zz"])
    assert dict(df.dtypes) == {"i": "smallint", "f": "float"}
    assert dict(csv.load_table(spark, str(path), optimize=False).dtypes) == {"i": "bigint", "f": "double", "s": "string"}


def test_samples(spark, tmp_path):
    df = spark.range(100)
    assert df.count() == csv.sample_rows(df, 200).distinct().count()
    drawn = csv.sample_rows(df, 10)
    assert drawn.distinct().count() == 10
    assert max(r["id"] for r in csv.sample_rows(df.coalesce(1), 10, head_only=True).collect()) < 30
    path = str(tmp_path / "numbers")
    csv.write_csv_table(df, path)
    assert csv.read_sample(spark, path, 7).distinct().count() == 7


def test_parquet_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_parquet_table(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int"), path, partition_by=["k"])
    assert {r["k"]: r["x"] for r in tables.read_parquet_table(spark, path).collect()} == {1: None, 2: 2.0}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_parquet_table(spark, str(tmp_path / "nothing"))


def test_fits(spark, tmp_path):
    path = str(tmp_path / "fit")
    fits.save_fit(spark, {"é": 1.5, "n": None}, path)
    assert fits.load_fit(spark, path) == {"é": 1.5, "n": None}
    with pytest.raises(ValueError, match="expected a list"):
        fits.load_column_list(spark, path)
    with pytest.raises(ValueError, match="a fit is"):
        fits.save_fit(spark, "text", path)
    fits.save_fit(spark, {"a": 1}, path)
    assert fits.load_shift_map(spark, path) == {"a": 1.0}
    spark.createDataFrame([("{broken",)], "value string").write.text(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="not valid JSON"):
        fits.load_encoding_rules(spark, str(tmp_path / "bad"))


def test_row_ids_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
    rows = add_row_id(df, ["k"], start=10).collect()
    assert rows[0].__fields__ == ["row_id", "k", "v"]
    assert {r["row_id"] - 10: r["k"] for r in rows} == {i: i for i in range(5000)}
    assert add_row_id(df.withColumnRenamed("k", "row_id"), ["v"]).columns == ["row_id", "v"]


def test_row_ids_with_one_hot_key(spark):
    """A key shared by most rows still spreads over the partitions, and the ids stay dense."""
    df = spark.range(4000).select((F.col("id") % 10 == 0).cast("int").alias("k"))
    out = add_row_id(df, ["k"], partitions=8)
    assert sorted(r["row_id"] for r in out.collect()) == list(range(4000))
    assert out.where("k = 0").agg(F.max("row_id")).first()[0] == 3599
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 1500


def test_materialized_table_is_in_the_shared_folder(spark):
    df = lineage.materialize(spark.range(10), "probe")
    assert df.inputFiles()[0].removeprefix("file:").removeprefix("//").startswith(
        lineage.shared_folder(spark).removeprefix("file:")
    )
    assert df.count() == 10


def test_running_profile(spark, tmp_path):
    source = tmp_path / "in"
    for i, rows in enumerate([[(1, None), (2, "a")], [(None, None), (4, "b"), (5, "c")]]):
        spark.createDataFrame(rows, "n int, s string").coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("n int, s string").option("maxFilesPerTrigger", 1).parquet(str(source))
    query = (
        running_missing_counts(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("running_profile")
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    assert {tuple(r) for r in spark.table("running_profile").collect()} == {("n", 5, 1), ("s", 5, 2)}


def test_fold_of_arrivals(spark, tmp_path):
    """Arrivals in several calls, nothing new, a lacking column, NaN, an empty file; each file counts once."""
    source, state, ddl = str(tmp_path / "in"), str(tmp_path / "state"), "n int, s string, x double"
    arrivals = [
        spark.createDataFrame([(1, None, 1.0), (2, "a", float("nan"))], ddl),
        spark.createDataFrame([(None, "b")], "n int, s string"),
        spark.createDataFrame([], ddl),
        spark.createDataFrame([(i, "z", None) for i in range(50)], ddl).repartition(4),
    ]
    for arrival in arrivals:
        arrival.write.mode("append").parquet(source)
        fold_arrivals(spark, source, ddl, state, files_per_batch=2)
        fold_arrivals(spark, source, ddl, state)
        whole = raw_profile(spark.read.schema(ddl).parquet(source)).collect()
        assert stored_profile(spark, ddl, state).collect() == whole
    assert whole[0]["missing"] == 52 and whole[0]["rows"] == 53


def test_fold_of_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("n,s\n1,x\n,y\n")
    ddl, state = "n int, s string", str(tmp_path / "state")
    fold_arrivals(spark, str(tmp_path / "in"), ddl, state, format="csv", options={"header": "true"})
    assert [(r["column"], r["missing"]) for r in stored_profile(spark, ddl, state).collect()] == [("n", 1), ("s", 0)]
