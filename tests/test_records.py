"""CSV files with quoted line breaks, read in byte ranges."""

import csv as python_csv
import io
import random

import pytest

from tabloom.sources import csv, records


@pytest.fixture
def small_ranges(spark):
    """Ranges of few bytes."""

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, rows, end="\n"):
    text = io.StringIO()
    python_csv.writer(text, lineterminator=end).writerows(rows)
    path.write_text(text.getvalue(), newline="")
    return len(text.getvalue().encode())


def read(spark, path, names="a string, b string, c string"):
    frame = csv.read_csv_table(spark, str(path), schema=names, missing=())
    return sorted(tuple(x or "" for x in r) for r in frame.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [3, 40, 1000])
def test_every_cut(spark, tmp_path, small_ranges, size, end):
    """Breaks, doubled quotes, separators and carriage returns on each side of every cut; records of many ranges."""
    draw = random.Random(size)
    parts = ["\n", '"', '""', ",", "x", "é漢", " ", "\r\n", '",', ',"', "word", "\n\n"]
    rows = [(f"{i}", "".join(draw.choices(parts, k=draw.randint(0, 9))), f"end{i}") for i in range(5 + size)]
    rows.insert(3, ("long", "line\n" * 30, 'quote " alone'))
    total = write(tmp_path / "t.csv", [("a", "b", "c"), *rows], end)
    small_ranges(size)
    frame = csv.read_csv_table(spark, str(tmp_path / "t.csv"), schema="a string, b string, c string", missing=())
    got = [tuple(x or "" for x in r) for r in frame.collect()]
    assert sorted(got) == sorted(rows)
    if size < 1000:
        assert records._lines(spark, str(tmp_path / "t.csv"), "utf-8").rdd.getNumPartitions() >= total // (size + 1)


def test_several_files_and_headers(spark, tmp_path, small_ranges):
    rows = [[(f"{f}-{i}", "one\ntwo" if i % 3 else "plain", "z") for i in range(20)] for f in range(3)]
    for f, own in enumerate(rows):
        write(tmp_path / f"part{f}.csv", [("a", "two\nline header", "c"), *own])
    (tmp_path / "part9.csv").write_text("")
    small_ranges(25)
    names = csv.read_csv_table(spark, str(tmp_path / "part0.csv")).columns
    assert names == ["a", "two\nline header", "c"]
    assert read(spark, tmp_path, "a string") == sorted(r for own in rows for r in own)


def test_quotes_within_unquoted_values_mean_nothing(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n5" disk,x,1\n"q\nr",y"y,2\nz,"a ""b""\n",3\n\n  ,,\n"open",w,4\n')
    small_ranges(9)
    want = [("  ", "", ""), ('5" disk', "x", "1"), ("open", "w", "4"), ("q\nr", 'y"y', "2"), ("z", 'a "b"\n', "3")]
    assert read(spark, path) == want


def test_long_and_short_rows(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x\ny"\n2,3,4\n5\n"6","z"\n')
    small_ranges(5)
    assert csv.count_rows(spark, str(path)) == 3
    frame = csv.read_csv_table(spark, str(path))
    assert dict(frame.dtypes) == {"a": "bigint", "b": "string"}
    assert sorted(tuple(r) for r in frame.collect()) == [(1, "x\ny"), (5, None), (6, "z")]
    assert csv.read_csv_table(spark, str(path), rows=1).collect()[0]["b"] == "x\ny"


def test_plain_files_need_no_python(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x, y"\n2,z\n')
    assert records.read_records(spark, str(path)) is None
    path.write_bytes('a,b\n1,"x\ny é"\n2,z\n'.encode("latin-1"))
    assert read(spark, path, "a string")[0] == ("1", "x\ny \ufffd")
    found = csv.read_csv_table(spark, str(path), encoding="iso-8859-1", schema="a string").collect()
    assert sorted(tuple(r) for r in found) == [("1", "x\ny é"), ("2", "z")]


@pytest.mark.parametrize(
    ("line", "inside", "after"),
    [
        ("", False, False), ("", True, True), ('a,"b', False, True), ('a,"b""', False, True), ('a,"b"",c"', False, False),
        ('b",c', True, False), ('b"",c', True, True), ('b","c', True, True), ('"', False, True), ('""', False, False),
        ('"""', False, True), ('a"b,c', False, False), ('"a"b,"c"', False, False), ('"a"b,"c', False, True), ('",', True, False),
    ],
)
def test_states(line, inside, after):
    assert records.ends_inside(line, inside) is after
