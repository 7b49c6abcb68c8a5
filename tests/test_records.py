"""Split CSV files against the reader that takes a whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources.records import csv_records, moved
from tidemark.sources.tables import _CSV, read_table_csv, write_table_csv

SCHEMA = "id bigint, text string, `a-b` string, n double"


def made(seed, rows=60):
    r = random.Random(seed)
    parts = ['"', '""', ",", "\n", "\r\n", " ", "é", "x", "word ", '",', ',"', '"\n"', "\n\n"]
    cell = lambda: "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
    return [(i, cell() + "z" * r.choice([0, 0, 0, 400]), cell(), float(i)) for i in range(rows)]


def split(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def small_ranges(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: split(spark, size)
    for c, v in before.items():
        spark.conf.set(c, v)


def cells(df):
    return sorted(tuple(r) for r in df.collect())


def test_moved():
    assert not moved("a,b", False) and moved('a,"b', False)
    assert moved('c",d', True) is False and moved('c","d', True)
    assert not moved('"a ""q"" b",c', False)
    assert moved('""', True) and not moved('"', True)
    assert moved('x",5" pipe,"y', True)  # a quote inside an open cell is text
    assert not moved('5" pipe,b', False)


@pytest.mark.parametrize("seed,size", [(1, 300), (2, 900), (4, 1 << 20)])
@pytest.mark.parametrize("max_states", [50_000, 0])
def test_equal_to_whole_files(spark, tmp_path, small_ranges, seed, size, max_states):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1 + seed % 2)
    path = str(tmp_path / "t")
    write_table_csv(df, path)
    small_ranges(size)
    raw = "c0 string, c1 string, c2 string, c3 string"
    whole = spark.read.schema(raw).options(**_CSV, multiLine=True).csv(path)
    parsed = csv_records(spark, path, max_states).where("NOT is_header").select(
        F.from_csv("record", raw, {"quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
                                   "ignoreTrailingWhiteSpace": "false"}).alias("r")).select("r.*")
    assert cells(parsed.fillna("")) == cells(whole.fillna(""))
    assert csv_records(spark, path).where("is_header").count() == 1 + seed % 2
    if size < 1000:
        assert csv_records(spark, path).rdd.getNumPartitions() > 10


def test_python_csv_with_carriage_returns(spark, tmp_path, small_ranges):
    rows = [(i, t.replace("\r", ""), s.replace("\r", ""), n) for i, t, s, n in made(9)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\r\n")
    writer.writerow(["id", "text", "a-b", "n"])
    writer.writerows(rows)
    (tmp_path / "t.csv").write_bytes(out.getvalue().encode())
    small_ranges(150)
    schema = spark.createDataFrame([], SCHEMA).schema
    got = {r["id"]: r["text"] or "" for r in read_table_csv(spark, str(tmp_path / "t.csv"), schema).collect()}
    assert got == {i: t for i, t, _, _ in rows}


def test_wrong_header_and_empty_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,words,a-b,n\n1,x,y,2\n")
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(Exception, match="header"):
        read_table_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    (tmp_path / "e.csv").write_text("id,text,a-b,n\n")
    assert read_table_csv(spark, str(tmp_path / "e.csv"), schema).collect() == []
