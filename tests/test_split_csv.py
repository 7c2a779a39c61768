"""Splittable CSV with line breaks: records across block ends, against Spark's own whole-file reader and the rows written."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from pricelens.sources import split_csv
from pricelens.sources.listings import CSV, read_raw_csv, write_clean
from pricelens.sources.split_csv import csv_records, read_split_csv

SPLIT = "spark.sql.files.maxPartitionBytes"
#: An empty text comes back as a null, as from Spark's own reader.
NASTY = ["plain", None, "two\nlines", '"quoted"', 'a ""b""', "\n", "\n\n\nmany", 'ends with "', "comma, comma", "  padded ", "x" * 300, 'x\n"y"\n' * 20,
         "tab\t", "é\n日本", "back\\slash"]


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get(SPLIT), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    yield lambda n: spark.conf.set(SPLIT, str(n))
    spark.conf.set(SPLIT, before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [64, 257, 1_000, 1 << 20])
def test_round_trip_at_every_block_size(spark, tmp_path, small_blocks, block):
    rnd = random.Random(block)
    want = [(str(i), rnd.choice(NASTY), rnd.choice(NASTY)) for i in range(300)]
    df = spark.createDataFrame(want, "id string, a string, b string")
    write_clean(df.coalesce(1), str(tmp_path / "one"), fmt="csv")
    small_blocks(block)
    got = read_raw_csv(spark, str(tmp_path / "one"))
    assert rows_of(got) == sorted(want, key=str)
    tasks = spark.read.text(str(tmp_path / "one")).rdd.getNumPartitions()
    assert tasks > 20 if block < 1_000 else True


def test_many_files_and_a_glob(spark, tmp_path, small_blocks):
    want = [(str(i), NASTY[i % len(NASTY)]) for i in range(200)]
    write_clean(spark.createDataFrame(want, "id string, a string").repartition(5), str(tmp_path / "many"), fmt="csv")
    small_blocks(100)
    assert rows_of(read_raw_csv(spark, f"{tmp_path}/many/*.csv")) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_joins_beyond_the_broadcast_bound(spark, tmp_path, small_blocks, monkeypatch, seed):
    rnd = random.Random(seed)
    want = [(str(i), rnd.choice(NASTY)) for i in range(80)]
    write_clean(spark.createDataFrame(want, "id string, a string").coalesce(1), str(tmp_path / "f"), fmt="csv")
    small_blocks(90)
    monkeypatch.setattr(split_csv, "MOST_ODD", 0)
    assert rows_of(read_raw_csv(spark, str(tmp_path / "f"))) == sorted(want, key=str)


def test_a_field_longer_than_several_blocks_and_crlf(spark, tmp_path, small_blocks):
    long = "line\n" * 200
    path = tmp_path / "x.csv"
    path.write_bytes(("a,b\r\n1,\"" + long + "\"\r\n2,plain\r\n\r\n3,\"q\"\r\n").encode())
    small_blocks(64)
    assert rows_of(read_raw_csv(spark, str(path))) == [("1", long), ("2", "plain"), ("3", "q")]


def test_same_rows_as_the_whole_file_reader(spark, tmp_path, small_blocks):
    path = tmp_path / "y.csv"
    path.write_text('id,a,b\n1,"x, ""y""",z\n2,,\n3,"",\n\n4,only\n5,"multi\nline","and\n\nmore"\n6,  s  ,t\n')
    small_blocks(16)
    whole = spark.read.options(**CSV).option("multiLine", True).csv(str(path))
    assert rows_of(read_raw_csv(spark, str(path))) == rows_of(whole)


def test_an_open_quote_is_returned_as_it_stands_and_empty_files_have_no_rows(spark, tmp_path, small_blocks):
    (tmp_path / "open.csv").write_text('a\n"never\nclosed\n')
    small_blocks(8)
    assert [r.record for r in csv_records(spark, str(tmp_path / "open.csv")).where("not first").collect()] == ['"never\nclosed']
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert read_raw_csv(spark, str(tmp_path / "empty.csv")).count() == 0


def test_texts_of_documents_in_one_file(spark, tmp_path, small_blocks):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("string"), "text")
    write_clean(docs.coalesce(1), str(tmp_path / "docs"), fmt="csv")
    assert len(glob.glob(os.path.join(str(tmp_path / "docs"), "*.csv"))) == 1
    small_blocks(20_000)
    got = read_split_csv(spark, str(tmp_path / "docs"), docs.schema, CSV)
    assert rows_of(got) == rows_of(docs)
