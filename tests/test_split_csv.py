"""Large CSV files with quoted line breaks, against the reader that takes a file in one task."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import types as T

from starloom.operators.keys import ORDINAL
from starloom.sources import extracts
from starloom.sources.raw import read_columns, read_csv_or_empty
from starloom.sources.split_csv import _read, read_records

SMALL_BLOCKS = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in SMALL_BLOCKS}
    for k, v in SMALL_BLOCKS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def in_order(df):
    rows = df.orderBy(ORDINAL).drop(ORDINAL).collect()
    return [tuple(r) for r in rows]


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(["id", "a text", "other"])
        writer.writerows(rows)


def texts(chance, n):
    parts = ["plain", "", "a,b", 'say "hi"', "two\nlines", "\n", '"\n"', "é😀", " x ", "end\r\nof", '""', ",\n,", "long " * 30]
    return [[str(i), chance.choice(parts) + chance.choice(parts), chance.choice(parts)] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_and_order_are_those_of_one_task(spark, small_blocks, tmp_path, end):
    chance = random.Random(7)
    (tmp_path / "in").mkdir()
    write(tmp_path / "in/a.csv", texts(chance, 150), end)
    write(tmp_path / "in/b.csv", [[str(i), "no break", "x"] for i in range(60)], end)
    write(tmp_path / "in/c.csv", [["1", "x\n" * 900, "y"], ["2", "\n" * 700 + ",", 'q"\n'], ["3", "", ""]], end)
    write(tmp_path / "in/d.csv", [], end)
    path = str(tmp_path / "in")
    got, expected = read_records(spark, path, whole_below=0), _read(spark, path, None, True)
    assert got.columns == expected.columns
    assert in_order(got) == in_order(expected)
    assert got.count() == 213
    lines = read_records(spark, str(tmp_path / "in/a.csv"), whole_below=0)
    assert len({r[0] for r in lines.select(f"{ORDINAL}.block").collect()}) > 10  # many blocks, not one task


def test_quotes_out_of_place(spark, small_blocks, tmp_path):
    amid = tmp_path / "amid.csv"
    amid.write_text('id,size\n' + "".join(f'{i},5" pipe\n' for i in range(41)) + '99,"a\nb"\n')
    assert in_order(read_records(spark, str(amid), whole_below=0)) == in_order(_read(spark, str(amid), None, True))
    late = tmp_path / "late.csv"
    late.write_text('id,size\n1,pipe 5"\n' + "".join(f"{i},x\n" for i in range(90)) + '2,pipe 6"\n')
    with pytest.raises(Exception, match="quotes out of place"):
        read_records(spark, str(late), whole_below=0).collect()


def test_another_header_is_an_error(spark, small_blocks, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in/a.csv", [["1", "a\nb", "c"]] * 3)
    (tmp_path / "in/b.csv").write_text('id,else,other\n1,"a\nb",c\n')
    with pytest.raises(Exception, match="other columns"):
        read_records(spark, str(tmp_path / "in"), whole_below=0).collect()


def test_stored_results_and_column_subsets_keep_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", 2.5), (2, 'x "y"\n', None)], "k int, s string, v double")
    extracts.write_csv(df.coalesce(1), str(tmp_path / "out"))
    assert sorted(read_csv_or_empty(spark, str(tmp_path / "out"), df.schema).collect()) == sorted(df.collect())
    assert sorted(tuple(r) for r in read_columns(spark, str(tmp_path / "out"), ["s", "none"]).collect()) == [("a\nb",), ('x "y"\n',)]


def test_typed_rows_over_many_blocks(spark, small_blocks, tmp_path):
    df = spark.createDataFrame([(i, f"row {i}\nbreak" if i % 3 else "plain", i / 4) for i in range(200)], "k int, s string, v double")
    extracts.write_csv(df.coalesce(1), str(tmp_path / "out"))
    schema = T.StructType(df.schema.fields)
    assert sorted(tuple(r)[:3] for r in read_records(spark, str(tmp_path / "out"), schema, whole_below=0).collect()) == sorted(map(tuple, df.collect()))
