"""Split reading of quoted CSV against the one-task reader and Python's csv module."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources import records, sinks, tables


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few hundred bytes, so that records and even cells lie over several of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def made_cells(r, n):
    parts = ["a", "é漢😀", '"', ",", "\n", " ", "\\", "12", "x" * 40, "\n\n", '""', "'"]
    return [[str(k), *["".join(r.choice(parts) for _ in range(r.randrange(7))) for _ in range(3)]] for k in range(n)]


def written(path, header, rows, end="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerows([header, *rows])
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write(out.getvalue())


def as_read(rows):
    return sorted(tuple(cell or None for cell in row) for row in rows)


def test_ranges_give_the_rows_of_one_task(spark, folder, small_ranges):
    rows = made_cells(random.Random(1), 400)
    written(f"{folder}/t/a.csv", ["k", "b", "c", "d"], rows)
    splits = records.survey_splits(spark, f"{folder}/t")
    assert splits.count() > 20 and splits.where("starts_inside").count() > 3
    found = records.read_split_csv(spark, f"{folder}/t")
    assert sorted(map(tuple, found.collect())) == as_read(rows)
    whole = tables.read_table_csv(spark, f"{folder}/t")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, found.collect()), key=str)


def test_one_cell_over_many_ranges(spark, folder, small_ranges):
    rows = [["1", "x\n" * 3000, "", "z"], ["2", "y", "", ""], ["3", '"\n' * 700, ",", ""]]
    written(f"{folder}/t/a.csv", ["k", "b", "c", "d"], rows)
    assert sorted(map(tuple, records.read_split_csv(spark, f"{folder}/t").collect())) == as_read(rows)


@pytest.mark.parametrize("seed", range(3))
def test_batches_of_any_size(spark, folder, seed):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(1 + 2 * seed))
    try:
        rows = made_cells(random.Random(seed), 60)
        written(f"{folder}/t/a.csv", ["k", "b", "c", "d"], rows)
        assert sorted(map(tuple, records.read_split_csv(spark, f"{folder}/t").collect())) == as_read(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_carriage_returns(spark, folder, small_ranges):
    rows = [[str(k), f"line\r\nof {k}", "a" * (k % 50)] for k in range(100)]
    written(f"{folder}/t/a.csv", ["k", "b", "c"], rows, end="\r\n")
    assert sorted(map(tuple, records.read_split_csv(spark, f"{folder}/t").collect())) == as_read(rows)


def test_files_that_differ(spark, folder, small_ranges):
    written(f"{folder}/t/1.csv", ["k", "name", "amount"], [[str(k), f"n{k}\n", f"{k}.5"] for k in range(50)])
    written(f"{folder}/t/2.csv", ["amount", "k", "name"], [["7", "100", "x"], ["8", "101", ""]])
    written(f"{folder}/t/3.csv", ["k", "flag`s", "amount"], [["200", "t", "n/a"]])
    open(f"{folder}/t/4.csv", "w").close()
    frame = records.read_split_csv(spark, f"{folder}/t", {"k": T.LongType()}, file="from")
    assert frame.columns == ["k", "name", "amount", "flag`s", "from"]
    found = {row["k"]: tuple(row)[1:4] for row in frame.collect()}
    assert len(found) == 53
    assert (found[3], found[100], found[101], found[200]) == (("n3\n", "3.5", None), ("x", "7", None), (None, "8", None), (None, "n/a", "t"))
    types = records.file_types(records.read_split_csv(spark, f"{folder}/t", file="from"), "from")
    assert {tuple(row) for row in records.merged_types(types).collect()} == {
        ("k", 53, "BIGINT"), ("name", 51, "TEXT"), ("amount", 53, "TEXT"), ("flag`s", 1, "TEXT"),
    }
    clashes = records.type_clashes(types).collect()
    assert {(c.column_name, c.file[-5:], c.file_type, c.merged_type) for c in clashes} == {
        ("amount", "1.csv", "NUMERIC", "TEXT"), ("amount", "2.csv", "BIGINT", "TEXT"),
    }


def test_short_and_long_rows(spark, folder):
    os.makedirs(f"{folder}/t")
    with open(f"{folder}/t/a.csv", "w") as file:
        file.write("﻿a,b,c\n1,2,3\n\n4,5\n6,7,8,9\nx,y,z\n")
    found = records.read_split_csv(spark, f"{folder}/t", {"a": T.IntegerType()}, malformed="line")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "2", "3", None), (4, "5", None, "4,5"), (6, "7", "8", "6,7,8,9"), (None, "y", "z", "x,y,z")], key=str
    )
    assert found.drop("line").count() == 4
    with pytest.raises(Exception, match="MALFORMED"):
        records.read_split_csv(spark, f"{folder}/t", strict=True).collect()


@pytest.mark.parametrize("text, said", [("a,a\n1,2\n", "share a name"), ("a,\n1,2\n", "no name"), ('a,b\n"1,2\n', "never closed"), ('"a\nb",c\n1,2\n', "several lines")])
def test_what_cannot_be_read(spark, folder, text, said):
    os.makedirs(f"{folder}/t")
    with open(f"{folder}/t/bad.csv", "w") as file:
        file.write(text)
    with pytest.raises(ValueError, match=said) as problem:
        records.read_split_csv(spark, f"{folder}/t")
    assert "bad.csv" in str(problem.value)


def test_no_shuffle_of_records_and_all_ranges_read(spark, folder, small_ranges):
    written(f"{folder}/t/a.csv", ["k", "b"], [[str(k), "v" * 20] for k in range(2000)])
    frame = records.read_split_csv(spark, f"{folder}/t")
    assert frame.rdd.getNumPartitions() > 20
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_round_trip_of_own_export(spark, folder):
    rows = [(k, t, None if k % 3 else float(k)) for k, t in enumerate(['q"q', "a\nb", " edge ", "back\\slash", None, "c,d", "\r\n"])]
    frame = spark.createDataFrame(rows, "k long, t string, x double")
    sinks.export_table_csv(frame.repartition(2), f"{folder}/t")
    back = records.read_split_csv(spark, f"{folder}/t", {f.name: f.dataType for f in frame.schema})
    assert sorted(back.collect()) == sorted(frame.collect())
    assert back.where(F.col("t").isNull()).count() == 1
