"""Published versions: half-written ones are not seen, readers keep theirs, untouched parts keep their files."""

import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import merge
from riskloom.operators.rates import grouped_rate
from riskloom.sources import versions as v


@pytest.fixture
def table(spark, folder):
    return v.VersionedTable(spark, f"{folder}/t")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, value string, part string")


def values(df):
    return sorted(map(tuple, df.select("k", "value").collect()), key=str)


def data_files(path):
    return {
        os.path.join(where, name): os.stat(os.path.join(where, name)).st_mtime_ns
        for where, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet") and "/data/" in where
    }


def test_readers_keep_their_version(spark, table):
    assert table.version() == 0
    first = table.publish(frame(spark, [(1, "a", "x"), (2, "b", "y")]), ["x", "y"])
    pinned = table.read(first)
    assert table.publish(frame(spark, [(3, "c", "x")]), ["x", "y"]) == 2
    assert values(pinned) == [(1, "a"), (2, "b")] == values(table.read(first))
    assert values(table.read()) == [(3, "c")] and table.state().keys() == {"x"}
    table.publish(frame(spark, []), ["x"])
    empty = table.read()
    assert empty.count() == 0 and empty.columns == ["k", "value"]


def test_a_write_that_fails_half_way_is_not_seen(spark, table, folder):
    table.publish(frame(spark, [(k, "old", "x") for k in range(100)]), ["x"])
    broken = F.when(F.col("id") == 900, F.raise_error(F.lit("lost in the middle")).cast("string")).otherwise("new")
    rows = spark.range(0, 1000, numPartitions=8).select(F.col("id").alias("k"), broken.alias("value"), F.lit("x").alias("part"))
    with pytest.raises(Exception, match="lost in the middle"):
        table.publish(rows, ["x"])
    assert len(os.listdir(f"{folder}/t/data")) == 2
    assert table.version() == 1 and set(values(table.read())) == {(k, "old") for k in range(100)}


def test_the_later_of_two_writers_gives_way(spark, table, monkeypatch):
    table.publish(frame(spark, [(1, "a", "x")]), ["x"])
    other = v.VersionedTable(spark, table.path)
    monkeypatch.setattr(other, "version", lambda: 1)
    assert table.publish(frame(spark, [(2, "won", "x")]), ["x"]) == 2
    with pytest.raises(v.Conflict):
        other.publish(frame(spark, [(3, "lost", "x")]), ["x"])
    with pytest.raises(v.Conflict):
        table.publish(frame(spark, [(4, "late", "x")]), ["x"], based_on=1)
    assert values(table.read()) == [(2, "won")]


def test_new_columns_and_bad_parts(spark, table):
    table.publish(frame(spark, [(1, "a", "x")]), ["x"])
    table.publish(frame(spark, [(2, "b", "y")]).withColumn("more", F.lit(5)), ["y"])
    assert {tuple(row) for row in table.read().collect()} == {(1, "a", None), (2, "b", 5)}
    with pytest.raises(ValueError, match="unsafe"):
        table.publish(frame(spark, []), ["../x"])
    with pytest.raises(ValueError, match="not replaced"):
        table.publish(frame(spark, [(1, "a", "z"), (2, "b", None)]), ["x"])
    assert table.version() == 2


def test_upsert_rewrites_touched_parts_only(spark, table, folder):
    rows = [(k, f"v{k}", "") for k in range(300)] + [(None, "gone", "")]
    old = frame(spark, rows).drop("part")
    v.upsert_parts(table, old, "k", 20)
    before = data_files(folder)
    new = frame(spark, [(5, "changed", ""), (1005, "added", ""), (5, "last", "")]).drop("part")
    v.upsert_parts(table, new, "k", 20, "value")
    after = data_files(folder)
    assert before.items() <= after.items()
    touched = {row[0] for row in new.select(v.key_parts("k", 20)).distinct().collect()}
    folders = {part: state[0] for part, state in table.state().items()}
    assert len(touched) <= 2 and len(set(folders.values())) == 2
    assert {part for part, where in folders.items() if where == table.state()[sorted(touched)[0]][0]} == touched
    assert values(table.read()) == values(merge.upsert(old, new, "k", "value"))
    assert v.upsert_parts(table, new.limit(0), "k", 20) == 2


def test_a_batch_that_comes_again_counts_once(spark, table):
    facts = spark.range(1000).select(
        (F.col("id") % 7).cast("string").alias("kind"), (F.col("id") % 5 == 0).alias("flag"), (F.col("id") / 4).alias("amount"), (F.col("id") % 3).alias("batch")
    )
    for batch in (0, 1, 2, 1, 0):
        v.publish_partials(table, facts.where(F.col("batch") == batch), f"day-{batch}", ["kind"], F.col("flag"), F.col("amount"), 2)
    mine = grouped_rate(v.merged_partials(table, ["kind"]), ["kind"], None, scale=2, partials=True)
    whole = grouped_rate(facts, ["kind"], F.col("flag"), F.col("amount"), scale=2)
    assert sorted(mine.collect()) == sorted(whole.collect())
    plan = v.merged_partials(table, ["kind"])._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan
