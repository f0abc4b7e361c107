"""Audits of a new batch against stored ones: the rows of full joins, without reading batches that no key can be in."""

import glob
import os

import pytest

from riskloom.operators import quality
from riskloom.sources.keyed import BLOCK_BITS, KeyedBatches, key_filter


@pytest.fixture
def batches(spark, folder):
    return KeyedBatches(spark, f"{folder}/t", {"k": "bigint"})


def frame(spark, keys):
    return spark.createDataFrame([(key, f"row {n}") for n, key in enumerate(keys)], "k int, value string")


def found(df):
    return sorted(map(tuple, df.collect()))


def spoil(batches, batch):
    """Makes the stored rows of a batch unreadable; the number of files."""
    where, _ = batches.rows.state()[batch]
    files = glob.glob(f"{where}/part={batch}/*.parquet")
    for name in files:
        with open(name, "wb") as out:
            out.write(b"no parquet")
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    return len(files)


def test_duplicates_and_orphans_equal_full_joins(spark, batches):
    old = {"a": list(range(0, 4000, 2)) + [7, 7, None], "b": list(range(3000, 9000, 3)), "c": []}
    for name, keys in old.items():
        batches.add(frame(spark, keys), name)
    new = [*range(2500, 12000, 5), 20000, 20000, None, None, 7]
    stored = [key for keys in old.values() for key in keys]
    wanted = sorted(
        (key, new.count(key), stored.count(key)) for key in set(new) - {None} if new.count(key) > 1 or key in stored
    )
    assert found(batches.duplicates(frame(spark, new))) == wanted
    parents = frame(spark, stored).select("k")
    expected = found(quality.fk_orphans(frame(spark, new), parents, "k"))
    assert found(batches.orphans(frame(spark, new))) == expected
    other = frame(spark, new).withColumnRenamed("k", "of")
    assert found(batches.orphans(other, {"k": "of"})) == expected


def test_batches_without_a_hit_are_not_read(spark, batches):
    batches.add(frame(spark, range(1000)), "old")
    batches.add(frame(spark, range(5000, 5100)), "late")
    assert spoil(batches, "old")
    assert found(batches.duplicates(frame(spark, [5001, 7000, 7001]))) == [(5001, 1, 1)]
    with pytest.raises(Exception):
        batches.duplicates(frame(spark, [5])).collect()


def test_a_batch_that_comes_again_counts_once(spark, batches):
    batches.add(frame(spark, [1, 2, 3]), "a")
    batches.add(frame(spark, [3, 4]), "b")
    assert found(batches.duplicates(frame(spark, [1, 3]), "a")) == [(3, 1, 1)]
    batches.add(frame(spark, [8]), "a")
    assert found(batches.duplicates(frame(spark, [1, 3, 8]))) == [(3, 1, 1), (8, 1, 1)]


def test_a_batch_without_its_filter_is_read_whole(spark, batches, monkeypatch):
    batches.add(frame(spark, [1, 2]), "a")
    monkeypatch.setattr(batches, "index", lambda batch: None)
    batches.add(frame(spark, [5, 6]), "a")  # the filter is still that of the first rows
    batches.add(frame(spark, [9]), "b")
    assert found(batches.duplicates(frame(spark, [1, 5, 9, 10]))) == [(5, 1, 1), (9, 1, 1)]
    assert found(batches.orphans(frame(spark, [1, 5, 9, 10])).select("k")) == [(1,), (10,)]


def test_empty_and_null_batches(spark, batches):
    assert found(batches.duplicates(frame(spark, [1, 1, 2]))) == [(1, 2, 0)]
    batches.add(frame(spark, []), "none")
    batches.add(frame(spark, [None, None]), "nulls")
    assert found(batches.duplicates(frame(spark, [None, 2, 2]))) == [(2, 2, 0)]
    assert found(batches.duplicates(frame(spark, []))) == []
    assert found(batches.orphans(frame(spark, [None, 2]))) == [(2, "row 1")]


def test_reserved_names_are_refused(spark, folder, batches):
    with pytest.raises(ValueError, match="reserved"):
        KeyedBatches(spark, folder, {"block": "bigint"})
    with pytest.raises(ValueError, match="part"):
        batches.add(spark.createDataFrame([(1, "x")], "k int, part string"), "a")


def test_filters_lose_no_key_and_let_few_others_through(spark, batches):
    batches.add(frame(spark, range(40_000)), "a")
    probes = spark.range(0, 80_000).withColumnRenamed("id", "k")
    hits = [row["k"] for row in batches.candidates(probes).collect()]
    assert set(range(40_000)) <= set(hits)
    assert len(hits) - 40_000 < 800
    made = key_filter(frame(spark, range(40_000)), ["k"], 16)
    assert made.count() == 16 and all(len(row["bitmap"]) * 8 == BLOCK_BITS for row in made.collect())


def test_keys_of_several_columns(spark, folder):
    batches = KeyedBatches(spark, folder, {"a": "bigint", "b": "string"})
    rows = "a int, b string"
    batches.add(spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], rows), "first")
    new = spark.createDataFrame([(1, "y"), (2, "x"), (2, None), (2, None)], rows)
    assert found(batches.duplicates(new)) == [(1, "y", 1, 1)]
    assert found(batches.orphans(new)) == [(2, "x")]
