"""Heavy hitters and stored profiles against counts of every value."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import hitters as h
from riskloom.operators import profile as p
from riskloom.operators import summaries


@pytest.fixture(scope="module")
def frame(spark):
    r = random.Random(4)
    rows = [
        (
            r.choice("abcdefghijklmnop"),
            "hot" if r.random() < 0.4 else f"v{r.randrange(4000)}" if r.random() < 0.5 else f"w{r.randrange(9)}",
            f"key{k}" * (30 if k % 2 else 1),
            None if k % 3 else float(k % 5) * (-1 if k % 10 == 0 else 1),
            None,
            k % 7 == 0,
        )
        for k in range(8000)
    ]
    return spark.createDataFrame(rows, "few string, `mixed col` string, own string, num double, none string, flag boolean").repartition(5)


COLUMNS = ["few", "mixed col", "own", "num", "none", "flag"]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("tracked", [16, 128, 1024])
def test_same_rows_as_counting_everything(frame, tracked):
    assert rows_of(h.heavy_categories(frame, COLUMNS, 10, tracked)) == rows_of(p.top_categories(frame, COLUMNS, 10))


def test_recount_covers_what_is_promised(frame):
    """Every value above twice the summary's error is a candidate, for summaries of any size."""
    exact = p.value_counts(frame, COLUMNS, digest=True).where(F.col("value").isNotNull()).collect()
    for tracked in (16, 64, 512):
        found = {row["position"]: row for row in h.heavy_candidates(frame, COLUMNS, tracked).collect()}
        for row in exact:
            mine = found[COLUMNS.index(row["feature_name"])]
            assert len(mine["values"]) <= tracked
            if row["n_rows"] > 2 * h.summary_error(tracked) * mine["n_present"]:
                assert row["value"] in mine["values"]


def test_values_are_not_shuffled(spark, frame):
    """What the two scans of a proven column shuffle is a row per task and candidate, not one per value."""
    many = spark.range(0, 60_000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("top"), F.pmod("id", F.lit(20)))).otherwise(F.concat(F.lit("rare"), "id")).alias("v")
    )
    candidates = h.kept(h.heavy_candidates(many, ["v"]), "test-candidates")
    counts = h.recounted(many, ["v"], candidates)
    counts.collect()
    values = candidates.select(F.explode("values")).count()
    assert values < 1024
    assert [row["n_rows"] for row in counts.orderBy(F.desc("n_rows")).limit(10).collect()] == [3000] * 10
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows_of(h.heavy_categories(many, ["v"])) == rows_of(p.top_categories(many, ["v"]))


def test_empty_table_and_no_columns(spark, frame):
    none = frame.where("false")
    assert h.heavy_categories(none, COLUMNS).count() == 0


def test_stored_profiles_merge(spark, frame, folder):
    parts = [frame.where("few < 'e'"), frame.where("few >= 'e' and few < 'k'"), frame.where("few >= 'k'")]
    for number, part in [*enumerate(parts), (1, parts[1])]:
        summaries.store_summary(part, COLUMNS, folder + "/s", f"b{number}")
    merged = {row["feature_name"]: row for row in summaries.stored_profile(spark, folder + "/s").collect()}
    whole = {row["feature_name"]: row for row in p.exact_column_stats(frame, COLUMNS).collect()}
    for name in COLUMNS:
        mine, exact = merged[name], whole[name]
        assert (mine["n_rows"], mine["n_null"], mine["null_ratio"]) == (exact["n_rows"], exact["n_null"], exact["null_ratio"])
        assert abs(mine["distinct_non_null"] - exact["distinct_non_null"]) <= max(1, 0.04 * exact["distinct_non_null"])
        assert abs(mine["dominant_ratio"] - exact["dominant_ratio"]) <= 2 * h.summary_error(h.TRACKED)
    assert merged["few"]["top_category_coverage"] == pytest.approx(whole["few"]["top_category_coverage"])
    with_more = parts[0].withColumn("late", F.lit(1))
    summaries.store_summary(with_more, ["few", "late"], folder + "/s", "b9")
    again = {row["feature_name"]: row for row in summaries.stored_profile(spark, folder + "/s").collect()}
    assert again["late"]["n_rows"] == parts[0].count() and again["few"]["n_rows"] == whole["few"]["n_rows"] + parts[0].count()


def test_only_the_new_batch_is_scanned(spark, frame, folder):
    summaries.store_summary(frame, ["few"], folder + "/s", "old")
    plan = summaries.stored_profile(spark, folder + "/s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and folder + "/s" in plan
