"""Top categories without a shuffle of every value: bounded summaries propose, a second scan counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.longform import POSITION, long_cells, named, names_table, quoted
from riskloom.operators.profile import TOP_CATEGORIES, _as_text, _types, rank_categories, top_categories
from riskloom.session import scratch_path

#: Values that a summary tracks. Its table has the next power of two of 4/3 of them.
TRACKED = 1024
#: The summary undercounts a value by at most 3.5 / table size of the counted rows, a bound of the frequent-items sketch.
ERROR = 3.5


def summary_error(tracked: int) -> float:
    """Share of the counted rows by which a summary may miss a value's count."""
    return ERROR / (1 << (tracked * 4 // 3 - 1).bit_length())


def frequent(name: str, data_type: T.DataType, tracked: int, merged: bool = False) -> str:
    """SQL of the summary of a column's present values, long texts by their digest; ``merged`` keeps it open for merging."""
    value, size = _as_text(name, data_type, digest=True), int(tracked)
    call = f"approx_top_k_accumulate({value}, {size})" if merged else f"approx_top_k({value}, {size}, {size})"
    return f"{call} FILTER (WHERE {quoted(name)} IS NOT NULL)"


def heavy_candidates(df: DataFrame, columns: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """position, n_present, values: per column, the values that may be frequent.

    Every task keeps a frequent-items summary of bounded size per column and
    summaries merge, so one row per task is shuffled, however many values there
    are. Values that are in more than twice :func:`summary_error` of a column's
    present rows are always among ``values``, of which there are at most ``tracked``.
    """
    types = _types(df)
    measures = [F.expr(f"count({quoted(name)})").alias(f"n_{i}") for i, name in enumerate(columns)]
    measures += [F.expr(frequent(name, types[name], tracked)).alias(f"t_{i}") for i, name in enumerate(columns)]
    found = [
        F.struct(F.col(f"n_{i}").alias("n_present"), F.transform(f"t_{i}", lambda top: top["item"]).alias("values"))
        for i in range(len(columns))
    ]
    cells = df.agg(*measures).select(F.posexplode(F.array(*found)).alias(POSITION, "cell")).select(POSITION, "cell.*")
    return cells.where("n_present > 0")


def recounted(df: DataFrame, columns: Sequence[str], candidates: DataFrame) -> DataFrame:
    """position, whole, n_rows: exact counts of the candidate values, by a second scan.

    The broadcast table has at most as many rows as summaries track values, of at
    most 64 characters each. Values that no task holds as a candidate are never shuffled.
    """
    types = _types(df)
    pairs = [f"struct({_as_text(n, types[n], digest=True)} AS value, {_as_text(n, types[n], digest=False)} AS whole)" for n in columns]
    cells = long_cells(df, pairs, "cell").where("cell.value IS NOT NULL").select(POSITION, "cell.*")
    wanted = F.broadcast(candidates.select(POSITION, F.explode("values").alias("value")))
    counts = cells.join(wanted, [POSITION, "value"]).groupBy(POSITION, F.col("value").alias("short"))
    return counts.agg(F.min("whole").alias("value"), F.count(F.lit(1)).alias("n_rows")).drop("short")


def _proven(df: DataFrame, columns: Sequence[str], counts: DataFrame, candidates: DataFrame, top: int, tracked: int) -> DataFrame:
    """feature_name, proven: whether no value outside the candidates can be among the ``top`` of a column.

    Either the candidates make up all present rows, or the last one that counts
    is above what the summary may miss.
    """
    totals = named(candidates.select(POSITION, "n_present"), columns)
    counted = counts.groupBy("feature_name").agg(
        F.sum("n_rows").alias("counted"), F.try_element_at(F.sort_array(F.collect_list("n_rows"), False), F.lit(top)).alias("last")
    )
    least = 2 * summary_error(tracked) * F.col("n_present")
    judged = names_table(df, columns).join(F.broadcast(totals), "feature_name", "left").join(F.broadcast(counted), "feature_name", "left")
    enough = F.col("n_present").isNull() | (F.col("counted") == F.col("n_present")) | (F.col("last") > least)
    return judged.select("feature_name", F.coalesce(enough, F.lit(False)).alias("proven"))


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the session's shared folder and read back: they are small and several plans need them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def heavy_categories(df: DataFrame, columns: Sequence[str], top: int = TOP_CATEGORIES, tracked: int = TRACKED) -> DataFrame:
    """feature_name, value, n_rows, position: what :func:`top_categories` gives, with a shuffle that does not grow with the values.

    Two scans: summaries of bounded size propose values, their exact counts
    follow. A column whose ``top`` categories are not proven by that (more than
    ``tracked`` values and the last category rarer than one row in about 300 at
    the default) is counted whole, as before; which columns these are comes to the driver.
    """
    names = list(columns)
    if not names:
        return top_categories(df, names, top)
    candidates = kept(heavy_candidates(df, names, tracked), "hitters-candidates")
    counts = kept(named(recounted(df, names, candidates), names), "hitters-counts")
    proven = _proven(df, names, counts, candidates, top, tracked)
    rest = {row["feature_name"] for row in proven.where(~F.col("proven")).collect()}
    known = counts if not rest else counts.where(~F.col("feature_name").isin(*rest))
    found = rank_categories(known, top)
    if rest:
        found = found.unionByName(top_categories(df, [name for name in names if name in rest], top))
    return found
