"""What the operators share: words, stored intermediate tables, running totals, connected components."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows read back from Parquet in the session's shared folder.

    Cuts the lineage: whatever is computed from the result survives the loss of
    executors without running ``df`` again, and reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    """Equality under which two nulls are equal."""
    return left.eqNullSafe(right)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no column of the frames is called that, in any case of letters."""
    taken = {column.lower() for frame in frames for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunk_rank(df: DataFrame, keys: list[str], chunk: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """Exclusive running sums of ``values`` (name -> summed column) within ``keys``, by ``chunk`` and then ``order``.

    No window sees a key's rows whole, so a key that holds a third of the rows
    is no larger a task than any other: rows are summed within their chunk, and
    the chunk totals, one row each, are summed in two levels above that. The
    caller chooses chunks of bounded size. ``chunk`` must be a non-negative whole number.
    """
    totals = df.groupBy(*keys, chunk).agg(*[F.sum(column).alias(f"_t_{name}") for name, column in values.items()])
    totals = totals.withColumn("_upper", F.shiftright(F.col(chunk).cast("long"), 10))
    upper = totals.groupBy(*keys, "_upper").agg(*[F.sum(f"_t_{name}").alias(f"_u_{name}") for name in values])
    above = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_upper").rowsBetween(Window.unboundedPreceding, -1)
    beside = Window.partitionBy(*keys, "_upper").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    upper = upper.select(*keys, "_upper", *[before(f"_u_{name}", above).alias(f"_u_{name}") for name in values])
    starts = totals.select(*keys, "_upper", chunk, *[before(f"_t_{name}", beside).alias(f"_t_{name}") for name in values])
    starts = join_null_safe(starts, upper, [*keys, "_upper"]).select(
        *keys, chunk, *[(F.col(f"_t_{name}") + F.col(f"_u_{name}")).alias(f"_s_{name}") for name in values]
    )
    local = df.select("*", *[before(column, inside).alias(f"_l_{name}") for name, column in values.items()])
    joined = join_null_safe(local, starts, [*keys, chunk])
    return joined.select(*df.columns, *[(F.col(f"_l_{name}") + F.col(f"_s_{name}")).alias(name) for name in values])


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, nulls equal; the key columns of the left side stay."""
    other = {c: free_name(f"_r_{c}", left, right) for c in keys}
    renamed = right.withColumnsRenamed(other)
    condition = functools.reduce(operator.and_, [same(F.col(c), F.col(other[c])) for c in keys])
    return left.join(renamed, condition, how).drop(*other.values())


def ranged(df: DataFrame, by: list[str], rows_per_part: int, name: str, most_parts: int = 10_000) -> DataFrame:
    """The rows stored in ranges of ``by``, ascending, with the number of their range as ``_part``.

    Equal keys share a range, nulls come first. The number of ranges follows the
    rows up to ``most_parts``.
    """
    rows = df.count()
    parts = max(1, min(most_parts, -(-rows // rows_per_part)))
    dealt = df.repartitionByRange(parts, *[F.col(c) for c in by])
    return stored(dealt.withColumn("_part", F.spark_partition_id().cast("long")), name)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): one row (node, component) per node, component the smallest node.

    Alternates two star contractions until nothing changes: every node hands its
    larger neighbours to its smallest neighbour, then does the same among its
    smaller ones. A component ends as a star around its smallest node. Smallest
    neighbours are plain grouped minima, which combine before the shuffle, so a
    node with very many links is not gathered anywhere; its joins are left to
    the skew handling of AQE. Each round is stored in the shared folder and only
    its row count and checksum come to the driver. Null ends and loops are no links.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _checksum(current)
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(smallest.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        following = stored(small, "links")
        latest = _checksum(following)
        if latest == mark:
            break
        current, mark = following, latest
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = current.groupBy("a").agg(F.min("b").alias("component"))
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), "component").union(centres)


def _checksum(links: DataFrame) -> tuple[int, int]:
    digest = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    row = links.agg(F.count("*").alias("n"), digest.alias("s")).first()
    return row["n"], int(row["s"])
