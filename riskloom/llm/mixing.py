"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import chunk_rank, free_name, join_null_safe, stored, text_of, word_count

BLOCK_WORDS = 1000
#: A source's words are taken this many times at most.
MOST_PASSES = 3
#: Schedule points have this many binary digits.
POINT_BITS = 40
#: Documents of one source that are shuffled and summed in one group.
GROUP_ROWS = 1024
#: More sources than this are refused: their totals and weights are handled on the driver.
MOST_SOURCES = 100_000
WEIGHTS = (1, 2, 3)


def water_fill(sizes: list[int], weights: list[int], most: int = MOST_PASSES) -> list[Fraction]:
    """Shares of all sizes by weight; a share stops at ``most`` times its size and its excess goes to the others."""
    total, targets = Fraction(sum(sizes)), [Fraction(0)] * len(sizes)
    open_ = [k for k, size in enumerate(sizes) if size]
    while open_:
        unit = total / sum(weights[k] for k in open_)
        full = [k for k in open_ if unit * weights[k] > most * sizes[k]]
        if not full:
            for k in open_:
                targets[k] = unit * weights[k]
            break
        for k in full:
            targets[k] = Fraction(most * sizes[k])
            total -= targets[k]
        open_ = [k for k in open_ if k not in set(full)]
    return targets


def sized_documents(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, source, size) stored: one row per document, ``size`` its words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text_of()).alias("size"),
    )
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "mix-sizes")


def source_plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS) -> DataFrame:
    """(source, source_no, source_size, target, quota, blocks, low, high, groups): one row per source.

    Sources are ordered by code point, null last, and weighted by ``weights`` in
    turn. ``quota`` is the target in whole words; ``low`` and ``high`` enclose the
    schedule points of the source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).take(MOST_SOURCES + 1)
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    totals.sort(key=lambda row: (row["source"] is None, row["source"] or ""))
    targets = water_fill([row["size"] for row in totals], [weights[k % len(weights)] for k in range(len(totals))])
    whole, below, rows = sum(targets), Fraction(0), []
    for k, (row, target) in enumerate(zip(totals, targets)):
        quota = round(target)
        low = _point(below, whole)
        below += target
        rows.append(
            (row["source"], k, row["size"], float(target), quota, -(-quota // block), low, _point(below, whole),
             max(1, -(-row["rows"] // GROUP_ROWS)))
        )
    schema = "source string, source_no long, source_size long, target double, quota long, blocks long, low long, high long, groups long"
    return sized.sparkSession.createDataFrame(rows, schema)


def _point(part: Fraction, whole: Fraction) -> int:
    return int(part / whole * (1 << POINT_BITS)) if whole else 0


def schedule(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """(slot, source_no, block): which block of which source comes when.

    Slot i gets the van der Corput point of i, its binary digits reversed, and the
    source in whose share of the unit interval the point falls; a source's slots
    are ranked and take its blocks in order. In any run of the first n slots every
    source is within a few blocks (log n) of its share. Slots beyond a source's
    quota stay empty; the few blocks a source has left at the end follow as last slots.
    """
    rows = plan.select("source_no", "blocks", "low", "high").orderBy("source_no").collect()
    slots = sum(row["blocks"] for row in rows)
    starts = F.array(*[F.lit(row["high"]).cast("long") for row in rows] or [F.lit(0).cast("long")])
    reversed_ = F.reverse(F.lpad(F.bin("id"), POINT_BITS, "0"))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.conv(reversed_, 2, 10).cast("long").alias("point"))
    past = F.size(F.filter(starts, lambda high: high <= F.col("point"))).cast("long")
    points = points.select("slot", past.alias("source_no"), F.shiftright("slot", 12).alias("chunk"), F.lit(1).cast("long").alias("one"))
    ranked = chunk_rank(points, ["source_no"], "chunk", ["slot"], {"block": "one"})
    ranked = ranked.join(plan.select("source_no", "blocks"), "source_no").where("block < blocks")
    counts = points.groupBy("source_no").agg(F.count("*").alias("served"))
    short = plan.select("source_no", "blocks").join(counts, "source_no", "left").fillna(0, ["served"]).where("served < blocks")
    rest = short.select("source_no", F.explode(F.sequence("served", F.col("blocks") - 1)).alias("block"))
    return ranked.select("slot", "source_no", "block").union(
        rest.select((F.lit(slots) + F.col("block")).alias("slot"), "source_no", "block")
    )


def block_pieces(sized: DataFrame, plan: DataFrame, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """(source_no, block, _row, epoch, from_word, to_word): documents cut into blocks of equal numbers of words.

    The documents of a source follow each other in a shuffled order, fixed by
    ``seed`` and the ids, as often as its quota needs, and the last block ends
    where the quota does. The running total comes from small groups of the
    shuffled order, so that a large source is many tasks.
    """
    rows = join_null_safe(sized.where("size > 0"), plan, ["source"])
    key = F.xxhash64(F.lit(seed).cast("long"), "doc_id")
    rows = rows.withColumn("_key", key).withColumn("_group", F.pmod("_key", "groups"))
    rows = chunk_rank(rows, ["source_no"], "_group", ["_key", "doc_id", "_row"], {"offset": "size"})
    passes = F.ceil(F.col("quota") / F.col("source_size")).cast("long")
    rows = rows.where("quota > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)).alias("epoch"))
    rows = rows.withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("offset"))
    rows = rows.withColumn("end", F.least(F.col("begin") + F.col("size"), "quota")).where("begin < end")
    first, last = F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}")
    rows = rows.select("*", F.explode(F.sequence(first, last)).alias("block"))
    low, high = F.greatest("begin", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    return rows.select(
        "source_no", "block", "_row", "epoch", (low - F.col("begin")).alias("from_word"), (high - F.col("begin")).alias("to_word")
    )


def mix(sized: DataFrame, plan: DataFrame, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """(slot, source_no, block, _row, epoch, from_word, to_word): the words of the mix, in the order of their slots."""
    slots = schedule(sized.sparkSession, plan)
    return slots.join(block_pieces(sized, plan, block, seed), ["source_no", "block"])


def mixed_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs`` (doc_id, text, source).

    ``taken`` counts the words of the mix that come from the row, repeats included:
    at most MOST_PASSES times its size, and over a source its target in whole
    words. Null texts have no words; a null source is a source of its own and the
    last. Rows with the same id are mixed separately. An empty table gives no rows.
    """
    sized = sized_documents(docs)
    plan = source_plan(sized, weights, block)
    taken = mix(sized, plan, block, seed).groupBy("_row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    rows = join_null_safe(sized, plan.select("source", "source_size", "target"), ["source"]).join(taken, "_row", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """Rows of ``docs`` as often as the mix passes over them, every column as it was.

    A pass counts when the mix takes more than half of the row's words in it; only
    the document on which a source's quota ends is ever taken in part.
    """
    number = free_name("_row", docs)
    whole = stored(docs.withColumn(number, F.monotonically_increasing_id()), "mix-documents", compression="zstd")
    rows = whole.select(
        F.col(number).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text_of()).alias("size")
    )
    sized = stored(rows, "mix-sizes")
    plan = source_plan(sized, weights, block)
    passes = mix(sized, plan, block, seed).groupBy("_row", "epoch").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    passes = passes.join(sized.select("_row", "size"), "_row").where("2 * words > size").select(F.col("_row").alias(number))
    return whole.join(passes, number).drop(number)
