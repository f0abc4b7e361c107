"""Stored batches with filters over their keys, so that the audit of a new batch reads old rows only where a key may occur."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.longform import quoted
from riskloom.session import scratch_path
from riskloom.sources.versions import PART, VersionedTable, publish_batch

#: Bits of a block, which is the bitmap of Spark's bitmap functions, and how many of them a key sets.
BLOCK_BITS = 32768
PROBES = 7
#: A filter has at least this many bits for each row of its batch.
BITS_PER_ROW = 10
RESERVED = {PART, "_h", "blocks", "block", "bitmap", "n_new", "n_stored"}


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(quoted(name)) for name in keys])


def _bits(h: Column) -> list[Column]:
    """The places that a key sets within its block, steps of one hash from another."""
    first, step = F.xxhash64(h, F.lit(1)), F.xxhash64(h, F.lit(2))
    return [F.pmod(F.shiftright(first, 20) + k * F.shiftright(step, 20), F.lit(BLOCK_BITS)) for k in range(PROBES)]


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def key_filter(df: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """block, bitmap: a Bloom filter of the keys in ``blocks`` blocks; a key sets all of its bits in one block.

    Hashes are placed by block before any bitmap is made, so a block is built once
    and by one task, and no task holds a bitmap of all keys.
    """
    placed = df.select(_hash(keys).alias("h")).distinct().withColumn("block", F.pmod("h", F.lit(blocks)))
    bits = placed.repartition("block").select("block", F.explode(F.array(*_bits(F.col("h")))).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


class KeyedBatches:
    """A versioned table of batches below ``path`` with a filter of keys per batch.

    ``key`` maps the key columns to their types, to which every batch is cast, so
    that equal keys have equal hashes; use integers, texts, dates or decimals. A
    batch that comes again replaces its own rows and filter. A filter names the
    folder of the rows that it was made from: where a writer stopped between the
    two, the batch has no filter that counts and is read whole, and no key is missed.
    The size of a filter follows its batch, about two bytes a row.
    """

    def __init__(self, spark: SparkSession, path: str, key: Mapping[str, str]):
        if RESERVED & set(key):
            raise ValueError(f"key columns with reserved names: {sorted(RESERVED & set(key))}")
        self.spark, self.key = spark, dict(key)
        self.rows = VersionedTable(spark, f"{path.rstrip('/')}/rows")
        self.filters = VersionedTable(spark, f"{path.rstrip('/')}/filters")

    def typed(self, df: DataFrame) -> DataFrame:
        """The rows with their key columns in the types of the index."""
        return df.withColumns({name: F.col(quoted(name)).cast(kind) for name, kind in self.key.items()})

    def add(self, df: DataFrame, batch: str) -> int:
        """Store a batch and its filter; the version of the rows."""
        if PART in df.columns:
            raise ValueError(f"a stored batch cannot have a column {PART!r}")
        version = publish_batch(self.rows, self.typed(df), batch)
        self.index(batch)
        return version

    def index(self, batch: str) -> None:
        """Make the filter of a stored batch anew; only this batch is read."""
        folder = self.rows.state().get(batch, (None, None))[0]
        there = self.rows.read(parts=[batch])
        blocks = 1 << max(0, (there.count() * BITS_PER_ROW - 1) // BLOCK_BITS).bit_length()
        made = key_filter(self._present(there), list(self.key), blocks)
        made = made.select(F.lit(blocks).cast("long").alias("blocks"), F.col("block").cast("long").alias("block"), "bitmap", F.lit(folder).alias("folder"))
        publish_batch(self.filters, made, batch)

    def _present(self, df: DataFrame) -> DataFrame:
        return df.dropna(subset=[quoted(name) for name in self.key])

    def _filters(self) -> tuple[DataFrame | None, list[str], list[str]]:
        """Blocks that count with their part, the parts they are of, and the stored parts without them."""
        stored = {part: folder for part, (folder, _) in self.rows.state().items()}
        if not stored:
            return None, [], []
        parts = [part for part in self.filters.state() if part in stored]
        if not parts:
            return None, [], sorted(stored)
        blocks = self.filters.read(parts=parts)
        by_folder = self.spark.createDataFrame([(stored[p], p) for p in sorted(stored)], "folder string, part string")
        blocks = blocks.join(F.broadcast(by_folder), "folder")  # one row a stored batch
        known = sorted(row[PART] for row in blocks.select(PART).distinct().collect())
        return blocks, known, sorted(set(stored) - set(known))

    def candidates(self, counted: DataFrame, without: str | None = None) -> DataFrame:
        """The keys of ``counted`` (a row per key) with each stored part that may hold them, in a stored table.

        ``without`` names a part that is left out.
        """
        names = [quoted(name) for name in self.key]
        blocks, known, unknown = self._filters()
        probes = counted.select(*names, _hash(list(self.key)).alias("_h"))
        parts = [part for part in unknown if part != without]
        found = probes.select(*names, F.explode(F.array(*[F.lit(p) for p in parts]).cast("array<string>")).alias(PART))
        if blocks is not None and any(part != without for part in known):
            if without is not None:
                blocks = blocks.where(F.col(PART) != without)
            # powers of two: a few dozen at most
            sizes = sorted(row[0] for row in blocks.select("blocks").distinct().collect())
            probes = probes.withColumn("blocks", F.explode(F.array(*[F.lit(size).cast("long") for size in sizes])))
            probes = probes.withColumn("block", F.pmod("_h", "blocks"))
            met = probes.join(blocks.select("blocks", "block", "bitmap", PART), ["blocks", "block"])
            for bit in _bits(F.col("_h")):
                met = met.where(_is_set(F.col("bitmap"), bit))
            found = found.unionByName(met.select(*names, PART))
        path = scratch_path(self.spark, "key-candidates")
        found.write.parquet(path)
        return self.spark.read.schema(found.schema).parquet(path)

    def _stored_counts(self, counted: DataFrame, without: str | None) -> DataFrame:
        """The keys of ``counted`` that stored parts hold, with their number of rows there as ``n_stored``."""
        names = [quoted(name) for name in self.key]
        hits = self.candidates(counted, without)
        parts = sorted(row[0] for row in hits.select(PART).distinct().collect())
        if not parts:
            return counted.select(*names, F.lit(0).cast("long").alias("n_stored")).limit(0)
        there = self.rows.read(parts=parts).select(*names)
        wanted = hits.select(*names).distinct()
        return there.join(wanted, list(self.key), "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("n_stored"))

    def duplicates(self, new: DataFrame, batch: str | None = None) -> DataFrame:
        """Key columns, n_new, n_stored: keys of a new batch that it repeats or that other stored batches have.

        ``batch`` is the name under which the rows come: rows stored under it are
        about to be replaced and do not count. A key with a null in it is no key.
        The new rows are counted by key first, so a key with very many rows is one
        probe; parts that no key may be in are not read.
        """
        names = [quoted(name) for name in self.key]
        counted = self._present(self.typed(new)).groupBy(*names).agg(F.count(F.lit(1)).alias("n_new"))
        both = counted.join(self._stored_counts(counted, batch), list(self.key), "left").fillna(0, ["n_stored"])
        return both.where((F.col("n_new") > 1) | (F.col("n_stored") > 0))

    def orphans(self, child: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
        """Rows of ``child`` whose key is set and that no stored batch has; ``columns`` maps key columns to the child's.

        Key columns of the child come out in the types of the index.
        """
        of = {name: (columns or {}).get(name, name) for name in self.key}
        kept = child.withColumns({of[name]: F.col(quoted(of[name])).cast(kind) for name, kind in self.key.items()})
        kept = kept.dropna(subset=[quoted(name) for name in of.values()])
        counted = kept.select(*[F.col(quoted(of[name])).alias(name) for name in self.key]).distinct()
        known = self._stored_counts(counted, None).select(*[F.col(quoted(name)).alias(of[name]) for name in self.key])
        return kept.join(known, list(of.values()), "left_anti")
