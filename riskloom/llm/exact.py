"""Exact duplicates through an extendible-hash index kept in shared files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, free_name, join_null_safe, stored, text_of

SPACES = re.compile(rb"[\x20\x09-\x0D]+")
#: Bytes that a task keeps to collapse copies before anything is shuffled: texts, and what a text and a row cost beside.
HELD_BYTES = 64 << 20
ENTRY_BYTES, MEMBER_BYTES = 300, 100
#: Directory: at most 2 ** MOST_DEPTH entries of a few bytes, so that it may be broadcast.
MOST_DEPTH = 18
LEAST_CAPACITY = 2048
#: Bytes of index that an owner task is given, or more where that would be over MOST_OWNERS tasks; a bucket is never cut.
OWNED_BYTES = 32 << 20
MOST_OWNERS = 20_000


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text with every run of ASCII white space as one space; a null text is empty."""
    return SPACES.sub(b" ", (text or "").encode())


class _Copies:
    """Rows of one task, collapsed to one entry per text. Equal hashes are chained and told apart by their bytes."""

    def __init__(self, partition: int):
        self.next = partition << 33
        self.clear()

    def clear(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.members: list[tuple[int | None, list]] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        key = xxhash.xxh64_intdigest(text)
        chain = self.chains.setdefault(key - (1 << 64) if key >> 63 else key, [])
        entry = next((e for e in chain if e[0] == text), None)
        if entry is None:
            # text, address, smallest id, its row, rows, digest
            entry = [text, self.next, doc_id, len(self.members), 0, hashlib.sha256(text).digest()]
            self.next += 1
            chain.append(entry)
            self.bytes += len(text) + ENTRY_BYTES
        elif doc_id is not None and (entry[2] is None or doc_id < entry[2]):
            entry[2], entry[3] = doc_id, len(self.members)
        entry[4] += 1
        self.members.append((doc_id, entry))
        self.bytes += MEMBER_BYTES

    def batch(self) -> pa.RecordBatch:
        """Members (text null, with their place in the entry) and then entries."""
        ids = [doc_id for doc_id, _ in self.members]
        addresses = [entry[1] for _, entry in self.members]
        first = [entry[3] == row for row, (_, entry) in enumerate(self.members)]
        digests = [entry[5] for _, entry in self.members]
        entries = [(key, entry) for key, chain in self.chains.items() for entry in chain]
        none, more = [None] * len(ids), [None] * len(entries)
        columns = [
            pa.array([False] * len(ids) + [True] * len(entries), pa.bool_()),
            pa.array(ids + more, pa.int64()),
            pa.array(addresses + [entry[1] for _, entry in entries], pa.int64()),
            pa.array(first + more, pa.bool_()),
            pa.array(digests + more, pa.binary()),
            pa.array(none + [key for key, _ in entries], pa.int64()),
            pa.array(none + [entry[2] for _, entry in entries], pa.int64()),
            pa.array(none + [entry[4] for _, entry in entries], pa.int64()),
            pa.array(none + [len(entry[0]) + ENTRY_BYTES for _, entry in entries], pa.int64()),
            pa.array(none + [entry[0] for _, entry in entries], pa.binary()),
        ]
        names = ["is_entry", "doc_id", "address", "first", "digest", "hash", "least", "copies", "size", "text"]
        self.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)


def collapse(docs: DataFrame) -> DataFrame:
    """One member row per document and one entry row per text that a task has met, stored in the shared folder.

    A task collapses the copies it reads, so a text with any number of copies
    reaches the index as one entry per task. Memory is bounded: at HELD_BYTES,
    repeated rows counted as well, the task hands over what it has and starts
    anew, which only makes another entry of texts it meets again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies = None
        for batch in batches:
            for doc_id, text, partition in zip(*(column.to_pylist() for column in batch.columns)):
                copies = copies or _Copies(partition)
                copies.add(doc_id, normalised(text))
                if copies.bytes > HELD_BYTES:
                    yield copies.batch()
        if copies and copies.members:
            yield copies.batch()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.spark_partition_id().cast("long").alias("partition"),
    )
    kinds = "is_entry boolean, doc_id long, address long, first boolean, digest binary, "
    return stored(
        rows.mapInArrow(run, kinds + "hash long, least long, copies long, size long, text binary"), "exact-index", compression="zstd"
    )


def prefix(depth: int):
    """The first ``depth`` bits of the hash as a number."""
    return F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """Extendible directory: for each prefix of the deepest level, the depth, bucket and owner task of its hashes.

    All entries start in one bucket of depth zero. A bucket with more than
    ``capacity`` distinct hashes splits by the next bit; when it is as deep as the
    directory, the directory doubles first. Because a split depends on the
    counts below a prefix only, all splits are read off the counts of the deepest
    prefixes: a bucket is the shortest prefix whose count fits. Copies share
    their hash, cannot be split, and do not count. Owner tasks take buckets in the
    order of their keys, a new owner about every OWNED_BYTES of index.
    """
    hashes = entries.groupBy("hash").agg(F.sum("size").alias("size"))
    n = hashes.count()
    depth = min(MOST_DEPTH, max(0, (max(n, 1) - 1).bit_length() - capacity.bit_length() + 4))
    leaves = hashes.groupBy(prefix(depth).alias("slot")).agg(F.count("*").alias("fill"), F.sum("size").alias("size"))
    leaves = stored(leaves, "exact-leaves")
    levels = leaves.select("slot", "fill", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("bucket", F.call_function("shiftright", "slot", F.lit(depth) - F.col("depth")))
    fills = levels.groupBy("depth", "bucket").agg(F.sum("fill").alias("total"))
    fits = levels.join(fills, ["depth", "bucket"]).where((F.col("total") <= capacity) | (F.col("depth") == depth))
    chosen = fits.groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("at"))
    slots = chosen.select("slot", F.col("at.depth").alias("depth"), F.col("at.bucket").alias("bucket"))
    # at most 2 ** MOST_DEPTH rows, so one task may order them
    buckets = slots.join(leaves, "slot").groupBy("depth", "bucket").agg(F.min("slot").alias("from"), F.sum("size").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("from").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    owned = max(OWNED_BYTES, (leaves.agg(F.sum("size")).first()[0] or 0) // MOST_OWNERS)
    owners = buckets.select("depth", "bucket", F.floor(before / owned).cast("int").alias("owner"))
    return slots.join(owners, ["depth", "bucket"]), depth


def resolve(entries: DataFrame, capacity: int | None = None) -> DataFrame:
    """(address, keep_id, group_size, winner): the group of every entry, by owner tasks of whole buckets.

    The directory names the owner task of every bucket; an owner has a range of
    keys of about OWNED_BYTES, sorted by hash. It walks each chain of equal hashes
    and compares bytes, so that texts are equal by their bytes and never by their
    hash alone.
    """
    # capacity follows the data beyond 2 ** (MOST_DEPTH - 2) buckets, and so bounds the directory
    capacity = capacity or max(LEAST_CAPACITY, entries.count() >> (MOST_DEPTH - 2))
    slots, depth = directory(entries, capacity)
    slots = stored(slots, "exact-directory")
    owners = slots.agg(F.coalesce(F.max("owner"), F.lit(0))).first()[0] + 1
    placed = entries.withColumn("slot", prefix(depth)).join(F.broadcast(slots), "slot")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain = None, []

        def settled() -> pa.RecordBatch:
            rows = [
                (address, entry[1], entry[2], address == entry[3]) for entry in chain for address in entry[4]
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                names=["address", "keep_id", "group_size", "winner"],
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for key, address, least, copies, text in zip(*(column.to_pylist() for column in batch.columns)):
                if key != current:
                    if chain:
                        held.append(settled())
                    current, chain = key, []
                entry = next((e for e in chain if e[0] == text), None)
                if entry is None:
                    # rows come by smallest id, so the first of a chain is the one that stays
                    chain.append([text, least, copies, address, [address]])
                else:
                    entry[2] += copies
                    entry[4].append(address)
            if len(held) >= 1024:
                yield merged(held)
                held = []
        if chain:
            held.append(settled())
        if held:
            yield merged(held)

    dealt = placed.repartitionById(owners, "owner").sortWithinPartitions("hash", F.col("least").asc_nulls_last(), "address")
    rows = dealt.select("hash", "address", "least", "copies", "text")
    return rows.mapInArrow(own, "address long, keep_id long, group_size long, winner boolean")


def merged(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def exact_groups(docs: DataFrame, capacity: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id, text).

    Texts are equal when their bytes are after each run of ASCII white space
    became one space; a null text is an empty one. Of equal texts the row with
    the smallest doc_id stays; a null id only where no other has the text; of
    rows with that same id, one. Other columns are not looked at.
    """
    index = collapse(docs)
    entries = index.where("is_entry").select("hash", "address", "least", "copies", "size", "text")
    members = index.where("not is_entry").select("doc_id", "address", "first", "digest")
    groups = stored(resolve(entries, capacity), "exact-groups")
    return members.join(groups, "address").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("first") & F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text; every column as it was."""
    digest = free_name("_digest", docs)
    kept = exact_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias(digest))
    spaced = F.regexp_replace(text_of(), SPACE, " ")
    rows = join_null_safe(docs.withColumn(digest, F.sha2(spaced, 256)), kept, ["doc_id", digest], "left_semi")
    return rows.dropDuplicates(["doc_id", digest]).drop(digest)
