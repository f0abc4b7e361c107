"""Near copies by the Jaccard similarity of word shingles: SimHash fingerprints and MinHash bands find pairs, exact sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import simhash
from riskloom.llm.common import components, free_name, join_null_safe, stored

SEED = 42
SHINGLE = 5
#: Two texts are linked from this similarity on, as a fraction of whole numbers.
LEAST = (4, 5)
#: Two texts meet when the fingerprints of their shingles differ in at most RADIUS of 64 bits.
RADIUS = 3
#: At a similarity of 0.8 most fingerprints lie further apart than that, and a radius wide enough
#: for all has no selective keys. So two texts also meet when all ROWS minima of one of BANDS bands are equal: at a similarity of 0.8
#: all but 2 in 10,000 pairs, nearer ones sooner.
BANDS, ROWS = 28, 6
#: Texts of one set of candidates compared in one task; larger sets are dealt to pairs of blocks.
BLOCK = 1024
#: Places of the table that tells which texts are candidates at all; it goes to every task.
SIEVE = 1 << 21

_RANDOM = np.random.default_rng(SEED)
_FLIPS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words end at ASCII white space; lower case is that of A-Z."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 hashes of all runs of words, in order; a shorter text is one run."""
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64)


def shingles(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Distinct XXH64 hashes of all runs of words, ascending."""
    return np.unique(shingle_hashes(words, shingle))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for every band: equal sets have equal keys, and two sets share a minimum as often as they are similar."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 1024):
        mixed = (hashes[start : start + 1024, None] ^ _FLIPS) * _FACTORS
        least = np.minimum(least, mixed.min(axis=0))
    bands = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(band.tobytes(), k) - (1 << 63) for k, band in enumerate(bands)]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, node, fingerprint, bands) of every row.

    ``key`` and ``node`` are the hashes of its text as it is and of its words.
    ``fingerprint`` is the majority of its runs of words, repeats included, and
    ``bands`` are the band keys of the distinct ones.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, bands = [], [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                nodes.append(xxhash.xxh64_intdigest(b" ".join(words), SEED) - (1 << 63))
                hashes = shingle_hashes(words)
                prints.append(simhash.majority(hashes) if words else 0)
                bands.append(band_keys(np.unique(hashes)))
            prints = pa.array(np.array(prints, np.uint64).view(np.int64))
            columns = [*batch.columns[:2], pa.array(nodes, pa.int64()), prints, pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "node", "fingerprint", "bands"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(sketch, "doc_id long, key long, node long, fingerprint long, bands array<long>")


def text_key():
    return F.xxhash64(F.col("text").cast("string"))


def close_prints(sketched: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes whose fingerprints differ in at most RADIUS bits.

    Nodes of one fingerprint are tied to the smallest of them, which stands for
    all when the distinct fingerprints are compared.
    """
    printed = stored(sketched.select("node", "fingerprint").distinct(), "jaccard-prints")
    least = printed.groupBy("fingerprint").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    least = stored(least, "jaccard-least")
    equal = printed.join(least.where("n > 1"), "fingerprint").where("node <> least")
    first, second = (least.select(F.col("fingerprint").alias(end), F.col("least").alias(f"least_{end}")) for end in "ab")
    close = simhash.links(least.select("fingerprint"), RADIUS).distinct().join(first, "a").join(second, "b")
    return equal.select(F.col("node").alias("a"), F.col("least").alias("b")).union(close.select("least_a", "least_b"))


def candidates(sketched: DataFrame) -> DataFrame:
    """(node, component): sets of nodes that hold together by close fingerprints or shared band keys.

    No pair is compared yet. Each node of a band key is tied to the smallest one
    there, so a key of any length makes as many rows as it has nodes.
    """
    banded = stored(sketched.select("node", F.explode("bands").alias("band")).distinct(), "jaccard-bands")
    smallest = banded.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1")
    tied = banded.join(smallest.select("band", "least"), "band").where("node <> least")
    tied = tied.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return components(tied.union(close_prints(sketched)).distinct())


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two ascending sets share at least LEAST of their union."""
    up, down = LEAST
    if min(len(left), len(right)) * down < max(len(left), len(right)) * up:
        return False
    both = np.concatenate([left, right])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared * down >= (len(both) - shared) * up


def spanning_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (later, earlier) that connect the same sets as all similar pairs do.

    Two similar sets share one of the first hashes of each, as many as may be
    missing from the other and one more. Pairs that meet there are compared once,
    and not at all when links already connect them.
    """
    up, down = LEAST
    root = np.arange(len(sets))
    fronts = [s[: len(s) - -(-len(s) * up // down) + 1] for s in sets]
    owner = np.repeat(np.arange(len(sets)), [len(f) for f in fronts])
    hashes = np.concatenate(fronts)
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    found: list[tuple[int, int]] = []
    seen: set[int] = set()
    place, shift = np.arange(len(hashes)), 0
    while True:
        shift += 1
        place = place[place + shift < len(hashes)]
        place = place[hashes[place] == hashes[place + shift]]
        if not len(place):
            return found
        first, second = owner[place], owner[place + shift]
        apart = root[first] != root[second]
        for code in np.unique(first[apart] * len(sets) + second[apart]).tolist():
            i, j = divmod(code, len(sets))
            if root[i] != root[j] and code not in seen:
                seen.add(code)
                if similar(sets[i], sets[j]):
                    found.append((j, i))
                    a, b = sorted((root[i], root[j]))
                    root[root == b] = a


def links(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes whose texts met and are similar, and no others.

    The texts of a set of candidates are sent once, to the task that compares
    them; a set with more than BLOCK texts is dealt to all pairs of its blocks.
    """
    held = stored(candidates(sketched), "jaccard-candidates")
    blocks = held.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    texts = sketched.groupBy("node").agg(F.min("key").alias("key"))
    wanted = stored(held.join(blocks, "component").join(texts, "node"), "jaccard-wanted")
    place = F.pmod("key", F.lit(SIEVE))
    sieve = F.broadcast(wanted.select(place.alias("place")).distinct())
    rows = docs.select(text_key().alias("key"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("place", place).join(sieve, "place", "left_semi").select("key", "text")
    rows = rows.dropDuplicates(["key"]).join(wanted, "key")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other),
    )
    dealt = rows.select("component", F.explode(meets).alias("block"), "node", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets = None, [], []

        def settled() -> Iterator[pa.RecordBatch]:
            if found := spanning_links(sets) if sets else []:
                ends = [pa.array([nodes[pair[k]] for pair in found], pa.int64()) for k in range(2)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        for batch in batches:
            for component, block, node, text in zip(*(column.to_pylist() for column in batch.columns)):
                if (component, block) != group:
                    yield from settled()
                    group, nodes, sets = (component, block), [], []
                nodes.append(node)
                sets.append(shingles(words_of(text)))
        yield from settled()

    dealt = dealt.repartition("component", "block").sortWithinPartitions("component", "block", "node")
    return dealt.mapInArrow(compare, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, key, component, is_first) of every row of ``docs`` (doc_id, text).

    Rows are linked when the sets of their runs of SHINGLE words have a Jaccard
    similarity of at least LEAST; a text of fewer words is one run, and all
    texts without a word are alike. ``component`` is the same for all rows that
    can be reached, and the one with the smallest doc_id is the first; a null
    doc_id only where there is no other.
    """
    sketched = stored(sketches(docs), "jaccard-sketches")
    found = components(links(docs, sketched)).withColumnRenamed("component", "reached")
    rows = sketched.select("doc_id", "key", "node").join(found, "node", "left")
    rows = rows.withColumn("component", F.coalesce("reached", "node"))
    rows = rows.withColumn("rank", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))
    first = rows.groupBy("component").agg(F.min("rank").alias("first"))
    return rows.join(first, "component").select("doc_id", "key", "component", F.col("rank").eqNullSafe(F.col("first")).alias("is_first"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that come first among their near copies; every column as it was."""
    key = free_name("_key", docs)
    others = near_copies(docs).where("not is_first").select("doc_id", F.col("key").alias(key)).distinct()
    return join_null_safe(docs.withColumn(key, text_key()), others, ["doc_id", key], "left_anti").drop(key)
