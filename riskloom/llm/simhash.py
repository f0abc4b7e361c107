"""SimHash near-duplicates: fingerprints of word shingles, linked by a bit-sliced comparison of bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, join_null_safe, stored

SEED = 42
BITS = 64
#: The 64 bits are cut into this many parts; two fingerprints that differ in at most
#: ``radius`` bits agree on at least PARTS - radius of them.
PARTS = 6
#: Rows of one key that are compared in one group; longer keys are dealt to pairs of blocks.
BLOCK = 16_384
CHUNK = 1 << 18
#: Planes compared between two looks at which lanes are still within the radius.
LOOK = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority fingerprint of the XXH64 hashes of all shingles; zero without a word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return majority(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the 64-bit hashes."""
    hashes = hashes.astype("<u8", copy=False)
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start : start + 4096].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row; a null text is an empty one.

    Lower case is that of A-Z, words end at ASCII white space, and repeated
    shingles vote each time. Texts of any length are read whole; rows that
    repeat or share an id get a row each.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, fingerprint long")


def carry_save(counter: tuple[np.ndarray, ...], bit: np.ndarray) -> tuple[np.ndarray, ...]:
    """Add one bit to every lane of a bit-sliced counter whose last digit saturates."""
    carry, digits = bit, []
    for digit in counter[:-1]:
        digits.append(digit ^ carry)
        carry = digit & carry
    return (*digits, counter[-1] | carry)


def close_lanes(left: np.ndarray, right: np.ndarray, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Of 64 lanes a word, those of ``wanted`` whose 64 bits differ in at most ``radius`` places.

    ``left`` and ``right`` hold the bit planes, 64 rows by words. All lanes of a word
    count their differences at once. A word is abandoned as soon as each of its
    wanted lanes is beyond the radius.
    """
    result = np.zeros_like(wanted)
    alive = np.flatnonzero(wanted)
    kept = wanted[alive]
    digits = radius.bit_length() + 1  # counts 0 .. radius, and the saturating digit
    start = (1 << (digits - 1)) - 1 - radius  # the last digit is set from the first count beyond the radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counter = tuple(np.full(len(alive), full if start >> k & 1 else 0, np.uint64) for k in range(digits))
    for plane in range(BITS):
        counter = carry_save(counter, left[plane, alive] ^ right[plane, alive])
        if plane % LOOK == LOOK - 1:
            near = kept & ~counter[-1]
            some = near != 0
            if not some.all():
                alive, kept = alive[some], kept[some]
                counter = tuple(digit[some] for digit in counter)
                if not len(alive):
                    return result
    result[alive] = kept & ~counter[-1]
    return result


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Planes of 64-bit values: row k holds bit k of all values, 64 lanes a word."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.zeros((BITS, -(-len(values) // 64) * 64), np.uint8)
    lanes[:, : len(values)] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view("<u8")


def shifted(planes: np.ndarray, by: int) -> np.ndarray:
    """Lane i of the result is lane i + ``by``; lanes beyond the end are zero."""
    words, bits = divmod(by, 64)
    moved = np.zeros_like(planes)
    width = planes.shape[-1] - words
    if width <= 0:
        return moved
    moved[..., :width] = planes[..., words:] >> np.uint64(bits)
    if bits and width > 1:
        moved[..., : width - 1] |= planes[..., words + 1 :] << np.uint64(64 - bits)
    return moved


def linked(keys: np.ndarray, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in rows sorted by key, of one key and within the radius, by distance in the order."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    # rows of keys with several rows only, so that lone rows cost nothing
    several = np.repeat(sizes > 1, sizes)
    where, sizes = np.flatnonzero(several), sizes[sizes > 1]
    if not len(where):
        return
    left_over = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(where)) - 1  # rows of the key that follow
    planes = bit_planes(values[where].astype(np.uint64))
    lanes = np.zeros(planes.shape[1] * 64, bool)
    for shift in range(1, int(sizes.max())):
        lanes[: len(where)] = left_over >= shift
        wanted = np.packbits(lanes, bitorder="little").view("<u8").astype(np.uint64)
        words = np.flatnonzero(wanted)
        near = close_lanes(planes[:, words], take_shifted(planes, words, shift), wanted[words], radius)
        if near.any():
            hit = np.unpackbits(near.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
            row, lane = np.nonzero(hit)
            first = words[row] * 64 + lane
            yield where[first], where[first + shift]


def take_shifted(planes: np.ndarray, words: np.ndarray, by: int) -> np.ndarray:
    """The chosen words of :func:`shifted`, without moving the others."""
    whole, bits = divmod(by, 64)
    padded = np.concatenate([planes, np.zeros((planes.shape[0], 1), planes.dtype)], axis=1)
    last = planes.shape[1]
    low = padded[:, np.minimum(words + whole, last)] >> np.uint64(bits)
    if bits:
        low |= padded[:, np.minimum(words + whole + 1, last)] << np.uint64(64 - bits)
    return low


def forest(nodes: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same rows as ``pairs``, each to the first of its set; fewer than there are rows."""
    root = np.arange(len(nodes))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for first, second in pairs:
        new = root[first] != root[second]
        for i, j in zip(first[new].tolist(), second[new].tolist()):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
        while not np.array_equal(root, flat := root[root]):
            root = flat
    moved = np.flatnonzero(root != np.arange(len(root)))
    return nodes[moved], nodes[root[moved]]


def bit_parts() -> list[tuple[int, int]]:
    """(first bit, width) of the parts."""
    edges = [BITS * k // PARTS for k in range(PARTS + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def band_keys(prints: DataFrame, radius: int) -> DataFrame:
    """(key, fingerprint): one row for every choice of parts of which two close fingerprints share at least one."""

    def bits(low: int, width: int):
        return F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << width) - 1))

    keys = []
    for table, choice in enumerate(combinations(bit_parts(), PARTS - radius)):
        key = F.lit(table).cast("long")
        for low, width in choice:
            key = F.shiftleft(key, width).bitwiseOR(bits(low, width))
        keys.append(key)
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fingerprint")


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``radius`` bits of each other, and no others.

    ``prints`` has distinct fingerprints. Each goes to the keys made of every
    PARTS - radius of its bit parts (20 keys of 31 to 33 bits), so two within the
    radius meet under one key at least and few others do. The rows of a key are
    compared in one task; a key with more than BLOCK rows is dealt to all pairs
    of its blocks, which meet in tasks of their own, so that none is dropped and
    no task grows with the key. Out come the links of a spanning forest of
    every chunk of rows, not all pairs.
    """
    if not 0 <= radius < PARTS:
        raise ValueError(f"radius must be below {PARTS}")
    keyed = band_keys(prints, radius)
    long_keys = keyed.groupBy("key").count().where(F.col("count") > BLOCK)
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    sized = keyed.join(long_keys.select("key", blocks.alias("blocks")), "key", "left")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other),
    )
    group = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(meets))
    grouped = sized.select("key", group.alias("block"), "fingerprint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, values in whole_groups(batches):
            a, b = forest(values, linked(groups, values, radius))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = grouped.repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(compare, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows sorted by (key, block) in chunks that never part a group: (group numbers, fingerprints)."""
    held: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)]))
        rows += batch.num_rows
        if rows >= CHUNK:
            table = np.concatenate(held, axis=1)
            change = np.flatnonzero((table[:2, 1:] != table[:2, :-1]).any(axis=0)) + 1
            cut = int(change[-1]) if len(change) else 0
            if cut:
                yield numbered(table[:, :cut])
            held, rows = [table[:, cut:]], table.shape[1] - cut
    if rows:
        yield numbered(np.concatenate(held, axis=1))


def numbered(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    change = np.r_[False, (table[:2, 1:] != table[:2, :-1]).any(axis=0)]
    return np.cumsum(change), table[2]


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every row of ``docs`` (doc_id, text).

    Rows are linked when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest doc_id of all that can be reached. Equal
    fingerprints meet once, however many rows have them. Null and empty texts
    have fingerprint zero and are linked like any other. A null doc_id never
    names a component unless nothing else does. Other columns are not looked at.
    """
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    found = components(links(distinct.select("fingerprint"), radius))
    labels = distinct.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    labels = labels.withColumn("component", F.coalesce("component", "fingerprint"))
    smallest = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = labels.join(smallest, "component").select("fingerprint", "component_id")
    return prints.join(labels, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component; every column as it was."""
    first = near_duplicates(docs, radius, shingle).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return join_null_safe(docs, first.select("doc_id").distinct(), ["doc_id"], "left_semi")
