"""Sharding by a minimax contiguous partition of whole groups."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import chunk_rank, ranged, stored, text_of, utf8_bytes

#: Stretches of groups that the driver looks at at first, at most.
FIRST_STRETCHES = 4096
#: A stretch that matters is cut into 2 ** FINER parts at a time.
FINER = 6
_NULL_ID = -(1 << 63)


class Outline:
    """Ends of stretches of the ordered groups: where each ends, its number, and whether it is a single group."""

    def __init__(self, ends: list[tuple[int, int, bool]]):
        self.ends = sorted(ends)
        self.edges = [0, *[end for end, _, _ in self.ends]]
        self.total = self.edges[-1]

    def cuts(self, capacity: int, shards: int, hopeful: bool, at: int = 0) -> tuple[list[int], bool]:
        """Greedy cuts from ``at`` on for a capacity, and whether all fits.

        ``hopeful`` cuts inside a stretch as if it could be cut anywhere; otherwise only
        known edges are cut at. The true greedy cuts lie between the two.
        """
        cuts = []
        for _ in range(shards):
            reach = at + capacity
            if reach >= self.total:
                return cuts, True
            k = bisect_right(self.edges, reach) - 1
            at = reach if hopeful and not self.ends[k][2] else self.edges[k]
            cuts.append(at)
        return cuts, False

    def smallest(self, low: int, shards: int, hopeful: bool) -> int:
        """Smallest capacity from ``low`` on that fits, by bisection."""
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[1]:
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts for a feasible capacity that leave shards as equal as they can be, not the last one short.

        Each cut is the known edge nearest to an equal share of what is left, unless
        the rest would not fit any more; the greedy cut always leaves it fitting.
        """
        at, cuts = 0, []
        for left in range(shards, 1, -1):
            goal = at + (self.total - at) / left
            greedy = bisect_right(self.edges, at + capacity) - 1
            k = min(bisect_right(self.edges, goal), greedy)
            near = sorted({k, max(k - 1, 0)}, key=lambda j: abs(self.edges[j] - goal))
            fitting = (self.edges[j] for j in near if self.edges[j] > at and self.cuts(capacity, left - 1, False, self.edges[j])[1])
            at = next(fitting, self.edges[greedy])
            cuts.append(at)
        return cuts

    def open_stretches(self, low: int, high: int, shards: int) -> list[int]:
        """Numbers of the stretches in which a cut can lie for any capacity from ``low`` to ``high``."""
        near, far = [0, *self.cuts(low, shards, False)[0]], [0, *self.cuts(high, shards, True)[0]]
        near += [self.total] * (shards + 1 - len(near))
        far += [self.total] * (shards + 1 - len(far))
        found = set()
        for first, last in zip(near, far):
            k = max(0, bisect_right(self.edges, min(first + low, self.total)) - 1)
            while k < len(self.ends) and self.edges[k] <= last + high:
                if not self.ends[k][2]:
                    found.add(self.ends[k][1])
                k += 1
        return sorted(found)


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, offsets of the cuts) for ``groups`` (rank, before, bytes) in the order of rank.

    A capacity is feasible if filling shards greedily, group by group, needs at
    most ``shards``; the smallest is found by bisection, and the cuts are made within
    it. The driver holds the ends of
    stretches of groups only. Where a cut may fall inside a stretch, and the
    answer is still open, just those stretches are read at a finer grain, until
    the capacity is exact. What it holds is bounded by FIRST_STRETCHES and some
    hundred parts per shard and round, whatever the number of groups.
    """
    top = groups.agg(F.count("*").alias("n"), F.max("bytes").alias("largest"), F.sum("bytes").alias("total")).first()
    if not top["n"]:
        return 0, []
    grain = max(0, (top["n"] - 1).bit_length() - FIRST_STRETCHES.bit_length() + 1)
    low = max(top["largest"], -(-top["total"] // shards))

    def read(rows: DataFrame, grain: int) -> list[tuple[int, int, bool]]:
        ends = rows.groupBy(F.shiftright("rank", grain).alias("stretch")).agg(
            F.max(F.col("before") + F.col("bytes")).alias("end"), F.count("*").alias("n")
        )
        return [(row["end"], row["stretch"], row["n"] == 1) for row in ends.collect()]

    outline = Outline(read(groups, grain))
    while True:
        least = outline.smallest(low, shards, True)
        most = outline.smallest(least, shards, False)
        wanted = outline.open_stretches(least, most, shards) if least < most else []
        if not wanted or not grain:
            return most, outline.even_cuts(most, shards)
        # stretches at the current grain only; coarser ones that matter no more stay as they are
        finer = max(0, grain - FINER)
        inner = groups.where(F.shiftright("rank", grain).isin(wanted))
        kept = [(end, -1, True) for end, number, single in outline.ends if number not in set(wanted)]
        outline = Outline([*kept, *read(inner, finer)])
        low, grain = least, finer


def sharded(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs`` (doc_id, text).

    The law is ``bytes``: rows are grouped by equal texts, groups are ordered by
    their smallest doc_id and never parted, and the largest shard is as small as a
    contiguous partition allows. ``size`` is the UTF-8 bytes of the text and 8 more.
    ``slot`` numbers a shard's rows by doc_id without gaps. A null text is an empty
    one; null ids come first; rows that repeat each get a slot. A shard can stay
    empty when there are fewer groups than shards, or when one group is larger than the rest.
    """
    text = text_of()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("_id"),
        (utf8_bytes(text) + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("_hash"),
        F.lit(1).cast("long").alias("_one"),
    )
    rows = ranged(rows, ["_id"], 4096, "shard-rows")
    # texts that are not equal but share size and 96 bits of hashes are kept together, which parts no group
    same_text = ["_hash", "text_crc32", "size"]
    groups = rows.groupBy(*same_text).agg(
        F.min("_id").alias("first"), F.min("_part").alias("_part"), F.sum("size").alias("bytes"), F.lit(1).cast("long").alias("one")
    )
    groups = chunk_rank(groups, [], "_part", ["first", *same_text], {"rank": "one", "before": "bytes"})
    groups = stored(groups.select(*same_text, "rank", "before", "bytes"), "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    past = F.size(F.filter(F.array(*[F.lit(cut).cast("long") for cut in cuts] or [F.lit(1 << 62)]), lambda cut: cut <= F.col("before")))
    placed = rows.join(groups.select(*same_text, past.cast("int").alias("shard")), same_text)
    placed = chunk_rank(placed, ["shard"], "_part", ["_id", *same_text], {"slot": "_one"})
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
