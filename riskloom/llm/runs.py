"""Periodic runs of words: block convolutions at dyadic scales propose periods, extensions decide."""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A prime with roots of unity of order 2^23, and its generator.
PRIME, GENERATOR = 998244353, 3
#: Moduli of the prefix hashes; what they say is compared word by word afterwards.
MODULI = ((2147483647, 1_000_003), (998244353, 911_382_323))
LEAST_LENGTH, LEAST_EXPONENT = 24, 3
FIRST_BLOCK = LEAST_LENGTH // LEAST_EXPONENT
#: Numbers transformed, and candidates extended, at a time.
SLAB = 1 << 18

Run = tuple[int, int, int]


@functools.lru_cache(maxsize=64)
def twiddles(size: int, inverse: bool) -> np.ndarray:
    """Powers 0 to size/2 of a root of unity of order ``size``."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    return powers(pow(root, PRIME - 2, PRIME) if inverse else root, max(1, size // 2), PRIME)[:, None]


def powers(base: int, count: int, modulus: int) -> np.ndarray:
    found = np.ones(count, np.int64)
    done = 1
    while done < count:
        more = min(done, count - done)
        found[done : done + more] = found[:more] * pow(base, done, modulus) % modulus
        done += more
    return found


def transformed(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row, in natural order; the inverse is not divided by the length."""
    count, size = rows.shape
    rows, width = rows.reshape(count, size, 1), size
    while width > 1:
        half = width // 2
        low, high = rows[:, :half], rows[:, half:]
        both = np.stack(((low + high) % PRIME, (low - high) * twiddles(width, inverse) % PRIME), axis=2)
        rows, width = both.reshape(count, half, -1), half
    return rows.reshape(count, size)


def matches(codes: np.ndarray, starts: np.ndarray, block: int, nearest: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the blocks that come again ``nearest`` to ``nearest + count - 1`` words later.

    A block x comes again in its window y at a lag when the sum of (x - y)^2 is
    zero: the squares are running sums, the products one cyclic correlation per
    block, all in whole numbers modulo PRIME. Equal words always give zero; a
    zero of other words is found out when the match is extended.
    """
    reach = block + count - 1
    size = 1 << (reach - 1).bit_length()
    padded = np.concatenate((codes, np.full(nearest + reach, codes.max(initial=0) + 1, np.int64)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    scale = 2 * pow(size, PRIME - 2, PRIME) % PRIME
    for at in range(0, len(starts), max(1, SLAB // size)):
        some = starts[at : at + max(1, SLAB // size), None]
        left = np.zeros((len(some), size), np.int64)
        right = np.zeros((len(some), size), np.int64)
        left[:, :block] = codes[some + np.arange(block)]
        right[:, :reach] = padded[some + nearest + np.arange(reach)]
        turned = np.roll(transformed(left)[:, ::-1], 1, axis=1)
        products = transformed(turned * transformed(right) % PRIME, inverse=True)[:, :count]
        squares = np.cumsum(right[:, :reach] ** 2 % PRIME, axis=1)
        squares = np.concatenate((np.zeros((len(some), 1), np.int64), squares), axis=1)
        sums = (left[:, :block] ** 2 % PRIME).sum(axis=1, keepdims=True) + squares[:, block:] - squares[:, :count]
        row, lag = np.nonzero((sums - products * scale) % PRIME == 0)
        found.append((some[row, 0], lag + nearest))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class Stretches:
    """Lengths of equal stretches from two places on, by bisection over prefix hashes."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.tables = []
        for modulus, base in MODULI:
            factors = powers(base, self.n + 1, modulus)
            sums = np.concatenate((np.zeros(1, np.int64), np.cumsum((codes + 1) % modulus * factors[: self.n] % modulus) % modulus))
            self.tables.append((modulus, factors, sums))

    def equal(self, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> np.ndarray:
        answer = np.ones(len(low), bool)
        for modulus, factors, sums in self.tables:
            left = (sums[low + length] - sums[low]) % modulus * factors[high - low] % modulus
            answer &= left == (sums[high + length] - sums[high]) % modulus
        return answer

    def longest(self, low: np.ndarray, high: np.ndarray, backward: bool) -> np.ndarray:
        """Equal words from ``low`` and ``high`` on, or before them."""
        least, most = np.zeros(len(low), np.int64), (low if backward else self.n - high).copy()
        while (least < most).any():
            middle = (least + most + 1) // 2
            back = middle if backward else 0
            fits = self.equal(low - back, high - back, middle)
            least, most = np.where(fits, middle, least), np.where(fits, most, middle - 1)
        return least


def stretched(codes: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """Ends of the stretch around ``start`` in which words ``period`` apart are identical, compared word by word."""
    differ = np.flatnonzero(codes[: len(codes) - period] != codes[period:])
    at = int(np.searchsorted(differ, start))
    low = int(differ[at - 1]) + 1 if at else 0
    high = int(differ[at]) if at < len(differ) else len(codes) - period
    return low, high + period


def is_run(codes: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether the words have the period and neither neighbour keeps it."""
    return (
        bool((codes[start : end - period] == codes[start + period : end]).all())
        and (start == 0 or codes[start - 1] != codes[start - 1 + period])
        and (end == len(codes) or codes[end] != codes[end - period])
    )


def word_codes(words: list[bytes]) -> np.ndarray:
    numbers = {word: k for k, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def unexplained(
    n: int, kept: dict[tuple[int, int], tuple[int, int]], low: np.ndarray, distance: np.ndarray, block: int
) -> tuple[np.ndarray, np.ndarray]:
    """The matches that do not lie, block and copy, in one run whose period divides their distance: that run is their stretch."""
    end, period = np.zeros(n, np.int64), np.ones(n, np.int64)
    for (s, e), (q, _) in sorted(kept.items(), key=lambda run: run[0][1]):
        end[s:e], period[s:e] = e, q
    new = (end[low] < low + distance + block) | (distance % period[low] != 0)
    return low[new], distance[new]


def found_runs(codes: np.ndarray) -> list[Run]:
    """(start, length, period) of all runs of ``codes``, by start, then period.

    A run of period q holds a block that starts at a multiple of its own length
    and comes again q words later: of 8 words for q below 16, and of the power of
    two below q for longer ones. Only blocks all of whose words come again at
    such distances are convolved. Each match is stretched both ways as long as
    words at its distance are identical. The stretch of a multiple of the
    smallest period is the same one, so the smallest distance of a stretch is kept.
    """
    n = len(codes)
    if n < LEAST_LENGTH:
        return []
    order = np.argsort(codes, kind="stable")
    again = np.flatnonzero(codes[order[1:]] == codes[order[:-1]])
    if not len(again):
        return []
    gap = np.full(n, n + 1, np.int64)
    gap[order[again]] = order[again + 1] - order[again]
    last = np.zeros(int(codes.max()) + 1, np.int64)
    last[codes] = np.arange(n)
    farthest = last[codes] - np.arange(n)
    stretches = None
    kept: dict[tuple[int, int], tuple[int, int]] = {}
    block, nearest, count = FIRST_BLOCK, 1, 2 * FIRST_BLOCK - 1
    while LEAST_EXPONENT * nearest <= n:
        blocks = n // block
        hopeful = (gap <= nearest + count - 1) & (farthest >= nearest)
        starts = np.flatnonzero(hopeful[: blocks * block].reshape(blocks, block).all(axis=1)) * block
        if len(starts):
            low, distance = matches(codes, starts, block, nearest, count)
            fits = low + distance + block <= n
            low, distance = low[fits], distance[fits]
            if kept:
                low, distance = unexplained(n, kept, low, distance, block)
            if len(low):
                stretches = stretches or Stretches(codes)
            for at in range(0, len(low), SLAB):
                a, d = low[at : at + SLAB], distance[at : at + SLAB]
                ahead = stretches.longest(a, a + d, False)
                behind = stretches.longest(a, a + d, True)
                start, end = a - behind, a + d + ahead
                long = (ahead >= block) & (end - start >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * d))
                for s, e, q, b in zip(start[long].tolist(), end[long].tolist(), d[long].tolist(), a[long].tolist()):
                    if (s, e) not in kept or q < kept[s, e][0]:
                        kept[s, e] = (q, b)
        block, nearest, count = 2 * block, 2 * block, 2 * block
    exact: dict[tuple[int, int], int] = {}
    for (start, end), (period, inside) in kept.items():
        if not is_run(codes, start, end, period):
            start, end = stretched(codes, inside, period)
        if end - start >= max(LEAST_LENGTH, LEAST_EXPONENT * period):
            exact[start, end] = min(period, exact.get((start, end), period))
    return sorted((start, end - start, period) for (start, end), period in exact.items())


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exponent; of equal ones the first, then the shortest period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    return [word for word, keep in zip(words, kept.tolist()) if keep]


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """About a tenth of the documents, by the checksum of their id, repeat a stretch of their words to the end."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


_RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, collapsed binary"
)
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def periodic_runs(
    docs: DataFrame,
    changed: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    collapse: bool = True,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its runs of repeated words, and its text without the repeats.

    Words end at ASCII white space. A run is a stretch with a smallest period of q
    words, at least 24 words and three periods long, that cannot be made longer.
    ``start``, ``length``, ``period`` and ``exponent_milli`` are of the run that is
    most often its own period, null where there is none; ``collapsed`` keeps the
    first period of every run, words joined by one space (null without
    ``collapse``; its digest is always there). ``changed`` may replace the words
    of a document first. A null or empty text has no words, a text below 24 words
    no runs. Rows do not meet: no shuffle, repeated rows get a row each, and
    memory is a small multiple of the longest text. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split() for field in _RESULT.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [measured(i, t) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                columns = [pa.array(values, _KINDS[kind]) for values, (_, kind) in zip(zip(*rows), names)]
                yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in names])

    def measured(doc_id: int | None, text: str | None) -> tuple:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if changed:
            words = changed(doc_id, words)
        runs = found_runs(word_codes(words)) if len(words) >= LEAST_LENGTH else []
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
        kept = b" ".join(without_repeats(words, runs))
        best = strongest(runs)
        numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digests = hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()
        return (doc_id, len(runs), *numbers, *digests, kept if collapse else None)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _RESULT)
