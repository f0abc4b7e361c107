"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from riskloom.llm import runs
from riskloom.llm.queries import op13_periodic_runs


def all_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(24, 3 * q):
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def fibonacci(order):
    a, b = [0], [1]
    for _ in range(order):
        a, b = b, a + b
    return b


def texts_of_numbers():
    r = random.Random(3)
    yield from ([], [1] * 23, [1] * 24, [1, 2] * 500, ([0] * 37 + [1]) * 9, fibonacci(12) * 3)
    for _ in range(400):
        n = r.randrange(300)
        yield [r.randrange(r.choice([1, 2, 3])) for _ in range(n)]
        tail = [r.randrange(90) for _ in range(n)]
        at = r.randrange(n + 1)
        period = 1 + (n - at) // (3 + r.randrange(8))
        yield [tail[i] if i < at else tail[at + (i - at) % period] for i in range(n)]
        parts = [[r.randrange(3) for _ in range(r.randrange(1, 40))] * r.randrange(1, 6) for _ in range(5)]
        yield [word for part in parts for word in part]


def test_runs_equal_all_periods():
    for words in texts_of_numbers():
        assert runs.found_runs(np.array(words, dtype=np.int64)) == all_runs(words), words


def test_transform_is_a_cyclic_correlation():
    r = np.random.default_rng(5)
    left, right = r.integers(0, 1000, (2, 16)), r.integers(0, 1000, (2, 16))
    turned = np.roll(runs.transformed(left)[:, ::-1], 1, axis=1)
    found = runs.transformed(turned * runs.transformed(right) % runs.PRIME, inverse=True) * pow(16, -1, runs.PRIME) % runs.PRIME
    expected = [[int((left[m] * np.roll(right[m], -lag)).sum()) for lag in range(16)] for m in range(2)]
    assert found.tolist() == expected


def test_false_hashes_are_found_out(monkeypatch):
    """Prefix hashes that take everything for equal change nothing."""
    words = np.array([5, 6, 7] * 12 + list(range(40)), dtype=np.int64)
    monkeypatch.setattr(runs.Stretches, "equal", lambda self, low, high, length: np.ones(len(low), bool))
    assert runs.found_runs(words) == [(0, 36, 3)]


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = sorted(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))[:1]
    numbers = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


SCHEMA = "doc_id long, text string, start string, collapsed string"


def test_query_equals_brute_force(spark, folder):
    r = random.Random(11)
    texts = [" ".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(1, 160))) for _ in range(300)]
    texts += [None, "", " \n\t", "x " * 5000, "é 漢\x0b😀\r" * 30, "one \x1c two\x1c\n" * 12, "a" * 300_000]
    rows = [(i, t, "other", "column") for i, t in enumerate(texts)] + [(3, texts[3], None, None)] * 2
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    found = op13_periodic_runs(spark, folder)
    assert Counter(tuple(row) for row in found.collect()) == Counter(expected_row(i, t) for i, t, *_ in rows)
    assert any(row[1] for row in found.collect())


def test_empty_table_and_null_ids(spark):
    assert runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = spark.createDataFrame([(None, "w " * 30, "", "")], SCHEMA)
    row = runs.periodic_runs(rows, runs.with_planted_period).first()
    assert (row.doc_id, row.n_runs, row.start, row.length, row.period, bytes(row.collapsed)) == (None, 1, 0, 30, 1, b"w")


@pytest.mark.parametrize("doc_id", [0, 7, 123456])
def test_planted_period_keeps_the_length(doc_id):
    words = [b"%d" % k for k in range(100)]
    assert len(runs.with_planted_period(doc_id, words)) == 100
