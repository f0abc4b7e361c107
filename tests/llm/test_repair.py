"""Conversation repair against a search over all edits, on plain Python rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.llm import repair
from riskloom.llm.queries import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, pos long, audit string, copies string"
LEGAL = re.compile(r"(s?(ua)+)?")
STEPS = {"": "su", "s": "u", "u": "a", "a": "u"}
COSTS = {"I": 3, "R": 3, "D": 4, "K": 0}


def plain_damage(rows):
    """conv_id -> rows (turn, role, text) after damage, in order."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = found[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for conv, kept in found.items()}


def plain_repair(rows):
    """Counts, cost, audit and repaired rows, by keeping every (last initial, seen s) with its best audit row by row."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    # best[last written initial] = (cost, audit, lines); the pattern allows a or nothing at the end
    best = {"": (0, "", [])}

    def better(into, key, value):
        if key not in into or value[:2] < into[key][:2]:
            into[key] = value

    def inserted(best):
        for _ in range(4):
            for last, (cost, audit, lines) in list(best.items()):
                after = "a" if last == "u" else "u"
                line = "user:" if after == "u" else "assistant:"
                better(best, after, (cost + 3, audit + "I", [*lines, line]))
        return best

    for (_, role, text), fault in zip(rows, faults):
        following = {}
        for last, (cost, audit, lines) in inserted(best).items():
            better(following, last, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 if fault else 0
            after = "a" if last == "u" else "u"
            better(following, after, (cost + 3, audit + "R", [*lines, ("user:" if after == "u" else "assistant:") + text]))
            if role[:1] and role[0] in STEPS[last]:
                better(following, role[0], (cost, audit + "K", [*lines, role + ":" + text]))
        best = following
    cost, audit, lines = min((v for last, v in inserted(best).items() if last in ("", "a")), key=lambda v: v[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    assert LEGAL.fullmatch("".join(line[0] for line in lines))
    counts = [faults.count(kind) for kind in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def every_audit(tokens, most):
    """Least (cost, audit) of all edit strings with at most ``most`` insertions, by trying all."""
    found = []

    def walk(at, state, cost, audit, inserts):
        if at == len(tokens) and state in repair.GOALS:
            found.append((cost, audit))
        initial = repair.written(state)
        if inserts < most:
            walk(at, repair.LEGAL[state][initial], cost + 3, audit + "I", inserts + 1)
        if at == len(tokens):
            return
        own, cut = tokens[at]
        walk(at + 1, state, cost + 4, audit + "D", inserts)
        walk(at + 1, repair.LEGAL[state][initial], cost + 3 + 3 * cut, audit + "R", inserts)
        if own in repair.LEGAL[state]:
            walk(at + 1, repair.LEGAL[state][own], cost + 3 * cut, audit + "K", inserts)

    walk(0, 0, 0, "", 0)
    return min(found)


def test_agenda_equals_all_edits():
    r = random.Random(2)
    for _ in range(150):
        tokens = [(r.choice("suax"), r.random() < 0.3) for _ in range(r.randrange(6))]
        cost, pieces = repair.joined_spans([repair.span_items(tokens, (0,))])
        assert (cost, "".join(p for _, p in pieces)) == every_audit(tokens, 3)


def test_spans_may_be_cut_anywhere():
    r = random.Random(4)
    for _ in range(100):
        tokens = [r.choice([1, 3, (r.choice("suax"), r.random() < 0.3)]) for _ in range(r.randrange(1, 40))]
        whole = repair.joined_spans([repair.span_items(tokens, (0,))])
        cuts = sorted({0, len(tokens), *(r.randrange(len(tokens)) for _ in range(3))})
        parts = [repair.span_items(tokens[a:b], repair.LEGAL) for a, b in zip(cuts, cuts[1:])]
        cost, pieces = repair.joined_spans(parts)
        assert (cost, "".join(p for _, p in pieces)) == (whole[0], "".join(p for _, p in whole[1]))


def made_rows():
    r = random.Random(9)
    rows = []
    for conv in range(150):
        said = ["Yes.", "No", "Why?", " \n", "", "Good! ", "a" * r.randrange(5), None]
        for turn in range(r.randrange(1, 30)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            rows.append((conv, None if r.random() < 0.05 else turn + 3 * (r.random() < 0.1), role, r.choice(said)))
    rows += [(900, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(5000)]
    rows += [(901, 7, "user", "same.")] * 3000 + [(None, t, "user", "null id.") for t in range(4)]
    rows += [(902, None, "user", "long " * 50_000 + "."), (903, 5, "assistant", "x" * 100_000)]
    dropped = next(t for t in range(100) if zlib.crc32(f"904:{t}".encode()) % 20 == 0)
    return [*rows, rows[0], rows[5], (904, dropped, "user", "gone.")]


def test_query_equals_plain_repair(spark, folder, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 64)
    rows = made_rows()
    frame = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], SCHEMA).repartition(5)
    frame.write.parquet(f"{folder}/conversations.parquet")
    found = {row[0]: tuple(row)[1:] for row in op11_conversation_repair(spark, folder).collect()}
    expected = {conv: plain_repair(kept) for conv, kept in plain_damage(rows).items()}
    assert found.keys() == expected.keys()
    for conv in expected:
        assert found[conv] == expected[conv], conv
    assert found[904] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(repair.damaged(empty), empty).count() == 0


@pytest.mark.parametrize("text", ["", " ", "\t\n"])
def test_only_blank_rows(spark, text):
    rows = spark.createDataFrame([(1, 0, "user", text, 0, "", "")], SCHEMA).withColumn("copies", F.lit(3).cast("long"))
    row = repair.repaired(rows, rows).first()
    assert (row.blank, row.illegal, row.cost, row.audit) == (3, 2, 12, "DDD")
