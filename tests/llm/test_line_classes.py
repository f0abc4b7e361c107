"""Near lines with an edit distance that grows with the length."""

import random

from riskloom.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_links_of_all_lengths_equal_all_pairs(spark):
    r = random.Random(9)
    texts = set()
    for length in (5, 20, 38, 39, 40, 41, 60, 118, 119, 120, 122, 150):
        base = "".join(r.choice("abcdefé") for _ in range(length))
        texts.add(base)
        for edits in (1, 2, 3, 4, 5, 6):
            line = base
            for _ in range(edits):
                at = r.randrange(len(line))
                line = line[:at] + r.choice(["", "x", "yé"]) + line[at + r.randint(0, 1) :]
            texts.add(line)
    texts = sorted(texts)
    allowed = lambda n: 1 if n < 40 else 3 if n < 120 else 5
    expected = {}
    for k, a in enumerate(texts):
        for b in texts[k + 1 :]:
            if abs(len(a) - len(b)) <= 5 and (d := distance(a, b)) <= allowed(min(len(a), len(b))):
                expected[frozenset((a, b))] = d
    assert {2, 3, 4, 5} <= set(expected.values())
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    names = dict(lines.line_rows(frame).select(lines.line_id(), "line").distinct().collect())
    links = lines.line_links(frame, lines.distinct_lines(frame)).collect()
    assert {frozenset((names[x.a], names[x.b])): x.distance for x in links} == expected
