"""Keys of near lines: few enough to plan and shuffle, and no pair within the edits is without a common one."""

import random

from riskloom.llm import lines


def test_plans_of_line_links_stay_small(spark, monkeypatch):
    sizes, write = {}, lines.stored

    def measured(frame, name, **options):
        sizes[name] = len(frame._jdf.queryExecution().optimizedPlan().toString())
        return write(frame, name, **options)

    monkeypatch.setattr(lines, "stored", measured)
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        base = "".join(random.Random(1).choice("abcdef ") for _ in range(130)) + "."
        docs = spark.createDataFrame([(1, base), (2, base[:60] + "xyz" + base[60:]), (3, "other")], "doc_id long, text string")
        links = lines.line_links(docs, lines.distinct_lines(docs))
        assert [row.distance for row in links.collect()] == [3]
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert max(sizes.values()) < 50_000, sizes


def test_lines_within_the_edits_share_a_key(spark):
    r = random.Random(4)
    texts, pairs = {}, []

    def add(line):
        return texts.setdefault(line, len(texts))

    for length in (1, 2, 3, 7, 8, 9, 31, 38, 39, 40, 42, 47, 48, 63, 64, 118, 119, 120, 124, 127, 128, 131, 160, 193, 256, 300):
        edits = 1 if length < 40 else 3 if length < 120 else 5
        for _ in range(12):
            line = "".join(r.choice("ab é") for _ in range(length)).strip(" ") or "a"
            edits_here, other = (1 if len(line) < 40 else 3 if len(line) < 120 else 5), line
            kind, middle = r.choice(["front", "end", "anywhere"]), r.randrange(len(line))
            for _ in range(min(edits, edits_here)):  # insertions and replacements only: this line stays the shorter one
                at = {"front": r.randint(0, min(3, len(other))), "end": len(other) - r.randint(0, min(3, len(other)))}.get(kind)
                at = r.choice([middle, r.randint(0, len(other))]) if at is None else at
                other = other[:at] + r.choice("xyé") + other[at + r.randint(0, 1) :]
            if other != line:
                pairs.append((add(line), add(other)))
    frame = spark.createDataFrame([(k, t) for t, k in texts.items()], "line_id long, line string")
    own, held, rows = {}, {}, {}
    for row in lines.key_rows(frame).collect():
        held.setdefault(row.line_id, set()).add(row.key)
        rows[row.line_id] = rows.get(row.line_id, 0) + 1
        if row.own:
            own.setdefault(row.line_id, set()).add(row.key)
    assert all(own[a] & held[b] for a, b in pairs)
    assert max(map(len, own.values())) == 6 and max(rows.values()) <= 3 * 18
