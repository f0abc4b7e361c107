"""Near-duplicate lines: an edit-distance join over segments of lines, in DataFrame operations only."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import components, stored, text_of

BLANKS = " \t\n\x0b\x0c\r"
#: (characters, edits): lines of so many characters and more may differ in so many edits; of two lines the shorter one decides.
THRESHOLD = ((0, 1), (40, 3), (120, 5))
Threshold = int | tuple[tuple[int, int], ...]
#: Rows of the table that tells which lines may be among some ids, 64 places each; it goes to every task.
SIEVE = 1 << 19
#: Letters whose numbers in a line are compared before the line itself; each in 4 bits, modulo 16.
LETTERS = "eantorislducmpgh"


def classes_of(threshold: Threshold) -> list[tuple[int, int | None, int]]:
    """(first length, length beyond the last, edits) of every class; one number holds for all lengths."""
    steps = ((0, threshold),) if isinstance(threshold, int) else threshold
    ends = [*(first for first, _ in steps[1:]), None]
    return [(first, end, edits) for (first, edits), end in zip(steps, ends)]


def most_edits(threshold: Threshold) -> int:
    return max(edits for _, _, edits in classes_of(threshold))


def by_class(length: Column, threshold: Threshold, value: Callable[[int], Column | None]) -> Column:
    """``value`` of the edits that lines of this length allow; null where it gives none."""
    chosen = F.lit(None).cast("long")
    for first, end, edits in classes_of(threshold):
        inside = length >= first if end is None else (length >= first) & (length < end)
        if (result := value(edits)) is not None:
            chosen = F.when(inside, result).otherwise(chosen)
    return chosen


def banded_distance(left: Column, right: Column, threshold: int) -> Column:
    """Edit distance of two texts in characters; exact up to ``threshold``, null beyond it.

    The built-in looks at the diagonals within ``threshold`` of the main one only,
    in generated code.
    """
    return F.nullif(F.levenshtein(left, right, threshold).cast("long"), F.lit(-1).cast("long"))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): every line with a word of every document, without the white space around it."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text_of(), "\n")).alias("line_no", "line"))
    line = F.col("line")
    blank = functools.reduce(operator.or_, [side(F.lit(c)) for c in BLANKS for side in (line.startswith, line.endswith)])
    trimmed = F.when(blank, F.btrim(line, F.lit(BLANKS))).otherwise(line)  # trimming by a set copies the line's places
    return lines.select("doc_id", "line_no", trimmed.alias("line")).where("line <> ''")


def line_id() -> Column:
    return F.xxhash64("line")


def letter_counts(line: Column) -> Column:
    """How often each of LETTERS is in the line, modulo 16, four bits each."""
    counts = [
        F.shiftleft((F.length(line) - F.length(F.replace(line, F.lit(c)))).cast("long").bitwiseAND(F.lit(15)), 4 * k)
        for k, c in enumerate(LETTERS)
    ]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), counts)


def counts_apart(left: Column, right: Column) -> Column:
    """Lower bound of the edit distance from two :func:`letter_counts`: half of all differences, rounded up."""
    differences = []
    for k in range(len(LETTERS)):
        d = F.abs(F.shiftrightunsigned(left, 4 * k).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(right, 4 * k).bitwiseAND(F.lit(15)))
        differences.append(F.least(d, F.lit(16) - d))
    return F.shiftright(functools.reduce(operator.add, differences) + 1, 1)


def base_of(length: Column) -> Column:
    """``length`` with all but its three leading binary digits cleared: lines of one base are cut alike, four bases an octave."""
    unit = F.call_function("shiftleft", F.lit(1), F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)))).cast("int") - 2, F.lit(0)))
    return length - length % unit


def probes(edits: int) -> list[int]:
    """The places where a line is asked for each of its ``edits`` + 1 segments, as 256 * part + 128 + shift.

    Of two lines within ``edits`` edits one segment of the shorter line comes again
    in the longer one with exactly as many edits before it as there are segments
    before it, so at most the rest of them behind it. Segments of the first half are
    placed from the start of a line, the others from its end: a place is then off by
    no more than the edits on that side, whatever the two lengths are.
    """
    near = [min(part, edits - part) for part in range(edits + 1)]
    return [256 * part + 128 + shift for part, most in enumerate(near) for shift in range(-most, most + 1)]


def key_rows(texts: DataFrame, threshold: Threshold = THRESHOLD) -> DataFrame:
    """(key, own, line_id): the keys under which distinct lines (line_id, line) meet; ``own`` are those of a line's own segments.

    Lines that allow the same edits and have the same base have segments of the
    same size, whole ones that need not reach the middle of the line. A line is
    asked for the segments of its own base and of every other one that lines
    shorter by the allowed edits have. Keys keep 40 bits; lines that meet by chance are measured like any other.
    """
    most = most_edits(threshold)

    def edits_of(length: Column) -> Column:
        return by_class(length, threshold, F.lit).cast("int")

    target = F.col("length") - F.col("shorter")
    rows = texts.select("line_id", "line", F.length("line").alias("length"), F.explode(F.sequence(F.lit(0), F.lit(most))).alias("shorter"))
    rows = rows.where(target >= 0).select("*", edits_of(target).alias("edits"), base_of(target).alias("base"))
    other = (edits_of(target + 1) != F.col("edits")) | (base_of(target + 1) != F.col("base"))
    rows = rows.where((F.col("shorter") <= F.col("edits")) & ((F.col("shorter") == 0) | other))  # once a kind of segments
    places = F.coalesce(*[F.when(F.col("edits") == k, F.lit(probes(k))) for k in sorted({k for _, _, k in classes_of(threshold)})])
    size = F.expr("cast(base div (edits + 1) as int)")
    rows = rows.select("*", size.alias("size"), F.explode(places).alias("place"))
    rows = rows.select("*", F.shiftright("place", 8).alias("part"), (F.col("place").bitwiseAND(F.lit(255)) - 128).alias("shift"))
    part, left = F.col("part"), 2 * F.col("part") <= F.col("edits")
    start = F.when(left, part * F.col("size")).otherwise(F.col("length") - (F.col("edits") + 1 - part) * F.col("size"))
    rows = rows.select("*", (start + F.col("shift")).alias("start"))
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("length"))
    # a line shorter by so many characters leaves that many fewer edits for the other side of the segment
    spare = F.when(left, F.col("shift") - F.col("shorter") + F.col("edits") - part).otherwise(part - F.col("shorter") - F.col("shift"))
    rows = rows.where(fits & (spare >= 0) & ((F.col("size") > 0) | (F.col("part") == 0)))  # one empty segment is as good as many
    key = F.xxhash64("base", "edits", "part", F.substring("line", F.col("start") + 1, F.col("size")))
    own = (F.col("shorter") == 0) & (F.col("shift") == 0)
    return rows.select(F.shiftrightunsigned(key, 24).alias("key"), own.alias("own"), "line_id")


def distinct_lines(docs: DataFrame, threshold: Threshold = THRESHOLD) -> DataFrame:
    """(line_id, first_doc_id, copies) of every distinct line, stored; they are the same for every ``threshold``.

    Only these longs are shuffled, and copies of a line combine in the task that
    reads them. Lines are known by a 64-bit hash.
    """
    lines = line_rows(docs).select("doc_id", line_id().alias("line_id"))
    return stored(lines.groupBy("line_id").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("copies")), "lines")


def sieved(docs: DataFrame, ids: DataFrame, among: bool) -> DataFrame:
    """(line_id, line) of the lines of ``docs`` that may be ``among`` ``ids`` (line_id), or of those that cannot be; copies included.

    The table of at most SIEVE rows is small enough to send to every task; of 30
    million ids in it about six in ten other lines pass as well, of three million about one in ten.
    """
    place = F.pmod("line_id", F.lit(64 * SIEVE))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    marks = ids.select(word.alias("word"), mark.alias("mark")).groupBy("word").agg(F.bit_or("mark").alias("marks"))
    lines = line_rows(docs).select(line_id().alias("line_id"), "line").withColumn("word", word)
    held = F.coalesce(F.call_function("shiftrightunsigned", F.col("marks"), bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return lines.join(F.broadcast(marks), "word", "left").where(held if among else ~held).select("line_id", "line")


def distinct_texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(line_id, line) of every one of ``lines`` of ``docs``, once each.

    What is certain to be there once stays in the task that reads it; only the texts
    of repeated lines, and of those in the same place of the sieve, are shuffled.
    """
    repeated = lines.where("copies > 1").select("line_id")
    return sieved(docs, repeated, among=False).union(sieved(docs, repeated, among=True).distinct())


def shared_keys(docs: DataFrame, lines: DataFrame, threshold: Threshold = THRESHOLD) -> DataFrame:
    """The rows of :func:`key_rows` whose key another line has too and at least one line as its own, stored.

    Nearly all keys belong to one line. They are sorted out where the rows of a key
    first come together, in one pass over a key however many lines hold it.
    """
    held = Window.partitionBy("key")
    rows = key_rows(distinct_texts(docs, lines), threshold).select(
        "key", "own", "line_id",
        F.min("line_id").over(held).alias("first"), F.max("line_id").over(held).alias("last"), F.max("own").over(held).alias("asked"),
    )
    return stored(rows.where("first < last and asked").select("key", "own", "line_id"), "line-keys")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line_id, line) of the ``wanted`` (line_id), once each.

    Most lines are not wanted; the sieve drops nearly all of them where they are read.
    """
    return sieved(docs, wanted, among=True).distinct().join(wanted, "line_id", "left_semi")


def candidates(keys: DataFrame, texts: DataFrame, threshold: Threshold = THRESHOLD) -> DataFrame:
    """(a, b): pairs of lines, a < b, that share one of the ``keys`` (key, own, line_id) and whose lengths and letters are not too far apart.

    ``texts`` (line_id, line) has their texts. Lines that share a key meet by the length of the shorter one, so that a
    passage which very many lines have in common does not bring all of them together.
    """
    traits = texts.select("line_id", F.length("line").alias("length"), letter_counts(F.col("line")).alias("letters"))
    rows = keys.join(stored(traits, "line-traits"), "line_id")
    index = rows.where("own").select("key", "length", F.col("line_id").alias("x"), F.col("letters").alias("lx"))
    shorter = F.explode(F.sequence(F.lit(0), F.lit(most_edits(threshold)))).alias("shorter")
    probe = rows.select("key", "length", F.col("line_id").alias("y"), F.col("letters").alias("ly"), shorter)
    probe = probe.withColumn("length", F.col("length") - F.col("shorter"))
    allowed = by_class(F.col("length"), threshold, F.lit)
    met = probe.where(F.col("shorter") <= allowed).drop("shorter").join(index, ["key", "length"])
    pairs = met.where((F.col("x") != F.col("y")) & (counts_apart(F.col("lx"), F.col("ly")) <= allowed))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def line_links(docs: DataFrame, lines: DataFrame, threshold: Threshold = THRESHOLD) -> DataFrame:
    """(a, b, distance) of all pairs of distinct ``lines`` of ``docs`` within the edits of the shorter one, stored."""
    keys = shared_keys(docs, lines, threshold)
    texts = stored(texts_of(docs, keys.select("line_id").distinct()), "line-texts")
    pairs = stored(candidates(keys, texts, threshold), "line-candidates")
    left = texts.select(F.col("line_id").alias("a"), F.col("line").alias("left"))
    right = texts.select(F.col("line_id").alias("b"), F.col("line").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    allowed = by_class(F.least(F.length("left"), F.length("right")), threshold, F.lit)
    distance = banded_distance(F.col("left"), F.col("right"), most_edits(threshold))
    measured = both.select("a", "b", allowed.alias("allowed"), distance.alias("distance"))
    return stored(measured.where("distance <= allowed").drop("allowed"), "line-links")


def near_duplicate_lines(docs: DataFrame, threshold: Threshold = THRESHOLD) -> DataFrame:
    """(line_id, first_doc_id, copies, n_links, class_id, class_doc_id, class_copies) of every distinct line of ``docs`` (doc_id, text).

    Lines are what stands between line feeds, without the white space around it;
    lines without a word are left out. Two lines are linked when at most
    as many insertions, deletions or replacements of characters turn one into the
    other as ``threshold`` allows, for all lines or by the length of the shorter one.
    Each line is cut into one segment more than that; of two such lines
    one has a segment of the other unchanged, near its place, so every linked
    pair meets under a segment's key, and each pair that meets is measured.
    ``copies`` counts occurrences, ``n_links`` other distinct lines; ``class_id`` is the
    smallest line_id that can be reached by links, ``class_doc_id`` and
    ``class_copies`` the smallest doc_id and all occurrences there. Null and empty
    texts have no lines; a null doc_id names no line unless it is the only one.
    """
    lines = distinct_lines(docs, threshold)
    links = line_links(docs, lines, threshold)
    ends = links.select(F.explode(F.array("a", "b")).alias("line_id")).groupBy("line_id").agg(F.count("*").alias("n_links"))
    classes = components(links.select("a", "b")).select(F.col("node").alias("line_id"), F.col("component").alias("class_id"))
    rows = lines.select("line_id", "first_doc_id", "copies").join(classes.join(ends, "line_id"), "line_id", "left")
    rows = rows.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    rows = rows.withColumn("class_id", F.coalesce("class_id", "line_id"))
    # lines without a link are their own class and need no grouping
    linked = rows.where("n_links > 0").groupBy("class_id").agg(
        F.min("first_doc_id").alias("class_doc_id"), F.sum("copies").alias("class_copies")
    )
    rows = rows.join(linked, "class_id", "left")
    return rows.select(
        "line_id", "first_doc_id", "copies", "n_links", "class_id",
        F.when(F.col("n_links") > 0, F.col("class_doc_id")).otherwise(F.col("first_doc_id")).alias("class_doc_id"),
        F.coalesce("class_copies", "copies").alias("class_copies"),
    )
