"""Language by Bayesian fusion of the text with declared language, address suffix and host."""

from __future__ import annotations

import functools
import html
import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import free_name, join_null_safe, stored

#: The text model is fitted on at most this many labelled texts of each language.
SAMPLE_PER_LANGUAGE = 500
BUCKETS = 1 << 14
#: Class of texts that no language of the model explains better than chance.
UNKNOWN = "und"
UNKNOWN_PRIOR = 0.01
#: Log likelihood, against zero for any language, of a text without a letter being in none.
NO_TEXT = 60.0
#: Every character is in three trigrams, which are no independent evidence.
TEMPER = 1 / 3
#: Text with this many letters or more is noise if they come nearly evenly: two letters of it are alike
#: less than EVEN times as often as of evenly drawn ones. Prose in any alphabet has 1.5 times and more.
LETTERS_TO_JUDGE = 30
EVEN = 1.3
#: Beyond this lead of a language over chance no other evidence makes a text unknown.
CLEAR = 60.0
SITE_WEIGHT, HOST_WEIGHT, TABLE_WEIGHT = 10.0, 5.0, 20.0
#: Bytes of a text that are looked up at once.
STRIDE = 1 << 16

HIDDEN = re.compile(r"<(script|style)\b|<!--", re.I)
HIDDEN_ENDS = {
    "script": re.compile(r"</script\s*>", re.I),
    "style": re.compile(r"</style\s*>", re.I),
    None: re.compile("-->"),
}
TAGS = re.compile(r"<[^<>]*>")
NAME = r"^([A-Za-z]+)"
DECLARED = r"(?is)<html\b[^<>]*?\s(?:xml:)?lang\s*=\s*[\"']?([A-Za-z]+)"


def language_name(column: str) -> Column:
    """The language of a label or declaration without its region or script, in lower case; null where there is none."""
    name = F.lower(F.regexp_extract(F.coalesce(F.col(column), F.lit("")), NAME, 1))
    return F.when(name != "", name)


def without_hidden(markup: str) -> str:
    """The markup with scripts, styles and comments as spaces; one that nothing closes is left, and found out only once.

    The time is linear in the length: after the last end of a kind none is looked for.
    """
    kept, at, place, open_ended = [], 0, 0, set()
    while found := HIDDEN.search(markup, place):
        kind = found[1] and found[1].lower()
        end = None if kind in open_ended else HIDDEN_ENDS[kind].search(markup, found.end())
        if end:
            kept.append(markup[at : found.start()])
            at = place = end.end()
        else:
            open_ended.add(kind)
            place = found.end()
    return " ".join([*kept, markup[at:]])


def visible_text(markup: str | None) -> str:
    """The text of a page; time is linear in its length, whatever is left unclosed in it."""
    return html.unescape(TAGS.sub(" ", without_hidden(markup or "")))


#: Bytes that letters are made of, and the space between words.
LETTER_BYTES = np.array([b >= 128 or chr(b).isalpha() or b == 32 for b in range(256)])


def trigram_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams of letters and spaces in the lower-cased text, STRIDE bytes at a time.

    Numbers, symbols and punctuation are written alike in all languages and are no evidence.
    """
    raw = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-8", "replace"), np.uint8)
    for start in range(0, max(len(raw) - 2, 0), STRIDE):
        part = raw[start : start + STRIDE + 2]
        letters, part = LETTER_BYTES[part], part.astype(np.uint32)
        mixed = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA77)) ^ (part[2:] * np.uint32(0xC2B2AE3D))
        buckets = (mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)
        yield buckets[letters[:-2] & letters[1:-1] & letters[2:]]


def is_noise(text: str, letters: frozenset[str]) -> bool:
    """Whether a text that no language of the model explains has no letters, or letters drawn evenly.

    Few letters, or mostly others than the model has seen, are no ground to call a text noise.
    """
    counts = {c: n for c, n in Counter(text.lower()).items() if c.isalpha()}
    n = sum(counts.values())
    if not n:
        return True
    if n < LETTERS_TO_JUDGE or 2 * sum(k for c, k in counts.items() if c in letters) < n:
        return False
    alphabet = len(counts) if n >= 10 * len(counts) else max(len(counts), 26)
    return alphabet * sum(k * (k - 1) for k in counts.values()) < EVEN * n * (n - 1)


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of trigram buckets, a column per language; an unknown text draws them evenly.

    ``letters`` are those of the texts it was fitted on.
    """

    languages: tuple[str, ...]
    table: np.ndarray
    letters: frozenset[str] = frozenset()

    @property
    def classes(self) -> tuple[str, ...]:
        return (*self.languages, UNKNOWN)

    def log_likelihoods(self, text: str) -> np.ndarray:
        total, seen = np.zeros(len(self.languages) + 1), 0
        for buckets in trigram_buckets(text):
            if len(buckets) > BUCKETS // 8:
                total[:-1] += np.bincount(buckets, minlength=BUCKETS) @ self.table
            else:
                total[:-1] += self.table[buckets].sum(axis=0)
            seen += len(buckets)
        # letters without a trigram of them, such as a lone initial, speak for no class
        total[-1] = -seen * math.log(BUCKETS) if seen else 0.0 if any(map(str.isalpha, text)) else NO_TEXT
        return total * TEMPER


def fit_text_model(labelled: DataFrame) -> TextModel:
    """Fit on a bounded sample of ``labelled`` (doc_id, text, lang): the rows with the smallest hashes of their id.

    Every labelled language is a class, whatever their number; regions and scripts
    of a label do not count. Counts of trigrams are grouped sums; what comes to the
    driver is at most BUCKETS numbers for each language, and the letters seen.
    """
    known = labelled.withColumn("lang", language_name("lang")).where(F.col("lang") != UNKNOWN)
    sizes = known.groupBy("lang").count().collect()
    languages = tuple(sorted(row["lang"] for row in sizes))
    if not languages:
        return TextModel((), np.zeros((BUCKETS, 0)))
    numbers = {lang: k for k, lang in enumerate(languages)}
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)  # evenly spread from 0 to 2 ** 63
    # rows that can be among the smallest: twice as many as are taken, whatever the size of the table
    reach = [(row["lang"], min((1 << 63) - 1, 2 * SAMPLE_PER_LANGUAGE * (1 << 63) // row["count"])) for row in sizes]
    reach = F.broadcast(labelled.sparkSession.createDataFrame(reach, "lang string, reach long"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    rows = known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").withColumn("place", place)
    rows = rows.join(reach, "lang").where("place <= reach").withColumn("nth", F.row_number().over(order))
    chosen = rows.where(F.col("nth") <= SAMPLE_PER_LANGUAGE).select("doc_id", "lang")
    # at most SAMPLE_PER_LANGUAGE short rows a language
    texts = known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    texts = join_null_safe(texts, F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        letters: set[str] = set()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for buckets in trigram_buckets(text or ""):
                    sums[numbers[lang]] += np.bincount(buckets, minlength=BUCKETS)
                letters.update((text or "").lower())
        lang, bucket = np.nonzero(sums)
        points = [ord(c) for c in letters if c.isalpha()]  # as language -1
        columns = [np.r_[lang, np.full(len(points), -1)], np.r_[bucket, points], np.r_[sums[lang, bucket], np.ones(len(points))]]
        columns = [pa.array(column.astype(np.int64)) for column in columns]
        yield pa.RecordBatch.from_arrays(columns, names=["language", "bucket", "n"])

    counted = texts.select("lang", "text").mapInArrow(count, "language long, bucket long, n long")
    sums = np.full((BUCKETS, len(languages)), 0.1)
    totals = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = (totals.column(k).to_numpy() for k in range(3))
    of_texts = lang >= 0
    sums[bucket[of_texts], lang[of_texts]] += n[of_texts]
    return TextModel(languages, np.log(sums / sums.sum(axis=0)), frozenset(map(chr, bucket[~of_texts].tolist())))


def page_fields(pages: DataFrame) -> DataFrame:
    """(_id, _key, markup, host, site, suffix, declared) of web pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), DECLARED, 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("_id"),
        F.xxhash64("url", "html").alias("_key"),
        F.coalesce("html", F.lit("")).alias("body"),
        F.when(host != "", host).alias("host"),
        F.when(declared != "", declared).alias("declared"),
    )
    return rows.withColumn("site", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))


def document_key() -> Column:
    return F.xxhash64("text", "lang", "source")


def document_fields(docs: DataFrame) -> DataFrame:
    """The same of documents (doc_id, text, lang, source): the source is the host and ``lang`` what is declared."""
    return docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        document_key().alias("_key"),
        F.coalesce("text", F.lit("")).alias("body"),
        F.col("source").cast("string").alias("host"),
        language_name("lang").alias("declared"),
        F.lit(None).cast("string").alias("site"),
        F.lit(None).cast("string").alias("suffix"),
    )


def text_evidence(fields: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    """The fields without the body, and for each class the log likelihood ``l_k`` and the posterior ``p_k`` of the text alone.

    ``noise`` tells of texts that may be unknown whether they look like noise.
    """
    n = len(model.classes)
    prior = np.log(np.array([*[(1 - UNKNOWN_PRIOR) / max(n - 1, 1)] * (n - 1), UNKNOWN_PRIOR]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(t) if markup else t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            likely = np.array([model.log_likelihoods(t) for t in texts]).reshape(-1, n)
            noise = [bool(l[-1] >= l.max() - CLEAR) and is_noise(t, model.letters) for t, l in zip(texts, likely)]
            posterior = softmax(likely + prior)
            columns = [*(batch.column(k) for k in range(batch.num_columns - 1)), pa.array(noise, pa.bool_())]
            columns += [pa.array(np.ascontiguousarray(column)) for table in (likely, posterior) for column in table.T]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "noise", *[f"{x}_{k}" for x in "lp" for k in range(n)]])

    kept = ["_id", "_key", "host", "site", "suffix", "declared"]
    schema = "_id long, _key long, host string, site string, suffix string, declared string, noise boolean, "
    schema += ", ".join(f"{x}_{k} double" for x in "lp" for k in range(n))
    return fields.select(*kept, "body").mapInArrow(score, schema)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def fused(evidence: DataFrame, model: TextModel) -> DataFrame:
    """(_id, _key, host, declared, noise, text_language, language, confidence): the posterior over all evidence.

    Host priors are smoothed towards those of the site, the last two labels of
    the host, and these towards all pages: every level is a grouped sum of the
    text posteriors, from which a page's own is taken out again. How often a
    language is declared, or has a suffix, is counted the same way, so a site
    template that declares one language everywhere carries little weight.
    Missing evidence counts for nothing.
    """
    n, classes = len(model.classes), model.classes
    sums = [F.sum(f"p_{k}") for k in range(n)]
    overall = evidence.agg(*[F.coalesce(s, F.lit(0.0)).alias(f"g_{k}") for k, s in enumerate(sums)]).first()
    mass = sum(overall) or 1.0
    everywhere = [(overall[k] + 1 / n) / (mass + 1) for k in range(n)]

    def total(prefix: str) -> Column:
        return functools.reduce(operator.add, [F.col(f"{prefix}_{k}") for k in range(n)]).alias(f"{prefix}_all")

    # totals are columns of their own, so that no expression grows with the square of the number of classes
    hosts = evidence.groupBy("host", "site").agg(*[s.alias(f"h_{k}") for k, s in enumerate(sums)])
    sites = hosts.groupBy("site").agg(*[F.sum(f"h_{k}").alias(f"s_{k}") for k in range(n)])
    hosts = join_null_safe(hosts.select("*", total("h")), sites.select("*", total("s")), ["site"])
    rows = join_null_safe(evidence, hosts, ["host", "site"])

    site_known, host_known = F.col("site").isNotNull(), F.col("host").isNotNull()
    priors = []
    for k in range(n):
        by_site = (F.col(f"s_{k}") - F.col(f"p_{k}") + SITE_WEIGHT * everywhere[k]) / (F.col("s_all") - 1 + SITE_WEIGHT)
        upper = F.when(site_known, by_site).otherwise(F.lit(everywhere[k]))
        by_host = (F.col(f"h_{k}") - F.col(f"p_{k}") + HOST_WEIGHT * upper) / (F.col("h_all") - 1 + HOST_WEIGHT)
        priors.append(F.greatest(F.when(host_known, by_host).otherwise(upper), F.lit(1e-9)))

    # declarations outside the model's languages are one value, so this table has at most n rows
    value = F.when(F.col("declared").isin(*classes[:-1]), F.col("declared")).otherwise(F.when(F.col("declared").isNotNull(), "other"))
    declared = {
        row["value"]: [row[f"d_{k}"] for k in range(n)]
        for row in evidence.groupBy(value.alias("value")).agg(*[s.alias(f"d_{k}") for k, s in enumerate(sums)]).collect()
        if row["value"] is not None
    }
    stated = [sum(counts[k] for counts in declared.values()) for k in range(n)]
    chances = [
        (name, *[(counts[k] + TABLE_WEIGHT * (0.8 if name == classes[k] else 0.2 / n)) / (stated[k] + TABLE_WEIGHT) for k in range(n)])
        for name, counts in declared.items()
    ]
    chances = evidence.sparkSession.createDataFrame(chances, "_value string, " + ", ".join(f"c_{k} double" for k in range(n)))
    rows = rows.withColumn("_value", value).join(F.broadcast(chances), "_value", "left")
    says = [F.coalesce(f"c_{k}", F.lit(1.0)) for k in range(n)]

    suffixes = evidence.where("suffix is not null").groupBy("suffix").agg(*[s.alias(f"x_{k}") for k, s in enumerate(sums)])
    seen = suffixes.agg(*[F.coalesce(F.sum(f"x_{k}"), F.lit(0.0)).alias(f"x_{k}") for k in range(n)]).first()
    seen_all = sum(seen) or 1.0
    rows = rows.join(suffixes.select("*", total("x")), "suffix", "left")
    score = []
    for k in range(n):
        share = F.col("x_all") / seen_all  # of the suffix in all pages, towards which its share in a language is smoothed
        suffix = (F.col(f"x_{k}") + TABLE_WEIGHT * share) / (seen[k] + TABLE_WEIGHT)
        suffix = F.coalesce(suffix, F.lit(1.0))
        score.append((F.col(f"l_{k}") + F.log(priors[k]) + F.log(says[k]) + F.log(suffix)).alias(f"z_{k}"))

    rows = rows.select("_id", "_key", "host", "declared", "noise", *[f"l_{k}" for k in range(n)], *score)
    names = F.array(*[F.lit(c) for c in classes])
    z, text = F.array(*[f"z_{k}" for k in range(n)]), F.array(*[f"l_{k}" for k in range(n)])
    top = F.array_max(z)
    weight = F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return rows.select(
        "_id",
        "_key",
        "host",
        "declared",
        "noise",
        F.element_at(names, F.array_position(text, F.array_max(text)).cast("int")).alias("text_language"),
        F.element_at(names, F.array_position(z, top).cast("int")).alias("language"),
        (1 / weight).alias("confidence"),
    )


def identified(fields: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    return fused(stored(text_evidence(fields, model, markup), "language-evidence"), model)


def page_languages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """(page_id, host, declared, text_language, language, confidence) of every page (page_id, url, html).

    ``labelled`` (doc_id, text, lang) fits the text model on a bounded sample.
    ``text_language`` goes by the text alone. Null or malformed addresses have no host,
    a page without text is decided by the other evidence or is unknown; rows that
    repeat get a row each. Without labelled rows every page is unknown.
    """
    found = identified(page_fields(pages), fit_text_model(labelled), True)
    return found.withColumnRenamed("_id", "page_id").drop("_key", "noise")


def document_languages(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, _key, declared, noise, text_language, language, confidence) of every document (doc_id, text, lang, source)."""
    found = identified(document_fields(docs), fit_text_model(labelled), False)
    return found.withColumnRenamed("_id", "doc_id").drop("host")


def keep_identified(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are in some language by all evidence; every column as it was.

    Rejected are texts that chance explains better than any language of the model,
    with their source and declared language taken into account, and that look like
    noise themselves: empty texts, symbols, evenly drawn letters. Texts in a language
    or in letters that no labelled text has are not noise.
    """
    noise = document_languages(docs, labelled).where((F.col("language") == UNKNOWN) & F.col("noise"))
    key = free_name("_key", docs)
    rejected = noise.select("doc_id", F.col("_key").alias(key)).distinct()
    return join_null_safe(docs.withColumn(key, document_key()), rejected, ["doc_id", key], "left_anti").drop(key)
