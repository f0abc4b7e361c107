"""Column names that clash with helpers, repeats that fill a task, markup that nothing closes, and posteriors recomputed."""

import math
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import exact, jaccard, language, mixing, quality

CLASHING = ["_digest", "_key", "_row", "_r_doc_id", "_r__key", "_R_SOURCE", "__key"]
WORDS = "the of and river stone cloud paper green table window house small tree light sound".split()


def prose(seed, n=60):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="module")
def clashing(spark):
    texts = [prose(k) for k in range(12)]
    texts += [texts[0], texts[1].replace(" ", "  "), " ".join([*texts[2].split(), "end"]), None, "", "12 ## 7"]
    rows = [(k, text, "en" if k % 5 else None, f"s{k % 2}" if k % 7 else None, *[f"{name} {k}" for name in CLASHING]) for k, text in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{name} string" for name in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "keep",
    [exact.keep_one, jaccard.keep_first, lambda docs: language.keep_identified(docs, docs), mixing.mixed_documents],
    ids=["exact", "jaccard", "language", "mixing"],
)
def test_columns_named_like_helpers_stay(clashing, keep):
    kept = keep(clashing)
    assert kept.columns == clashing.columns
    found = kept.collect()
    rows = set(map(tuple, clashing.collect()))
    assert found and all(tuple(row) in rows for row in found)
    plain = keep(clashing.drop(*CLASHING)).collect()
    assert sorted(row.doc_id for row in found) == sorted(row.doc_id for row in plain)


def test_repeats_count_towards_what_a_task_holds():
    copies = exact._Copies(0)
    for k in range(10_000):
        copies.add(k, b"")
    assert copies.bytes >= 10_000 * exact.MEMBER_BYTES
    assert copies.batch().num_rows == 10_001 and copies.bytes == 0 and not copies.members


def test_owners_have_ranges_of_keys(spark, monkeypatch):
    rows = [(k, f"text number {k % 700} " * (1 + k % 3)) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    whole = sorted(map(tuple, exact.exact_groups(docs).collect()))
    monkeypatch.setattr(exact, "OWNED_BYTES", 20_000)
    entries = exact.collapse(docs).where("is_entry")
    slots, depth = exact.directory(entries, 4)
    dealt = sorted((row.slot, row.owner) for row in slots.collect())
    owners = [owner for _, owner in dealt]
    assert depth > 4 and owners == sorted(owners) and owners[-1] > 5
    total = entries.agg(F.sum("size")).first()[0]
    assert owners[-1] <= total // 20_000
    assert sorted(map(tuple, exact.exact_groups(docs, 4).collect())) == whole
    monkeypatch.setattr(exact, "MOST_OWNERS", 2)
    assert max(row.owner for row in exact.directory(entries, 4)[0].collect()) <= 2


def test_hidden_markup_equals_a_pattern():
    pattern = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
    pieces = ["<script", "<SCRIPT>", "</script>", "</Script \n>", "<style x>", "</style>", "<!--", "-->", "<!-->", ">", " a ", "\n", "<p>", "<scripts>"]
    r = random.Random(3)
    for _ in range(3000):
        markup = "".join(r.choices(pieces, k=r.randint(0, 12)))
        assert language.without_hidden(markup) == pattern.sub(" ", markup)


@pytest.mark.parametrize("piece", ["<script ", "<!-- ", "<style>", "<script></style>", "<", "</script"])
def test_unclosed_markup_takes_linear_time(piece):
    began = time.perf_counter()
    language.visible_text(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - began < 10


def test_posteriors_equal_plain_sums(spark):
    say = {"fr": "la maison est dans la forêt et le chat dort sur une chaise ", "en": "the house is in the forest and the cat sleeps on a chair "}
    labelled = spark.createDataFrame([(k, say[lang] * (1 + k % 2), lang) for k in range(20) for lang in say], "doc_id long, text string, lang string")
    r = random.Random(9)
    hosts = ["www.a.fr", "b.a.fr", "c.com", "d.co.uk", "e.org"]
    pages = []
    for k in range(80):
        lang = r.choice(["fr", "en"])
        text = (say[lang] * r.randint(1, 3))[: r.choice([0, 3, 9, 30, 400])]
        tag = r.choice(["<html>", f"<html lang='{lang}'>", '<html lang="de">', ""])
        pages.append((k, r.choice([f"http://{r.choice(hosts)}/{k}", "none", None]), f"{tag}<p>{text}</p>"))
    fields = language.page_fields(spark.createDataFrame(pages, "page_id long, url string, html string"))
    model = language.fit_text_model(labelled)
    evidence = language.text_evidence(fields, model, True)
    found = {row["_id"]: row for row in language.fused(evidence, model).collect()}
    classes, rows = model.classes, evidence.collect()
    n = len(classes)

    def sums(of):
        table = defaultdict(lambda: [0.0] * n)
        for row in rows:
            for k in range(n):
                table[of(row)][k] += row[f"p_{k}"]
        return table

    def declared(row):
        return row.declared if row.declared in classes[:-1] else "other" if row.declared else None

    every, site, host = sums(lambda row: 0)[0], sums(lambda row: row.site), sums(lambda row: (row.host, row.site))
    stated, suffix = sums(declared), sums(lambda row: row.suffix)
    stated.pop(None, None), suffix.pop(None, None)
    base = [(x + 1 / n) / (sum(every) + 1) for x in every]
    heavy, light, table = language.SITE_WEIGHT, language.HOST_WEIGHT, language.TABLE_WEIGHT
    for row in rows:
        z = []
        for k in range(n):
            own, prior = row[f"p_{k}"], base[k]
            if row.site is not None:
                prior = (site[row.site][k] - own + heavy * prior) / (sum(site[row.site]) - 1 + heavy)
            if row.host is not None:
                here = host[row.host, row.site]
                prior = (here[k] - own + light * prior) / (sum(here) - 1 + light)
            value = row[f"l_{k}"] + math.log(max(prior, 1e-9))
            says = declared(row)
            if says is not None:
                smooth = 0.8 if says == classes[k] else 0.2 / n
                value += math.log((stated[says][k] + table * smooth) / (sum(s[k] for s in stated.values()) + table))
            if row.suffix is not None:
                share = sum(suffix[row.suffix]) / sum(map(sum, suffix.values()))
                value += math.log((suffix[row.suffix][k] + table * share) / (sum(s[k] for s in suffix.values()) + table))
            z.append(value)
        best = max(range(n), key=z.__getitem__)
        answer = found[row["_id"]]
        assert answer.language == classes[best]
        assert answer.confidence == pytest.approx(1 / sum(math.exp(x - z[best]) for x in z), rel=1e-9)
    assert len(found) == len(rows) == 80


def test_taken_words_equal_passes_over_a_shuffled_source(spark):
    r = random.Random(4)
    rows = [(k, " ".join(["w"] * r.randint(0, 40)), r.choice(["a", "b", "b", "b", None])) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {row.doc_id: row for row in mixing.mixed_sizes(docs, block=17).collect()}
    keys = {row.doc_id: row.key for row in docs.select("doc_id", F.xxhash64(F.lit(0).cast("long"), "doc_id").alias("key")).collect()}
    sizes, sources = {row[0]: len(row[1].split()) for row in rows}, {row[0]: row[2] for row in rows}
    totals = {s: sum(sizes[k] for k in sizes if sources[k] == s) for s in set(sources.values())}
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    # shares of 1, 2, 3; sources that would pass three times their size stop there, the rest share what is over
    left, open_, targets = sum(totals.values()), dict(zip(order, (1, 2, 3))), {}
    while open_:
        full = [s for s in open_ if left * open_[s] / sum(open_.values()) > 3 * totals[s]]
        for s in full:
            targets[s] = 3 * totals[s]
        if not full:
            targets.update({s: left * open_[s] / sum(open_.values()) for s in open_})
            break
        left -= sum(targets[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s not in full}
    for s in order:
        quota, at, taken = round(targets[s]), 0, defaultdict(int)
        ids = sorted((keys[k], k) for k in sizes if sources[k] == s)
        for _ in range(3):
            for _, k in ids:
                taken[k] += max(0, min(at + sizes[k], quota) - at)
                at += sizes[k]
        for _, k in ids:
            assert found[k].target == pytest.approx(targets[s]) and found[k].taken == taken[k]


def test_stop_words_are_a_ratio(spark):
    rare = "zebra " * 30 + "quartz lantern copper " * 10 + "The of"
    rows = [(1, prose(1)), (2, prose(1).upper()), (3, " ".join(f"w{k}x" for k in range(98)) + " the of"), (4, rare), (5, "кот " + " ".join(f"слово{k} и" for k in range(60)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row.doc_id: row for row in quality.judged(docs).collect()}
    words = {k: text.split() for k, text in rows}
    stop = set(quality.stop_forms())
    assert all(found[k].n_stop_words == sum(w.lower() in stop for w in words[k]) for k in words)
    assert "stop_words" not in found[1].failed_rules and "stop_words" not in found[2].failed_rules
    assert "stop_words" in found[3].failed_rules and "stop_words" in found[5].failed_rules
    own = {row.doc_id: row for row in quality.judged(docs, stop_words={"ru": ("и",)}).collect()}
    assert "stop_words" not in own[5].failed_rules and "stop_words" in own[1].failed_rules


def survivors(rows):
    """Ids that the pipeline keeps, by all pairs: texts with letters, one of each text, one of each group of near copies."""
    first = {}
    for doc_id, text in sorted(rows, key=lambda row: row[0]):
        if any(map(str.isalpha, text or "")):
            first.setdefault(" ".join(text.split()), doc_id)
    sets = {k: {tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t, k in first.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(k for k in sets if find(k) == k)


def test_pipeline_keeps_one_of_near_copies(spark, tmp_path):
    rows = [(k, prose(k, 120)) for k in range(25)]
    near = rows[3][1].split()
    near[60] = "changed"
    far = rows[4][1].split()
    far[10:110:8] = ["other"] * len(far[10:110:8])
    rows += [(100, " ".join(near)), (101, " ".join(far)), (102, rows[5][1].replace(" ", "\n")), (103, None), (104, ""), (105, "7 ## 7")]
    rows += [(106, "long " + prose(77, 20_000)), (6, rows[6][1]), (6, rows[6][1])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string, _digest long"
    spark.createDataFrame([(k, t, "en", "s0", 1, "x", 2) for k, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    expected = survivors(rows)
    assert 100 not in expected and 101 in expected and 6 in expected
    assert sorted(row.doc_id for row in found) == expected


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
