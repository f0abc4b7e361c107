"""The training-text operators against brute force, the tokenizers library and exact round trips."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import bpe, chat, chunks, exact, language, lines, mixing, quality, sharding, simhash, simple8b
from riskloom.llm.common import components
from riskloom.llm.queries import MARKED

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int"
WORDS = "the of and river stone cloud paper green table window house small tree light sound".split()


def make_docs():
    """Copies, near copies, nulls, empty and long texts, repeated rows and ids, clashing extra columns."""
    r = random.Random(7)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 80))) for _ in range(40)]
    texts += [texts[0]] * 9 + [texts[1].replace(" ", "\n\t")] + [texts[2] + " extra"]
    texts += [None, "", " \n", "<|endoftext|> x\n <|endoftext|>", "x" * 400, "é漢😀 \x1c a!\x1c!", "a " * 6000, "12 34 ##"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 1, "no", 5) for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (4, "other text", None, None, None, None, None), (None, texts[0], "en", "s1", 1, "", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(rows):
    return Counter(tuple(row) for row in rows)


def near_classes(texts, radius=3):
    """text -> (fingerprint, texts reachable), by all pairs."""

    def fingerprint(text):
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if grams else 0

    prints = {t: fingerprint(t) for t in set(texts)}
    reach = {f: {f} for f in prints.values()}
    for a in list(reach):
        for b in list(reach):
            if (a ^ b).bit_count() <= radius and reach[a] is not reach[b]:
                joined = reach[a] | reach[b]
                for f in joined:
                    reach[f] = joined
    return prints, reach


def test_simhash_equals_all_pairs(docs, empty):
    rows = make_docs()
    prints, reach = near_classes([row[1] for row in rows])
    least = {}
    for row in rows:
        if row[0] is not None:
            key = min(reach[prints[row[1]]])
            least[key] = min(least.get(key, row[0]), row[0])
    expected = Counter((row[0], f"{prints[row[1]]:016x}", least.get(min(reach[prints[row[1]]]))) for row in rows)
    assert counted(simhash.near_duplicates(docs).collect()) == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_bit_sliced_comparison_equals_plain_one(monkeypatch):
    r = np.random.default_rng(3)
    centre = r.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (600, 3), dtype=np.uint64), axis=1)
    values = (centre[r.integers(0, 12, 600)] ^ flips).view(np.int64)
    keys = np.sort(r.integers(0, 9, 600))
    found = {(int(i), int(j)) for a, b in simhash.linked(keys, values, 3) for i, j in zip(a, b)}
    plain = {
        (i, j)
        for i in range(600)
        for j in range(i + 1, 600)
        if keys[i] == keys[j] and ((int(values[i]) ^ int(values[j])) & (1 << 64) - 1).bit_count() <= 3
    }
    assert found == plain and plain


def test_long_simhash_keys_are_dealt_in_blocks(spark, monkeypatch):
    near = [(v,) for v in {(1 << a) | (1 << b) for a in range(40) for b in range(40)}]
    frame = spark.createDataFrame(near, "fingerprint long")
    whole = {r.component for r in components(simhash.links(frame)).collect()}
    monkeypatch.setattr(simhash, "BLOCK", 16)
    assert {r.component for r in components(simhash.links(frame)).collect()} == whole == {1}


def test_exact_groups_equal_grouping(docs, empty):
    rows = make_docs()
    groups = defaultdict(list)
    for row in rows:
        groups[exact.normalised(row[1])].append(row[0])
    found = exact.exact_groups(docs, capacity=2).collect()
    for row in found:
        group = next(g for t, g in groups.items() if hashlib.sha256(t).hexdigest() == row.text_sha256)
        assert row.group_size == len(group) and row.keep_id == min(i for i in group if i is not None)
    assert len(found) == len(rows) and sum(row.kept for row in found) == len(groups)
    assert exact.keep_one(docs).count() == len(groups) and exact.keep_one(docs).columns == docs.columns
    assert exact.exact_groups(empty).count() == 0


def test_mixing_meets_targets(docs, empty):
    rows = make_docs()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += len((row[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = mixing.water_fill([sizes[s] for s in order], [mixing.WEIGHTS[k % 3] for k in range(len(order))])
    assert sum(targets) == sum(sizes.values())
    found = mixing.mixed_sizes(docs, block=17).collect()
    assert len(found) == len(rows) and all(row.taken <= 3 * row.size for row in found)
    taken = defaultdict(int)
    for row in found:
        taken[row.target] += row.taken
    assert sum(taken.values()) == sum(round(t) for t in targets)
    assert counted(found) == counted(mixing.mixed_sizes(docs.repartition(5), block=17).collect())
    assert mixing.mixed_sizes(empty).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


def test_schedule_stays_near_shares(spark):
    plan = spark.createDataFrame(
        [(k, b, low << 36, high << 36) for k, (b, low, high) in enumerate([(100, 0, 4), (300, 4, 16)])],
        "source_no long, blocks long, low long, high long",
    )
    rows = sorted(mixing.schedule(spark, plan).collect())
    assert Counter(r.source_no for r in rows) == {0: 100, 1: 300}
    assert [r.block for r in rows if r.source_no == 1] == list(range(300))
    assert all(abs(sum(r.source_no == 0 for r in rows[:n]) - n / 4) <= 3 for n in range(401))


def test_shards_are_minimax(docs, empty):
    rows = sorted(make_docs(), key=lambda row: (row[0] is not None, row[0]))
    groups = {}
    for row in rows:
        text = row[1] or ""
        groups[text] = groups.get(text, 0) + len(text.encode()) + 8
    sizes, shards = list(groups.values()), 5

    def fits(capacity):
        used, room = 1, capacity
        for size in sizes:
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))
    found = sharding.sharded(docs, shards).collect()
    total, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    for row in found:
        total[row.shard] += row.size
        slots[row.shard].append(row.slot)
        homes[(row.text_crc32, row.size)].add(row.shard)
    assert max(total.values()) == best and len(found) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())
    assert sharding.sharded(empty).count() == 0


def test_outline_refines_to_the_exact_capacity(spark, monkeypatch):
    r = random.Random(2)
    sizes = [r.randint(1, 500) for _ in range(3000)]
    before = np.cumsum([0, *sizes[:-1]]).tolist()
    groups = spark.createDataFrame(list(zip(range(3000), before, sizes)), "rank long, before long, bytes long")
    exact_answer = sharding.minimax_cuts(groups, 7)[0]
    monkeypatch.setattr(sharding, "FIRST_STRETCHES", 16)
    monkeypatch.setattr(sharding, "FINER", 2)
    assert sharding.minimax_cuts(groups, 7)[0] == exact_answer


@pytest.mark.parametrize("size", [1 << 20, 5])
def test_bpe_equals_the_library(size, monkeypatch):
    monkeypatch.setattr(chunks, "SLICE", size)
    r, library = random.Random(size), Tokenizer.from_file(PATH)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", " \n", "é", "ß", "1", "²", "!!", "'s", "\x1c", "\x85", "\xa0",
             "<|endoftext|>", "😀", "漢字", "_", "Ж", "x" * 70, "ab" * 60, "՘", "<|endof"]
    own, other = bpe.Encoder(PATH), simple8b.LibraryEncoder(PATH)
    for _ in range(1500):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 20)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode([text])[0].tolist() == ids and other.encode([text])[0].tolist() == ids
        assert own.decode(np.array(ids, int)).decode() == library.decode(ids, skip_special_tokens=False)


def test_encoded_documents_and_files(docs, empty):
    rows, library = make_docs(), Tokenizer.from_file(PATH)
    ids = [library.encode(row[1] or "", add_special_tokens=False).ids for row in rows]
    digest = [hashlib.sha256(np.array(i, "<u4")).hexdigest() for i in ids]
    plain = [hashlib.sha256((row[1] or "").encode()).hexdigest() for row in rows]
    expected = Counter((row[0], len(i), d, p) for row, i, d, p in zip(rows, ids, digest, plain))
    assert counted(bpe.encoded_documents(docs, PATH).collect()) == expected
    start, files = 0, Counter()
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0], rows[k][1] or "")):
        full = np.array([*ids[k], 0], "<u4")
        files[(rows[k][0], start, len(full), zlib.crc32(full))] += 1
        start += len(full)
    assert counted(simple8b.encoded_files(docs, PATH).collect()) == files
    assert bpe.encoded_documents(empty, PATH).count() == simple8b.encoded_files(empty, PATH).count() == 0


def test_simple8b_round_trip():
    r = np.random.default_rng(1)
    for k in range(120):
        n = int(r.integers(0, 3000))
        widths = r.integers(0, 64 if k % 2 else 4, size=n).astype(np.uint64)
        ids = np.zeros(n, np.uint64) if k % 5 == 0 else r.integers(0, 1 << 63, n, dtype=np.uint64) >> (np.uint64(63) - widths)
        words, offsets, escapes = simple8b.pack(ids)
        assert np.array_equal(simple8b.unpack(words, escapes), ids)
        for b, first in enumerate(offsets):
            last = offsets[b + 1] if b + 1 < len(offsets) else len(words)
            assert np.array_equal(simple8b.unpack(words[first:last], escapes), ids[b * 1024 : (b + 1) * 1024])


def test_chat_round_trip(spark):
    rows = [(1, 1, "assistant", MARKED), (1, 0, "user", "### \\x: <"), (1, 2, None, None), (2, 0, "user", ""), (1, 3, "assistant", "b"),
            (None, None, "assistant", "z"), (3, 0, "assistant", "t"), (3, 0, "assistant", "t")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash"))
    turns, examples = chat.write_examples(frame)
    found = {row.conv_id: row for row in chat.conversation_digests(turns, examples).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or ""))
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        joined = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        row = found[conv]
        assert (row.n_turns, row.turns_sha256) == (len(own), hashlib.sha256(joined.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    spelled = {(r.conv_id, r.target_pos): r for r in chat.spelled_out(turns, examples).collect()}
    assert len(spelled) == 5 and all(len(r.text) == r.example_chars for r in spelled.values())
    assert spelled[(1, 3)].text.startswith(spelled[(1, 1)].text) and spelled[(1, 3)].text.endswith("### assistant: b</turn>\n")
    assert chat.conversation_digests(*chat.write_examples(frame.limit(0))).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 3])
def test_line_links_equal_all_pairs(spark, threshold):
    r = random.Random(3)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(0, 14))) for _ in range(30)]

    def changed(line):
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(line))
            line = line[:at] + r.choice(["", "a", "xé"]) + line[at + r.randint(0, 1) :]
        return line

    texts = [changed(r.choice(base)) for _ in range(200)] + ["a", "b", "ab", "", "é"]
    rows = [(k, "\n".join(texts[4 * k : 4 * k + 4]), "x") for k in range(52)] + [(None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, line string")
    distinct = sorted({t.strip() for t in texts if t.strip()})
    expected = {frozenset((a, b)): edit_distance(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :]}
    expected = {pair: d for pair, d in expected.items() if d <= threshold}
    names = dict(lines.line_rows(frame).select(lines.line_id(), "line").distinct().collect())
    links = lines.line_links(frame, lines.distinct_lines(frame, threshold), threshold).collect()
    assert {frozenset((names[x.a], names[x.b])): x.distance for x in links} == expected
    found = lines.near_duplicate_lines(frame, threshold).collect()
    assert len(found) == len(distinct) and sum(row.n_links for row in found) == 2 * len(expected)
    assert lines.near_duplicate_lines(frame.limit(0), threshold).count() == 0


def test_quality_of_odd_rows(docs, empty):
    found = {row.doc_id: row for row in quality.judged(docs).collect()}
    rows = {row[0]: row for row in make_docs() if row[0] != 4}
    for doc_id, row in rows.items():
        words = (row[1] or "").encode().split()
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) for j in range(3) if windows[tuple(words[k : k + 3])] > 1}
        assert (found[doc_id].n_words, found[doc_id].n_repeat_words) == (len(words), len(covered))
        assert found[doc_id].base_failed == (len(words) < 50 or 2 * len(covered) > len(words))
    assert quality.judged(empty).count() == 0


def test_language_fuses_evidence(spark, docs, empty):
    french = "la maison est dans la forêt et le chat dort sur une chaise verte pour la nuit "
    english = "the house is in the forest and the cat sleeps on a green chair for the night "
    labelled = spark.createDataFrame([(k, t, l) for k in range(30) for t, l in ((french, "fr"), (english, "en"))], "doc_id long, text string, lang string")
    pages = [(k, f"http://www.a.fr/{k}", f"<html lang='fr'><body>{french}</body></html>") for k in range(20)]
    pages += [(50, "http://www.a.fr/x", "<html lang=fr><p>ok</p></html>"), (51, None, None), (52, "no address", f"<p>{english}</p>"), (53, "", "")]
    found = {r.page_id: r for r in language.page_languages(spark.createDataFrame(pages, "page_id long, url string, html string"), labelled).collect()}
    assert all(found[k].language == "fr" for k in range(20)) and found[50].language == "fr" and found[52].language == "en"
    assert found[51].language == found[53].language == "und" and found[0].host == "www.a.fr"
    kept = language.keep_identified(docs, docs)
    gone = {row.doc_id for row in docs.exceptAll(kept).collect()}
    texts = {row[0]: row[1] for row in make_docs()}
    assert kept.columns == docs.columns and all(not any(c.isalpha() for c in texts[k] or "") for k in gone)
    assert {k for k, t in texts.items() if not (t or "").strip()} <= gone
    assert language.keep_identified(empty, empty).count() == 0


def test_components_equal_union_find(spark):
    r = random.Random(5)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(1000, k) for k in range(400, 700)] + [(k, k + 1) for k in range(2000, 2100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    found = components(frame).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for x in list(root)} and len(found) == len(root)


def test_pipeline_stages(spark, tmp_path):
    long = [(100 + k, " ".join(random.Random(k).choices(WORDS, k=60)), "en", "s0", 1) for k in range(30)]
    rows = [*long, (500, long[0][1].replace(" ", "  "), "en", "s0", 1), (501, "12 ## 7", "en", "s0", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(PATH)
    prints, reach = near_classes([row[1] for row in long])
    least = {}
    for row in long:
        least.setdefault(min(reach[prints[row[1]]]), row[0])
    texts = {row[0]: row[1] for row in long}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # one source: its target is its size, so every document that is left passes once
    assert sorted(row.doc_id for row in found) == sorted(least.values())
    for row in found:
        assert row.n_tokens == len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)
