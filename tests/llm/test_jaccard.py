"""Near copies of the pipeline against all pairs of word shingles."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from riskloom.llm import jaccard, simhash

SCHEMA = "doc_id long, text string, lang string"


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 5 else {tuple(words)}


def near_texts():
    """Texts of many lengths and copies of them with a few words changed, so that pairs lie on both sides of 0.8."""
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(40):
        words = r.choices(vocabulary, k=r.randint(1, 200))
        texts.append(" ".join(words))
        for _ in range(r.randint(0, 5)):
            changed = list(words)
            for _ in range(r.randint(1, 5)):
                changed[r.randrange(len(changed))] = r.choice(vocabulary)
            texts.append(" ".join(changed))
    return [*texts, texts[0].upper(), "", " \n", None]


def expected_first(texts):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    return {i for i, x in enumerate(root) if i == x}


def test_near_copies_equal_all_pairs(spark, monkeypatch):
    texts = near_texts()
    frame = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], SCHEMA).repartition(3)
    expected = expected_first(texts)
    assert len(expected) < len(texts) - 30
    kept = corpus_pipeline.without_near_copies(spark, frame, "")
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == expected
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    assert {r.doc_id for r in jaccard.keep_first(frame).collect()} == expected
    assert jaccard.keep_first(frame.limit(0)).count() == 0


def test_fingerprints_alone_miss_near_copies():
    """The pairs that three bits let pass are there in the texts above."""
    texts = near_texts()
    sets, prints = [plain_set(t) for t in texts], [simhash.fingerprint(t) for t in texts]
    far = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and (prints[i] ^ prints[j]).bit_count() > 3
    ]
    assert far


def test_bands_meet_at_the_least_similarity():
    r = random.Random(3)
    met = 0
    for _ in range(500):
        own = [r.getrandbits(64) for _ in range(100)]
        left, right = own[:90], own[10:]  # 80 of 100 shared
        keys = [jaccard.band_keys(jaccard.np.array(sorted(x), jaccard.np.uint64)) for x in (left, right)]
        met += any(a == b for a, b in zip(*keys))
    assert met >= 498


def test_close_fingerprints_alone_propose_pairs(spark):
    """Without any band key, copies within three bits of each other are still candidates; those further apart are not."""
    r = random.Random(5)
    base = [f"w{r.randrange(400)}" for _ in range(400)]
    texts = [" ".join(base), " ".join(base).upper(), " ".join([*base, "more"]), " ".join(f"v{k}" for k in range(400))]
    prints = [simhash.fingerprint(t, jaccard.SHINGLE) for t in texts]
    assert prints[0] == prints[1] and 0 <= (prints[0] ^ prints[2]).bit_count() <= 3 < (prints[0] ^ prints[3]).bit_count()
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], SCHEMA)
    sketched = jaccard.sketches(docs)
    assert [x.fingerprint % (1 << 64) for x in sketched.orderBy("doc_id").collect()] == prints
    nodes = {x.doc_id: x.node for x in sketched.collect()}
    alone = sketched.withColumn("bands", F.array().cast("array<long>"))
    sets = {x.node: x.component for x in jaccard.candidates(alone).collect()}
    assert nodes[0] == nodes[1] and set(sets) == {nodes[0], nodes[2]} and len(set(sets.values())) == 1
    assert {x.doc_id for x in jaccard.keep_first(docs).collect()} == {0, 3}
