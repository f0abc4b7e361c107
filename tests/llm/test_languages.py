"""Languages in any number, and texts in none of them."""

import random

import pytest

from riskloom.llm import language

SCHEMA = "doc_id long, text string, lang string, source string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

RUSSIAN = "когда наступила весна старый рыбак вышел на берег реки и долго смотрел на воду потому что ждал возвращения сына из города "
GREEK = "το παλιό σπίτι στην άκρη του χωριού είχε μια μεγάλη αυλή όπου τα παιδιά έπαιζαν κάθε απόγευμα μέχρι να νυχτώσει "
HUNGARIAN = "amikor megérkezett a tavasz az öreg halász kiment a folyó partjára és sokáig nézte a vizet mert várta hogy hazatérjen a fia "
THAI = "บ้านเก่าหลังหนึ่งตั้งอยู่ริมแม่น้ำและมีสวนขนาดใหญ่ที่เด็กๆชอบมาเล่นทุกเย็นจนกว่าจะมืด "


def invented(k):
    """Prose in a made-up language of its own letters' frequencies: 300 words, some much more common than others."""
    r = random.Random(k)
    weights = [r.random() ** 3 for _ in LETTERS]
    vocabulary = ["".join(r.choices(LETTERS, weights, k=r.randint(2, 8))) for _ in range(300)]
    return lambda seed: " ".join(random.Random(seed).choices(vocabulary, [1 / (n + 1) for n in range(300)], k=60))


def named(k):
    return "x" + LETTERS[k // 26] + LETTERS[k % 26]


def prose(spark, classes=40):
    """The less frequent languages come last; labels have regions and either case."""
    rows = []
    for k in range(classes):
        say = invented(k)
        for n in range(12 if k < 32 else 6):
            label = (named(k), named(k).upper(), f"{named(k)}-XX")[n % 3]
            rows.append((len(rows), say(f"{k} {n}"), label, f"s{k % 3}"))
    return spark.createDataFrame(rows, SCHEMA)


def test_every_labelled_language_is_a_class(spark):
    docs = prose(spark)
    model = language.fit_text_model(docs)
    assert model.languages == tuple(sorted(named(k) for k in range(40)))
    found = {r.doc_id: r.language for r in language.document_languages(docs, docs).collect()}
    labels = {r.doc_id: r.lang.lower()[:3] for r in docs.collect()}
    assert sum(found[k] == labels[k] for k in labels) >= 0.98 * len(labels)
    assert language.keep_identified(docs, docs).count() == len(labels)


@pytest.mark.parametrize("declared", [None, "en", "xx"])
def test_texts_beyond_the_model_stay(spark, declared):
    english = "when spring came the old fisherman walked to the bank of the river and looked at the water because he waited for his son "
    r = random.Random(1)
    noise = [" ".join("".join(r.choices(LETTERS, k=r.randint(2, 9))) for _ in range(60)) for _ in range(5)]
    rows = [(k, english * (1 + k % 3), "en", "s1") for k in range(40)]
    rows += [(100 + k, text * 6, declared, "s1") for k, text in enumerate((RUSSIAN, GREEK, HUNGARIAN, THAI))]
    rows += [(200 + k, text, declared, "s1") for k, text in enumerate(noise)]
    rows += [(300, "12 ## 7", declared, "s1"), (301, "", declared, "s1"), (302, "★ ★ ★ — ★", declared, "s1"), (303, None, declared, "s1")]
    docs = spark.createDataFrame(rows, SCHEMA)
    # the model knows English only
    kept = {row.doc_id for row in language.keep_identified(docs, docs.where("doc_id < 100")).collect()}
    assert kept == {*range(40), 100, 101, 102, 103}


def test_letters_without_a_trigram_go_by_other_evidence(spark):
    english = "when spring came the old fisherman walked to the bank of the river and looked at the water "
    rows = [(k, english, "en", "s1") for k in range(40)] + [(100, "A.", "en", "s1"), (101, "7.", "en", "s1")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.language for r in language.document_languages(docs, docs).collect()}
    assert found[100] == "en" and found[101] == language.UNKNOWN
