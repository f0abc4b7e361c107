"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on its posteriors."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored, text_of

WORD = re.compile(r"\w+")
#: Patterns of abuse that hold for any corpus, each a voter of its own. These are of single words.
WORD_PATTERNS = {
    "insult": r"(?:idiot|moron|imbecil\w*|stupid\w*|dumb|loser|scum|trash|worthless|pathetic|disgusting)s?",
    "profanity": r"fuck\w*|shit\w*|bitch\w*|bastard\w*|asshole\w*|cunt\w*",
    "insult_de": r"(?:arschloch|schlampe|trottel|scheiß|wichser|dummkopf|hurensohn|missgeburt)\w*",
    "insult_fr": r"connard\w*|salop\w*|merde|putain|crétin\w*|abruti\w*|enculé\w*",
    "insult_es": r"(?:idiota|estúpid[oa]|imbécil|mierda|cabrón|puta|gilipollas|pendej[oa])s?",
}
#: Patterns of the lower-case text, each with one of which a text that matches has at least one.
TEXT_PATTERNS = {
    "address": (
        r"\b(?:you(?: are|'re)?|du bist|tu es|eres)\s+(?:an?\s+|ein\w*\s+|une?\s+|un[ao]?\s+)?(?:\w+\s+)?(?:idiot\w*|moron|loser|trottel|clown|scum|trash)",
        ("idiot", "moron", "loser", "trottel", "clown", "scum", "trash"),
    ),
    "threat": (r"\b(?:kill|hurt|beat|hunt)\s+(?:you|him|her|them)\b|\bhope you die\b", ("kill", "hurt", "beat", "hunt", "die")),
    "masked": (r"\b(?:[fs]\*{2,}\w*|[a-z]+[*@#$]{2,}[a-z]+)\b", ("*", "@", "#", "$")),
}


#: Correlations of votes within a class that are below this are taken for chance.
LEAST_CORRELATION = 0.3
#: Deviations of the bound on what a feature says.
DEVIATIONS = 3.0
RIDGE = 0.1


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learnt; the driver and every task hold at most this much."""

    #: Labelled texts of each class from which words for voters are mined.
    labelled: int = 20_000
    #: Texts on each side of even odds on which the classifier is fitted.
    fitted: int = 10_000
    #: Voters from mined words and beginnings of words, of each class.
    voters: int = 160
    #: Features of the classifier.
    features: int = 4096
    #: Texts of its class that a mined feature must be in.
    support: int = 5
    #: Rounds of expectation and maximisation.
    rounds: int = 8
    threshold: float = 0.7


def held_out() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1).alias("held_out")


def word_features(word: str) -> list[str]:
    """The word, and its beginnings of three to eight characters."""
    return [word + "$", *[word[:k] for k in range(3, 9) if len(word) > k]]


class FeatureCache:
    """Numbers of the wanted features of a text, then of the patterns of its words; what a word gives is remembered."""

    def __init__(self, wanted: list[str], patterns: Iterable[str] = (), most: int = 500_000):
        self.numbers = {feature: k for k, feature in enumerate(wanted)}
        self.patterns = list(enumerate(map(re.compile, patterns), len(wanted)))
        self.known: dict[str, tuple[int, ...]] = {}
        self.most = most

    def numbers_of(self, text: str) -> set[int]:
        found: set[int] = set()
        known = self.known
        for word in set(WORD.findall(text.lower())):
            numbers = known.get(word)
            if numbers is None:
                numbers = tuple(self.numbers[f] for f in word_features(word) if f in self.numbers)
                numbers += tuple(k for k, pattern in self.patterns if pattern.fullmatch(word))
                if len(known) >= self.most:
                    known.clear()
                if len(word) <= 64:
                    known[word] = numbers
            if numbers:
                found.update(numbers)
        return found


def text_key() -> Column:
    return F.xxhash64(text_of(), F.length(text_of()))


def labelled_texts(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, toxic) of at most ``labelled`` distinct texts of each class, in the order of a hash."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where("toxic is not null and doc_id is not null")
    keys = docs.where(~held_out() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    texts = keys.join(known, "doc_id").groupBy("key").agg(F.max_by("toxic", "doc_id").alias("toxic"), F.max("doc_id").alias("doc_id"))
    by_hash = [F.xxhash64("key", F.lit(1)), F.col("doc_id")]
    classes = [texts.where(F.col("toxic") == k).orderBy(*by_hash).limit(settings.labelled) for k in (0, 1)]
    return classes[0].union(classes[1]).select("doc_id", "toxic")


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns, text_of().alias("text"))


def feature_counts(texts: DataFrame) -> DataFrame:
    """(feature, n0, n1): sums of the weights ``w0`` and ``w1`` of the texts (w0, w1, text) that hold a feature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(sums: tuple[Counter, Counter]) -> pa.RecordBatch:
            names = list(sums[0].keys() | sums[1].keys())
            columns = [pa.array(names, pa.string()), *[pa.array([float(c[n]) for n in names], pa.float64()) for c in sums]]
            return pa.RecordBatch.from_arrays(columns, names=["feature", "n0", "n1"])

        sums = Counter(), Counter()
        for batch in batches:
            for w0, w1, text in zip(*(column.to_pylist() for column in batch.columns)):
                features = {f for word in set(WORD.findall(text.lower())) for f in word_features(word)}
                for weight, total in zip((w0, w1), sums):
                    if weight:
                        for feature in features:
                            total[feature] += weight
                if len(sums[0]) + len(sums[1]) > 500_000:
                    yield flushed(sums)
                    sums = Counter(), Counter()
        yield flushed(sums)

    counts = texts.select("w0", "w1", "text").mapInArrow(run, "feature string, n0 double, n1 double")
    return counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def evidence(own: Column, other: Column, share: float) -> Column:
    """How much, in log odds, being in a text speaks for its class at least: Wilson's bound at three deviations, over the class's share."""
    n = own + other
    centre, spread = own / n + DEVIATIONS**2 / (2 * n), DEVIATIONS * F.sqrt(own * other / (n * n * n) + DEVIATIONS**2 / (4 * n * n))
    least = F.greatest((centre - spread) / (1 + DEVIATIONS**2 / n), F.lit(1e-9))
    return F.log(least / (1 - least)) - math.log(share / (1 - share))


def telling(counts: DataFrame, totals: tuple[float, float], most: int, support: float, sign: int, least: float = 1.0) -> list[tuple[str, float]]:
    """At most ``most`` features that speak for class 1 (``sign`` 1) or 0 (-1), the strongest first, with their counts there."""
    if min(totals) <= 0:
        return []
    names = ("n1", "n0") if sign > 0 else ("n0", "n1")
    own, other = F.col(names[0]), F.col(names[1])
    share = totals[sign > 0] / sum(totals)
    rows = counts.where(own >= support).select("feature", own.alias("own"), evidence(own, other, share).alias("evidence"))
    rows = rows.where(F.col("evidence") >= least).orderBy(F.desc("evidence"), "feature").limit(most)
    return [(row.feature, row.own) for row in rows.collect()]


def unlike(features: list[tuple[str, float]], most: int) -> list[str]:
    """The first features, without those that begin, or are begun by, one before them that is in nearly the same texts."""
    kept: dict[str, float] = {}
    for feature, count in features:
        word = feature.rstrip("$")
        nested = [k for k in kept if k.rstrip("$").startswith(word) or word.startswith(k.rstrip("$"))]
        if all(min(count, kept[k]) < 0.8 * max(count, kept[k]) for k in nested):
            kept[feature] = count
        if len(kept) == most:
            break
    return list(kept)


@dataclass(frozen=True)
class Voters:
    """Lexicon voters, one a mined feature, then one a pattern, then one for texts without any of them.

    A vote is 1 for toxic, 2 for clean, 0 for none.
    """

    toxic: list[str]
    clean: list[str]

    def __len__(self) -> int:
        return len(self.toxic) + len(self.clean) + len(WORD_PATTERNS) + len(TEXT_PATTERNS) + 1

    def votes(self, texts: Iterable[str]) -> Iterator[bytes]:
        cache = FeatureCache(self.toxic + self.clean, WORD_PATTERNS.values())
        speaks = bytes([1] * len(self.toxic) + [2] * len(self.clean) + [1] * len(WORD_PATTERNS))
        patterns = [(re.compile(pattern), parts) for pattern, parts in TEXT_PATTERNS.values()]
        for text in texts:
            row = bytearray(len(self))
            for k in cache.numbers_of(text):
                row[k] = speaks[k]
            lower = text.lower()
            for k, (pattern, parts) in enumerate(patterns, len(speaks)):
                row[k] = any(part in lower for part in parts) and bool(pattern.search(lower))
            if 1 not in row:
                row[-1] = 2
            yield bytes(row)


def voted(docs: DataFrame, voters: Voters) -> DataFrame:
    """(doc_id, key, votes) of every row; votes have a byte a voter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = pa.array(list(voters.votes(batch.column(2).to_pylist())), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), votes], names=["doc_id", "key", "votes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, votes binary")


@dataclass
class LabelModel:
    """How likely each vote is in each class, how much of a voter is its own, and the share of class 1.

    ``rates`` has [class, voter, vote]. Voters whose votes go together within the
    classes say the same thing more than once: a voter counts by one over the
    sum of its correlations, its own included.
    """

    rates: np.ndarray
    share: np.ndarray
    prior: float

    @classmethod
    def from_sums(cls, counts: np.ndarray, pairs: np.ndarray, sides: np.ndarray) -> LabelModel:
        """``counts`` [class, voter, vote], ``pairs`` [class, voter, voter] of signed votes, ``sides`` the sizes of the classes."""
        rates = (counts + 0.1) / (sides + 0.3)[:, None, None]
        return cls(rates, 1 / correlations(counts, pairs, sides).sum(axis=1), float((sides[1] + 1) / (sides.sum() + 2)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        says = np.log(self.rates[1]) - np.log(self.rates[0])
        total = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for voter in range(votes.shape[1]):
            total += self.share[voter] * says[voter][votes[:, voter]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def correlations(counts: np.ndarray, pairs: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Sizes of the correlations of signed votes within the classes, averaged by the classes' sizes.

    A class in which a voter hardly ever votes says nothing of its correlations;
    small ones are taken for chance.
    """
    found, known = np.zeros(pairs.shape[1:]), np.zeros(pairs.shape[1])
    for k in (0, 1):
        n = max(sides[k], 1e-9)
        mean = (counts[k, :, 1] - counts[k, :, 2]) / n
        covariance = pairs[k] / n - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        heard = np.where(np.diag(pairs[k]) > 1, sides[k], 0.0)
        found += heard[:, None] * np.clip(np.abs(covariance / np.outer(spread, spread)), 0, 1)
        known += heard
    found /= np.maximum(known, 1e-9)[:, None]
    found[found < LEAST_CORRELATION] = 0
    np.fill_diagonal(found, 1)
    return found


def sums_of(votes: np.ndarray, posterior: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :meth:`LabelModel.from_sums` needs of some texts."""
    signed = np.where(votes == 2, -1.0, votes.astype(float))
    sides = np.stack([(1 - posterior) * weights, posterior * weights])
    counts = np.stack([np.stack([(side[:, None] * (votes == vote)).sum(axis=0) for vote in range(3)], axis=1) for side in sides])
    pairs = np.stack([(signed * side[:, None]).T @ signed for side in sides])
    return counts, pairs, sides.sum(axis=1)


def _vote_matrix(votes: list[bytes], voters: int) -> np.ndarray:
    return np.frombuffer(b"".join(votes), np.uint8).reshape(len(votes), voters)


def fitted_labels(votes: DataFrame, labelled: DataFrame, voters: Voters, settings: Settings) -> LabelModel:
    """The label model of all texts of ``votes`` (doc_id, key, votes), held to the labels of the ``labelled`` ones.

    What is not labelled takes part by its posterior, the labelled texts by their
    labels as well, so the classes cannot turn into another split of the corpus,
    such as short and long texts. Every round is one pass over the distinct rows of votes; a task sends the
    driver its sums, whose size is that of the voters squared.
    """
    count = len(voters)
    known = votes.join(F.broadcast(labelled), "doc_id").select("votes", "toxic").collect()
    matrix = _vote_matrix([bytes(row.votes) for row in known], count)
    truth = np.array([row.toxic for row in known], float)
    certain = sums_of(matrix, truth, np.ones(len(truth)))
    model = LabelModel.from_sums(*certain)
    patterns = stored(votes.select("key", "votes").distinct().groupBy("votes").agg(F.count("*").alias("n")), "toxicity-patterns")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                some = _vote_matrix(part.column(0).to_pylist(), count)
                sums = sums_of(some, model.posterior(some), np.array(part.column(1).to_pylist(), float))
                total = sums if total is None else tuple(a + b for a, b in zip(total, sums))
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()]) for part in total], names=["counts", "pairs", "sides"])

    for _ in range(settings.rounds):
        parts = patterns.mapInArrow(run, "counts binary, pairs binary, sides binary").collect()
        if not parts:
            break
        shapes = ((2, count, 3), (2, count, count), (2,))
        sums = [sum(np.frombuffer(row[k], float).reshape(shape) for row in parts) for k, shape in enumerate(shapes)]
        model = LabelModel.from_sums(*[known + found for known, found in zip(certain, sums)])
    return model


def with_posterior(votes: DataFrame, model: LabelModel, count: int) -> DataFrame:
    """(doc_id, key, posterior) of every row of votes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.posterior(_vote_matrix(batch.column(2).to_pylist(), count))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.float64())], names=["doc_id", "key", "posterior"])

    return votes.select("doc_id", "key", "votes").mapInArrow(run, "doc_id long, key long, posterior double")


@dataclass
class Classifier:
    """A linear score of features that are in a text or not."""

    features: list[str]
    weights: np.ndarray
    bias: float

    def scores(self, texts: Iterable[str]) -> list[float]:
        cache = FeatureCache(self.features)
        weights = self.weights.tolist()
        totals = (self.bias + math.fsum(weights[k] for k in cache.numbers_of(text)) for text in texts)
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, total)))) for total in totals]


def fitted_line(features: list[str], rows: list[list[int]], target: np.ndarray, weight: np.ndarray, steps: int = 500) -> Classifier:
    """Logistic regression on soft targets with a ridge, by accelerated gradients."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.fromiter((k for r in rows for k in r), np.int64, len(row))
    line, bias, total = np.zeros(len(features)), 0.0, max(float(weight.sum()), 1e-9)
    if len(rows):
        share = min(max(float((weight * target).sum() / total), 1e-4), 1 - 1e-4)
        bias = math.log(share / (1 - share))
    else:
        return Classifier(features, line, -10.0)
    # curvature is at most a quarter of the heaviest column; a diagonal step for each
    curve = RIDGE + np.bincount(column, weight[row], len(features)) * max(1, max((len(r) for r in rows), default=1)) / 4
    ahead, ahead_bias, pace = line.copy(), bias, 1.0
    for _ in range(steps):
        z = ahead_bias + np.bincount(row, ahead[column], len(rows))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        new = ahead - (np.bincount(column, error[row], len(features)) + RIDGE * ahead) / curve
        new_bias = ahead_bias - error.sum() / total
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, ahead_bias = new + (pace - 1) / following * (new - line), new_bias + (pace - 1) / following * (new_bias - bias)
        line, bias, pace = new, new_bias, following
    return Classifier(features, line, float(bias))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[Classifier, LabelModel, Voters]:
    """Voters, label model and classifier from the rows of ``docs`` (doc_id, text) that are not held out.

    Words for voters are mined from a bounded number of labelled texts (doc_id,
    toxic of ``labels``). The label model is fitted to the votes on all texts. The
    classifier is fitted to the posteriors of a bounded number of texts on either
    side of even odds, weighted back to the numbers of their sides. Exact copies
    of a text count once throughout.
    """
    docs = docs.where(~held_out())
    labelled = stored(labelled_texts(docs, labels, settings), "toxicity-labelled")
    texts = _texts(docs).join(F.broadcast(labelled), "doc_id")
    texts = texts.select((1.0 - F.col("toxic")).alias("w0"), F.col("toxic").cast("double").alias("w1"), "text")
    counts = stored(feature_counts(texts), "toxicity-words")
    sizes = {row.toxic: float(row.n) for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    totals = (sizes.get(0, 0.0), sizes.get(1, 0.0))
    mined = [telling(counts, totals, 8 * settings.voters, settings.support, sign) for sign in (1, -1)]
    voters = Voters(*[unlike(features, settings.voters) for features in mined])
    votes = stored(voted(docs, voters), "toxicity-votes")
    model = fitted_labels(votes, labelled, voters, settings)

    odds = with_posterior(votes, model, len(voters)).groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max("posterior").alias("posterior"))
    odds = stored(odds.where("doc_id is not null"), "toxicity-posteriors")
    toxic = F.col("posterior") >= 0.5
    sides = {row.toxic: row.n for row in odds.groupBy(toxic.alias("toxic")).agg(F.count("*").alias("n")).collect()}
    sample = [odds.where(toxic == side).orderBy(F.xxhash64("key", F.lit(2)), "doc_id").limit(settings.fitted) for side in (False, True)]
    scale = {side: max(1.0, sides.get(side, 0) / settings.fitted) for side in (False, True)}
    sample = stored(
        sample[0].union(sample[1]).select("doc_id", "posterior", F.when(toxic, scale[True]).otherwise(scale[False]).alias("weight")),
        "toxicity-sample",
    )
    chosen = stored(_texts(docs).join(F.broadcast(sample), "doc_id"), "toxicity-texts")
    weighed = chosen.select((F.col("weight") * (1 - F.col("posterior"))).alias("w0"), (F.col("weight") * F.col("posterior")).alias("w1"), "text")
    counts = stored(feature_counts(weighed), "toxicity-features")
    sums = weighed.agg(F.coalesce(F.sum("w0"), F.lit(0.0)).alias("w0"), F.coalesce(F.sum("w1"), F.lit(0.0)).alias("w1")).first()
    # half of the places for either class, so that many words of clean texts leave room for the few of toxic ones
    features = [f for sign in (1, -1) for f, _ in telling(counts, (sums.w0, sums.w1), settings.features // 2, settings.support, sign)]

    def present(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FeatureCache(features)
        for batch in batches:
            found = [sorted(cache.numbers_of(text)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["posterior", "weight", "found"])

    rows = chosen.select("posterior", "weight", "text").mapInArrow(present, "posterior double, weight double, found array<int>").collect()
    line = fitted_line(features, [row.found for row in rows], np.array([row.posterior for row in rows]), np.array([row.weight for row in rows]))
    return line, model, voters


def scored(docs: DataFrame, classifier: Classifier, threshold: float = Settings.threshold) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(classifier.scores(batch.column(2).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["doc_id", "held_out", "score"])

    rows = _texts(docs, held_out()).mapInArrow(run, "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted): how likely the whole text of every row of ``docs`` is labelled toxic.

    Held out are the rows whose checksum of doc_id leaves 1 when divided by 3:
    neither their labels nor their texts are learnt from. Only the text is ever
    an input of a score. A null text is scored as an empty one, a null doc_id is
    not learnt from. Of labels that disagree the greatest holds. Without a label
    of either class only the patterns vote, and without documents there are no
    rows. Repeated rows get a row each; other columns are ignored.
    """
    classifier, _, _ = fit(docs, labels, settings)
    return scored(docs, classifier, settings.threshold)
