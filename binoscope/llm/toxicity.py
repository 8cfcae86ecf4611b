"""Toxicity: a linear classifier on words and word beginnings that is penalised when swapping identity terms changes its score.

Fitted on a bounded sample of labelled documents (SAMPLED_DOCUMENTS, chosen by a hash of the id); the sample's words are
counted by Spark, the weights are found on the driver, and every whole text is scored by the tasks. A document that
names a group is paired with the same document naming another one (its features, beginnings of words included, are those
of the swapped text), and the squared difference of the two scores, times
COUNTERFACTUAL_WEIGHT, is added to the loss: neutral mentions of a group then carry no weight of their own.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binoscope.llm.text import plain_words, texts_of

SAMPLED_DOCUMENTS = 20_000
MOST_FEATURES = 20_000
LEAST_DOCUMENTS = 8         # that a word of the model must occur in
LEAST_STRENGTH = 3.0        # standard errors of its log odds ratio
RIDGE = 0.3                 # relative to the loss summed over the sample
COUNTERFACTUAL_WEIGHT = 20.0
STEPS = 300
CUTOFF = 0.7
BEGINNING = 6               # bytes
LEVELS = (1, 2, 3, 5)

# Terms of one row stand for each other in counterfactuals.
IDENTITY_TERMS = [
    "muslim christian jewish hindu buddhist atheist".split(),
    "muslims christians jews hindus buddhists atheists".split(),
    "woman man girl boy".split(), "women men girls boys".split(),
    "gay lesbian straight bisexual transgender queer".split(),
    "black white asian african latino arab".split(),
    "immigrant refugee foreigner citizen".split(), "immigrants refugees foreigners citizens".split(),
    "frau mann".split(), "frauen männer".split(), "muslime christen juden".split(),
    "femme homme".split(), "femmes hommes".split(), "musulmans chrétiens juifs".split(),
    "mujer hombre".split(), "mujeres hombres".split(), "musulmanes cristianos judíos".split(),
]


ROW_OF = {t.encode(): [o.encode() for o in row if o != t] for row in IDENTITY_TERMS for t in row}


def features(text: bytes | None) -> set[bytes]:
    """The distinct words, and the beginnings of longer words with how often they stand in the text (1, 2, 3 or 5 times
    at least). No word holds the marks ^ and *, so the names of the two kinds never meet."""
    return features_of(Counter(plain_words(text or b"")))


def features_of(words: Counter[bytes]) -> set[bytes]:
    starts: Counter[bytes] = Counter()
    for word, n in words.items():
        if len(word) > BEGINNING:
            starts[word[:BEGINNING]] += n
    return {*words, *(b"^%b*%d" % (start, level) for start, n in starts.items() for level in LEVELS if n >= level)}


def counterfactuals(text: bytes | None) -> list[tuple[bytes, bytes, list[bytes], list[bytes]]]:
    """(term out, term in, features that go, features that come) for each text with one term in place of another
    wherever it stands."""
    words = Counter(plain_words(text or b""))
    own, found = features_of(words), []
    for out in sorted(ROW_OF.keys() & words.keys()):
        for into in ROW_OF[out]:
            swapped = words.copy()
            swapped[into] += swapped.pop(out)
            new = features_of(swapped)
            found.append((out, into, sorted(own - new), sorted(new - own)))
    return found


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: bytes | None) -> float:
        own = self.weights.keys() & features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(self.weights[w] for w in own)))))


def fit_linear(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, width: int,
               swaps: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
               changes: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias for balanced log loss, ridge, and the squared change of score under swaps, by Adam's method.

    swaps: (document, word out, word in, how many words of the row the document could be given) per counterfactual.
    changes: (counterfactual, feature, -1 if it goes and 1 if it comes) for all features that a swap changes; without
    them, the two words alone.
    """
    balance = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    document, out, into, shared = swaps
    fair = COUNTERFACTUAL_WEIGHT / np.maximum(1, shared)
    if changes is None:
        each = np.arange(len(document))
        changes = np.concatenate((each, each)), np.concatenate((out, into)), np.repeat([-1, 1], len(document))
    which, changed, sign = changes

    def chance(logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def slope_at(weights: np.ndarray, bias: float) -> np.ndarray:
        logit = np.bincount(rows, weights=weights[columns], minlength=len(labels)) + bias
        p = chance(logit)
        q = chance(logit[document] + np.bincount(which, weights=sign * weights[changed], minlength=len(document)))
        # The gradient of fair * (p - q)^2, where q is the swapped document's score.
        gap = 2 * fair * (p[document] - q)
        here, there = gap * p[document] * (1 - p[document]), gap * q * (1 - q)
        error = balance * (p - labels) + np.bincount(document, weights=here - there, minlength=len(labels))
        swapped = -np.bincount(changed, weights=sign * there[which], minlength=width)
        return np.append(np.bincount(columns, weights=error[rows], minlength=width) + RIDGE * weights + swapped, error.sum())

    parameters, mean, square = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        slope = slope_at(parameters[:-1], parameters[-1])
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        pace = 0.1 * (1 - (step - 1) / STEPS)
        parameters -= pace * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    return parameters[:-1], float(parameters[-1])


_SWAPS = pa.list_(pa.struct([("out", pa.binary()), ("into", pa.binary()), ("gone", pa.list_(pa.binary())), ("come", pa.list_(pa.binary()))]))


def _words(batches):
    for batch in batches:
        texts = texts_of(batch.column(1))
        swaps = [[dict(zip(("out", "into", "gone", "come"), c)) for c in counterfactuals(t)] for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(features(t)) for t in texts], pa.list_(pa.binary())),
                                          pa.array(swaps, _SWAPS)], names=["label", "words", "swaps"])


def fit(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
        most: int = SAMPLED_DOCUMENTS) -> Model:
    """Learn from labelled documents, at most about `most` of them (labels other than 0 and 1 are left out).

    An id with several labels counts as toxic if one of them says so. Without documents of both labels the model is the
    bias alone.
    """
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(id).agg(F.max(label).alias("label"))
    share = min(1.0, most / max(1, marked.count()))
    drawn = marked.where(F.pmod(F.xxhash64(id, F.lit("toxicity")), F.lit(1_000_000)) < int(share * 1_000_000))
    # About `most` ids, so the texts stay where they are and only the drawn ones are read on.
    sample = documents.select(id, text).join(F.broadcast(drawn), id).select(F.col("label").cast("int").alias("label"), text)
    sample = sample.mapInArrow(_words, "label int, words array<binary>, swaps array<struct<out: binary, into: binary, "
                               "gone: array<binary>, come: array<binary>>>").persist()
    try:
        sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        negative, positive = sizes.get(0, 0), sizes.get(1, 0)
        if not negative or not positive:
            return Model({}, 2.0 if positive else -2.0 if negative else 0.0)
        own = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(
            F.count("*").alias("n"), F.sum("label").alias("hits"))
        a, b = F.col("hits") + 0.5, F.col("n") - F.col("hits") + 0.5
        odds = F.log(a / (positive + 1 - a)) - F.log(b / (negative + 1 - b))
        strength = F.abs(odds) / F.sqrt(1 / a + 1 / b)
        terms = sorted(ROW_OF)
        kept = own.where((F.col("n") >= LEAST_DOCUMENTS) & (strength >= LEAST_STRENGTH) & ~F.col("word").isin([F.lit(t) for t in terms]))
        words = [bytes(r["word"]) for r in kept.orderBy(strength.desc(), "word").limit(MOST_FEATURES).collect()]
        number = {w: k for k, w in enumerate([*sorted(words), *terms])}
        shared = documents.sparkSession.sparkContext.broadcast(number)

        @F.udf("array<int>")
        def numbers(of_document):
            return sorted(shared.value[bytes(w)] for w in of_document if bytes(w) in shared.value)

        @F.udf("array<array<int>>")
        def changes_of(swaps):
            """Per counterfactual: term out, term in, and the known features it changes, +1 and negative if they go."""
            known = shared.value
            return [[known[bytes(s["out"])], known[bytes(s["into"])], *(-1 - known[bytes(w)] for w in s["gone"] if bytes(w) in known),
                     *(1 + known[bytes(w)] for w in s["come"] if bytes(w) in known)] for s in swaps]

        table = sample.select("label", numbers("words").alias("numbers"), changes_of("swaps").alias("swaps")).toPandas()
    finally:
        sample.unpersist()
    table = table.iloc[sorted(range(len(table)), key=lambda i: (int(table["label"][i]), list(table["numbers"][i])))]
    own = [np.asarray(n, dtype=np.int64) for n in table["numbers"]]
    rows, columns = np.repeat(np.arange(len(own)), [len(n) for n in own]), np.concatenate([np.empty(0, np.int64), *own])
    swaps, changes = [], []
    for at, of_document in enumerate(table["swaps"]):
        for out, into, *changed in of_document:
            changes += [(len(swaps), abs(k) - 1, 1 if k > 0 else -1) for k in changed]
            swaps.append((at, out, into, len(ROW_OF[terms[out - len(words)]])))
    swapped, changed = [tuple(np.array(x, dtype=np.int64).reshape(-1, n).T) for x, n in ((swaps, 4), (changes, 3))]
    weights, bias = fit_linear(rows, columns, table["label"].to_numpy(dtype=float), len(number), swapped, changed)
    return Model({w: float(weights[k]) for w, k in number.items() if weights[k]}, bias)


def score_toxicity(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: id, score (0 to 1), predicted (1 from the cutoff on).

    Null and empty texts have the score of a text without known words. Repeated rows give repeated results; columns
    other than id and text are not read. The model is broadcast: at most MOST_FEATURES words and the identity terms.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            scores = np.array([shared.value.score(t) for t in texts_of(batch.column(1))], dtype=float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= cutoff).astype(np.int32))],
                                             names=[id, "score", "predicted"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(score, f"`{id}` {kind}, score double, predicted int")
