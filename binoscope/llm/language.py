"""Language identification: unigrams over the pieces of a fixed public vocabulary, summed over all segmentations.

A word is a run of letters, lower-cased, behind a start mark. Each language has a probability for every piece; the
probability of a word is the sum, over all ways to cut it into pieces, of the product of their probabilities, found by
the forward algorithm. Words are independent, so a text's log probability is the sum over its words, and each distinct
word of a batch is scored once, for all languages at once.

The piece probabilities come from expected counts: the share of each piece in all segmentations of all words of all
training documents when every piece is as likely as another (one round of expectation and maximisation). A task sends
on at most one number per language and piece.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.llm.text import texts_of

VOCABULARY = "piece_bpe_32k.model"
START = "▁"
LONGEST_WORD = 32           # letters; a longer run is scored in parts of this length
MOST_LANGUAGES = 256        # bound of the model that is broadcast (some 20,000 numbers each)
UNKNOWN = 1e-7              # probability of a letter that is no piece
SMOOTHING = 0.1             # added to each piece's expected count
UNDETERMINED = "und"
_LETTERS = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")
_CELLS = 2_000_000


class Vocabulary:
    """The lower-case pieces as a tree, so that a step from node to node is one look-up for many words at once."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.pieces = [p for p in pieces if p == p.lower() and START not in p[1:] and (p.removeprefix(START).isalpha() or p == START)]
        self.longest = max(map(len, self.pieces))
        letters = sorted({c for p in self.pieces for c in p})
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        # Nodes below the root only know letters of longer pieces; 0 is "no such letter" and "no such node".
        inner = sorted({c for p in self.pieces if len(p) > 1 for c in p[1:]})
        self.inner = np.zeros(len(letters) + 1, dtype=np.int32)
        self.inner[self.letter[[ord(c) for c in inner]]] = np.arange(1, len(inner) + 1)
        nodes = {"": 1} | {p: n for n, p in enumerate(sorted({p[:k] for p in self.pieces for k in range(1, len(p) + 1)}), 2)}
        self.first = np.zeros(len(letters) + 1, dtype=np.int32)
        self.next = np.zeros((len(nodes) + 2, len(inner) + 1), dtype=np.int32)
        for prefix, node in nodes.items():
            if len(prefix) == 1:
                self.first[self.letter[ord(prefix)]] = node
            elif prefix:
                self.next[nodes[prefix[:-1]], self.inner[self.letter[ord(prefix[-1])]]] = node
        self.piece = np.zeros(len(nodes) + 2, dtype=np.int32)      # number of the piece that ends at a node, from 1
        for number, p in enumerate(self.pieces, 1):
            self.piece[nodes[p]] = number

    def chunks(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of similar length together: (their numbers, letters with the start mark, lengths)."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            size = max(1, _CELLS // ((LONGEST_WORD + 1) * self.longest))
            own = order[at:at + size]
            at += size
            width = int(lengths[own[-1]])
            padded = "".join(words[i].ljust(width, "\0") for i in own.tolist())
            codes = np.frombuffer(padded.encode("utf-32-le"), dtype=np.uint32).reshape(len(own), width)
            letters = np.concatenate((np.full((len(own), 1), self.letter[ord(START)]), self.letter[codes]), axis=1)
            yield own, letters, lengths[own] + 1

    def steps(self, letters: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(from, to, piece numbers, 0 for none) of every stretch that is a piece of some word."""
        width = letters.shape[1]
        for start in range(width):
            node = self.first[letters[:, start]]
            for end in range(start + 1, min(width, start + self.longest) + 1):
                if end > start + 1:
                    node = self.next[node, self.inner[letters[:, end - 1]]]
                    if not node.any():
                        break
                piece = np.where(end <= lengths, self.piece[node], 0)
                if piece.any():
                    yield start, end, piece


@dataclass
class Model:
    languages: list[str]
    probabilities: np.ndarray       # (1 + pieces, languages); row 0 is 0


def forward(vocabulary: Vocabulary, letters: np.ndarray, lengths: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probability of every beginning of every word: (words, width + 1, languages). A lone letter costs UNKNOWN at least."""
    words, width = letters.shape
    before = np.zeros((words, width + 1, p.shape[1]))
    before[:, 0] = 1.0
    at = -1
    for start, end, piece in _all_starts(vocabulary, letters, lengths):
        if start != at:
            at = start
            before[:, start + 1] += before[:, start] * UNKNOWN
        if piece is not None:
            before[:, end] += before[:, start] * p[piece]
    return before


def _all_starts(vocabulary: Vocabulary, letters: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray | None]]:
    """`steps`, with an empty entry first for each start."""
    steps, held = vocabulary.steps(letters, lengths), None
    for start in range(letters.shape[1]):
        yield start, start + 1, None
        while True:
            held = held or next(steps, None)
            if held is None or held[0] != start:
                break
            yield held
            held = None


def log_probabilities(vocabulary: Vocabulary, words: list[str], p: np.ndarray) -> np.ndarray:
    """(words, languages)"""
    out = np.zeros((len(words), p.shape[1]))
    for own, letters, lengths in vocabulary.chunks(words):
        out[own] = np.log(forward(vocabulary, letters, lengths, p)[np.arange(len(own)), lengths])
    return out


def expected_counts(vocabulary: Vocabulary, words: list[str], times: np.ndarray) -> np.ndarray:
    """Expected number of each piece, by use: (1 + pieces, uses), for words that stand `times` (words, uses) often."""
    flat = np.full((len(vocabulary.pieces) + 1, 1), 1 / len(vocabulary.pieces))
    flat[0] = 0.0
    out = np.zeros((len(flat), times.shape[1]))
    for own, letters, lengths in vocabulary.chunks(words):
        before = forward(vocabulary, letters, lengths, flat)[:, :, 0]
        total = before[np.arange(len(own)), lengths]
        steps = list(vocabulary.steps(letters, lengths))
        after = np.zeros_like(before)
        after[np.arange(len(own)), lengths] = 1.0
        for at in reversed(range(letters.shape[1])):
            after[:, at] += np.where(at < lengths, after[:, at + 1] * UNKNOWN, 0.0)
            while steps and steps[-1][0] == at:
                start, end, piece = steps.pop()
                part = after[:, end] * flat[piece, 0]
                after[:, at] += part
        for start, end, piece in vocabulary.steps(letters, lengths):
            share = before[:, start] * flat[piece, 0] * after[:, end] / total
            some = np.flatnonzero(share)
            for use in range(times.shape[1]):
                out[:, use] += np.bincount(piece[some], weights=share[some] * times[own[some], use], minlength=len(out))
    return out


def words_of(text: bytes | None) -> list[str]:
    return _LETTERS.findall((text or b"").decode().lower())


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary_at(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", path: str | None = None) -> Model:
    """Learn from all documents with a language. More than MOST_LANGUAGES languages are an error, never cut."""
    place = path or public_tokenizers.path(VOCABULARY)
    learned = documents.where(F.col(lang).isNotNull())
    languages = sorted(r[0] for r in learned.select(lang).distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{lang} has more than {MOST_LANGUAGES} values.")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_at(place)
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for name, content in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found[name].update(words_of(content))
            number = {w: k for k, w in enumerate(dict.fromkeys(w for c in found.values() for w in c))}
            times = np.zeros((len(number), len(found)))
            for use, counts in enumerate(found.values()):
                times[[number[w] for w in counts], use] = list(counts.values())
            out = expected_counts(vocabulary, list(number), times)
            piece, use = np.nonzero(out)
            names = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([names[u] for u in use.tolist()], pa.string()), pa.array(piece.astype(np.int32)),
                                              pa.array(out[piece, use])], names=["lang", "piece", "n"])

    counted = learned.select(F.col(lang).cast("string").alias("lang"), text).mapInArrow(count, "lang string, piece int, n double")
    table = counted.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    p = np.full((len(vocabulary_at(place).pieces) + 1, len(languages)), SMOOTHING)
    column = {name: k for k, name in enumerate(languages)}
    p[table["piece"].to_numpy(), [column[n] for n in table["lang"]]] += table["n"].to_numpy()
    p[0] = 0.0
    return Model(languages, p / p.sum(axis=0, keepdims=True))


def identify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: id, lang_pred, score (the language's share if all were equally likely beforehand).

    Null texts and texts without a letter, and all texts under a model without languages, are "und" with score 0; equal
    languages are decided by name. Repeated rows give repeated results; columns other than id and text are not read.
    """
    place = path or public_tokenizers.path(VOCABULARY)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, p, vocabulary = shared.value.languages, shared.value.probabilities, vocabulary_at(place)
        for batch in batches:
            number: dict[str, int] = defaultdict()
            number.default_factory = number.__len__
            numbers = []
            for content in texts_of(batch.column(1)):
                own = words_of(content)
                numbers.append(np.fromiter(map(number.__getitem__, own), dtype=np.int64, count=len(own)))
            logs = log_probabilities(vocabulary, list(number), p)
            letter = np.fromiter((any(map(str.isalpha, w)) for w in number), dtype=bool, count=len(number))
            names, scores = [], []
            for own in numbers:
                if not languages or not letter[own].any():
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                total = logs[own].sum(axis=0)
                best = int(total.argmax())
                names.append(languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[id, "lang_pred", "score"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(name, f"`{id}` {kind}, lang_pred string, score double")

