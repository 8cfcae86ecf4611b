"""Best-fit packing: repeat counts of few-document length patterns, fitted to the histogram by non-negative least squares.

The driver sees the histogram of piece lengths only (at most `capacity` numbers, however large the corpus) and turns it
into a plan: patterns with repeat counts that use up every length exactly. A piece finds its sequence and offset from
its length and its rank among the pieces of that length, so nothing about single documents leaves the executors.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from binoscope.llm.shared import written
from binoscope.llm.text import texts_of

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
DESCENT_STEPS = 300
RANKED_AT_ONCE = 50_000     # pieces of one length that a task numbers together

_MOST_CACHED = 400_000


class WordIds(dict):
    """Token ids (little-endian unsigned 32-bit, as bytes) of texts without white space, remembered up to a bound.

    The tokenizer lower-cases, drops white space and never joins across it, so a text's ids are those of its parts. Parts
    of plain letters, digits and marks are cut as the tokenizer's own pattern does and given to its model; all others,
    and special tokens, go through the tokenizer whole.
    """
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    # The tokenizer's pattern, for these characters.
    CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.byte_level = [chr(b) if b in printable else chr(next(rest)) for b in range(256)]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= _MOST_CACHED:
                self.words.clear()
            written_as = word if word.isascii() else "".join(self.byte_level[b] for b in word.encode())
            known = self.words[word] = np.array([t.id for t in self.tokenizer.model.tokenize(written_as)], dtype="<u4").tobytes()
        return known

    def __missing__(self, part: str) -> bytes:
        if len(self) >= _MOST_CACHED:
            self.clear()
        if self.PLAIN.fullmatch(part) and "<|" not in part:
            value = b"".join(map(self.word, self.CUT.findall(part.lower())))
        else:
            value = self.whole(part)
        self[part] = value
        return value

    def of(self, text: str) -> bytes:
        # Python splits at these four separators too, the tokenizer does not.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


_CACHES: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own cache, kept from task to task."""
    if path not in _CACHES:
        _CACHES[path] = WordIds(path)
    return _CACHES[path]


def cut_pieces(docs: DataFrame, id: str, text: str, path: str, capacity: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids, in pieces of at most capacity ids."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_ids(path)
        for batch in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for row, content in enumerate(texts_of(batch.column(1))):
                ids = cache.of((content or b"").decode()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    owner.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=[id, "piece", "start", "length", "ids_crc32"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(cut, f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long")


def few_document_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All patterns of one to three of these lengths that fill a sequence exactly: rows (a, b, c), a >= b >= c, 0 for none."""
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if there[capacity] else []
    for a in lengths[lengths < capacity].tolist():
        b = lengths[(lengths <= a) & (lengths < capacity - a + 1)]
        c = capacity - a - b
        good = (c >= 0) & (c <= b) & ((c == 0) | there[np.maximum(c, 0)])
        found.append(np.stack((np.full(int(good.sum()), a), b[good], c[good]), axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = DESCENT_STEPS) -> np.ndarray:
    """Non-negative x with patterns' use of lengths near the histogram: least squares by accelerated projected descent."""
    if not len(patterns):
        return np.empty(0)
    target = histogram.astype(float).copy()
    target[0] = 0

    def use(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(patterns[:, k], weights=x, minlength=len(target)) for k in range(3))
        total[0] = 0
        return total

    def pull(residual: np.ndarray) -> np.ndarray:
        return residual[patterns].sum(axis=1)

    steep, probe = 1.0, np.ones(len(patterns))
    for _ in range(20):
        probe = pull(use(probe))
        steep = float(np.linalg.norm(probe))
        probe /= steep
    x = ahead = np.zeros(len(patterns))
    pace = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, ahead - pull(use(ahead) - target) / (1.02 * steep))
        quicker = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = new + (pace - 1) / quicker * (new - x)
        x, pace = new, quicker
    return x


def _take_fitted(patterns: np.ndarray, x: np.ndarray, left: np.ndarray) -> Iterator[tuple[tuple[int, ...], int]]:
    """Rounded repeat counts, the largest first, as far as the lengths last; full sequences only."""
    order = np.argsort(-x, kind="stable")
    order = order[x[order] > 1e-3]
    for pattern, wanted in zip(patterns[order].tolist(), np.maximum(1, np.rint(x[order])).astype(int).tolist()):
        own = [n for n in pattern if n]
        repeats = min([wanted, *(int(left[n]) // own.count(n) for n in set(own))])
        if repeats:
            for n in own:
                left[n] -= repeats
            yield tuple(own), repeats


def _take_rest(left: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over what is left: the longest piece, then always the longest that still fits."""
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return
        pattern: dict[int, int] = {}
        space = capacity
        while space:
            fits = lengths[:np.searchsorted(lengths, space, side="right")]
            n = next((n for n in reversed(fits.tolist()) if left[n] > pattern.get(n, 0)), None)
            if n is None:
                break
            pattern[n] = pattern.get(n, 0) + min(space // n, int(left[n]) - pattern.get(n, 0))
            space = capacity - sum(k * v for k, v in pattern.items())
        repeats = min(int(left[n]) // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= repeats * k
        yield tuple(n for n, k in pattern.items() for _ in range(k)), repeats


@dataclass
class Plan:
    """Runs of ranks by length: from a rank on, `copies` pieces a sequence from `sequence` on, the first at `offset`."""
    first: np.ndarray       # length << 40 | first rank, ascending
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    @classmethod
    def of(cls, histogram: np.ndarray, capacity: int) -> "Plan":
        left = histogram.astype(np.int64).copy()
        patterns = few_document_patterns(np.flatnonzero(left), capacity)
        rows, used, sequence = [], np.zeros(len(left), dtype=np.int64), 0
        taken = [*_take_fitted(patterns, fit_repeats(patterns, left), left), *_take_rest(left, capacity)]
        for pattern, repeats in taken:
            offset = 0
            for n in dict.fromkeys(pattern):
                copies = pattern.count(n)
                rows.append((n << 40 | int(used[n]), copies, sequence, offset))
                used[n] += copies * repeats
                offset += copies * n
            sequence += repeats
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
        return cls(*table.T, sequence)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.first, (length << 40) | rank, side="right") - 1
        k = rank - (self.first[run] & ((1 << 40) - 1))
        return self.sequence[run] + k // self.copies[run], self.offset[run] + k % self.copies[run] * length


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and one id 0; null and empty texts are that id alone. Only documents over the capacity
    are cut. Repeated rows are packed as often as they occur, null ids as any other; other columns are not read; an
    empty table gives no rows. The plan has a row per pattern and length: at most 3 * capacity^2 / 12 for the fitted
    patterns and a few thousand for the rest, some 40 MB at worst for 2048.
    """
    spark = docs.sparkSession
    pieces = cut_pieces(docs, id, text, path or public_tokenizers.path(VOCABULARY), capacity)
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():
        histogram[r["length"]] = r["count"]
    shared = spark.sparkContext.broadcast(Plan.of(histogram, capacity))

    parts = int(histogram.max()) // RANKED_AT_ONCE + 1
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "part").count().select(
        "length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1
    ranked = dealt.withColumn("within", within).join(counts, ["length", "part"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("place", place("length", F.col("before") + F.col("within"))).select(
        id, "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
