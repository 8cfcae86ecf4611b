"""Phrase collocations by prefix-free parsing: n-grams are counted once per distinct chunk and weighted by its frequency.

1. A text is a run of words with marks between its pieces. Wherever the hash of OVERLAP words in a row hits a fixed
   residue a chunk begins, so equal passages are cut alike wherever they stand. A chunk reaches OVERLAP words into the
   next one; its own n-grams are those that begin before the next chunk, so each n-gram of the corpus has one owner and lies
   wholly inside it.
2. Equal chunks are grouped: the dictionary with its parse frequencies. Copies and shared passages cost nothing more.
3. All words of the dictionary are counted, then pairs of frequent words by a 64-bit hash, then all n-grams whose pairs may
   be frequent, exactly and by their text. What may be frequent stands in two bitmaps of FILTER_BITS bits: a bit too many only
   lets an infrequent n-gram be counted for nothing, so the size of the bitmaps never touches the result.
4. Candidates meet the counts of their parts in joins.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binoscope.llm.shared import written
from binoscope.llm.text import texts_of

MOST_WORDS = 5
LEAST_COUNT = 100
TOP = 2_000
CHUNK_WORDS = 32                # of a chunk, on average
OVERLAP = MOST_WORDS - 1
FILTER_BITS = 1 << 26           # of each bitmap: 8 MB
LOAD_TOKENS = 1_000_000         # tokens that a task counts together
HELD_HASHES = 2_000_000         # pair hashes that a task adds up before it passes them on
UNKNOWN = "und"

_MARK = b"\xff"                 # between pieces; no byte of UTF-8
# White space and marks of the contract, A-Z lower-cased.
_CUT = bytes(255 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEED = 42
_FIRST, _SECOND, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)
_MOST_CACHED = 500_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def tokens_of(text: bytes) -> list[bytes]:
    """Words and marks between pieces."""
    return text.translate(_CUT).replace(_MARK, b" \xff ").split()


def cuts(tokens: list[bytes], hashes: dict[bytes, int], overlap: int = OVERLAP, chunk: int = CHUNK_WORDS) -> list[int]:
    """Where chunks begin: at the first token, and at every window of `overlap` tokens whose hash hits the residue."""
    if len(tokens) <= overlap:
        return [0]
    each = np.fromiter(map(hashes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    total = np.zeros(len(tokens) - overlap + 1, dtype=np.uint64)
    for k in range(overlap):
        total = total * _FIRST + each[k:k + len(total)]
    total = (total ^ (total >> _TURN)) * _SECOND
    hit = np.flatnonzero((total >> np.uint64(33)) % np.uint64(chunk) == 0)
    return [0, *hit[hit > 0].tolist()]


def parse(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, chunk, own, n): distinct chunks, how many of their tokens are their own, and their parse frequency."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()

        def rows(found: Counter) -> pa.RecordBatch:
            langs, parts, own = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary()), pa.array(own, pa.int32()),
                                               pa.array([*found.values()], pa.int64())], names=["lang", "chunk", "own", "n"])

        for batch in batches:
            found: Counter = Counter()
            for language, content in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                tokens = tokens_of(content or b"")
                if not tokens:
                    continue
                begins = cuts(tokens, hashes)
                for at, after in zip(begins, [*begins[1:], None]):
                    part = tokens[at:after if after is None else after + OVERLAP]
                    found[language, b" ".join(part), len(part) if after is None else after - at] += 1
                if len(found) >= 100_000:
                    yield rows(found)
                    found = Counter()
            yield rows(found)

    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), text)
    parsed = named.mapInArrow(chunks, "lang string, chunk binary, own int, n long")
    return parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


@dataclass
class Load:
    """Chunks laid end to end: a word number for each token, -1 for a mark and between chunks."""
    words: list[bytes]
    language: list[str]             # of each word number
    token: np.ndarray
    owned: np.ndarray               # whether an n-gram that begins here is the chunk's own
    weight: np.ndarray

    def hashes(self) -> np.ndarray:
        """xxhash64(lang, word) as Spark has it."""
        seeds = {name: xxhash.xxh64_intdigest(name.encode(), _SEED) for name in set(self.language)}
        return np.fromiter((xxhash.xxh64_intdigest(w, seeds[name]) for w, name in zip(self.words, self.language)), dtype=np.uint64,
                           count=len(self.words))


def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[Load]:
    held: dict[str, list[tuple[bytes, int, int]]] = defaultdict(list)
    tokens = 0
    for batch in batches:
        for language, chunk, own, n in zip(*(c.to_pylist() for c in batch.columns)):
            held[language].append((chunk, own, n))
            tokens += chunk.count(b" ") + 2
            if tokens >= LOAD_TOKENS:
                yield _laid(held)
                held, tokens = defaultdict(list), 0
    if held:
        yield _laid(held)


def _laid(held: dict[str, list[tuple[bytes, int, int]]]) -> Load:
    number = count()
    words: list[bytes] = []
    language: list[str] = []
    token, owned, weight = [], [], []
    marks = []
    for name, rows in held.items():
        numbers: dict[bytes, int] = defaultdict(number.__next__)
        marks.append(numbers[_MARK])
        all_tokens = b" \xff ".join(c for c, _, _ in rows).split(b" ")
        token.append(np.fromiter(map(numbers.__getitem__, all_tokens), dtype=np.int64, count=len(all_tokens)))
        length = np.array([c.count(b" ") + 2 for c, _, _ in rows])
        length[-1] -= 1
        place = np.arange(len(all_tokens)) - np.repeat(np.cumsum(length) - length, length)
        owned.append(place < np.repeat(np.array([own for _, own, _ in rows]), length))
        weight.append(np.repeat(np.array([n for _, _, n in rows], dtype=np.int64), length))
        words.extend(numbers)
        language.extend([name] * len(numbers))
    token = np.concatenate(token)
    token[np.isin(token, marks)] = -1
    return Load(words, language, token, np.concatenate(owned), np.concatenate(weight))


def _summed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, first places, places of the keys among them, sums)."""
    own, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    total = np.zeros(len(own), dtype=np.int64)
    np.add.at(total, inverse, weight)
    return own, first, inverse, total


def count_words(dictionary: DataFrame) -> DataFrame:
    """(lang, phrase, n) of all words; the row without a phrase has the number of all words of its language."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for load in loads(batches):
            real = load.owned & (load.token >= 0)
            total = np.zeros(len(load.words), dtype=np.int64)
            np.add.at(total, load.token[real], load.weight[real])
            there = np.flatnonzero(total)
            whole: Counter = Counter()
            for k in there.tolist():
                whole[load.language[k]] += int(total[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([*(load.language[k] for k in there.tolist()), *whole], pa.string()),
                 pa.array([*(load.words[k].decode() for k in there.tolist()), *[None] * len(whole)], pa.string()),
                 pa.array([*total[there].tolist(), *whole.values()], pa.int64())], names=["lang", "phrase", "n"])

    return dictionary.mapInArrow(counted, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The low bits of a column `h` of 64-bit hashes, as a bitmap; the driver gets `bits` bits at most."""
    place = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    found = np.zeros(max(bits // 8, 4096), dtype=np.uint8)
    for r in parts.toLocalIterator():
        begin = (r["part"] - 1) * 4096
        found[begin:begin + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return found


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(8 * len(bits) - 1)
    return bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1


def _pairs(load: Load, hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs of words that may be frequent begin, and the pairs' hashes."""
    known = np.append(_has(words, hashes), False)           # the last is the mark's
    good = known[load.token]
    at = np.flatnonzero(good[:-1] & good[1:])
    mixed = hashes[load.token[at]] * _FIRST + hashes[load.token[at + 1]] * _SECOND
    return at, (mixed ^ (mixed >> _TURN)) * _FIRST


def count_pairs(dictionary: DataFrame, words: np.ndarray) -> DataFrame:
    """(h, n): occurrences of pairs of words that may be frequent, by the pair's hash."""
    shared = dictionary.sparkSession.sparkContext.broadcast(words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], names=["h", "n"])

        for load in loads(batches):
            at, pair = _pairs(load, load.hashes(), shared.value)
            own = load.owned[at]
            keys, _, _, sums = _summed(np.append(keys, pair[own]), np.append(sums, load.weight[at[own]]))
            if len(keys) >= HELD_HASHES:
                yield rows()
                keys, sums = keys[:0], sums[:0]
        yield rows()

    return dictionary.mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def count_phrases(dictionary: DataFrame, words: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """(lang, phrase, n) of the n-grams of 2 words and more whose pairs may all be frequent."""
    shared = dictionary.sparkSession.sparkContext.broadcast((words, pairs))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = shared.value
        for load in loads(batches):
            at, pair = _pairs(load, load.hashes(), words)
            at = at[_has(pairs, pair)]
            follows = np.zeros(len(load.token) + 1, dtype=bool)     # a pair that may be frequent begins here
            follows[at] = True
            key = load.token[at]                                    # of the n-gram without its last word
            languages, phrases, numbers = [], [], []
            for size in range(2, MOST_WORDS + 1):
                _, first, inverse, _ = _summed(key << 32 | load.token[at + size - 1], np.zeros(len(at), dtype=np.int64))
                total = np.zeros(len(first), dtype=np.int64)
                own = load.owned[at]
                np.add.at(total, inverse[own], load.weight[at[own]])
                for k in np.flatnonzero(total).tolist():
                    begin = at[first[k]]
                    part = load.token[begin:begin + size].tolist()
                    languages.append(load.language[part[0]])
                    phrases.append(b" ".join([load.words[t] for t in part]).decode())
                    numbers.append(int(total[k]))
                longer = follows[at + size - 1]
                at, key = at[longer], inverse[longer]
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(phrases, pa.string()), pa.array(numbers, pa.int64())],
                                             names=["lang", "phrase", "n"])

    return dictionary.mapInArrow(counted, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, text: str, lang: str, least: int) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of everything from one to MOST_WORDS words with f >= least, (lang, n) of all words)."""
    dictionary = written(parse(docs, text, lang), "chunks")
    words = written(count_words(dictionary).where(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    single = words.where(F.col("phrase").isNotNull())
    known = bitmap(single.select(F.xxhash64("lang", "phrase").alias("h")), FILTER_BITS)
    pairs = bitmap(count_pairs(dictionary, known).where(F.col("n") >= least).select("h"), FILTER_BITS)
    phrases = written(count_phrases(dictionary, known, pairs).where(F.col("n") >= least), "phrases")
    return (single.unionByName(phrases).withColumnRenamed("n", "f"), words.where(F.col("phrase").isNull()).select("lang", "n"))


def _joined(words, begin, length):
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best `top` phrases of 2 to MOST_WORDS words.

    Null and empty texts have no words; a null language is UNKNOWN. Repeated rows count as often as they occur. Other columns
    are not read, whatever their names; an empty table gives no rows. Counts and scores are whole numbers: products are
    decimals of 38 digits. Ties are ordered by a, then by the phrase's bytes.
    """
    counts, totals = frequent(docs, text, lang, least)
    split = counts.withColumn("words", F.split("phrase", " ", -1)).withColumn("k", F.size("words"))
    candidates = split.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "words", "k")

    parts = candidates.select("lang", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    parts = parts.select("lang", "phrase", "a", "cut", _joined("words", F.lit(1), F.col("cut")).alias("first"),
                         _joined("words", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    left, right = counts.toDF("lang", "first", "l"), counts.toDF("lang", "rest", "r")
    whole = parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    a, n, l, r = (F.col(c).cast("decimal(19,0)") for c in "anlr")
    scored = whole.select("lang", "phrase", "a", "n", "cut", "l", "r", (F.lit(1000).cast("decimal(4,0)") * a * n).alias("over"), (l * r).alias("under"))
    scored = scored.withColumn("score", F.expr("over div under"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("least"))

    sizes = F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")
    inner = candidates.where("k > 2").select("lang", "a", "words", "k", sizes)
    inner = inner.select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("begin"))
    inner = inner.select("lang", "a", _joined("words", F.col("begin"), F.col("size")).alias("phrase"))
    inside = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))

    kept = lowest.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("least.a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return kept.select("lang", "phrase", "least.score", "least.l", "least.r", "least.a", "least.n") \
               .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top) \
               .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
