"""Ranked lexical search: document intervals, best first, bounded by range maxima over posting lists.

1. The queries are cut into blocks of a bounded number of terms. For a block, one pass over the texts keeps of each
   document its length and how often it holds each of the block's terms; that table is the index, written once.
2. Document counts, lengths and document frequencies are sums over the index, and give every term its weight and every
   posting its impact.
3. A task gathers documents into shards of a bounded number of postings, in the order of their ids. Each term's posting
   list has a sparse table that names the strongest posting of any stretch of it.
4. A query starts from the whole shard. The bound of a document interval is the weighted sum of its range maxima, so no
   document in it can score higher. The intervals with the highest bounds are split at the strongest document of their
   strongest term: that document is scored, the two sides get bounds of their own, and intervals that cannot reach the
   k-th score are dropped. What is left when no interval is open are the shard's best documents, exactly.
5. The best of all shards are ranked per query, in two steps, so that no task gets the candidates of all shards at once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from binoscope.llm.shared import written
from binoscope.llm.text import plain_words, texts_of

TOP = 20
SATURATION = 12                 # tf / (tf + 1.2 m), in tenths
LENGTH_SHARE = 25               # per cent of m that follows the document's length
BLOCK_TERMS = 200_000           # term occurrences of the queries that are searched, and broadcast, together
SHARD_POSTINGS = 1_000_000
CELLS = 8_000_000               # (interval, term) pairs that a search may have open
SALTS = 64

_FIRST_SPLITS, _MOST_SPLITS = 16, 1_024


@dataclass
class Query:
    """One query of a block: its number, its distinct terms by number, and how often it has each."""
    number: int
    terms: np.ndarray
    repeats: np.ndarray


def blocks(rows: Iterable[Row], most: int) -> Iterator[tuple[list, list[Query], dict[bytes, int]]]:
    """(ids, queries, term numbers) of consecutive queries; a block has at most `most` term occurrences, or one query."""
    ids: list = []
    queries: list[Query] = []
    numbers: dict[bytes, int] = {}
    held = 0
    for identity, text in rows:
        counts = Counter(plain_words((text or "").encode()))
        if not counts:
            continue
        if ids and held + len(counts) > most:
            yield ids, queries, numbers
            ids, queries, numbers, held = [], [], {}, 0
        terms = np.array([numbers.setdefault(t, len(numbers)) for t in counts], dtype=np.int64)
        queries.append(Query(len(ids), terms, np.array([*counts.values()], dtype=np.int64)))
        ids.append(identity)
        held += len(counts)
    if ids:
        yield ids, queries, numbers


def index_terms(docs: DataFrame, id: str, text: str, numbers: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts): words of each document, and the numbers and occurrences of the wanted terms in it."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value.get
        for batch in batches:
            sizes, own, rows = [], [], []
            for row, content in enumerate(texts_of(batch.column(1))):
                words = plain_words(content or b"")
                sizes.append(len(words))
                found = np.array([t for t in map(wanted, words) if t is not None], dtype=np.int64)
                terms, times = np.unique(found, return_counts=True)
                own.append(terms)
                rows.append(times)
            offsets = pa.array(np.cumsum([0, *map(len, own)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *own]).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int32)))],
                names=["id", "n", "terms", "counts"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(count, f"id {kind}, n long, terms array<int>, counts array<int>")


class Shard:
    """Posting lists of a shard's documents, one behind the other by (term, document), with their sparse table."""

    def __init__(self, terms: np.ndarray, documents: np.ndarray, impacts: np.ndarray, size: int):
        order = np.lexsort((documents, terms))
        self.size = size
        self.documents = documents[order]
        self.keys = terms[order] * size + self.documents
        # One posting more than there are, weaker than all: what an empty stretch points at.
        self.impacts = np.append(impacts[order], 0)
        self.none = len(order)
        longest = int(np.bincount(terms).max()) if len(terms) else 1
        # levels[j][i] is the first strongest posting of i .. i + 2^j - 1. Stretches that run over the end of a list
        # are filled as well and never asked for.
        self.levels = [np.arange(len(order), dtype=np.int32)]
        while 2 << (len(self.levels) - 1) <= longest:
            half, below = 1 << (len(self.levels) - 1), self.levels[-1]
            left, right = below, np.append(below[half:], below[-half:])
            self.levels.append(np.where(self.impacts[right] > self.impacts[left], right, left).astype(np.int32))
        self.table = np.stack(self.levels) if len(order) else np.empty((1, 0), dtype=np.int32)
        self.log = np.zeros(longest + 1, dtype=np.int8)
        for k in range(1, len(self.levels)):
            self.log[1 << k:] = k

    def place(self, terms: np.ndarray, document) -> np.ndarray:
        """Where each term's postings from this document on begin."""
        return np.searchsorted(self.keys, terms * self.size + document)

    def strongest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first strongest posting of each stretch low .. high - 1."""
        empty = high <= low
        if not self.none:
            return np.full(low.shape, self.none)
        level = self.log[np.where(empty, 1, high - low)]
        low = np.where(empty, 0, low)
        left = self.table[level, low]
        right = self.table[level, np.where(empty, 0, high - (1 << level.astype(np.int64)))]
        return np.where(empty, self.none, np.where(self.impacts[right] > self.impacts[left], right, left))


@dataclass
class Open:
    """Document intervals that may still hold a result; low and high are their stretches of the query's lists."""
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray       # the interval's first document: ties go to the earliest
    bound: np.ndarray
    split: np.ndarray       # the document to split at

    def take(self, rows: np.ndarray) -> "Open":
        return Open(self.low[rows], self.high[rows], self.first[rows], self.bound[rows], self.split[rows])

    def and_(self, other: "Open") -> "Open":
        return Open(*(np.concatenate(pair) for pair in zip(vars(self).values(), vars(other).values())))


def best_documents(shard: Shard, terms: np.ndarray, weights: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, intervals split): the `top` best scores above 0 and not below `least`, earliest documents first on ties."""
    known = weights > 0
    terms, weights = terms[known], weights[known]
    best, scores, splits = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), 0
    if not len(terms) or not shard.none:
        return best, scores, splits

    def bounded(low: np.ndarray, high: np.ndarray, first: np.ndarray) -> Open:
        strongest = shard.strongest(low, high)
        parts = weights * shard.impacts[strongest]
        leading = strongest[np.arange(len(low)), parts.argmax(axis=1)]
        found = Open(low, high, first, parts.sum(axis=1), np.append(shard.documents, 0)[leading])
        return found.take(found.bound > 0)

    def alive(found: Open) -> Open:
        """Without the intervals that can no longer give a result."""
        keep = found.bound >= least
        if len(best) == top:
            keep &= (found.bound > scores[-1]) | ((found.bound == scores[-1]) & (found.first < best[-1]))
        return found if keep.all() else found.take(keep)

    stretch = max(1, min(shard.size, CELLS // (2 * len(terms))))
    for begin in range(0, shard.size, stretch):
        end = min(begin + stretch, shard.size)
        still = alive(bounded(shard.place(terms, begin)[None], shard.place(terms, end)[None], np.array([begin])))
        width = _FIRST_SPLITS
        most = max(1, min(_MOST_SPLITS, CELLS // (8 * len(terms))))
        while len(still.bound):
            width = min(2 * width, most)
            rows = np.argpartition(-still.bound, width - 1)[:width] if len(still.bound) > width else np.arange(len(still.bound))
            rest = np.ones(len(still.bound), dtype=bool)
            rest[rows] = False
            now, still = still.take(rows), still.take(rest)
            splits += len(rows)
            place = shard.place(terms, now.split[:, None])
            there = (place < now.high) & (shard.keys[np.minimum(place, shard.none - 1)] == terms * shard.size + now.split[:, None])
            own = (np.where(there, shard.impacts[place], 0) * weights).sum(axis=1)
            found, given = np.append(best, now.split), np.append(scores, own)
            good = given >= max(least, 1)
            found, given = found[good], given[good]
            order = np.lexsort((found, -given))[:top]
            best, scores = found[order], given[order]
            sides = bounded(np.concatenate((now.low, place + there)), np.concatenate((place, now.high)),
                            np.concatenate((now.first, now.split + 1)))
            still = alive(still.and_(sides))
    return best, scores, splits


@dataclass
class Scoring:
    """The corpus sums: documents with a word, their words, and the weight of each term of the block."""
    documents: int
    words: int
    weight: np.ndarray

    @classmethod
    def of(cls, documents: int, words: int, frequency: np.ndarray) -> "Scoring":
        return cls(documents, words, np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()],
                                              dtype=np.int64))

    def impact(self, times: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - LENGTH_SHARE + LENGTH_SHARE * n * self.documents // self.words
        return 1_000_000_000 * times // (1_000 * times + SATURATION * m)


def search_shards(index: DataFrame, queries: list[Query], scoring: Scoring, top: int) -> DataFrame:
    """(query, id, score): the best documents of every shard for every query of the block."""
    shared = index.sparkSession.sparkContext.broadcast((queries, scoring))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, scoring = shared.value
        least = [0] * len(queries)      # the top-th score so far in this task, which later shards have to reach

        def searched(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            rows = rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending")], null_placement="at_end"))
            terms, times = (rows[c].combine_chunks() for c in ("terms", "counts"))
            each = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
            document = np.repeat(np.arange(rows.num_rows), each)
            n = np.repeat(rows["n"].to_numpy(), each)
            impacts = scoring.impact(times.flatten().to_numpy().astype(np.int64), n)
            shard = Shard(terms.flatten().to_numpy().astype(np.int64), document, impacts, rows.num_rows)
            number, place, score = [], [], []
            for q in queries:
                best, scores, _ = best_documents(shard, q.terms, q.repeats * scoring.weight[q.terms], top, least[q.number])
                if len(best) == top:
                    least[q.number] = max(least[q.number], int(scores[-1]))
                number.append(np.full(len(best), q.number))
                place.append(best)
                score.append(scores)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(number), pa.int32()), rows["id"].take(pa.array(np.concatenate(place))).combine_chunks(),
                 pa.array(np.concatenate(score), pa.int64())], names=["query", "id", "score"])

        held: list[pa.RecordBatch] = []
        postings = 0
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            begin = passed = 0
            while begin < batch.num_rows:
                cut = int(np.searchsorted(ends, passed + SHARD_POSTINGS - postings, side="right"))
                cut = max(cut, begin + (not held))       # a document of more postings is a shard by itself
                if cut > begin:
                    held.append(batch.slice(begin, cut - begin))
                    postings += int(ends[cut - 1]) - passed
                    begin, passed = cut, int(ends[cut - 1])
                if begin < batch.num_rows:
                    yield searched(held)
                    held, postings = [], 0
        if held:
            yield searched(held)

    kind = index.schema["id"].dataType.simpleString()
    return index.where(F.size("terms") > 0).mapInArrow(search, f"query int, id {kind}, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """(query, rank, id, score): the best of all shards; the candidates meet in salted parts first."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    part = Window.partitionBy("query", "salt").orderBy(*order)
    least = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top).drop("salt", "rank")
    return least.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)


def rank_documents(docs: DataFrame, queries: DataFrame, id: str = "doc_id", text: str = "text", query_id: str = "item_id",
                   query_text: str = "text", top: int = TOP) -> DataFrame:
    """(query id, rank, document id, score): every query's `top` best documents with a score above 0.

    A document without a term is not counted, and null, empty or wordless texts never appear; a query without a term has
    no rows. Rows are documents and queries of their own: repeated document rows each take a rank, in any order on equal
    ids; repeated query rows each have their ranks. Null ids count as any other and come last on ties. Other columns are
    not read. Empty tables give no rows. The queries pass the driver block by block (BLOCK_TERMS); each block is a pass
    over the texts.
    """
    spark = docs.sparkSession
    own, other = docs.select(id).schema[0].dataType.simpleString(), queries.select(query_id).schema[0].dataType.simpleString()
    if id.lower() == query_id.lower():
        raise ValueError("Documents and queries need id columns of different names.")
    results: list[DataFrame] = []
    for names, block, numbers in blocks(queries.select(query_id, query_text).toLocalIterator(), BLOCK_TERMS):
        index = written(index_terms(docs, id, text, numbers), "postings")
        sums = index.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("words")).first()
        frequency = np.zeros(len(numbers), dtype=np.int64)
        for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            frequency[r["term"]] = r["count"]
        scoring = Scoring.of(sums["documents"], sums["words"] or 1, frequency)
        best = written(ranked(search_shards(index, block, scoring, top), top), "ranked")
        named = spark.createDataFrame(list(enumerate(names)), f"query int, `{query_id}` {other}")
        results.append(best.join(F.broadcast(named), "query").select(query_id, F.col("rank").cast("int").alias("rank"),
                                                                     F.col("id").alias(id), "score"))
    if not results:
        return spark.createDataFrame([], f"`{query_id}` {other}, rank int, `{id}` {own}, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole
