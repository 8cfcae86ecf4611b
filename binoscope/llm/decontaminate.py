"""Benchmark decontamination: an FM-index per shard of documents, searched backward for the phrases of a benchmark.

A shard is the part of the documents that one task reads at a time. Words that no phrase holds cannot lie in an
occurrence, so a shard's index covers the maximal runs of phrase words that are long enough for a phrase; nothing
that could match is left out. Phrases come in chunks of bounded size: each chunk is broadcast, and a task searches
its shard for one chunk after the other, so the benchmark may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binoscope.llm.text import WORDY, free_name, plain_words, texts_of

WINDOW = 10
CHUNK_WORDS = 2_000_000     # phrase words in one broadcast chunk (some 50 MB)
SHARD_TOKENS = 1_000_000    # tokens under one index
SAMPLED = 8                 # every eighth suffix position is kept

REPORT = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:long,end:long>>"


@dataclass
class Phrases:
    """One chunk: word numbers from 1, the distinct windows by length, and the items of each window."""
    numbers: dict[bytes, int]
    windows: dict[int, tuple[np.ndarray, list[list[str]]]]

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int) -> "Phrases":
        numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = tuple(numbers.setdefault(w, len(numbers) + 1) for w in words)
            for at in range(max(1, len(ids) - window + 1)):
                found.setdefault(ids[at:at + window], set()).add(item)
        windows = {}
        for length in sorted({len(w) for w in found}):
            own = [w for w in found if len(w) == length]
            windows[length] = (np.array(own, dtype=np.int32), [sorted(found[w]) for w in own])
        return cls(numbers, windows)


class Wavelet:
    """A wavelet tree in matrix form: rank(c, i) counts the symbol c before place i, for whole arrays at once."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for shift in reversed(range(max(1, int(largest).bit_length()))):
            bit = (symbols >> shift) & 1
            ones = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        first = np.zeros_like(place)
        for shift, ones, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            first = np.where(one, zeros + ones[first], first - ones[first])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - first


def suffix_order(tokens: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; each separator (0) is a symbol of its own, below all words."""
    ends = tokens == 0
    rank = tokens.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    step, n = 1, len(tokens)
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-step or None] = rank[step:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        if int(rank[order[-1]]) == n - 1 or step * 2 >= n:
            return order
        step *= 2


class FMIndex:
    """Backward search and location over a token sequence in which 0 separates runs and stands at the end."""

    def __init__(self, tokens: np.ndarray, largest: int):
        order = suffix_order(tokens)
        self.last = tokens[order - 1].astype(np.int64)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(tokens, minlength=largest + 1)))).astype(np.int64)
        self.tree = Wavelet(self.last, largest)
        # Run starts are sampled as well, so that walking back never has to pass a separator.
        kept = (order % SAMPLED == 0) | (self.last == 0)
        self.sampled = np.concatenate(([0], np.cumsum(kept)))
        self.positions = order[kept]
        self.kept = kept

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern number, low, high) of every pattern with an occurrence: its suffixes lie in [low, high)."""
        which = np.arange(len(patterns))
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.last), dtype=np.int64)
        for column in reversed(range(patterns.shape[1])):
            symbol = patterns[which, column].astype(np.int64)
            low = self.below[symbol] + self.tree.rank(symbol, low)
            high = self.below[symbol] + self.tree.rank(symbol, high)
            some = low < high
            which, low, high = which[some], low[some], high[some]
            if not len(which):
                break
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The token position of each suffix, by walking back to the next sampled one."""
        position, walked, open_ = np.zeros(len(rows), dtype=np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            at = rows[open_]
            done = self.kept[at]
            position[open_[done]] = self.positions[self.sampled[at[done]]] + walked
            open_, at = open_[~done], at[~done]
            symbol = self.last[at]
            rows[open_] = self.below[symbol] + self.tree.rank(symbol, at)
            walked += 1
        return position


def _shards(tokens: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The long enough runs of phrase words, in shards: (tokens with separators, place of each in the input)."""
    inside = np.concatenate(([0], (tokens != 0).astype(np.int8), [0]))
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    sizes = ends - starts + 1
    shard = np.cumsum(sizes) // SHARD_TOKENS
    for number in np.unique(shard):
        own = shard == number
        first, size = starts[own], sizes[own]
        place = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        run = tokens[np.minimum(place, len(tokens) - 1)].copy()
        run[np.cumsum(size) - 1] = 0
        yield run, place


def _occurrences(tokens: np.ndarray, phrases: Phrases) -> Iterator[tuple[np.ndarray, int, list[list[str]], np.ndarray]]:
    """(places of occurrences, length, items by window, window of each occurrence)."""
    for run, place in _shards(tokens, min(phrases.windows)):
        index = FMIndex(run, len(phrases.numbers))
        for length, (patterns, items) in phrases.windows.items():
            which, low, high = index.search(patterns)
            if len(which):
                count = high - low
                rows = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(int(count.sum()))
                yield place[index.locate(rows)], length, items, np.repeat(which, count)


def search_texts(texts: list[bytes | None], chunks: list[Phrases]) -> list[tuple[int, int, list[str], np.ndarray]]:
    """For each text: number of words, hit words, item ids as sorted strings, and the mask of its hit words."""
    words = [plain_words(t) if t else [] for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    edges = np.zeros(int(starts[-1]) + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for phrases in chunks:
        get, none = phrases.numbers.get, lambda n: [0] * n
        tokens = np.zeros(int(starts[-1]), dtype=np.int32)
        for own, at in zip(words, starts):
            tokens[at:at + len(own)] = np.fromiter(map(get, own, none(len(own))), dtype=np.int32, count=len(own))
        for places, length, of_window, window in _occurrences(tokens, phrases):
            np.add.at(edges, places, 1)
            np.add.at(edges, places + length, -1)
            owner = np.searchsorted(starts, places, side="right") - 1
            for pair in np.unique(owner * len(of_window) + window):
                items[pair // len(of_window)].update(of_window[pair % len(of_window)])
    hit = np.cumsum(edges) > 0
    masks = [hit[at:at + len(own)] for own, at in zip(words, starts)]
    return [(len(w), int(m.sum()), sorted(i), m) for w, i, m in zip(words, items, masks)]


def hit_spans(text: bytes, mask: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans [start, end) of the stretches of hit words, merged where hit words are neighbours."""
    inside = np.diff(np.frombuffer(b" " + text.translate(WORDY) + b" ", dtype=np.uint8) != 32, prepend=False)
    turns = np.flatnonzero(inside) - 1
    starts, ends = turns[::2], turns[1::2]
    turn = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return list(zip(starts[np.flatnonzero(turn == 1)].tolist(), ends[np.flatnonzero(turn == -1) - 1].tolist()))


def _in_characters(text: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(before[a]), "end": int(before[b])} for a, b in spans]


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def clean_texts(texts: list[bytes | None], chunks: list[Phrases]) -> list[bytes | None]:
    """The texts without hit words. What a cut brings together is searched again until nothing is found."""
    texts, open_ = list(texts), list(range(len(texts)))
    while open_:
        hits = search_texts([texts[i] for i in open_], chunks)
        open_, hits = [i for i, h in zip(open_, hits) if h[1]], [h for h in hits if h[1]]
        for i, h in zip(open_, hits):
            texts[i] = without_spans(texts[i], hit_spans(texts[i], h[3]))
    return texts


def broadcast_phrases(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> list:
    """Broadcasts of the phrases, each of at most CHUNK_WORDS words (or one item); items are fetched one by one."""
    context = benchmark.sparkSession.sparkContext
    chunks, items, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    for row in rows.toLocalIterator():
        words = plain_words((row["text"] or "").encode())
        if size and size + len(words) > CHUNK_WORDS:
            chunks.append(context.broadcast(Phrases.of(items, window)))
            items, size = [], 0
        if words:
            items.append((row["item"], words))
            size += len(words)
    if items:
        chunks.append(context.broadcast(Phrases.of(items, window)))
    return chunks


def find_benchmark(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_hit, item_ids (sorted strings), spans (character spans to remove).

    Words are runs of 0-9, a-z (after lower-casing A-Z) and characters beyond ASCII. A window is `window` consecutive
    words of an item; an item with fewer words is one window, one without words none. Null and empty texts have no
    words; repeated rows give repeated results; an empty benchmark hits nothing; an item without an id counts under
    the name "null". Columns other than id and text are not read.
    """
    chunks = broadcast_phrases(benchmark, text=text, window=window)

    def report(batches):
        own = [c.value for c in chunks]
        for batch in batches:
            texts = texts_of(batch.column(1))
            hits = search_texts(texts, own)
            spans = [_in_characters(t, hit_spans(t, h[3])) if h[1] else [] for t, h in zip(texts, hits)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h[0] for h in hits], pa.int64()), pa.array([h[1] for h in hits], pa.int64()),
                 pa.array([h[2] for h in hits], pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[id, "n_words", "n_hit", "item_ids", "spans"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(report, f"`{id}` {kind}, {REPORT}")


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: str | None = "n_chars", window: int = WINDOW) -> DataFrame:
    """The same rows and columns, without the words of benchmark windows in `text`; `length`, if there, follows the text.

    Punctuation and spacing around a cut stay. Texts without a window, null and empty texts are left as they are.
    """
    chunks = broadcast_phrases(benchmark, window=window)
    new = free_name(docs, "cut")

    def cut(batches):
        own = [c.value for c in chunks]
        for batch in batches:
            texts = clean_texts(texts_of(batch.column(batch.num_columns - 1)), own)
            yield batch.set_column(batch.num_columns - 1, new, pa.array(texts, pa.binary()).cast(pa.string()))

    moved = docs.withColumn(new, F.col(f"`{text}`")).drop(text)
    changed = moved.mapInArrow(cut, moved.schema)

    def column(name: str) -> Column:
        if name == text:
            return F.col(f"`{new}`").alias(text)
        if name == length:
            return F.length(f"`{new}`").cast(docs.schema[name].dataType).alias(name)
        return F.col(f"`{name}`")

    return changed.select(*[column(c) for c in docs.columns])
