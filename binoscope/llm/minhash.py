"""MinHash near-dedup: universal hash minima, banding, signature verification, and connected components.

1. One pass over the texts gives each document's set size, a 128-bit fingerprint of its set, and its band keys.
   Documents with the same set form a class; only the class's smallest id goes on, so copies cost nothing further.
2. Classes that share a band key are candidates. Each is tied to the least class of the bucket, and large-star and
   small-star steps join the ties into candidate groups; no pairs within a bucket are made.
3. Inside a candidate group the signatures are compared, then the full sets, and only links that join two parts go out:
   at most one per class. A group larger than a block is compared block by block, so a task holds two blocks at most.
4. The confirmed links give the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binoscope.llm.components import components
from binoscope.llm.shared import written
from binoscope.llm.text import free_name, spaced_words, texts_of

WORDS = 5
PERCENT = 85
MINIMA = 252
MOST_MISSED = 3e-9              # the chance that a pair at the bound shares no band
DEVIATIONS = 6                  # of a signature's estimate, that pairs are compared below the bound
BLOCK_CLASSES, BLOCK_SHINGLES = 1_000, 1_000_000
MOST_BLOCKS = 16                # a larger candidate group is compared within its buckets instead

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_A = _RANDOM.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, MINIMA, dtype=np.uint64)
_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)
_AT_ONCE = 512
_MOST_CACHED = 400_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """The sorted set of 64-bit hashes of all runs of `words` words; a shorter text is one run."""
    own = spaced_words(text or b"")
    if not own:
        return np.empty(0, dtype=np.uint64)
    values = np.fromiter(map(hashes.__getitem__, own), dtype=np.uint64, count=len(own))
    size = min(words, len(own))
    total = np.full(len(own) - size + 1, size, dtype=np.uint64)
    for at in range(size):
        total = (total ^ values[at:len(own) - size + 1 + at]) * _MIX
        total ^= total >> _TURN
    return np.unique(total)


def signature(own: np.ndarray) -> np.ndarray:
    """The least value of each of MINIMA universal hashes (a x + b mod 2^64, upper half)."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(own), _AT_ONCE):
        part = own[at:at + _AT_ONCE, None] * _A
        part += _B
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> _TURN).astype(np.uint32)


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows), with as many rows as the bound allows: 42 of 6 at 85, 50 of 5 at 80."""
    rows = next((r for r in range(MINIMA, 1, -1) if (1 - (percent / 100) ** r) ** (MINIMA // r) <= MOST_MISSED), 1)
    return MINIMA // rows, rows


def least_estimate(percent: int) -> float:
    """The share of equal minima from which on two sets are compared in full."""
    share = percent / 100
    return share - DEVIATIONS * (share * (1 - share) / MINIMA) ** 0.5


def band_keys(minima: np.ndarray, percent: int = PERCENT) -> list[int]:
    bands, rows = banding(percent)
    value = np.arange(1, bands + 1, dtype=np.uint64) * _MIX
    for row in minima[:bands * rows].reshape(bands, rows).T.astype(np.uint64):
        value = (value ^ row) * _MIX
        value ^= value >> _TURN
    return value.view(np.int64).tolist()


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), dtype=np.int64).tolist())


def could_link(size: int, percent: int = PERCENT) -> bool:
    """Whether a set of this size can be similar to a different one: leaving out one member must stay within the bound."""
    return 100 * (size - 1) >= percent * size


def _summaries(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, prints, keys = [], [], []
        for text in texts_of(batch.column(1)):
            own = shingles(text, hashes)
            sizes.append(len(own))
            prints.append(fingerprint(own))
            keys.append(band_keys(signature(own), percent) if could_link(len(own) + 1, percent) else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
             pa.array([p[1] for p in prints], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            names=["id", "mark", "n", "h1", "h2", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        own = [shingles(t, hashes) for t in texts_of(batch.column(1))]
        prints = [fingerprint(s) for s in own]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
             pa.array([s.tobytes() for s in own], pa.binary()), pa.array([signature(s).tobytes() for s in own], pa.binary())],
            names=["rep", "h1", "h2", "members", "minima"])


def linked(one: np.ndarray, other: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


def joining_links(ids: list[int], sets: list[np.ndarray], minima: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Confirmed links that together join whatever any links join; the likeliest pairs are tried first."""
    sizes, least = np.array([len(s) for s in sets]), least_estimate(percent)
    found = []
    for i in range(len(ids) - 1):
        rest = slice(i + 1, None)
        fits = 100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])
        near = np.flatnonzero(fits) + i + 1
        if len(near):
            alike = (minima[near] == minima[i]).mean(axis=1)
            good = alike >= least
            found.append(np.stack((alike[good], np.full(int(good.sum()), i), near[good])))
    if not found:
        return []
    pairs = np.concatenate(found, axis=1)
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, j in pairs[1:, np.argsort(-pairs[0], kind="stable")].astype(int).T.tolist():
        one, other = root(i), root(j)
        if one != other and linked(sets[i], sets[j], percent):
            parent[other] = one
            links.append((ids[i], ids[j]))
    return links


def _confirm(block: pa.Table, percent: int) -> pa.Table:
    sets = [np.frombuffer(s, dtype=np.uint64) for s in block.column("members").to_pylist()]
    minima = np.frombuffer(b"".join(block.column("minima").to_pylist()), dtype=np.uint32).reshape(len(sets), MINIMA)
    links = joining_links(block.column("rep").to_pylist(), sets, minima, percent)
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _in_blocks(members: DataFrame) -> DataFrame:
    """(group, one, other, rep, h1, h2): each pair of blocks of a group is a task's work; a single block is a pair of itself."""
    totals = members.groupBy("group").agg(F.count("*").alias("classes"), F.sum("n").alias("size"))
    blocks = F.greatest(F.ceil(F.col("classes") / BLOCK_CLASSES), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("long")
    placed = members.join(totals.where("classes > 1").select("group", blocks.alias("blocks")), "group")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("rep", "h1"), F.col("blocks")))
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: (k != F.col("own")) | (F.col("blocks") == 1)))
    return placed.withColumn("k", other).select("group", F.least("own", "k").alias("one"), F.greatest("own", "k").alias("other"), "rep", "h1", "h2")


def _links(docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes."""
    bands = reps.select("rep", "h1", "h2", "n", F.explode("keys").alias("key"))
    least = bands.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    ties = bands.join(least.select("key", "least"), "key").where("rep > least").select("rep", "least")
    groups = written(components(ties, "rep", "least").withColumnRenamed("node", "rep"), "groups")
    sizes = reps.join(groups, "rep").groupBy("component").agg(
        (F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_SHINGLES) > MOST_BLOCKS).alias("large"))
    grouped = groups.join(sizes, "component")
    small = reps.join(grouped.where("not large"), "rep").select(F.col("component").alias("group"), "rep", "h1", "h2", "n")
    large = bands.join(grouped.where("large"), "rep").select(F.col("key").alias("group"), "rep", "h1", "h2", "n")
    blocks = _in_blocks(small).withColumn("by", F.lit(0)).unionByName(_in_blocks(large).withColumn("by", F.lit(1)))
    members = docs.join(groups.select(F.col("rep").alias("id")), "id", "left_semi").mapInArrow(
        _sets, "rep long, h1 long, h2 long, members binary, minima binary").dropDuplicates(["rep", "h1", "h2"])
    return (blocks.join(members, ["rep", "h1", "h2"]).select("by", "group", "one", "other", "rep", "members", "minima")
            .groupBy("by", "group", "one", "other").applyInArrow(lambda block: _confirm(block, percent), "a long, b long"))


def _judged(docs: DataFrame, id: str, text: str, percent: int) -> DataFrame:
    """A row per row of docs: id, mark (a hash of the text), n, component."""
    own = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    found = written(own.mapInArrow(lambda batches: _summaries(batches, percent), "id long, mark long, n long, h1 long, h2 long, keys array<long>"), "sets")
    filled = found.where("n > 0 and id is not null")
    classes = written(filled.groupBy("h1", "h2").agg(F.min("id").alias("rep")), "classes")
    reps = written(filled.where(F.size("keys") > 0).join(classes.withColumnRenamed("rep", "id"), ["h1", "h2", "id"])
                   .dropDuplicates(["h1", "h2", "id"]).withColumnRenamed("id", "rep"), "reps")
    joined = components(written(_links(own.drop("mark"), reps, percent), "links"), "a", "b")
    named = classes.join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = found.select("id", "mark", "n", "h1", "h2").join(named, ["h1", "h2"], "left")
    alone = F.col("id").isNull() | (F.col("n") == 0)
    return out.select("id", "mark", "n", F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are runs of anything but white space, A-Z lower-cased; a set holds the distinct runs of five words, or the
    whole of a shorter text. Sets with 100 * intersection >= percent * union are linked, and a component's name is its
    smallest id. Null, empty and blank texts have no set and are alone. A null id is in no component (component_id
    null, kept true); rows that repeat an id are judged by their own text; ids are whole numbers; other columns are not
    read; an empty table gives no rows.
    """
    return _judged(docs, id, text, percent).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                                          F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents whose id names their component, all columns as they are.

    Of rows with the same id and text one stays; rows without an id stay.
    """
    stays = _judged(docs, id, text, percent).where("id = component").select("id", F.coalesce("mark", F.lit(0)).alias("mark")).distinct()
    own_id, own_mark, number = free_name(docs, "whole_id"), free_name(docs, "mark"), free_name(docs, "number")
    keyed = docs.withColumn(own_id, F.col(id).cast("long")).withColumn(own_mark, F.coalesce(F.xxhash64(text), F.lit(0)))
    stays = stays.withColumnRenamed("id", own_id).withColumnRenamed("mark", own_mark)
    first = F.row_number().over(Window.partitionBy(own_id, own_mark).orderBy(own_id))
    named = keyed.join(stays, [own_id, own_mark], "left_semi").withColumn(number, first).where(F.col(number) == 1)
    return named.select(*docs.columns).unionByName(docs.where(F.col(id).isNull()))
