"""BPE encoding and decoding with a public vocabulary: part boundaries and adjacent ranks in one short array per word.

A text is cut into words as the tokenizer's file says (special tokens, normalizer, split pattern). A word keeps two short
rows: the parts behind its boundaries, and the rank of joining each part with the next. The least rank is found by a scan,
its boundary is deleted, and the ranks of the two neighbours are looked up again, until no join is left. All new words of
a batch take these steps together, as rows of one array. Words longer than SHORT_WORD symbols keep their joins in a heap
over linked parts instead, so that a text without spaces costs n log n. Every task remembers the ids of the words it has
met, up to a bound.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from binoscope.llm.text import texts_of

VOCABULARY = "word_bpe_49k.json"
SHORT_WORD = 64             # symbols up to which a word is merged by scanning
LETTERS_AT_ONCE = 1_000_000 # of the texts that are cut together, and of one Arrow batch on the way out
WORDS_AT_ONCE = 20_000

_NEVER = 2**31 - 1
_SPECIAL = b"\xff"         # before special tokens among words; no byte of UTF-8
_MOST_CACHED = 200_000
# White space of the normalizer's pattern; Python's split() takes these four separators as well.
_SPACE = re.compile("[\x09-\x0d \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_PYTHON_ONLY = re.compile("[\x1c-\x1f]")


class Vocabulary:
    """The tokens, merge ranks and special tokens of a tokenizer file with word ends."""

    def __init__(self, path: str):
        told = json.loads(Path(path).read_text())
        model = told["model"]
        self.end: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        if not all(pair[0] + pair[1] in self.ids for pair in model["merges"]):
            raise ValueError("A join of the file has no token.")
        self.joined = np.array([self.ids[left + right] for left, right in model["merges"]], dtype=np.int32)
        pairs = np.array([self.ids[left] << 32 | self.ids[right] for left, right in model["merges"]], dtype=np.int64)
        self.rank_of = np.argsort(pairs).astype(np.int32)
        self.pairs = pairs[self.rank_of]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.byte_level = [chr(b) if b in printable else chr(next(rest)) for b in range(256)]
        self.byte_of = {c: b for b, c in enumerate(self.byte_level)}
        self.inner = np.array([self.ids[c] for c in self.byte_level], dtype=np.int32)
        self.final = np.array([self.ids[c + self.end] for c in self.byte_level], dtype=np.int32)
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in told["added_tokens"]):
            raise ValueError("Special tokens that take in spaces or normalized text are not supported.")
        self.special: dict[str, int] = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = np.empty(1 + max([*self.ids.values(), *self.special.values()]), dtype=object)
        for token, number in [*self.ids.items(), *self.special.items()]:
            self.tokens[number] = token

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of joining each left part with its right one, or _NEVER."""
        wanted = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[place] == wanted, self.rank_of[place], _NEVER)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids (32-bit numbers, as bytes) of each word."""
        found: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = 8
        while width < 2 * SHORT_WORD:
            # Words of like length share an array, so that short ones are not filled up to the longest.
            least, most = (0 if width == 8 else width // 2), min(width, SHORT_WORD)
            own = np.flatnonzero((size > least) & (size <= most))
            for begin in range(0, len(own), WORDS_AT_ONCE):
                some = own[begin:begin + WORDS_AT_ONCE]
                for k, ids in zip(some.tolist(), self._by_scan([words[k] for k in some.tolist()], size[some], most)):
                    found[k] = ids
            width *= 2
        for k in np.flatnonzero(size > SHORT_WORD).tolist():
            found[k] = self._by_heap(words[k])
        return found

    def _by_scan(self, words: list[bytes], size: np.ndarray, width: int) -> list[bytes]:
        """`parts` has a row of boundaries for each word, given as the part behind it; `ranks` the adjacent ranks."""
        column = np.arange(width)
        there = column < size[:, None]
        parts = np.zeros((len(words), width), dtype=np.int32)
        parts[there] = self.inner[np.frombuffer(b"".join(words), dtype=np.uint8)]
        parts[np.arange(len(words)), size - 1] = self.final[np.array([w[-1] for w in words])]
        ranks = np.full((len(words), width), _NEVER, dtype=np.int32)
        ranks[:, :-1] = np.where(there[:, 1:], self.ranks(parts[:, :-1], parts[:, 1:]), _NEVER)
        done, left = np.zeros_like(parts), size.copy()
        rows, many = np.arange(len(words)), size.copy()
        while len(rows):
            own = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            least = ranks[own, at]
            open_ = least < _NEVER
            if not open_.all():
                done[rows[~open_]], left[rows[~open_]] = parts[~open_], many[~open_]
                rows, many, parts, ranks, at, least = rows[open_], many[open_], parts[open_], ranks[open_], at[open_], least[open_]
                own = own[:len(rows)]
            if not len(rows):
                break
            parts[own, at] = self.joined[least]
            gone = at[:, None]
            parts = np.take_along_axis(parts, np.minimum(column + (column > gone), width - 1), axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(column + (column >= gone), width - 1), axis=1)
            many = many - 1
            after = np.minimum(at + 1, width - 1)
            ranks[own, at] = np.where(at + 1 < many, self.ranks(parts[own, at], parts[own, after]), _NEVER)
            later = np.flatnonzero(at)
            ranks[later, at[later] - 1] = self.ranks(parts[later, at[later] - 1], parts[later, at[later]])
        flat, ends = done[column < left[:, None]].tobytes(), np.cumsum(4 * left).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _by_heap(self, word: bytes) -> bytes:
        parts = self.inner[np.frombuffer(word, dtype=np.uint8)].tolist()
        parts[-1] = int(self.final[word[-1]])
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        first = self.ranks(np.array(parts[:-1], dtype=np.int32), np.array(parts[1:], dtype=np.int32)).tolist()
        heap = [(rank, i, parts[i] << 32 | parts[i + 1]) for i, rank in enumerate(first) if rank < _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            k = after[i]
            if parts[i] is None or k < 0 or parts[i] << 32 | parts[k] != pair:
                continue                            # one of the two has been joined since
            parts[i], parts[k] = int(self.joined[rank]), None
            after[i] = after[k]
            if after[k] >= 0:
                before[after[k]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0:
                    rank = int(self.ranks(np.array([parts[left]], dtype=np.int32), np.array([parts[right]], dtype=np.int32))[0])
                    if rank < _NEVER:
                        heapq.heappush(heap, (rank, left, parts[left] << 32 | parts[right]))
        return array("i", [p for p in parts if p is not None]).tobytes()

    def text(self, numbers: np.ndarray) -> str:
        """The tokens joined by spaces, as the file names no decoder; numbers that are no ids are left out."""
        known = numbers[(numbers >= 0) & (numbers < len(self.tokens))]
        return " ".join(t for t in self.tokens[known].tolist() if t is not None)


class Encoder:
    """Ids (32-bit numbers, as bytes) of texts; those of parts without white space are remembered up to a bound.

    Parts of plain letters, digits and marks are normalized and cut here; for all others the file's own normalizer and
    pattern are asked. The joining is the same for both.
    """
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    # The pattern of the file, for these characters.
    CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.library = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        special = self.vocabulary.special
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")

    def cut(self, part: str) -> list[bytes]:
        """The words of a part without special tokens, as bytes."""
        if self.PLAIN.fullmatch(part):
            return [w.encode() for w in self.CUT.findall(part.lower())]
        byte_of = self.vocabulary.byte_of
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [bytes(byte_of[c] for c in w) for w, _ in cut]

    def learn(self, parts: Iterable[str]) -> None:
        """Ids of all these parts, their new words joined together."""
        cut: dict[str, list[bytes]] = {}
        for part in parts:
            cut[part] = words = []
            begin = 0
            for m in self.special.finditer(part):
                words += self.cut(part[begin:m.start()]) if begin < m.start() else []
                words.append(_SPECIAL + m[0].encode())
                begin = m.end()
            words += self.cut(part[begin:]) if begin < len(part) else []
        wanted = set().union(*cut.values())
        if len(self.words) + len(wanted) > _MOST_CACHED:
            self.words = {}
        new = [w for w in wanted if w not in self.words]
        ordinary = [w for w in new if not w.startswith(_SPECIAL)]
        self.words |= zip(ordinary, self.vocabulary.merge(ordinary))
        for w in new:
            if w.startswith(_SPECIAL):
                self.words[w] = array("i", [self.vocabulary.special[w[len(_SPECIAL):].decode()]]).tobytes()
        known = self.words.__getitem__
        for part, words in cut.items():
            self.parts[part] = b"".join(map(known, words))

    def of(self, texts: list[str]) -> list[bytes]:
        split = [_SPACE.split(t) if _PYTHON_ONLY.search(t) else t.split() for t in texts]
        wanted = set().union(*split) - {""}
        if len(self.parts) + len(wanted) > _MOST_CACHED:
            self.parts = {}
        self.learn(wanted - self.parts.keys())
        known = self.parts.__getitem__
        return [b"".join(map(known, filter(None, parts))) for parts in split]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, ids: str = "ids") -> DataFrame:
    """(id, ids): the token ids of every whole text, as array<int>.

    Null and empty texts have no ids (an empty array). Every row gives one row, repeated rows and null ids too; other
    columns are not read, whatever their names; an empty table gives none. No shuffle; a task holds one batch of texts,
    cut LETTERS_AT_ONCE letters at a time, and its bounded memory of parts and words.
    """
    place = path or public_tokenizers.path(VOCABULARY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(place)
        for batch in batches:
            held: list[str] = []
            begin = letters = 0
            for row, content in enumerate(texts_of(batch.column(1))):
                held.append((content or b"").decode())
                letters += len(held[-1])
                if letters >= LETTERS_AT_ONCE or row == batch.num_rows - 1:
                    found = own.of(held)
                    offsets = np.cumsum([0, *map(len, found)]) // 4
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(found)), lists], names=[id, ids])
                    begin, letters, held = row + 1, 0, []

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(cut, f"`{id}` {kind}, `{ids}` array<int>")


def decode(ids: str | Column, path: str | None = None) -> Column:
    """The text of an array<int> column of ids: the tokens joined by single spaces, special tokens included.

    A null array has a null text, an empty one the empty text; numbers that are no ids are left out.
    """
    place = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf("string")
    def joined(lists: pa.Array) -> pa.Array:
        vocabulary = encoder(place).vocabulary
        return pa.array([None if x is None else vocabulary.text(np.array(x, dtype=np.int64)) for x in _rows(lists)], pa.string())

    return joined(F.col(ids) if isinstance(ids, str) else ids)


def _rows(lists: pa.ListArray) -> Iterator[np.ndarray | None]:
    """The rows of a list array as slices of its values; null numbers count as -1."""
    values = lists.values.fill_null(-1).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy(zero_copy_only=False)
    for k, known in enumerate(lists.is_valid().to_numpy(zero_copy_only=False)):
        yield values[offsets[k]:offsets[k + 1]] if known else None
