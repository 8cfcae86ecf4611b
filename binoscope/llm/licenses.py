"""License scans: exact phrases, and a fuzzy search for short notices.

The pigeonhole principle: a notice cut into k + 1 pieces has at least one piece unchanged wherever it stands with at
most k errors. So an automaton of all pieces finds every place that can hold a notice, and the regex library's
bounded-error matching verifies the text around such places and gives the span. The notices are a short list of the
caller, so nothing is shuffled or broadcast; each text is read whole by one task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from binoscope.llm.text import LOWER, WORDY, plain_words, texts_of

# The exact phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Short notices, and the labels of a fuzzy match.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "licensed under the apache license, version 2.0": "apache-2",
    "licensed under cc by-nc 4.0": "cc-by-nc",
    "creative commons attribution-noncommercial": "cc-by-nc",
    "licensed under the gnu general public license, version 3": "gpl-3",
    "licensed under the gnu general public license, version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms, with or without modification": "bsd",
    "mozilla public license, version 2.0": "mpl-2",
    "all rights reserved": "all-rights-reserved",
}
CHARACTERS_PER_ERROR = 14   # a notice of n characters may have n // 14 errors: substitutions, insertions, deletions


@dataclass
class Notice:
    text: str
    label: str
    errors: int
    pattern: regex.Pattern = field(init=False)

    def __post_init__(self):
        self.pattern = regex.compile(f"(?b)(?<![^\\W_])(?:{regex.escape(self.text)}){{e<={self.errors}}}(?![^\\W_])")

    def pieces(self) -> list[tuple[int, str]]:
        """(place, piece) of errors + 1 pieces of about equal length."""
        cuts = [len(self.text) * k // (self.errors + 1) for k in range(self.errors + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The notices' seeds in one automaton, and the phrases as word sequences."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str]):
        self.phrases = [(plain_words(p.encode()), label) for p, label in phrases.items()]
        self.exact = [(re.compile(rb"(?<![^ ])(?=" + b" +".join(map(re.escape, words)) + rb"(?![^ ]))"), words, label)
                      for words, label in self.phrases]
        self.notices = [Notice(t, label, len(t) // CHARACTERS_PER_ERROR) for t, label in notices.items()]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for at, piece in notice.pieces():
                seeds.setdefault(piece, []).append((number, at))
        self.seeds = ahocorasick.Automaton()
        for seed, owners in seeds.items():
            self.seeds.add_word(seed, (len(seed), owners))
        self.seeds.make_automaton()

    def places(self, text: bytes) -> tuple[int, list[int], list[str]]:
        """Number of words, the first word of each exact phrase, and its label."""
        folded = text.translate(WORDY)
        inside = np.frombuffer(folded, dtype=np.uint8) != 32
        begins = np.flatnonzero(inside & ~np.append(False, inside[:-1])) if len(folded) else np.empty(0, dtype=np.int64)
        starts, labels = [], []
        for pattern, words, label in self.exact:
            if words[0] in folded:
                own = np.fromiter((m.start() for m in pattern.finditer(folded)), dtype=np.int64)
                starts += np.searchsorted(begins, own).tolist()
                labels += [label] * len(own)
        return len(begins), starts, labels

    def fuzzy(self, text: str) -> list[tuple[int, int, str, int]]:
        """(start, end, label, errors) of every notice in a lower-cased text; any white space stands for a space."""
        single = " ".join(text.split())
        regions: dict[int, list[list[int]]] = {}
        for end, (length, owners) in self.seeds.iter(single):
            for number, at in owners:
                notice = self.notices[number]
                first = end + 1 - length - at - notice.errors
                start, stop = max(0, first), min(len(single), first + len(notice.text) + 2 * notice.errors)
                own = regions.setdefault(number, [])
                if own and start <= own[-1][1]:
                    own[-1] = [min(start, own[-1][0]), max(stop, own[-1][1])]
                else:
                    own.append([start, stop])
        found = {(m.start(), m.end(), self.notices[number].label, sum(m.fuzzy_counts))
                 for number, own in regions.items() for start, stop in own
                 for m in self.notices[number].pattern.finditer(single, start, stop)}
        if not found:
            return []
        places = [i for m in re.finditer(r"\S+", text) for i in range(m.start(), m.end() + 1)]
        return [(places[a], places[b - 1] + 1, label, errors) for a, b, label, errors in _best(sorted(found))]


def _best(spans: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Without the spans that overlap one with fewer errors (two versions of a license, say)."""
    kept, group, reach = [], [], -1
    for span in [*spans, None]:
        if span is None or span[0] >= reach:
            kept += [s for s in group if not any(o[3] < s[3] and o[0] < s[1] and s[0] < o[1] for o in group)]
            group = []
        if span:
            group.append(span)
            reach = max(reach, span[1])
    return kept


def scan_text(text: bytes | None, scanner: Scanner) -> dict:
    n, starts, base = scanner.places(text or b"")
    spans = scanner.fuzzy((text or b"").translate(LOWER).decode())
    best = 1.0 if base else max((1 - e / max(1, b - a) for a, b, _, e in spans), default=0.0)
    return {"n_words": n, "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(set(base))), "labels": ",".join(sorted({*base, *(s[2] for s in spans)})),
            "score": max(0.0, best), "spans": [dict(zip(("start", "end", "label", "errors"), s)) for s in spans]}


SCAN = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<start:long,end:long,label:string,errors:int>>")
_ARROW = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
          "labels": pa.string(), "score": pa.float64(),
          "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("errors", pa.int32())]))}


def scan_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
                  notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    A base place is where a phrase's words stand consecutively; several phrases or overlapping places all count. Spans
    are the fuzzy matches in characters, with their label and number of errors. The score is 1 with a base place, else
    1 less the errors per character of the best span, else 0. Null and empty texts have no words and no labels (empty
    strings, null word places); repeated rows give repeated results; other columns are not read.
    """
    def scan(batches):
        scanner = Scanner(phrases, notices)
        for batch in batches:
            rows = [scan_text(t, scanner) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[c] for r in rows], kind) for c, kind in _ARROW.items()]],
                                             names=[id, *_ARROW])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(scan, f"`{id}` {kind}, {SCAN}")
