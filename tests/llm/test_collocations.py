"""Collocations by prefix-free parsing against counting every n-gram of every text."""

import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from helpers_llm import documents, edge_texts, prose
from pyspark.sql import functions as F

from binoscope.llm import collocations as co


def brute(rows, least, top=2_000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i:i + k])] += 1
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            score, cut = min(((1000 * a * totals[lang]) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items())
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def text_of(rng, n):
    words = ["the", "of", "New", "york", "city", "in", "a", "b", "c'd", "été", "日本"]
    marks = ["", "", "", "", ",", ".", " ;", "\n", "\t", "\r\n", "?!", "\x0b"]
    return " ".join(rng.choice(["New York City", "in the", rng.choice(words)]) + rng.choice(marks) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    copy = text_of(rng, 120)
    own = [(t, None) for t in edge_texts() if t is None or len(t) < 40_000] + [(prose(300, 3), "en")]
    own += [(text_of(rng, rng.randrange(0, 150)), rng.choice(["en", "de", None])) for _ in range(60)]
    return own + [(copy, "en")] * 30 + [("x y z " * 400, "fr"), ("q" * 5_000 + " r " + "q" * 5_000, "fr"), ("one two. one two. one two", "fr")]


def found(table):
    return sorted(tuple(r) for r in table.collect())


@pytest.mark.parametrize("chunk, bits, tokens, held", [(32, 1 << 26, 1_000_000, 2_000_000), (3, 1 << 15, 200, 50), (1, 1 << 20, 5_000, 1)])
def test_collocations_match_brute_force(spark, rows, chunk, bits, tokens, held, monkeypatch):
    """Also with a bitmap so small that it lets everything through, and with loads and sums cut short."""
    monkeypatch.setattr(co, "FILTER_BITS", bits)
    monkeypatch.setattr(co, "LOAD_TOKENS", tokens)
    monkeypatch.setattr(co, "HELD_HASHES", held)
    monkeypatch.setattr(co.cuts, "__defaults__", (co.OVERLAP, chunk))
    docs = documents(spark, [(k, t, l) for k, (t, l) in enumerate(rows)])
    table = co.collocations(docs, least=12)
    assert table.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"),
                            ("n", "bigint"), ("score", "bigint")]
    assert found(table) == brute(rows, 12)
    assert found(co.collocations(docs, least=20, top=3)) == brute(rows, 20, 3)


def test_equal_passages_are_cut_alike():
    rng = random.Random(3)
    passage = [f"w{rng.randrange(50)}".encode() for _ in range(400)]
    hashes = co._Hashes()

    def chunks(tokens):
        begins = co.cuts(tokens, hashes)
        return [b" ".join(tokens[a:None if b is None else b + co.OVERLAP]) for a, b in zip(begins, [*begins[1:], None])]
    one, other = chunks([b"a"] * 7 + passage), chunks([b"b"] * 90 + passage + [b"c"] * 5)
    assert len(one) > 5 and set(one[2:-1]) <= set(other)     # the windows of the first cut may reach before the passage


def test_dictionary_keeps_one_row_for_copies(spark):
    text = prose(2_000, 1)
    one, many = (co.parse(documents(spark, [(k, text, "en") for k in range(n)]), "text", "lang") for n in (1, 25))
    assert many.count() == one.count() and {r.n for r in many.collect()} == {25}


def test_words_hash_as_in_spark(spark):
    words = ["a", "été", "日本語" * 30, "x" * 100]
    table = spark.createDataFrame([("en", w) for w in words], "lang string, word string")
    mine = [xxhash.xxh64_intdigest(w.encode(), xxhash.xxh64_intdigest(b"en", 42)) for w in words]
    assert [r.h % 2**64 for r in table.select(F.xxhash64("lang", "word").alias("h")).collect()] == mine


def test_products_beyond_64_bits(spark):
    """Scores of counts near 10^12 stay exact."""
    a, n, l, r = 10**12 - 7, 10**13 - 3, 10**12 + 5, 10**12 + 11
    counts = spark.createDataFrame([("en", "u v", a), ("en", "u", l), ("en", "v", r)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    kept = co.frequent
    try:
        co.frequent = lambda *_: (counts, totals)
        assert [x.score for x in co.collocations(documents(spark, [])).collect()] == [1000 * a * n // (l * r)]
    finally:
        co.frequent = kept


def test_empty_table_and_clashing_names(spark):
    assert co.collocations(documents(spark, [])).count() == 0
    assert co.collocations(documents(spark, [(1, None), (2, ""), (3, " . ")])).count() == 0
    extra = documents(spark, [(k, "Alpha beta", "en", "x", 1, 2) for k in range(3)], ", phrase string, n int, chunk int")
    assert found(co.collocations(extra, least=3)) == brute([("Alpha beta", "en")] * 3, 3)
