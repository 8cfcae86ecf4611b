"""Decontamination, license scans and URL filters against brute force."""

import hashlib
import re

import numpy as np
import pytest
from helpers_llm import documents, edge_texts, prose

from binoscope.llm import decontaminate as dc
from binoscope.llm import licenses, urls

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    own, hit, found = words(text), set(), set()
    for item, content in items:
        w = words(content)
        for size in {min(10, len(w))} - {0}:
            windows = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
            for at in range(len(own) - size + 1):
                if tuple(own[at:at + size]) in windows:
                    hit.update(range(at, at + size))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.fixture(scope="module")
def items():
    return [(k, prose(14 + k, 100 + k)) for k in range(6)] + [(50, "short one"), (51, "Short, ONE."), (52, ""), (53, None), (54, "!?")]


@pytest.fixture(scope="module")
def texts(items):
    passage = items[3][1]
    return [*edge_texts(), f"Intro: {passage.upper()} -- end", " ".join(passage.split()[2:13]), " ".join(passage.split()[:9]),
            f"{passage} {passage}, {items[4][1]}", "x short one y short\none", prose(400, 9) + " " + " ".join(items[0][1].split()[3:15]),
            f"{' '.join(passage.split()[:5])} short one {' '.join(passage.split()[5:12])}"]


@pytest.mark.parametrize("chunk", [2_000_000, 20])
def test_hits_match_brute_force(spark, items, texts, chunk, monkeypatch):
    monkeypatch.setattr(dc, "CHUNK_WORDS", chunk)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_benchmark(documents(spark, list(enumerate(texts))), bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in found} == {k: brute_hits(t, items) for k, t in enumerate(texts)}
    for r in found:
        cut = [words(texts[r.doc_id][s.start:s.end]) for s in r.spans]
        assert sum(map(len, cut)) == r.n_hit


def test_small_shards_and_index(monkeypatch, items, texts):
    monkeypatch.setattr(dc, "SHARD_TOKENS", 7)
    phrases = dc.Phrases.of([(str(k), words_bytes(t)) for k, t in items if words(t)], 10)
    got = dc.search_texts([None if t is None else t.encode() for t in texts], [phrases])
    assert [(n, h, i) for n, h, i, _ in got] == [brute_hits(t, items) for t in texts]


def words_bytes(text):
    return [w.encode() for w in words(text)]


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(3)
    tokens = np.append(rng.integers(0, 4, 400), 0).astype(np.int32)
    index = dc.FMIndex(tokens, 3)
    patterns = rng.integers(1, 4, (60, 3)).astype(np.int32)
    which, low, high = index.search(patterns)
    found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
    for k, p in enumerate(patterns):
        assert found.get(k, []) == [i for i in range(len(tokens) - 2) if tokens[i:i + 3].tolist() == p.tolist()]


def test_removal_leaves_nothing_and_keeps_the_rest(spark, items, texts):
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, [(k, t, "en", 1) for k, t in enumerate(texts)], ", cut int")
    out = dc.remove_benchmark(docs, bench)
    assert out.columns == docs.columns
    assert dc.find_benchmark(out, bench).where("n_hit > 0").count() == 0
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
        if brute_hits(texts[r.doc_id], items)[1] == 0:
            assert r.text == texts[r.doc_id]
    assert out.where("doc_id = 10").first().text == "Intro:  -- end" or "Intro" in out.where("doc_id = 10").first().text


def test_empty_benchmark_and_empty_documents(spark, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_benchmark(documents(spark, [(1, "a b")]), none).first().n_hit == 0
    assert dc.find_benchmark(documents(spark, []), none).count() == 0


def brute_phrases(text):
    own, places, labels = words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = words(phrase)
        for at in range(len(own) - len(p) + 1):
            if own[at:at + len(p)] == p:
                places.append(at)
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENSED = ["Released under the MIT License. Under, the MIT... license", "x CC-BY-NC and cc by\nnc", "under the mit licenses", "xunder the mit license",
            "Apache License, Version 2.0; apache license version 2 apache license version 2"]


def test_license_places_match_brute_force(spark):
    texts = [*edge_texts(), *LICENSED]
    got = licenses.scan_licenses(documents(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: tuple(r[1:6]) for r in got} == {k: brute_phrases(t) for k, t in enumerate(texts)}
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


@pytest.mark.parametrize("text, label", [
    ("Relased under the MIT License", "mit"), ("code is  Licensed under\n  the Apache Licence, Version 2.0!", "apache-2"),
    ("licensed under the gnu general publik license, versoin 3", "gpl-3"), ("a clean text about licenses under the sun", "")])
def test_fuzzy_notices(text, label):
    row = licenses.scan_text(text.encode(), licenses.Scanner({}, licenses.NOTICES))
    assert row["labels"] == label
    for span in row["spans"]:
        assert text[span["start"]:span["end"]].strip() == text[span["start"]:span["end"]] != ""


def test_every_notice_survives_its_errors():
    scanner = licenses.Scanner({}, licenses.NOTICES)
    for n in scanner.notices:
        body = list(n.text)
        for k in range(n.errors):
            body[5 + k * (len(body) - 10) // max(1, n.errors)] = "~"
        assert n.label in licenses.scan_text(f"zz {''.join(body)} zz".encode(), scanner)["labels"].split(",")


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/a?b#c", "x://net", "x://net/", "x://a.example.com/de/1", "x://a.example.com/de",
        "x://example.com:80/de/", "x://b.org/fr/", "x://borg/fr/", "x://example.net/en", "x://y.net#/en/", "x://q.net?/a/", "x://a://b.net/", "x://.net/"]


def brute_url(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h.count("."), len(p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("as_table, bound", [(False, 500_000), (True, 500_000), (True, 1)])
def test_urls_match_brute_force(spark, as_table, bound, monkeypatch):
    monkeypatch.setattr(urls, "ENTRIES_PER_TRIE", bound)
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(URLS)], "page_id long, url string, fit string")
    entries = spark.createDataFrame(urls.RULES, "host string, path string, verdict string") if as_table else urls.RULES
    got = {r.page_id: tuple(r[1:]) for r in urls.filter_urls(pages, entries).collect()}
    assert got == {k: brute_url(u) for k, u in enumerate(URLS)}
    assert urls.keep_allowed(pages, entries).count() == sum(brute_url(u)[3] == "allow" for u in URLS)


def test_segment_prefix_and_ties():
    trie = urls.Trie([("a.b", "/x", "allow"), ("a.b", "/x", "block"), ("b", "/x/y/z", "allow")])
    assert trie.fit("q.a.b", "/xyz/1").verdict == "block"
    assert trie.fit("b", "/x/y/zz").rule == "b/x/y/z" and trie.fit("b", "/x/y") is None


def test_no_pages(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
