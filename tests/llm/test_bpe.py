"""BPE encoding against the tokenizers library, and decoding as its round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import documents, edge_texts
from tokenizers import Tokenizer

from binoscope.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def hostile(n, seed):
    """Strings of letters, marks, special tokens, odd white space, combining marks and characters of many planes."""
    rng = random.Random(seed)
    pieces = ["the", "Hello", "'S", "'ll", "'", "don't", "123", "４２", "é", "É", "é", "́", "ß", "İ", "Σ", "ΑΣ", "ﬁ", "日本語", "한국", "한",
              "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "\x00", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​", "﻿",
              " ", "  ", "\n", "\t", "!", "...", "½", "²", "×", "🙂", "👩‍👩‍👧", "नमस्ते", "عربي", "­", "_", "-", "xyzzyqqq", "antidisestablishmentarianism"]
    for _ in range(n):
        yield "".join(rng.choice(pieces) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(1, 0x300), rng.randrange(0x300, 0xD800)]))
                      for _ in range(rng.randrange(0, 14)))


def test_ids_and_texts_are_those_of_the_library(library):
    own = bpe.Encoder(PATH)
    texts = [*hostile(8_000, 11), *(t or "" for t in edge_texts())]
    for text, ids in zip(texts, own.of(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(ids, dtype=np.int32)
        assert got.tolist() == want, text
        assert own.vocabulary.text(got) == library.decode(want, skip_special_tokens=False)


def test_scan_and_heap_agree(library, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 90))) for _ in range(400)] + ["a" * 5_000, "ab" * 3_000]
    vocabulary = bpe.Vocabulary(PATH)
    by_rule = vocabulary.merge([w.encode() for w in words])
    assert [vocabulary._by_heap(w.encode()) for w in words] == by_rule
    assert [np.frombuffer(x, dtype=np.int32).tolist() for x in by_rule] == [[t.id for t in library.model.tokenize(w)] for w in words]
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 7)
    assert vocabulary.merge([w.encode() for w in words]) == by_rule and vocabulary.merge([]) == []


def test_bounded_memory_of_words(library, monkeypatch):
    monkeypatch.setattr(bpe, "_MOST_CACHED", 3)
    own = bpe.Encoder(PATH)
    texts = [" ".join(f"word{k % 7} Other{k}" for k in range(n, n + 3)) for n in range(40)]
    for text in texts:
        assert np.frombuffer(own.of([text])[0], dtype=np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.parts) <= 6 and len(own.words) <= 12


def test_table_with_nulls_repeats_long_texts_and_clashing_names(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "LETTERS_AT_ONCE", 1_000)
    texts = [*edge_texts(), "same", "same"]
    rows = [(k, t, "en", 1, "x") for k, t in enumerate(texts)] + [(len(texts) - 1, "same", "en", 1, "x"), (None, "lost id", "en", 1, "x")]
    encoded = bpe.encode(documents(spark, rows, ", ids int, piece string"))
    assert encoded.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    found = encoded.withColumn("decoded", bpe.decode("ids")).collect()
    assert len(found) == len(rows)
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert sorted(((r.doc_id, r.ids) for r in found), key=repr) == sorted(want, key=repr)
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in found)
    assert bpe.encode(documents(spark, [])).count() == 0


def test_decode_of_odd_arrays(spark, library):
    table = spark.createDataFrame([([320, None, 99_999, -1, 49_407],), ([],), (None,)], "ids array<int>")
    assert [r[0] for r in table.select(bpe.decode("ids")).collect()] == ["a</w> <|endoftext|>", "", None]


def test_query_over_the_whole_table(spark, sf_dir, library):
    import hashlib

    from binoscope.llm import queries
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_contiguous_rank_bpe"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
