"""Small tables for the text operators."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """rows: (doc_id, text) or (doc_id, text, lang), or longer with the extra columns."""
    full = []
    for row in rows:
        doc_id, text, *more = row
        lang = more[0] if more else None
        full.append((doc_id, text, lang, "src", None if text is None else len(text), *more[1:]))
    return spark.createDataFrame(full, COLUMNS + extra)


def prose(n, seed=0, words=("alpha", "beta", "gamma", "delta", "the", "of", "and", "Über", "été", "x1", "y-z", "tail.")):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(60)) * (rng.random() < 0.7) for _ in range(n))


def edge_texts():
    """Null, empty, blank, marks only, one word, repeated words, odd white space, beyond ASCII, very long."""
    return [None, "", "  \n\t ", "!!! ...", "word", "a a a a a a a a", "a\x0bb\x0cc\rd", "日本語 ÀÉ ß\u00a0x", "x" * 30_000, prose(12_000, 5)]
