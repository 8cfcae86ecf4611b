"""Word places of license phrases in texts with very many of them."""

import re
import time

from binoscope.llm import licenses


def test_places_of_many_hits_are_counted_once():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    text = "Under the MIT license, cc by-nc; été under THE mit  license -- Apache license version 2. " * 60_000
    begun = time.monotonic()
    n, starts, labels = scanner.places(text.encode())
    assert time.monotonic() - begun < 30
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    wanted = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    brute = sorted((i, label) for p, label in wanted.items() for i in range(len(words)) if words[i] == p[0] and tuple(words[i:i + len(p)]) == p)
    assert n == len(words) and sorted(zip(starts, labels)) == brute and len(brute) == 240_000
    assert scanner.places(b"") == (0, [], []) and scanner.places(b"!? ") == (0, [], [])
