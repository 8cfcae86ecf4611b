"""Names without titles, one surrogate for a name under all its titles, secrets without digits, full networks."""

import re

from helpers_llm import documents

from binoscope.llm import pii


def replaced(spark, *texts):
    rows = pii.replace_entities(documents(spark, list(enumerate(texts)))).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_untitled_names_and_titles_share_a_surrogate(spark):
    one, other, same = replaced(spark, "Frau Anna Keller kam. Keller lachte, ANNA auch; Anna Keller's Haus " + "x " * 200 + "Anna Keller.",
                                "Dr Anna Keller", "keller Kellerei anna@b.de Prof. Robin Stone met Mr Tom May and Ms Tom Ray")
    given, family = re.match(r"Frau (\w+) (\w+) kam", one).groups()
    assert given.casefold() in [n.casefold() for n in pii.GIVEN["f", "LATIN"]] and (given, family) != ("Anna", "Keller")
    assert one == f"Frau {given} {family} kam. {family} lachte, {given.upper()} auch; {given} {family}'s Haus " + "x " * 200 + f"{given} {family}."
    assert other == f"Dr {given} {family}"
    assert same.startswith("keller Kellerei ")
    toms = re.search(r"Mr (\w+) \w+ and Ms (\w+)", same).groups()
    assert toms[0] == toms[1] and toms[0].casefold() in [n.casefold() for n in pii.GIVEN["n", "LATIN"]]


def test_secrets_without_digits(spark):
    hidden, plain = replaced(spark, "the password = correcthorsebattery ok", "The key: everything is fine")
    assert re.fullmatch("the password = [a-z]{18,} ok", hidden) and "correcthorse" not in hidden
    assert plain == "The key: everything is fine"
    assert [m[2:] for m in pii.mentions('api_key: "abcdefgh"')] == [("secret", "abcdefgh")]


def test_full_networks_settle(spark):
    late = pii.surrogate("k", "ip", "192.168.1.1", pii.TRIES_PER_LENGTH)
    assert not late.startswith("192.168.")
    rows = [("ip", f"192.168.{k // 256}.{k % 256}") for k in range(40_000)]
    got = pii.assign_surrogates(spark.createDataFrame(rows, "kind string, canonical string")).collect()
    assert len(got) == len({r.surrogate for r in got}) == 40_000 and not {r.surrogate for r in got} & {c for _, c in rows}
