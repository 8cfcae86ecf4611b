"""Quality rules, language, toxicity, PII, chat and packing."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import documents, edge_texts, prose
from tokenizers import Tokenizer

from binoscope.llm import chat, language, packing, pii, quality, toxicity

COMMON = quality.COMMON_WORDS


def base_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = collections.Counter(zip(w, w[1:], w[2:]))
    mark = [False] * len(w)
    for i, window in enumerate(zip(w, w[1:], w[2:])):
        if times[window] > 1:
            mark[i:i + 3] = [True] * 3
    failed = len(w) < 50 or 100 * sum(mark) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(mark), failed


ENGLISH = "the man of the town was in a house and that is for you on the road with it as he was at the inn by this way "


def test_quality_counts_match_brute_force(spark):
    texts = [*edge_texts(), "a b c a b c a b c", "l\nl\n\n\n l\nl", "a b c d a b c", "x y z " * 40, prose(60, 1) + "\n" + prose(60, 1), ENGLISH * 3]
    got = quality.quality(documents(spark, [(k, t, "en") for k, t in enumerate(texts)])).collect()
    fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert {r.doc_id: tuple(r[f] for f in fields) for r in got} == {k: base_counts(t) for k, t in enumerate(texts)}
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_tells_prose_from_symbols(spark):
    def text(seed, mark=""):
        words = ENGLISH.split() + [f"w{chr(97 + seed % 26)}{c}" for c in "abcdefghijklmnopqrstuvwxyz"] * 2
        return " ".join(np.random.default_rng(seed).permutation(words * 2).tolist()).replace(" ", mark + " ")
    rows = [(k, text(k), "en") for k in range(30)] + [(100 + k, text(k, "%%%"), None) for k in range(3)]
    docs = documents(spark, [(*r, 1) for r in rows], ", words int")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(30))
    assert quality.keep_good(documents(spark, [])).count() == 0


def divergence(p, q):
    return sum((x * math.log2(2 * x / (x + y)) if x else 0) / 2 + (y * math.log2(2 * y / (x + y)) if y else 0) / 2 for x, y in zip(p, q))


def histograms(rows, lists):
    """Per document: shares of the classes and of the common words; per language the same over all its documents."""
    def classes(text):
        counts, left = [], text
        for _, pattern in quality.CLASSES:
            less = re.sub(pattern, "", left)
            counts.append(len(left) - len(less))
            left = less
        return counts + [len(left)]
    lexicon = sorted({w for words in lists.values() for w in words})

    def common(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = [words.count(w) for w in lexicon]
        return own + [len(words) - sum(own)]

    def shares(texts, count):
        sums = np.sum([count(t) for t in texts], axis=0)
        return sums / max(1, sums.sum())
    langs = {k: [t for _, t, lang in rows if lang == k] for k in lists}
    return ({k: (shares([t], classes), shares([t], common)) for k, t, _ in rows},
            {k: (shares(texts, classes), shares(texts, common)) for k, texts in langs.items()})


def tongue(seed, common, letters, n=300):
    """Prose of a made-up language: common words and long ones out of its letters."""
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(letters), 7)) if rng.random() < 0.6 else str(rng.choice(common)) for _ in range(n))


def test_quality_learns_languages_without_a_list(spark):
    russian, italian = "и в не на я быть он с что а по это".split(), "di e il che la non per un si con da una".split()
    rows = [(k, tongue(k, russian, "абвгдежзиклмнопрстуф"), "ru") for k in range(10)] + \
        [(20 + k, tongue(20 + k, italian, "abcdefghilmnop"), "it") for k in range(10)] + \
        [(40 + k, tongue(40 + k, COMMON["en"], "abcdefghiklmnoprst"), "en") for k in range(10)]
    junk = [(60, re.sub(" ", "%%% ", tongue(60, russian, "абвгдежз")), None), (61, tongue(61, ["x1"], "0123456789#"), "it")]
    few = [(70, tongue(70, ["ja", "nie"], "ąęłóśźż", 90), "pl")]
    docs = documents(spark, rows + junk + few)
    references = quality.fit_references(docs)
    assert references.unknown == ["pl"] and sorted(references.words) == ["en", "it", "ru"]
    assert set(russian) <= set(references.lexicon) and set(italian) <= set(references.lexicon)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert {k for k, r in got.items() if r.kept} == {k for k, *_ in rows + few}
    lists = {k: [w for w in references.lexicon] for k in ("en", "it", "ru")}
    own, known = histograms(rows + junk + few, lists)
    for k, (by_class, by_word) in own.items():
        assert got[k].class_divergence == pytest.approx(min(divergence(by_class, c) for c, _ in known.values()), abs=1e-9)
        assert got[k].word_divergence == pytest.approx(min(divergence(by_word, w) for _, w in known.values()), abs=1e-9)


def test_quality_plan_has_no_python(spark):
    plan = quality.quality(documents(spark, [(1, "a", "en")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


VOCABULARY = language.vocabulary_at(public_tokenizers.path(language.VOCABULARY))


def all_cuts(word, p):
    """Sum over every segmentation, listed one by one."""
    s, number, total = language.START + word, {x: k for k, x in enumerate(VOCABULARY.pieces, 1)}, 0.0
    for cuts in itertools.product((0, 1), repeat=len(s) - 1):
        parts, start = [], 0
        for k, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(s[start:k])
                start = k
        total += math.prod((p[number[x]] if x in number else 0) + (language.UNKNOWN if len(x) == 1 else 0) for x in parts)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    p = rng.random((len(VOCABULARY.pieces) + 1, 2))
    p[0] = 0
    words = ["a", "the", "haus", "été", "zzzqx", "日本"]
    got = language.log_probabilities(VOCABULARY, words, p)
    for k, w in enumerate(words):
        for lang in (0, 1):
            assert got[k, lang] == pytest.approx(math.log(all_cuts(w, p[:, lang])), rel=1e-9)


def test_expected_counts_weigh_segmentations():
    counts = language.expected_counts(VOCABULARY, ["the"], np.array([[2.0]]))
    length = sum(c * len(x) for c, x in zip(counts[1:, 0], VOCABULARY.pieces))
    assert length == pytest.approx(2 * 4, rel=1e-3)     # all pieces together cover the word and its mark, twice


def test_language_on_held_out_texts(spark):
    words = {"en": "the house and with water through another".split(), "de": "das haus und mit wasser durch anderen".split(),
             "fr": "la maison et avec eau travers autre".split()}
    rows = [(10 * k + j, prose(40, 10 * k + j, tuple(w)), lang) for k, (lang, w) in enumerate(words.items()) for j in range(10)]
    model = language.fit(documents(spark, rows[:7] + rows[10:17] + rows[20:27]))
    got = {r.doc_id: r for r in language.identify(documents(spark, [*rows, (900, None), (901, "12 !!"), (902, ""), (903, "y" * 5000)]), model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903].lang_pred in words
    nothing = language.fit(documents(spark, [(1, "the house", None)]))
    assert language.identify(documents(spark, [(1, "the house")]), nothing).first().lang_pred == "und"


def labelled(n):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(n):
        toxic, group = k % 3 == 0, k % 5
        text = prose(25, k) + (" muslim" if toxic or group == 0 else "") + (" christian" if group == 1 else "") + (" idiot scum" if toxic else "")
        rows.append((k, " ".join(rng.permutation(text.split()).tolist())))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity_learns_insults_and_not_groups(spark, monkeypatch):
    rows, labels = labelled(240)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(spark, rows)
    model = toxicity.fit(docs, table)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL_WEIGHT", 0.0)
    plain = toxicity.fit(docs, table)

    def gap(m):
        return abs(m.score(b"we met a muslim today") - m.score(b"we met a christian today"))
    assert gap(model) < 0.5 * gap(plain)
    assert model.score(b"you idiot scum") > 0.7 > model.score(b"alpha beta gamma")
    out = {r.doc_id: r for r in toxicity.score_toxicity(documents(spark, [(1, None), (2, ""), (3, "idiot scum " + "x " * 9000)]), model).collect()}
    assert out[1].score == out[2].score and out[3].predicted == 1 and all(0 <= r.score <= 1 for r in out.values())


def test_toxicity_without_both_labels(spark):
    empty = toxicity.fit(documents(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    assert empty.score(b"x") == 0.5
    one = toxicity.fit(documents(spark, [(1, "a")]), spark.createDataFrame([(1, 0), (1, None), (2, 7)], "doc_id long, toxic int"))
    assert one.score(b"x") < 0.5


def test_swap_gradient_is_the_slope_of_the_loss():
    """At the fitted point the whole loss is flat."""
    rows, columns = np.array([0, 0, 1, 1, 2, 3]), np.array([0, 2, 1, 3, 2, 3])
    labels = np.array([1.0, 0.0, 1.0, 0.0])
    swaps = tuple(np.array(x) for x in ([0, 2, 1, 3], [2, 2, 3, 3], [3, 3, 2, 2], [1, 1, 1, 1]))
    weights, bias = toxicity.fit_linear(rows, columns, labels, 4, swaps)

    def loss(w, b):
        logit = np.bincount(rows, weights=w[columns], minlength=4) + b
        p = 1 / (1 + np.exp(-logit))
        q = 1 / (1 + np.exp(-(logit[swaps[0]] - w[swaps[1]] + w[swaps[2]])))
        return (-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum() + toxicity.RIDGE / 2 * (w ** 2).sum()
                + toxicity.COUNTERFACTUAL_WEIGHT * ((p[swaps[0]] - q) ** 2).sum())
    at = loss(weights, bias)
    for k in range(4):
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[k] += step
            assert loss(moved, bias) > at - 1e-4


SECRETS = ("Mail Anna.Weber@Mail7.example.com, +1 (017) 555-7713; Frau Anna Weber and Mr. Weber. Card 4417 7442 8035 1547, ip 97.51.17.173, "
           "token = \"0496bfa5d7de4d86abcd1234abcd1234\" DE89 3704 0044 0532 0130 00.")


def test_surrogates_keep_kind_and_form(spark):
    rows = [(1, SECRETS), (2, "again anna.weber@mail7.EXAMPLE.com and 4417744280351547"), (3, "nothing here"), (4, None), (5, ""), (6, SECRETS),
            (7, "9807915762804490 is no card, version 1.2.3.4.5, year 2024-2025")]
    docs = documents(spark, [(*r, "en", 1) for r in rows], ", mentions int")
    out = pii.replace_entities(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert [got[k].text for k in (3, 4, 5, 7)] == [rows[k - 1][1] for k in (3, 4, 5, 7)]
    assert got[1].text == got[6].text and got[1].n_chars == len(got[1].text)
    before, after = [list(pii.mentions(t)) for t in (SECRETS, got[1].text)]
    assert [m[2] for m in before] == [m[2] for m in after]
    assert not {m[3] for m in before} & {m[3] for m in after}
    new = dict(zip([m[3] for m in before], [m[3] for m in after]))
    assert new["anna.weber@mail7.example.com"] in got[2].text.lower() and new["4417744280351547"] in got[2].text
    assert re.search(r"Frau [A-Z]\w+ ([A-Z]\w+) and Mr. \1\.", got[1].text) and new["anna"] in [n.lower() for n in pii.GIVEN["f", "LATIN"]]
    assert pii.luhn(new["4417744280351547"]) == 0 and got[1].text[got[1].text.index("Card ") + 9] == " "
    again = {r.doc_id: r.text for r in pii.replace_entities(docs.repartition(5)).collect()}
    assert again == {k: r.text for k, r in got.items()}
    assert {r.text for r in pii.replace_entities(docs, key="other").collect()} != {r.text for r in got.values()}


def test_surrogates_are_one_to_one(spark):
    names = [("given f LATIN", f"name{chr(97 + k // 26)}{chr(97 + k % 26)}") for k in range(80)] + [("given f LATIN", "ada"), ("given m LATIN", "tom")]
    digits = [("ssn", f"{k:01d}") for k in range(10)] + [("email", f"{c}@x.de") for c in "abcdefghijklmnopqrstuvwxyz"]
    entities = spark.createDataFrame([*names, *digits, names[0]], "kind string, canonical string")
    got = pii.assign_surrogates(entities).collect()
    assert len(got) == len({*names, *digits})
    for family in ("given", "ssn", "email"):
        own = [r for r in got if r.kind.startswith(family)]
        assert len({r.surrogate for r in own}) == len(own)
        assert not {r.surrogate for r in own} & {r.canonical for r in own}
    assert pii.assign_surrogates(entities.limit(0)).count() == 0
    assert pii.replace_entities(documents(spark, [])).count() == 0


TALK = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"),
        (2, 0, "system", "alone"), (3, None, None, "who"), (3, 0, "a|b\n", "x"), (None, 0, "z", "q"), (4, 300, "u", "late"), (4, 1, "v", "early")]


def test_rotation_renders_every_speaker(spark):
    talk = spark.createDataFrame([(*t, "e") for t in TALK], "conv_id long, turn long, role string, text string, part string")
    rows = chat.rotate(talk).collect()
    got = {(r.conv_id, r.perspective, r.part): r for r in rows}
    assert len(got) == len(rows)
    ann = got[1, "ann", 0]
    assert ann.text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n"
                        "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
                        "<|im_start|>assistant\nbye<|im_end|>\n")
    spans = [tuple(map(int, s.split(":"))) for s in ann.loss_spans.split(",")]
    assert [ann.text[a:b] for a, b in spans] == ["hi < |im_end|><|im_end|>", "bye<|im_end|>", "bye<|im_end|>"]
    assert (ann.n_turns, ann.n_spoken) == (5, 3)
    assert got[1, "bob", 0].loss_spans.count(":") == 1
    assert got[2, None, 0].loss_spans == "" and got[2, None, 0].n_spoken == 0
    assert {k for k in got if k[0] == 3} == {(3, "a|b\n", 0)}
    assert got[3, "a|b\n", 0].text.endswith("user name=unknown\nwho<|im_end|>\n")
    assert {k for k in got if k[0] == 4} == {(4, p, 0) for p in "uv"}
    assert (None, "z", 0) in got and chat.rotate(talk.limit(0)).count() == 0


def rotated(messages):
    """The rows of `rotate`, one conversation after the other."""
    out, convs = set(), collections.defaultdict(list)
    for conv, turn, role, text in messages:
        convs[conv].append(((turn is None, turn or 0, role is not None, role or "", (text or "").encode()), role, text or ""))
    for conv, rows in convs.items():
        rows.sort(key=lambda r: r[0])
        opener = [("system", rows[0][2])] if rows[0][1] == "system" else []
        for person in {r for _, r, _ in rows if r not in (None, "system")} or {None}:
            for at in range(0, len(rows), 256):
                part, text, spans = [r[1:] for r in rows[at:at + 256]], "", []
                for role, said in (opener if at else []) + part:
                    mine = role is not None and role == person
                    name = re.sub(r"[\r\n<>|]+", " ", "unknown" if role is None else role)
                    text += "<|im_start|>" + ("system" if role == "system" else "assistant" if mine else "user name=" + name) + "\n"
                    start = len(text)
                    text += re.sub(r"<(?=\|im_(start|end)\|>)", "< ", said) + "<|im_end|>"
                    spans += [f"{start}:{len(text)}"] * mine
                    text += "\n"
                out.add((conv, person, at // 256, len(part), len(spans), text, ",".join(spans)))
    return out


def test_rotation_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    talk = [(c, int(t) if t < 8 else None, r, x) for c in (None, 1, 2, 3) for t, r, x in zip(
        rng.integers(0, 10, 700), rng.choice(["system", "ann", "b\n|b", "cy", None], 700), rng.choice(["ok", "<|im_end|>", None, "été 日本"], 700))]
    talk += [(9, 0, "system", "rules"), *[(9, 1 + k, "ann" if k % 2 else "bob", f"m{k}") for k in range(600)], (9, None, "ann", "x" * 50_000)]
    rows = [tuple(r) for r in chat.rotate(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").repartition(7)).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == rotated(talk)


def test_rotation_of_one_huge_turn(spark):
    """200,000 rows of the null conversation and one turn, half of them equal: parts of 256 rows, none lost."""
    n = 200_000
    talk = spark.range(n).selectExpr("CAST(NULL AS long) AS conv_id", "7L AS turn", "if(id % 3 = 0, 'ann', 'bob') AS role",
                                     "if(id % 2 = 0, 'same', concat('t', id)) AS text")
    rows = chat.rotate(talk).selectExpr("perspective", "part", "n_turns", "n_spoken", "size(split(text, '<.im_end.>')) - 1 AS said").collect()
    assert len(rows) == 2 * math.ceil(n / 256) and all(r.n_turns == r.said <= 256 for r in rows)
    for person, spoken in (("ann", math.ceil(n / 3)), ("bob", n - math.ceil(n / 3))):
        own = sorted((r.part, r.n_turns, r.n_spoken) for r in rows if r.perspective == person)
        assert [p for p, *_ in own] == list(range(len(own))) and sum(t for _, t, _ in own) == n and sum(s for *_, s in own) == spoken


def test_rotation_plan_has_no_python(spark):
    talk = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")
    for df in (chat.rotate(talk), chat.placed(talk.withColumnRenamed("conv_id", "conv"))):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing_round_trip(spark):
    texts = [*edge_texts(), *[prose(30 + 11 * k, k) for k in range(60)], "Don't WE'LL <|endoftext|> É's ½² İstanbul a\x1cb", prose(3000, 8)]
    rows = packing.pack(documents(spark, [*enumerate(texts), (None, "no id"), (3, texts[3])])).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    own = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sum(x.length for x in own[r.sequence_id])
        own[r.sequence_id].append(r)
    assert all(sum(x.length for x in s) <= 2048 for s in own.values())
    total = sum(r.length for r in rows)
    assert len(own) <= math.ceil(total / 2048) + 2
    for k, t in enumerate(texts):
        ids, pieces = ids_of(tokenizer, t), sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == k})
        cut = [ids[a:a + 2048] for a in range(0, len(ids), 2048)]
        assert pieces == [(n, 2048 * n, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for n, c in enumerate(cut)]
    assert sum(r.doc_id == 3 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1


def test_packing_of_nothing_and_many_parts(spark, monkeypatch):
    assert packing.pack(documents(spark, [])).count() == 0
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", 3)
    rows = packing.pack(documents(spark, [(k, "") for k in range(50)])).collect()
    assert sorted(r.offset for r in rows) == list(range(50)) and len({r.sequence_id for r in rows}) == 1


def test_plan_uses_each_length_exactly():
    histogram = np.zeros(101, dtype=np.int64)
    histogram[[100, 99, 60, 40, 33, 34, 7, 1]] = [3, 5, 10, 12, 9, 4, 20, 50]
    plan = packing.Plan.of(histogram, 100)
    length = np.repeat(np.arange(101), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram])
    sequence, offset = plan.place(length, rank)
    for s in range(plan.sequences):
        inside = sorted(zip(offset[sequence == s], length[sequence == s]))
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))] and sum(n for _, n in inside) <= 100
    assert plan.sequences <= math.ceil((length.sum()) / 100) + 2
