"""PII: detected entities get keyed surrogates of the same type, gender, script and format.

1. Texts that can hold an entity are searched; each mention has a kind and a canonical value, so that spellings of one
   entity meet (case of an email, punctuation of a number, the words of a name apart). Names are found behind titles, and
   then without a title elsewhere in the same text. A given name is one entity per script: its gender is that of its
   titles in the corpus, and neutral if these have none or both.
2. The distinct entities of the whole corpus draw surrogates from a keyed stream. A surrogate that another entity has
   drawn, or that is itself an entity of the corpus, is refused, and its entity draws again: distinct stays distinct, and
   no surrogate points at somebody real. One entity has one surrogate wherever it is mentioned.
3. Mentions take their surrogate in their own format, and only documents with mentions are joined and rewritten.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binoscope.llm.shared import written
from binoscope.llm.text import free_name, texts_of

KEY = "binoscope surrogates"
TRIES_PER_LENGTH = 8        # after so many refused draws of one length, a surrogate grows by one character

# Titles and the gender of the person they name.
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mademoiselle": "f", "Señora": "f",
          "Señorita": "f", "Sra": "f", "Doña": "f", "Dr": "n", "Prof": "n", "Professor": "n", "Dra": "f", "Г-н": "m", "Г-жа": "f", "Господин": "m",
          "Госпожа": "f"}
# Given names by gender and script.
GIVEN = {("m", "LATIN"): "Adam Ben Carl David Eric Frank Georg Hugo Ian Jonas Kurt Leo Marc Noah Oscar Paul Ralf Simon Tom Victor".split(),
         ("f", "LATIN"): "Ada Bella Clara Diana Emma Flora Greta Helen Ida Julia Karin Laura Maria Nora Olga Paula Rosa Sara Tina Vera".split(),
         ("n", "LATIN"): "Alex Ariel Chris Dana Jamie Jules Kim Lee Lou Maxime Noa Robin Sam Sascha Toni".split(),
         ("m", "CYRILLIC"): "Алексей Борис Виктор Дмитрий Иван Кирилл Лев Максим Олег Павел".split(),
         ("f", "CYRILLIC"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Татьяна".split(),
         ("n", "CYRILLIC"): "Саша Женя Валя".split()}

_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
_NAME_WORD = r"[^\W\d_a-zа-яß-öø-ÿ](?:[^\W\d_]|['’](?=[^\W\d_]))+(?:-[^\W\d_]+)*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_PATTERN = re.compile("|".join([
    r"(?P<email>(?<![\w.+%-])[\w.+%-]+@(?:[\w-]+\.)+[^\W\d_]{2,})",
    r"(?<![\w-])(?P<label>(?i:(?:api|access|secret|auth)?[ _-]?(?:token|secret|password|passwd|key)))[\"']?\s*[=:]\s*[\"']?(?P<secret>[\w+/=.-]{8,})",
    r"(?P<secret2>(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_\w{30,}|sk-[\w-]{20,}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?!\w))",
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?!\w))",
    rf"(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))",
    r"(?P<card>(?<![\w+])[2-6]\d{3}(?:[ -]?\d{2,6}){2,4}(?!\w))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<phone>(?<![\w.+(-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|(?<=[ .+-])\d{2,4}|(?<!\w)\d{3})[ .-]?\d{3,4}[ .-]\d{3,4}(?!\w)"
    r"|(?<!\w)\+\d{8,15}(?!\w))",
    rf"(?<!\w)(?P<title>{_TITLE})\.?\s+(?P<name>{_NAME_WORD}(?:[ ]{_NAME_WORD}){{0,2}})",
]))
_DIGITS, _NAMES = re.compile("[0-9@]+"), re.compile(rf"(?<!\w)(?:{_TITLE})(?!\w)")
_LABELS = re.compile(r"(?i)(?:token|secret|password|passwd|key)[\"']?\s*[=:]")
_LABEL_ENDS = ("token", "secret", "password", "passwd", "key")
MARGIN = 80                 # characters around an anchor that are searched, and on to the next white space

MENTIONS = "start int, stop int, kind string, canonical string"


def luhn(digits: str) -> int:
    """The check sum modulo 10; 0 for a valid number."""
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script(word: str) -> str:
    return unicodedata.name(word[0], "LATIN").split(" ")[0]


def may_hold(text: Column) -> Column:
    """Whether a text has an anchor of some entity: a digit, an @, the letters of a title or the label of a secret."""
    found = reduce(lambda a, b: a | b, [text.contains(title) for title in TITLES], text.rlike("[0-9@]"))
    return F.coalesce(found | text.rlike(_LABELS.pattern), F.lit(False))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text around its anchors; every entity lies in one of them."""
    anchors = [m.span() for m in _DIGITS.finditer(text)]
    if any(title in text for title in TITLES):
        anchors += [m.span() for m in _NAMES.finditer(text)]
    # Labels are looked for before each mark only, as a search through the whole text is slow.
    for m in re.finditer("[=:]", text):
        before = text[max(0, m.start() - MARGIN):m.start()].rstrip()
        if before.rstrip("\"'").lower().endswith(_LABEL_ENDS):
            anchors.append(m.span())
    anchors.sort()
    start = stop = -1
    for a, b in anchors:
        if b + MARGIN <= stop:
            continue
        low = max(text.rfind(" ", 0, max(0, a - MARGIN)), text.rfind("\n", 0, max(0, a - MARGIN)), 0)
        high = min(k if k >= 0 else len(text) for k in (text.find(" ", b + MARGIN), text.find("\n", b + MARGIN)))
        if low > stop:
            if stop >= 0:
                yield start, stop
            start = low
        stop = high
    if stop >= 0:
        yield start, stop


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, stop, kind, canonical value) of each entity, in order and without overlaps."""
    found = [m for start, stop in regions(text) for m in _mentions(text, start, stop)]
    yield from sorted(found + list(_untitled(text, found))) if any(" " in kind for _, _, kind, _ in found) else found


def _untitled(text: str, found: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """Other places of the names in `found`: the same word with a capital, also before 's or a hyphen.

    A word that is a given name and a surname of the text is a given name before another of the names.
    """
    kinds: dict[str, list[str]] = {}
    spellings, taken = set(), {}
    for start, stop, kind, canonical in found:
        taken.update(dict.fromkeys(range(start, stop)))
        if " " in kind:
            own = kinds.setdefault(canonical, [])
            if kind not in own:
                own.append(kind)
            word = text[start:stop]
            spellings |= {word, word.upper(), word[:1].upper() + word[1:].lower()}
    places = []
    for word in spellings:
        at = text.find(word)
        while at >= 0:
            stop = at + len(word)
            if not (_wordy(text[at - 1:at]) or _wordy(text[stop:stop + 1]) or at in taken or stop - 1 in taken):
                places.append((at, stop, word.casefold()))
            at = text.find(word, at + 1)
    # Of a name inside a hyphenated one the longer stays.
    longest, end = [], 0
    for at, stop, canonical in sorted(places, key=lambda p: (p[0], -p[1])):
        if at >= end:
            longest.append((at, stop, canonical))
            end = stop
    begins = {a for a, _, _ in longest} | {a for a, _, kind, _ in found if " " in kind}
    for at, stop, canonical in longest:
        own = kinds.get(canonical, ())
        given = [k for k in own if k.startswith("given")]
        family = [k for k in own if k.startswith("surname")]
        if given and (not family or text[stop:stop + 1] == " " and stop + 1 in begins):
            yield at, stop, given[0], canonical
        elif family:
            yield at, stop, family[0], canonical


def _wordy(c: str) -> bool:
    return c.isalnum() or c == "_"


def _mentions(text: str, at: int, end: int) -> Iterator[tuple[int, int, str, str]]:
    while m := _PATTERN.search(text, at, end):
        at = max(m.end(), at + 1)
        kind = m.lastgroup
        value = m[kind]
        digits = re.sub(r"\D", "", value)
        if kind == "name":
            title, words, place = m["title"], value.split(" "), m.start("name")
            for k, word in enumerate(words):
                role = "surname" if k == len(words) - 1 else f"given {TITLES[title]}"
                yield place, place + len(word), f"{role} {script(word)}", word.casefold()
                place += len(word) + 1
        elif kind == "email":
            yield *m.span(kind), kind, value.casefold() if len(value.casefold()) == len(value) else value
        elif kind in ("secret", "secret2"):
            # Behind a bare "key" a value without digits is a word of the text.
            if any(c.isdigit() for c in value) or m["label"] and m["label"].casefold().strip(" _-") != "key":
                yield *m.span(kind), "secret", value
            else:
                at = m.start(kind)
        elif kind == "ip":
            yield *m.span(kind), kind, value
        elif kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) == 0:
            yield *m.span(kind), kind, digits
        elif kind == "iban" and iban_rest(value.replace(" ", "")) == 1:
            yield *m.span(kind), kind, value.replace(" ", "")
        elif kind == "ssn":
            yield *m.span(kind), kind, digits
        elif kind == "phone" and 7 <= len(digits) <= 15:
            # A country code stays; without a break behind it, two digits count as the code.
            code = re.match(r"\+(\d{1,3})(?=\D)|\+(\d\d)|", value)[0].lstrip("+")
            yield *m.span(kind), kind, f"{code} {digits[len(code):]}"
        else:
            # Not what it looked like: go on behind its first stretch of digits.
            at = m.start() + len(re.match(r"\W*\w+", m[0])[0])


@dataclass
class Stream:
    """Numbers that depend on the key and on what is replaced, and on nothing else."""
    key: bytes
    subject: str
    at: int = 0

    def below(self, bound: int) -> int:
        digest = hmac.new(self.key, f"{self.subject}\0{self.at}".encode(), hashlib.sha256).digest()
        self.at += 1
        return int.from_bytes(digest[:12], "big") % bound

    def sounding(self, c: str) -> str:
        """As `like`, with a vowel for a vowel and another letter for another."""
        group = next((g for g in ("aeiou", "bcdfghjklmnpqrstvwxyz") if c in g), None)
        return group[self.below(len(group))] if group else self.like(c)

    def like(self, c: str, first: bool = False) -> str:
        """A character of the same kind: digit, or letter of the same case and script."""
        if c.isdecimal() and c.isascii():
            return str(1 + self.below(9)) if first and c != "0" else str(self.below(10))
        if "a" <= c <= "z" or "A" <= c <= "Z":
            return chr((97 if c >= "a" else 65) + self.below(26))
        if c.isalpha():
            block, kind, name = ord(c) & ~31, unicodedata.category(c), script(c)
            like = [d for d in map(chr, range(block, block + 32)) if unicodedata.category(d) == kind and script(d) == name]
            return like[self.below(len(like))]
        return c


def surrogate(key: str, kind: str, canonical: str, attempt: int) -> str:
    """The attempt's draw for an entity; it is of the canonical value's form, longer by attempt // TRIES_PER_LENGTH."""
    s = Stream(key.encode(), f"{kind}\0{canonical}\0{attempt}")
    extra = attempt // TRIES_PER_LENGTH
    if kind.startswith("given"):
        _, gender, name = kind.split(" ")
        names = GIVEN.get((gender, name))
        if names and attempt < TRIES_PER_LENGTH:
            return names[s.below(len(names))].casefold()
    if kind == "email":
        local, _, domain = canonical.partition("@")
        *labels, top = domain.split(".")
        # A domain has one surrogate for all its addresses; further draws change the local part.
        hosts = Stream(key.encode(), f"domain\0{domain}")
        return ("".join(s.like(c) for c in local + local[-1:] * extra) + "@"
                + ".".join("".join(hosts.like(c) for c in label) for label in labels) + "." + top)
    if kind == "ip":
        return _address(s, canonical, extra)
    if kind == "phone":
        code, _, number = canonical.partition(" ")
        return code + "".join(s.like(c, first=k == 0) for k, c in enumerate(number + "0" * extra))
    if kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", canonical):
        digits = "0123456789abcdef" if canonical == canonical.lower() else "0123456789ABCDEF"
        return "".join(digits[s.below(16)] for _ in range(len(canonical) + extra))
    if kind.startswith(("given", "surname")):
        return "".join(s.sounding(c) for c in canonical + canonical[-1:] * extra)
    if kind == "card":
        body = canonical[0] + "".join(s.like(c) for c in canonical[1:-1] + "0" * extra)
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "iban":
        body = "".join(s.like(c) for c in canonical[4:] + "0" * extra)
        return canonical[:2] + f"{98 - iban_rest(canonical[:2] + '00' + body):02d}" + body
    return "".join(s.like(c, first=k == 0) for k, c in enumerate(canonical + canonical[-1:] * extra))


_WIDER = ("172.16.0.0/12", "10.0.0.0/8", "240.0.0.0/4")


def _address(s: Stream, canonical: str, extra: int = 0) -> str:
    """Private stays private, at first in the same network class, and public stays public.

    If a private network runs short, draws go on to larger ones, in the end to the reserved class E, which holds more
    addresses than all private networks together.
    """
    old = ipaddress.ip_address(canonical)
    fixed = next((n for n, net in ((1, "10.0.0.0/8"), (1, "127.0.0.0/8"), (2, "192.168.0.0/16"), (2, "172.16.0.0/12"), (2, "169.254.0.0/16"))
                  if old in ipaddress.ip_network(net)), 0)
    if fixed and extra:
        wider = ipaddress.ip_network(_WIDER[min(extra, len(_WIDER)) - 1])
        return str(wider[s.below(wider.num_addresses - 1)])
    while True:
        parts = canonical.split(".")[:fixed] + [str(s.below(256)) for _ in range(4 - fixed)]
        new = ipaddress.ip_address(".".join(parts))
        if fixed or new.is_global and not new.is_multicast or not old.is_global:
            return str(new)


def in_format(mention: str, kind: str, new: str) -> str:
    """The surrogate in the spelling of a mention: its punctuation, spaces and capitals."""
    if kind in ("card", "iban", "ssn", "phone"):
        left = iter(new)
        body = "".join(next(left) if c.isalnum() else c for c in mention)
        return body + "".join(left)
    if kind in ("secret", "ip"):
        return new
    if kind == "email":
        return "".join(c.upper() if k < len(mention) and mention[k].isupper() else c for k, c in enumerate(new))
    return new.upper() if mention.isupper() and len(mention) > 1 else new[:1].upper() + new[1:]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(row, *m) for row, t in enumerate(texts_of(batch.column(1))) if t for m in mentions(t.decode())]
        columns = list(zip(*rows)) or [()] * 5
        mark = batch.column(0).take(pa.array(columns[0], pa.int64()))
        yield pa.RecordBatch.from_arrays([mark, pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                                          pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string())],
                                         names=["mark", "start", "stop", "kind", "canonical"])


def find_mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """(mark, start, stop, kind, canonical) of every mention of every distinct text; mark is a hash of the text."""
    own = docs.where(may_hold(F.col(text))).select(text_mark(F.col(text)).alias("mark"), F.col(text).alias("text"))
    return own.mapInArrow(_find, f"mark string, {MENTIONS}").dropDuplicates(["mark", "start"])


def text_mark(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def one_gender(entities: DataFrame) -> DataFrame:
    """(kind, canonical, resolved) of the distinct entities; a given name has one resolved kind per script: the gender of
    its titles, neutral for none or both."""
    own = entities.select("kind", "canonical").distinct()
    given, name = F.col("kind").startswith("given "), F.substring_index("kind", " ", -1)
    sure = F.array_remove(F.collect_set(F.substring("kind", 7, 1)).over(Window.partitionBy(name, "canonical")), "n")
    resolved = F.concat(F.lit("given "), F.when(F.size(sure) == 1, F.get(sure, F.lit(0))).otherwise("n"), F.lit(" "), name)
    return own.where(given).withColumn("resolved", resolved).unionByName(own.where(~given).withColumn("resolved", F.col("kind")))


def assign_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canonical, surrogate) for distinct entities: one to one within a kind, and no surrogate is an entity."""
    @F.pandas_udf("string")
    def draw(kind: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *row) for row in zip(kind, canonical, attempt)], dtype=object)

    family = F.regexp_replace("kind", " .*", "")
    entities = written(entities.select("kind", "canonical").distinct().withColumn("family", family), "entities")
    real = entities.select("family", F.col("canonical").alias("surrogate")).distinct()
    settled, pending = None, entities.withColumn("attempt", F.lit(0))
    while not pending.isEmpty():
        drawn = written(pending.withColumn("surrogate", draw("kind", "canonical", "attempt")), "draws")
        free = drawn.join(real, ["family", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("family", "surrogate"), ["family", "surrogate"], "left_anti")
        winners = free.groupBy("family", "surrogate").agg(F.min(F.struct("canonical", "kind")).alias("who"))
        winners = winners.select("who.kind", "who.canonical", "family", "surrogate")
        settled = written(winners if settled is None else settled.unionByName(winners), "surrogates")
        pending = written(drawn.join(settled.select("kind", "canonical"), ["kind", "canonical"], "left_anti")
                          .select("kind", "canonical", "family", (F.col("attempt") + 1).alias("attempt")), "pending")
    if settled is None:
        return entities.select("kind", "canonical", F.lit("").alias("surrogate"))
    return settled.select("kind", "canonical", "surrogate")


def replace_entities(docs: DataFrame, text: str = "text", length: str | None = "n_chars", key: str = KEY, count: str | None = None) -> DataFrame:
    """The same rows and columns with surrogates in `text`; `length`, if there, follows the text; `count`, if named, is a
    new column with the number of mentions.

    Null and empty texts and texts without an entity stay as they are. Equal texts are replaced alike, whatever their
    ids, and repeated rows stay repeated. The result depends on the key and on the corpus's entities, not on the order
    or the partitions of its rows.
    """
    found = written(find_mentions(docs, text), "mentions")
    kinds = written(one_gender(found), "kinds")
    new = assign_surrogates(kinds.select(F.col("resolved").alias("kind"), "canonical"), key)
    new = kinds.join(new.withColumnRenamed("kind", "resolved"), ["resolved", "canonical"]).select("kind", "canonical", "surrogate")
    by_text = found.join(new, ["kind", "canonical"]).groupBy("mark").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "kind", "surrogate"))).alias("mentions"))

    @F.pandas_udf("string")
    def rewrite(text: pd.Series, of_text: pd.Series) -> pd.Series:
        out = []
        for content, own in zip(text, of_text):
            parts, at = [], 0
            for m in own if own is not None else ():
                parts += [content[at:m["start"]], in_format(content[m["start"]:m["stop"]], m["kind"], m["surrogate"])]
                at = m["stop"]
            out.append("".join([*parts, content[at:]]))
        return pd.Series(out, dtype=object)

    names = {n: free_name(docs, n) for n in ("mark", "mentions", "changed")}
    may = may_hold(F.col(f"`{text}`"))
    by_text = by_text.withColumnsRenamed({"mark": names["mark"], "mentions": names["mentions"]})
    joined = docs.where(may).withColumn(names["mark"], text_mark(F.col(f"`{text}`"))).join(by_text, names["mark"], "left")
    changed = joined.withColumn(names["changed"], F.when(F.col(names["mentions"]).isNull(), F.col(f"`{text}`")).otherwise(
        rewrite(F.col(f"`{text}`"), F.col(names["mentions"]))))

    def column(name: str) -> Column:
        if name == text:
            return F.col(names["changed"]).alias(text)
        if name == length:
            return F.when(F.col(names["mentions"]).isNull(), F.col(f"`{name}`")).otherwise(
                F.length(names["changed"])).cast(docs.schema[name].dataType).alias(name)
        return F.col(f"`{name}`")

    n = [] if count is None else [F.coalesce(F.size(names["mentions"]), F.lit(0)).cast("long").alias(count)]
    none = [] if count is None else [F.lit(0).cast("long").alias(count)]
    rest = docs.where(~may).select(*[F.col(f"`{c}`") for c in docs.columns], *none)
    return rest.unionByName(changed.select(*[column(c) for c in docs.columns], *n))
