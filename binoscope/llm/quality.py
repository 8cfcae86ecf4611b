"""Quality rules: base counts, and the Jensen-Shannon divergence of a document from language references.

Everything is a DataFrame expression on one row: the only shuffles are the sums behind the references, which hold one
row per language and class or common word, and, where the documents name a language without a word list, the count of
that language's words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binoscope.llm.text import free_name, let

# Frequent function words of each language that has a reference.
COMMON_WORDS = {
    "en": "the of and to a in is that for was on with he are be by from this at or it an you as his have not but they which".split(),
    "de": "der die und den das nicht ein von zu ist für auf mit sich des dem als auch eine im es an so aus bei wie nach oder war sind".split(),
    "es": "de la que el en y los se del las un por con no una para su al lo como más pero sus le ya o este sí porque esta".split(),
    "fr": "de la le et les des un une du en que est pour dans qui pas au sur ne se ce il plus par avec son sont je vous elle".split(),
}
# Character classes, taken away from a text one after the other; what is left is the class "other".
CLASSES = [("lower", "[a-z]+"), ("space", "[\\x20\\x09-\\x0D]+"), ("symbol", "[#*$%&|<>]+"), ("upper", "[A-Z]+"),
           ("mark", "[.,;:!?'\"()\\-]+"), ("digit", "[0-9]+")]
CLASS_NAMES = [name for name, _ in CLASSES] + ["other"]

LEAST_WORDS = 50            # fewer words fail the base rule
LEAST_CHARACTERS = 200      # guard of the character histogram
LEAST_COUNTED_WORDS = 80    # guard of the common-word histogram
LEARNED_WORDS = 32          # common words of a language without a list
LONGEST_COMMON_WORD = 32    # characters of a learned common word
LEAST_REFERENCE_WORDS = 1_000   # a language with fewer words in all its documents has no reference
MOST_LANGUAGES = 256        # more values of lang are an error
MOST_CLASS_DIVERGENCE = 0.09
MOST_WORD_DIVERGENCE = 0.1


def words_of(text: Column) -> Column:
    """Runs of anything but white space; null and empty texts have none."""
    body = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(body) > 0, F.split(body, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def class_lengths(text: Column) -> Column:
    """Number of characters by class, as an array in the order of CLASS_NAMES."""
    def step(left: Column, rest: list[tuple[str, str]], counts: list[Column]) -> Column:
        if not rest:
            return F.array(*counts, F.length(left))
        return let(F.regexp_replace(left, rest[0][1], ""),
                   lambda less: step(less, rest[1:], [*counts, F.length(left) - F.length(less)]))
    return let(F.coalesce(text, F.lit("")), lambda whole: step(whole, CLASSES, []))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long")


def _window(words: Column, place: Column) -> Column:
    return F.concat_ws(" ", F.get(words, place), F.get(words, place + 1), F.get(words, place + 2))


def window_keys(words: Column) -> Column:
    """array<long>: for each three-word window its hash, with the low bits replaced by its place.

    Sorted, they bring equal windows together; hashes that agree by chance are told apart by `repeated_words`.
    """
    def keys(part: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
            F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(part).bitwiseOR(i.cast("long")))
    return F.when(F.size(words) > 3, let(_hash_part(words), keys)).otherwise(F.array().cast("array<long>"))


def _hash_part(words: Column) -> Column:
    """All bits but those that a place in this text needs."""
    return F.when(F.size(words) < 2 ** 16, F.lit(-(2 ** 16))).otherwise(F.lit(-(2 ** 31)))


def repeated_words(words: Column, keys: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text; keys: the sorted `window_keys`.

    Windows whose key has an equal neighbour are compared as texts. Each repeated place, in order, then covers up to
    three words that the place before does not.
    """
    def alike(own: Column, part: Column) -> Column:
        pairs = F.array_compact(F.zip_with(own, F.slice(own, 2, F.greatest(F.size(own), F.lit(1))),
                                           lambda a, b: F.when(a.bitwiseAND(part) == b.bitwiseAND(part), F.array(a, b))))
        return F.array_distinct(F.flatten(pairs))

    def equal(windows: Column) -> Column:
        def one(i: Column) -> Column:
            own = F.get(windows, i)
            return F.when((own["w"] == F.get(windows, i - 1)["w"]) | (own["w"] == F.get(windows, i + 1)["w"]), own["i"])
        return F.array_compact(F.transform(F.sequence(F.lit(0), F.size(windows) - 1), one))

    def covered(places: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.size(places)), F.lit(0),
                           lambda total, i: total + F.least(F.lit(3), F.coalesce(F.get(places, i) - F.get(places, i - 1), F.lit(3))))

    def count(close: Column) -> Column:
        windows = F.sort_array(F.transform(close, lambda key: let(
            key.bitwiseAND(F.bitwise_not(_hash_part(words))).cast("int"), lambda i: F.struct(_window(words, i).alias("w"), i.alias("i")))))
        places = F.sort_array(let(windows, equal))
        return let(places, lambda own: F.when(F.size(own) > 0, covered(own)).otherwise(F.lit(0)))

    return let(let(_hash_part(words), lambda part: alike(keys, part)), lambda close: F.when(F.size(close) > 0, count(close)).otherwise(F.lit(0))).cast("long")


def common_counts(words: Column, lexicon: list[str]) -> Column:
    """array<struct<word, n>>: how often each word of the lexicon stands in the text, by runs of the sorted hits."""
    def runs(hits: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(hits) - 1),
                          lambda i: (i == 0) | (F.get(hits, i) != F.get(hits, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda start, k: F.struct(
            F.get(hits, start).alias("word"), (F.coalesce(F.get(at, k + 1), F.size(hits)) - start).alias("n"))))

    hits = F.sort_array(F.filter(words, lambda w: w.isin(lexicon)))
    return let(hits, lambda own: F.when(F.size(own) > 0, runs(own)).otherwise(
        F.array().cast("array<struct<word:string,n:int>>")))


def _divergence_term(p: Column, q: Column) -> Column:
    """One cell's part of the Jensen-Shannon divergence in bits; 0 where both are 0."""
    zero = F.lit(0.0)
    return (F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(zero)
            + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(zero)) / 2


class References:
    """Histograms of each language: shares of the character classes, and of the common words and all others.

    `unknown` are the languages that documents name and that have no reference.
    """

    def __init__(self, classes: dict[str, list[float]], words: dict[str, dict[str, float]], lexicon: list[str], unknown: list[str]):
        self.classes, self.words, self.lexicon, self.unknown = classes, words, lexicon, unknown

    def class_divergence(self, counts: Column) -> Column:
        """From the nearest language."""
        total = F.aggregate(counts, F.lit(0), lambda a, n: a + n).cast("double")

        def to(share: list[float], p: Column) -> Column:
            return reduce(lambda a, b: a + b, [_divergence_term(p[k], F.lit(q)) for k, q in enumerate(share)])
        shares = let(F.greatest(total, F.lit(1.0)), lambda n: F.transform(counts, lambda c: c / n))
        return let(shares, lambda p: F.array_min(F.array(*[to(s, p) for s in self.classes.values()], F.lit(1.0))))

    def word_divergence(self, counts: Column, n_words: Column) -> Column:
        """From the nearest language; a common word that a text lacks adds half its share."""
        def to(share: dict[str, float], own: Column) -> Column:
            q = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])

            def add(state: Column, cell: Column) -> Column:
                p = cell["n"] / n_words
                ref = F.coalesce(F.try_element_at(q, cell["word"]), F.lit(0.0))
                return F.struct((state["d"] + _divergence_term(p, ref)).alias("d"), (state["p"] + p).alias("p"),
                                (state["q"] + ref).alias("q"))
            start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
            sums = F.aggregate(own, start, add)
            known = F.lit(float(sum(share.values())))
            return let(sums, lambda s: s["d"] + (known - s["q"]) / 2 + _divergence_term(F.greatest(1 - s["p"], F.lit(0.0)), 1 - known))
        return let(counts, lambda own: F.array_min(F.array(*[to(s, own) for s in self.words.values()], F.lit(1.0))))


def learned_words(own: DataFrame) -> dict[str, list[str]]:
    """own(lang, text): the LEARNED_WORDS most frequent words of each language, ties to the first in order.

    A common word is made of letters and marks only. Counts are summed before they are shuffled, and only the listed
    words of a language reach the driver.
    """
    words = own.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    words = words.where((F.length("word") <= LONGEST_COMMON_WORD) & F.col("word").rlike("^[\\p{L}\\p{M}]+$"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    found: dict[str, list[str]] = {}
    for row in counts.withColumn("place", place).where(F.col("place") <= LEARNED_WORDS).collect():
        found.setdefault(row["lang"], []).append(row["word"])
    return found


def fit_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """Sums over all documents of each language that `lang` names; one small row per language and class or word.

    The common words of a language without a list in COMMON_WORDS are learned from its documents. A language with
    fewer than LEAST_REFERENCE_WORDS words in all has no reference; without any reference every divergence is the
    upper bound 1.
    """
    own = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    named = sorted(r["lang"] for r in own.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(named) > MOST_LANGUAGES:
        raise ValueError(f"More than {MOST_LANGUAGES} languages.")
    unlisted = [name for name in named if name not in COMMON_WORDS]
    lists = {name: COMMON_WORDS[name] for name in named if name in COMMON_WORDS}
    if unlisted:
        lists |= learned_words(own.where(F.col("lang").isin(unlisted)))
    lexicon = sorted({w for words in lists.values() for w in words})
    counted = own.select("lang", class_lengths(F.col("text")).alias("classes"), words_of(F.col("text")).alias("words"))
    cells = counted.select("lang", F.inline(F.concat(
        F.array(F.struct(F.lit("all words").alias("word"), F.size("words").alias("n"))),
        *[F.array(F.struct(F.lit(f"class {k}").alias("word"), F.col("classes")[i].alias("n"))) for i, k in enumerate(CLASS_NAMES)],
        common_counts(F.col("words"), lexicon))))
    # A common word has no blank, so it is none of the names of the other cells.
    sums = {(r["lang"], r["word"]): r["n"] for r in cells.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()}
    classes, words = {}, {}
    for name in named:
        total = sum(sums.get((name, f"class {k}"), 0) for k in CLASS_NAMES)
        all_words = sums.get((name, "all words"), 0)
        if total and all_words >= LEAST_REFERENCE_WORDS:
            classes[name] = [sums.get((name, f"class {k}"), 0) / total for k in CLASS_NAMES]
            words[name] = {w: sums[name, w] / all_words for w in lexicon if (name, w) in sums} or {"": 0.0}
    return References(classes, words, lexicon, [name for name in named if name not in classes])


def judged(docs: DataFrame, references: References, name: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """docs with a struct column `name`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_divergence, word_divergence (null without words), kept."""
    # No reference says nothing against a document.
    unknown = F.coalesce(F.col(f"`{lang}`").isin(references.unknown), F.lit(False)) if references.unknown else F.lit(False)
    def verdict(words: Column, classes: Column, repeats: Column) -> Column:
        n = F.size(words)
        characters = F.aggregate(classes, F.lit(0), lambda a, c: a + c)
        failed = (n < LEAST_WORDS) | (100 * repeats > 50 * n)
        by_class, by_word = references.class_divergence(classes), F.when(n > 0, references.word_divergence(common_counts(words, references.lexicon), n))

        def close(c: Column, w: Column) -> Column:
            return (((characters < LEAST_CHARACTERS) | (c <= MOST_CLASS_DIVERGENCE))
                    & ((n < LEAST_COUNTED_WORDS) | (w <= MOST_WORD_DIVERGENCE)))
        return let(by_class, lambda c: let(by_word, lambda w: F.struct(
            n.cast("long").alias("n_words"), (characters - classes[1]).cast("long").alias("word_chars"),
            classes[2].cast("long").alias("n_symbols"), duplicate_lines(F.col(f"`{text}`")).alias("n_dup_lines"),
            repeats.alias("n_repeat_words"), failed.alias("base_failed"), c.alias("class_divergence"),
            w.alias("word_divergence"), (~failed & (unknown | close(c, w))).alias("kept"))))

    # The keys are sorted in a column of their own, where Spark compiles the sort of plain longs.
    words, keys = free_name(docs, "words"), free_name(docs, "window_keys")
    split = docs.withColumn(words, words_of(F.col(f"`{text}`")))
    keyed = split.withColumn(keys, F.sort_array(window_keys(F.col(words))))
    struct = let(class_lengths(F.col(f"`{text}`")), lambda classes: let(
        repeated_words(F.col(words), F.col(keys)), lambda repeats: verdict(F.col(words), classes, repeats)))
    # A generator with one row: filters on the verdict stay above it instead of repeating its whole expression below.
    return keyed.select("*", F.explode(F.array(struct)).alias(name)).drop(words, keys)


def quality(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: id and the fields of `judged`.

    Null, empty and blank texts have no words and fail the base rule. Repeated rows give repeated results, an empty
    table gives no rows, and columns other than id, text and lang are not read. `lang` decides which reference a document
    adds to; a document is held against the nearest reference, whatever its `lang` says, unless that names a language
    with too few words for a reference: then the base rules alone decide.
    """
    references = fit_references(docs, text, lang)
    verdict = free_name(docs, "verdict")
    return judged(docs.select(id, text, lang), references, verdict, text, lang).select(id, f"{verdict}.*")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose documents pass the base rules and stay near a language; all columns as they are."""
    verdict = free_name(docs, "verdict")
    return judged(docs, fit_references(docs, text, lang), verdict, text, lang).where(F.col(verdict)["kept"]).drop(verdict)
