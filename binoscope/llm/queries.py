"""The registered queries of this folder, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binoscope.llm import bpe, chat, collocations, decontaminate, language, licenses, minhash, packing, pii, quality, ranked, toxicity, urls
from binoscope.llm.shared import findable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_benchmark_fm_index")
def benchmark_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_quality_divergence")
def quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@query("op10_license_notices")
def license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_url_trie", """
    WITH parts AS (
        SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS place FROM pages),
    cut AS (
        SELECT page_id, CASE WHEN place > 0 THEN substr(url, place + 3) ELSE '' END AS rest FROM parts),
    named AS (
        SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    found AS (
        SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                       WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM named)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM found""")
def url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query("op1_minhash_components")
def minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_nnls_packing")
def nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def fold(column: str, parts: int):
    """crc32 of the id as text, modulo the parts; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


@query("op9_counterfactual_toxicity")
def counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold("doc_id", 3) != 1))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op3_segmentation_language")
def segmentation_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(fold("doc_id", 4) != 2))
    named = language.identify(docs, model)
    return named.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op6_pii_surrogates")
def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, length=None, count="n_entities")


@query("op4_perspective_rotation", """
    WITH own AS (
        SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, coalesce(text, '')) - 1 AS place FROM conversations),
    people AS (SELECT DISTINCT conv_id, role AS perspective FROM own WHERE role <> 'system'),
    convs AS (SELECT DISTINCT conv_id FROM own),
    seen AS (SELECT convs.conv_id, perspective FROM convs LEFT JOIN people ON convs.conv_id IS NOT DISTINCT FROM people.conv_id),
    messages AS (
        SELECT conv_id, place // 256 AS part, place, role, text FROM own
        UNION ALL
        SELECT own.conv_id, part, -1, 'system', text FROM own JOIN (SELECT DISTINCT conv_id, place // 256 AS part FROM own WHERE place >= 256) later
            ON own.conv_id IS NOT DISTINCT FROM later.conv_id WHERE place = 0 AND role = 'system'),
    pieces AS (
        SELECT seen.conv_id, perspective, part, place, coalesce(role = perspective, false) AS mine,
               '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
                   ELSE 'user name=' || regexp_replace(coalesce(role, 'unknown'), '[\\r\\n<>|]+', ' ', 'g') END || chr(10) AS head,
               replace(replace(text, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') || '<|im_end|>' AS body
        FROM messages JOIN seen ON messages.conv_id IS NOT DISTINCT FROM seen.conv_id),
    laid AS (
        SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pieces)
    SELECT conv_id, perspective, part, count(*) FILTER (WHERE place >= 0) AS n_turns, count(*) FILTER (WHERE mine) AS n_spoken,
           string_agg(head || body || chr(10), '' ORDER BY place) AS text,
           coalesce(string_agg(CAST(before + length(head) AS BIGINT)::VARCHAR || ':' || CAST(before + length(head) + length(body) AS BIGINT)::VARCHAR, ','
                    ORDER BY place) FILTER (WHERE mine), '') AS loss_spans
    FROM laid GROUP BY conv_id, perspective, part""")
def perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


@query("op13_contiguous_rank_bpe")
def contiguous_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents")).withColumn("decoded", bpe.decode("ids"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


RANKED_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op11_interval_rmq_search", f"""
    WITH lists AS (SELECT doc_id, {RANKED_WORDS} AS words FROM documents),
    docs AS (SELECT doc_id, len(words) AS n FROM lists WHERE len(words) > 0),
    sums AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS words FROM docs),
    held AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS word FROM lists) GROUP BY doc_id, word),
    asked AS (SELECT item_id, word, count(*) AS repeats FROM (SELECT item_id, unnest({RANKED_WORDS}) AS word FROM benchmark) GROUP BY item_id, word),
    weights AS (SELECT word, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, sums GROUP BY word, documents),
    scores AS (SELECT item_id, held.doc_id,
            CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * documents) // sums.words))))) AS BIGINT) AS score
        FROM asked JOIN held USING (word) JOIN weights USING (word) JOIN docs ON docs.doc_id = held.doc_id, sums GROUP BY item_id, held.doc_id),
    placed AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0)
    SELECT * FROM placed WHERE rank <= 20""")
def interval_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_prefix_free_collocations", """
    WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
    lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces),
    grams AS (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
        FROM lists, range(1, 6) t(k) WHERE len(words) >= k),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k > 1 AND f >= 100),
    cut AS (SELECT lang, phrase, a, c AS cut, array_to_string(words[1:c], ' ') AS first, array_to_string(words[c + 1:], ' ') AS rest
        FROM candidates, range(1, 5) t(c) WHERE c < k),
    scored AS (SELECT cut.lang, cut.phrase, a, n, cut, l.f AS l, r.f AS r,
            CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
        FROM cut JOIN counts l ON l.lang = cut.lang AND l.phrase = first JOIN counts r ON r.lang = cut.lang AND r.phrase = rest
        JOIN totals ON totals.lang = cut.lang),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inside AS (SELECT lang, array_to_string(words[b:b + s - 1], ' ') AS phrase, max(a) AS longer
        FROM candidates, range(2, 5) t(s), range(1, 5) u(b) WHERE s < k AND b + s - 1 <= k GROUP BY 1, 2),
    kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase
        WHERE longer IS NULL OR longer < a),
    placed AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
    SELECT * FROM placed WHERE rank <= 2000""")
def prefix_free_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
