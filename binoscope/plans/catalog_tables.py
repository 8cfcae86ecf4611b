"""Queries on tables: sources and sinks, contracts, profiles, splits, feature preparation."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from binoscope.operators import checks, prepare, profile, split
from binoscope.operators.models import Features, assemble
from binoscope.plans import bindings as B
from binoscope.plans import sqltext as S
from binoscope.plans.registry import register, rounded
from binoscope.session import shared_folder
from binoscope.sources import sinks
from binoscope.sources.tables import load, read_records, read_table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Bounds and lists that part of the rows break, so that the checks have something to find.
TIGHT_BOUNDS = {"totalprice": (1000, 400000), "acctbal": (0, None), "order_year": (1993, 1997), "order_month": (1, 12)}
SHORT_LISTS = {"priority": ("1-URGENT", "2-HIGH", "3-MEDIUM"), "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")}


def _scratch(spark) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{uuid4().hex}"


# ---- sources and sinks

@register("A1_csv_source", f"""WITH {S.CLS} SELECT segment, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
  round(sum(totalprice), 2) + 0.0 AS total, min(id) AS first_id, max(id) AS last_id FROM cls GROUP BY segment""")
def csv_source(spark, sf_dir):
    path = _scratch(spark)
    raw = B.cls(spark, sf_dir).withColumn("y", F.when(F.col("y") == 1, "F").otherwise("O"))
    raw.select(*B.CLS_SPEC.required).write.option("header", True).csv(path)
    back = checks.encode_label(read_table(spark, path, B.CLS_SPEC), "y", B.CLS_SPEC.labels)
    return rounded(back.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), F.sum("totalprice").alias("total"),
                                               F.min("id").alias("first_id"), F.max("id").alias("last_id")), 2)


@register("A2_json_source", """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, min(event_id) AS first_id,
  max(event_id) AS last_id, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY event_type""")
def json_source(spark, sf_dir):
    path = _scratch(spark)
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    # Documents of at most 1,000 unique ids each, one per line.
    documents = events.groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(
        F.collect_list(F.struct("event_id", "user_id", "event_type", "value")).alias("records"))
    documents.select(F.to_json(F.struct("records"))).write.text(path)
    back = read_records(spark, path, schema=events.schema, whole_file=False)
    return rounded(back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"),
                                                  F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
                                                  F.sum("value").alias("total")), 4)


@register("A3_report_sink", f"""WITH {S.CLS} SELECT 'run-1' AS run_id, priority, count(*) AS n, round(avg(y), 6) + 0.0 AS rate
  FROM cls GROUP BY priority""")
def report_sink(spark, sf_dir):
    root = _scratch(spark)
    table = B.cls(spark, sf_dir).groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("rate"))
    sinks.write_report(table, root, "run-1", "rates")
    sinks.write_report(table.where("n < 0"), root, "run-2", "rates")
    return rounded(sinks.read_report(spark, root, "rates", "run-1").select("run_id", "priority", "n", "rate"))


@register("A4_strict_json_sink", f"""WITH {S.CLS_NULLS} SELECT id, y, round(totalprice, 4) + 0.0 AS totalprice, segment FROM cls_nulls""")
def strict_json_sink(spark, sf_dir):
    path = _scratch(spark)
    rows = B.cls_nulls(spark, sf_dir).select("id", "y", "totalprice", "segment")
    sinks.write_json_strict(rows, path)
    return rounded(spark.read.schema(rows.schema).json(path), 4)


@register("A5_flatten_nested", f"""WITH {S.CLS} SELECT region, count(*) AS n,
  '{{"by_class":{{"n0":' || CAST(sum(1 - y) AS BIGINT) || ',"n1":' || CAST(sum(y) AS BIGINT) || '}},"first":' || min(id) || '}}' AS summary,
  '[' || min(id) || ',' || max(id) || ']' AS span FROM cls GROUP BY region""")
def flatten_nested(spark, sf_dir):
    nested = B.cls(spark, sf_dir).groupBy("region").agg(
        F.count(F.lit(1)).alias("n"),
        F.struct(F.min("id").alias("first"), F.map_from_arrays(F.array(F.lit("n1"), F.lit("n0")), F.array(
            F.sum("y"), F.sum(1 - F.col("y")))).alias("by_class")).alias("summary"),
        F.array(F.min("id"), F.max("id")).alias("span"))
    return sinks.flatten_nested(nested, ["region", "n", "summary", "span"])


@register("A6_parquet_source", """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) + 0.0 AS quantity
  FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def parquet_source(spark, sf_dir):
    return rounded(load(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")), 2)


# ---- contracts

@register("B1_check_columns", f"""WITH {S.CLS} SELECT 'train' AS mode, count(*) AS n_rows, 'none' AS problem FROM cls
  UNION ALL SELECT 'train', count(*), 'missing columns: segment; unexpected columns: market' FROM cls""")
def check_columns(spark, sf_dir):
    return _column_report(B.cls(spark, sf_dir), "train")


@register("B2_check_scoring_columns", f"""WITH {S.CLS} SELECT 'score' AS mode, count(*) AS n_rows, 'unexpected columns: y' AS problem FROM cls
  UNION ALL SELECT 'score', count(*), 'missing columns: segment; unexpected columns: market, y' FROM cls""")
def check_scoring_columns(spark, sf_dir):
    return _column_report(B.cls(spark, sf_dir), "score")


def _column_report(cls, mode):
    reports = []
    for frame in (cls, cls.withColumnRenamed("segment", "market")):
        try:
            checks.check_columns(frame, B.CLS_SPEC, mode)
            problem = "none"
        except checks.ContractError as error:
            problem = str(error)
        reports.append(frame.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n_rows"), F.lit(problem).alias("problem")))
    return reports[0].unionByName(reports[1])


def _rule(rule: str, column: str, condition: str, source: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{column}' AS \"column\", CAST(coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT) "
            f"AS n_bad FROM {source}")


def _bounds_rules() -> str:
    parts = []
    for name, (low, high) in TIGHT_BOUNDS.items():
        outside = f"{name} < {low}" + (f" OR {name} > {high}" if high is not None else "")
        parts += [_rule("finite", name, f"isinf({name})", "cls_nulls"), _rule("whole", name, f"{name} % 1 <> 0", "cls_nulls"),
                  _rule("bounds", name, outside, "cls_nulls")]
    return " UNION ALL ".join(parts)


@register("B3_numeric_violations", f"WITH {S.CLS_NULLS} {_bounds_rules()}")
def numeric_violations(spark, sf_dir):
    return checks.numeric_violations(B.cls_nulls(spark, sf_dir), TIGHT_BOUNDS).select("rule", "column", "n_bad")


@register("B4_category_violations", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    _rule("blank", c, f"trim({c}) = ''", "cls_nulls") + " UNION ALL "
    + _rule("known", c, f"{c} NOT IN ({', '.join(repr(v) for v in vs)})", "cls_nulls") for c, vs in SHORT_LISTS.items()))
def category_violations(spark, sf_dir):
    return checks.category_violations(B.cls_nulls(spark, sf_dir), SHORT_LISTS).select("rule", "column", "n_bad")


@register("B4_unexpected_categories", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM cls_nulls WHERE {c} NOT IN ({', '.join(repr(v) for v in vs)}) GROUP BY {c}"
    for c, vs in SHORT_LISTS.items()))
def unexpected_categories(spark, sf_dir):
    return checks.unexpected_categories(B.cls_nulls(spark, sf_dir), SHORT_LISTS)


@register("B5_label_violations", f"""{_rule('label_null', 'o_orderstatus', 'o_orderstatus IS NULL', 'orders')} UNION ALL
  {_rule('label_known', 'o_orderstatus', "o_orderstatus NOT IN ('F', 'O')", 'orders')} UNION ALL
  SELECT 'label_classes', 'o_orderstatus', CAST(2 - max(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)
    - max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) FROM orders""")
def label_violations(spark, sf_dir):
    return checks.label_violations(load(spark, sf_dir, "orders"), "o_orderstatus", {"F": 1, "O": 0}).select("rule", "column", "n_bad")


@register("B6_key_violations", f"""{_rule('key_null', 'l_orderkey', 'l_orderkey IS NULL', 'lineitem')} UNION ALL
  {_rule('key_positive', 'l_orderkey', 'l_orderkey <= 0', 'lineitem')} UNION ALL
  {_rule('key_whole', 'l_orderkey', 'l_orderkey % 1 <> 0', 'lineitem')} UNION ALL
  SELECT 'key_unique', 'l_orderkey', CAST(count(l_orderkey) - count(DISTINCT l_orderkey) AS BIGINT) FROM lineitem""")
def key_violations(spark, sf_dir):
    return checks.key_violations(load(spark, sf_dir, "lineitem"), "l_orderkey").select("rule", "column", "n_bad")


@register("B7_duplicate_rows", """WITH doubled AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 2)
  SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS duplicate_rows FROM doubled""")
def duplicate_rows(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    return checks.duplicate_rows(lines.unionByName(lines.where("l_linenumber = 2")))


@register("B8_constant_check", " UNION ALL ".join([
    _rule("constant", "o_orderstatus", "o_orderstatus IS DISTINCT FROM 'F'", "orders"),
    _rule("constant", "o_custkey", "o_custkey IS DISTINCT FROM 1", "orders")]))
def constant_check(spark, sf_dir):
    return checks.constant_check(load(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_custkey": 1}).select("rule", "column", "n_bad")


NULL_COLUMNS = ["totalprice", "acctbal", "order_year", "priority", "segment", "region"]


@register("B9_null_columns", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, count({c}) = 0 AS all_missing FROM cls_nulls" for c in NULL_COLUMNS)
    + " UNION ALL SELECT 'never', count(*), TRUE FROM cls_nulls")
def null_columns(spark, sf_dir):
    frame = B.cls_nulls(spark, sf_dir).withColumn("never", F.lit(None).cast("string"))
    return checks.null_columns(frame, [*NULL_COLUMNS, "never"])


@register("B10_check_scored", f"""WITH {S.SCORED}, odd AS (
  SELECT id // 2 AS id, CASE WHEN id % 101 = 0 THEN NULL ELSE y END AS y, CASE WHEN id % 103 = 0 THEN p + 1 ELSE p END AS p FROM scored)
  {_rule('binary_label', 'y', 'y IS NULL OR y NOT IN (0, 1)', 'odd')} UNION ALL
  {_rule('score_range', 'p', 'p IS NULL OR p < 0 OR p > 1', 'odd')} UNION ALL
  SELECT 'key_unique', 'id', CAST(count(id) - count(DISTINCT id) AS BIGINT) FROM odd""")
def check_scored(spark, sf_dir):
    odd = B.scored(spark, sf_dir).select(
        F.floor(F.col("id") / 2).cast("long").alias("id"), F.when(F.col("id") % 101 != 0, F.col("y")).alias("y"),
        F.when(F.col("id") % 103 == 0, F.col("p") + 1).otherwise(F.col("p")).alias("p"))
    return checks.check_scored(odd).select("rule", "column", "n_bad")


@register("B11_normalize_missing", f"""WITH {S.CLS_NULLS} SELECT id, round(totalprice, 4) + 0.0 AS totalprice, round(acctbal, 4) + 0.0 AS acctbal,
  priority FROM cls_nulls""")
def normalize_missing(spark, sf_dir):
    rows = B.cls_nulls(spark, sf_dir)
    mixed = rows.select("id", F.coalesce("totalprice", F.lit(float("nan"))).alias("totalprice"), "acctbal", "priority")
    return rounded(checks.normalize_missing(mixed), 4)


@register("B12_encode_label", """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS BIGINT) AS y FROM orders""")
def encode_label(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return rounded(checks.encode_label(orders, "o_orderstatus", {"F": 1, "O": 0}).select("o_orderkey", "y"))


@register("B13_select_features", f"""WITH {S.CLS} SELECT id, round(totalprice, 4) + 0.0 AS totalprice, order_year, order_month, priority, region
  FROM cls""")
def select_features(spark, sf_dir):
    return rounded(checks.select_features(B.cls(spark, sf_dir), B.CLS_SPEC, exclude=["acctbal", "segment"], keep=["id"]), 4)


# ---- profiles

AUDIT_TYPES = {"id": "bigint", "y": "int", "totalprice": "double", "acctbal": "double", "order_year": "double", "order_month": "double",
               "priority": "string", "segment": "string", "region": "string"}


def _audit_sql() -> str:
    parts = [f"""SELECT '{c}' AS "column", '{t}' AS dtype, '{'categorical' if t == 'string' else 'numeric'}' AS kind, count(*) AS n_rows,
      count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_distinct,
      count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END = 1 AS constant FROM cls_nulls""" for c, t in AUDIT_TYPES.items()]
    return f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(parts)


@register("C1_audit", _audit_sql())
def audit(spark, sf_dir):
    return profile.audit(B.cls_nulls(spark, sf_dir))


@register("C1_audit_summary", """SELECT count(*) AS n_rows, (SELECT count(*) + 1 FROM (DESCRIBE lineitem)) AS n_columns,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows,
  0 AS n_missing, 'always' AS constant_columns FROM lineitem""")
def audit_summary(spark, sf_dir):
    return profile.audit_summary(load(spark, sf_dir, "lineitem").withColumn("always", F.lit("x")))


def _describe(column: str, source: str, digits: int = 4) -> str:
    stats = {"mean": f"avg({column})", "std": f"stddev_samp({column})", "min": f"min({column})", "q25": f"quantile_cont({column}, 0.25)",
             "q50": f"quantile_cont({column}, 0.5)", "q75": f"quantile_cont({column}, 0.75)", "max": f"max({column})"}
    return (f"SELECT '{column}' AS feature, count({column}) AS count, "
            + ", ".join(f"round(CAST({e} AS DOUBLE), {digits}) + 0.0 AS {n}" for n, e in stats.items()) + f" FROM {source}")


@register("C2_describe_numeric", " UNION ALL ".join(_describe(c, "lineitem") for c in LINE_NUMBERS))
def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(load(spark, sf_dir, "lineitem"), LINE_NUMBERS), 4)


def _describe_all_sql() -> str:
    numeric = [f"""SELECT feature, count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,
      mean, std, min, q25, q50, q75, max FROM ({_describe(c, 'cls_nulls')})""" for c in B.NUMERIC]
    empty = ", ".join("CAST(NULL AS DOUBLE)" for _ in range(7))
    text = [f"""SELECT '{c}', count({c}), count(DISTINCT {c}),
      (SELECT {c} FROM cls_nulls WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
      (SELECT count(*) FROM cls_nulls WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), {empty} FROM cls_nulls"""
            for c in B.CATEGORICAL]
    return f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(numeric + text)


@register("C3_describe_all", _describe_all_sql())
def describe_all(spark, sf_dir):
    return rounded(profile.describe_all(B.cls_nulls(spark, sf_dir), [*B.NUMERIC, *B.CATEGORICAL]), 4)


def _outliers(column: str, k: float = 0.75) -> str:
    return f"""SELECT '{column}' AS feature, CAST(sum(CASE WHEN {column} < q1 - {k} * (q3 - q1) OR {column} > q3 + {k} * (q3 - q1) THEN 1 ELSE 0 END)
      AS BIGINT) AS outlier_count FROM lineitem, (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM lineitem)"""


@register("C4_iqr_outliers", " UNION ALL ".join(_outliers(c, 0.45) for c in LINE_NUMBERS))
def iqr_outliers(spark, sf_dir):
    return profile.iqr_outliers(load(spark, sf_dir, "lineitem"), LINE_NUMBERS, k=0.45)


@register("C5_target_distribution", f"WITH {S.CLS} SELECT region, CAST(y AS BIGINT) AS y, count(*) AS count FROM cls GROUP BY region, y")
def target_distribution(spark, sf_dir):
    return rounded(profile.target_distribution(B.cls(spark, sf_dir), by=["region"]))


def _rates_sql() -> str:
    columns = [*B.NUMERIC, *B.CATEGORICAL]
    parts = [f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count, round(avg(y), 6) + 0.0 AS rate FROM cls_nulls
      WHERE {'TRUE' if c in B.CATEGORICAL else f'(SELECT count(DISTINCT {c}) FROM cls_nulls) <= 10'} GROUP BY {c}""" for c in columns]
    return f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(parts)


@register("C6_target_rates", _rates_sql())
def target_rates(spark, sf_dir):
    return rounded(profile.target_rates(B.cls_nulls(spark, sf_dir), [*B.NUMERIC, *B.CATEGORICAL], B.CATEGORICAL))


@register("C7_numeric_by_target", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(y AS BIGINT) AS y, round(avg({c}), 4) + 0.0 AS mean, round(quantile_cont({c}, 0.5), 4) + 0.0 AS median
    FROM cls_nulls GROUP BY y""" for c in B.NUMERIC))
def numeric_by_target(spark, sf_dir):
    return rounded(profile.numeric_by_target(B.cls_nulls(spark, sf_dir), B.NUMERIC), 4)


@register("C8_correlation_matrix", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, '{b}' AS other, {'max(1.0::DOUBLE)' if a == b else f'round(corr({a}, {b}), 6) + 0.0'} AS correlation FROM cls_nulls"
    for a in B.NUMERIC for b in B.NUMERIC))
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(B.cls_nulls(spark, sf_dir), B.NUMERIC))


@register("C9_histogram_by_class", f"""WITH {S.CLS_NULLS}, extent AS (
  SELECT y, min(totalprice) AS low, max(totalprice) AS high, count(totalprice) AS n_class, (max(totalprice) - min(totalprice)) / 16.0::DOUBLE AS width
  FROM cls_nulls GROUP BY y), filled AS (
  SELECT c.y, least(CAST(floor((totalprice - low) / width) AS BIGINT), 15) AS bin, count(*) AS n
  FROM cls_nulls c JOIN extent e ON c.y = e.y WHERE totalprice IS NOT NULL GROUP BY 1, 2)
  SELECT CAST(e.y AS BIGINT) AS y, b.bin, round(low + b.bin * width, 6) + 0.0 AS lower, round(low + (b.bin + 1) * width, 6) + 0.0 AS upper,
    coalesce(n, 0) AS n, round(coalesce(n, 0) / (n_class * width) * 1e6, 6) + 0.0 AS density_per_million
  FROM extent e CROSS JOIN (SELECT range AS bin FROM range(16)) b LEFT JOIN filled f ON f.y = e.y AND f.bin = b.bin""")
def histogram_by_class(spark, sf_dir):
    table = profile.histogram_by_class(B.cls_nulls(spark, sf_dir), "totalprice")
    return rounded(table.withColumn("density_per_million", F.col("density") * 1e6).drop("density"))


@register("C10_top_rows", f"WITH {S.CLS_NULLS} SELECT id, round(totalprice, 4) + 0.0 AS totalprice, segment FROM cls_nulls "
          "ORDER BY totalprice DESC NULLS LAST, id LIMIT 25")
def top_rows(spark, sf_dir):
    return rounded(profile.top_rows(B.cls_nulls(spark, sf_dir), "totalprice", 25).select("id", "totalprice", "segment"), 4)


# ---- splits and samples

SPLIT = f"""split AS (SELECT id, y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {S.hex_of('42', "'split'", 'id')})
  <= floor(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY y) + CAST(0.5 AS DOUBLE)) THEN 'test' ELSE 'train' END AS partition FROM labelled)"""


@register("D1_stratified_split", f"WITH {S.LABELLED}, {SPLIT} SELECT id, CAST(y AS BIGINT) AS y, partition FROM split")
def stratified_split(spark, sf_dir):
    return rounded(split.stratified_split(B.labelled(spark, sf_dir)))


@register("D2_split_manifest", f"WITH {S.LABELLED}, {SPLIT} SELECT id, partition FROM split")
def split_manifest(spark, sf_dir):
    return split.split_manifest(split.stratified_split(B.labelled(spark, sf_dir)))


@register("D3_stratified_folds", f"WITH {S.LABELLED} SELECT id, CAST(y AS BIGINT) AS y, {S.fold_of()} AS fold FROM labelled")
def stratified_folds(spark, sf_dir):
    return rounded(split.stratified_folds(B.labelled(spark, sf_dir)))


@register("D4_nested_folds", f"""WITH {S.LABELLED}, own AS (SELECT id, y, {S.fold_of()} AS own_fold FROM labelled),
  training AS (SELECT id, y, outer_fold FROM own, (SELECT range AS outer_fold FROM range(5)) WHERE outer_fold <> own_fold)
  SELECT id, CAST(y AS BIGINT) AS y, outer_fold, {S.fold_of(3, '42', ['outer_fold'], purpose='inner')} AS inner_fold FROM training""")
def nested_folds(spark, sf_dir):
    return rounded(split.nested_folds(B.labelled(spark, sf_dir), inner=3))


@register("D5_sample_n", f"WITH {S.LABELLED} SELECT id, CAST(y AS BIGINT) AS y FROM labelled ORDER BY {S.hex_of('42', "'sample'", 'id')} LIMIT 100")
def sample_n(spark, sf_dir):
    return rounded(split.sample_n(B.labelled(spark, sf_dir), 100))


@register("D5_sample_large", f"SELECT l_orderkey, l_linenumber, k FROM (SELECT l_orderkey, l_linenumber, k, row_number() OVER (ORDER BY "
          f"{S.hex_of('42', "'sample'", 'k')}) AS place FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS k FROM lineitem)) "
          "WHERE place <= 12000")
def sample_large(spark, sf_dir):
    keyed = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return rounded(split.sample_n(keyed.distinct(), 12_000, id="k"))


@register("D6_seeded_folds", f"""WITH {S.LABELLED}, seeded AS (SELECT id, y, seed FROM labelled, (SELECT unnest([42, 43, 44]) AS seed))
  SELECT id, CAST(y AS BIGINT) AS y, CAST(seed AS BIGINT) AS seed, {S.fold_of(5, 'seed', ['seed'])} AS fold FROM seeded""")
def seeded_folds(spark, sf_dir):
    return rounded(split.seeded_folds(B.labelled(spark, sf_dir), [42, 43, 44]))


# ---- feature preparation

def _median(column: str) -> str:
    return f"coalesce(quantile_cont({column}, 0.5), 0.0)"


@register("E1_fit_median", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({_median(c)}, 4) + 0.0 AS median FROM cls_nulls" for c in B.NUMERIC)
    + " UNION ALL SELECT 'never', 0.0 FROM (SELECT 1)")
def fit_median(spark, sf_dir):
    frame = B.cls_nulls(spark, sf_dir).withColumn("never", F.lit(None).cast("double"))
    return rounded(prepare.fit_median(frame, [*B.NUMERIC, "never"]), 4)


@register("E1_apply_fill", f"""WITH {S.CLS_NULLS} SELECT id, round(coalesce(totalprice, (SELECT {_median('totalprice')} FROM cls_nulls)), 4) + 0.0 AS totalprice,
  round(coalesce(acctbal, (SELECT {_median('acctbal')} FROM cls_nulls)), 4) + 0.0 AS acctbal FROM cls_nulls""")
def apply_fill(spark, sf_dir):
    frame = B.cls_nulls(spark, sf_dir).select("id", "totalprice", "acctbal")
    fills = {k: v[0] for k, v in prepare.literals(prepare.fit_median(frame, ["totalprice", "acctbal"]), "median").items()}
    return rounded(prepare.apply_fill(frame, fills), 4)


@register("E2_fit_mode", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"(SELECT '{c}' AS feature, {c} AS mode FROM cls_nulls WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in B.CATEGORICAL))
def fit_mode(spark, sf_dir):
    return prepare.fit_mode(B.cls_nulls(spark, sf_dir), B.CATEGORICAL)


@register("E3_fit_scale", f"WITH {S.CLS_NULLS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg({c}), 4) + 0.0 AS mean, round(CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END, 4) + 0.0 AS scale
    FROM cls_nulls""" for c in B.NUMERIC) + " UNION ALL SELECT 'same', 3.0, 1.0")
def fit_scale(spark, sf_dir):
    return rounded(prepare.fit_scale(B.cls_nulls(spark, sf_dir).withColumn("same", F.lit(3)), [*B.NUMERIC, "same"]), 4)


@register("E3_apply_scale", f"""WITH {S.CLS} SELECT id, round((totalprice - m) / s, 6) + 0.0 AS totalprice FROM cls,
  (SELECT avg(totalprice) AS m, stddev_pop(totalprice) AS s FROM cls)""")
def apply_scale(spark, sf_dir):
    frame = B.cls(spark, sf_dir).select("id", "totalprice")
    return rounded(prepare.apply_scale(frame, prepare.literals(prepare.fit_scale(frame, ["totalprice"]), "mean", "scale")))


@register("E4_one_hot", f"WITH {S.CLS_NULLS} SELECT id, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{c}_{v}\"" for c in ("segment", "region") for v in B.CLS_SPEC.categories[c])
    + " FROM cls_nulls")
def one_hot(spark, sf_dir):
    frame = B.cls_nulls(spark, sf_dir).select("id", "segment", "region")
    levels = {k: v[0] for k, v in prepare.literals(prepare.fit_levels(frame, ["segment", "region"]), "levels").items()}
    return prepare.one_hot(frame, levels)


def _scaled(column: str) -> str:
    return f"(coalesce({column}, {column}_med) - {column}_m) / {column}_s"


def _filled_stats(where: str = "TRUE") -> str:
    medians = ", ".join(f"{_median(c)} AS {c}_med" for c in B.NUMERIC)
    stats = ", ".join(f"any_value({c}_med) AS {c}_med, avg(coalesce({c}, {c}_med)) AS {c}_m, stddev_pop(coalesce({c}, {c}_med)) AS {c}_s" for c in B.NUMERIC)
    return f"SELECT {stats} FROM cls_nulls, (SELECT {medians} FROM cls_nulls WHERE {where}) WHERE {where}"


@register("E5_assemble", f"""WITH {S.CLS_NULLS}, stats AS ({_filled_stats()})
  SELECT id, 19 AS slots, round({' + '.join(_scaled(c) for c in B.NUMERIC)} + 3, 6) + 0.0 AS total FROM cls_nulls, stats""")
def assemble_vectors(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    vectors, names = assemble(B.cls_nulls(spark, sf_dir), Features(tuple(B.NUMERIC), tuple(B.CATEGORICAL)))
    slots = vectors.select("id", F.size(vector_to_array("features")).alias("slots"),
                           F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("total"))
    return rounded(slots)


FOLDED_NULLS = f"""{S.CLS_NULLS}, folded_nulls AS (SELECT *, {S.fold_of()} AS fold FROM cls_nulls)"""


def _fold_stats_sql() -> str:
    parts = [f"""SELECT o.fold, '{c}' AS feature, median, avg(coalesce({c}, median)) AS mean,
      CASE WHEN stddev_pop(coalesce({c}, median)) > 0 THEN stddev_pop(coalesce({c}, median)) ELSE 1.0 END AS scale
      FROM (SELECT m.fold, {_median('t.' + c)} AS median FROM (SELECT DISTINCT fold FROM folded_nulls) m JOIN folded_nulls t ON t.fold <> m.fold GROUP BY m.fold) o
      JOIN folded_nulls f ON f.fold <> o.fold GROUP BY o.fold, median""" for c in B.NUMERIC]
    return (f"WITH {FOLDED_NULLS}, stats AS ({' UNION ALL '.join(parts)}) SELECT fold, feature, round(median, 4) + 0.0 AS median, "
            "round(mean, 4) + 0.0 AS mean, round(scale, 4) + 0.0 AS scale FROM stats")


@register("E6_fit_per_fold", _fold_stats_sql())
def fit_per_fold(spark, sf_dir):
    folded = split.stratified_folds(B.cls_nulls(spark, sf_dir))
    return rounded(prepare.fit_statistics(folded, B.NUMERIC, [], split.FOLDS)["numeric"], 4)


@register("E6_fit_per_fold_categorical", f"WITH {FOLDED_NULLS}, o AS (SELECT DISTINCT fold FROM folded_nulls), " + "c AS (" + " UNION ALL ".join(
    f"SELECT o.fold, '{c}' AS feature, {c} AS value, count(*) AS n FROM o JOIN folded_nulls f ON f.fold <> o.fold WHERE {c} IS NOT NULL GROUP BY o.fold, {c}"
    for c in B.CATEGORICAL) + """) SELECT fold, feature, arg_min(value, (-n, value)) AS mode, string_agg(value, '|' ORDER BY value) AS levels
  FROM c GROUP BY fold, feature""")
def fit_per_fold_categorical(spark, sf_dir):
    folded = split.stratified_folds(B.cls_nulls(spark, sf_dir))
    table = prepare.fit_statistics(folded, [], B.CATEGORICAL, split.FOLDS)["categorical"]
    return table.select("fold", "feature", "mode", F.array_join("levels", "|").alias("levels"))


@register("E6_apply_per_fold", _fold_stats_sql().split("SELECT fold, feature, round")[0] + ", long AS (" + " UNION ALL ".join(
    f"SELECT id, fold, '{c}' AS feature, {c} AS value FROM folded_nulls" for c in B.NUMERIC)
    + """) SELECT id, l.fold, l.feature, round((coalesce(value, median) - mean) / scale, 5) + 0.0 AS value
  FROM long l JOIN stats s ON l.fold = s.fold AND l.feature = s.feature""")
def apply_per_fold(spark, sf_dir):
    folded = split.stratified_folds(B.cls_nulls(spark, sf_dir))
    statistics = prepare.fit_statistics(folded, B.NUMERIC, [], split.FOLDS)["numeric"]
    return rounded(prepare.apply_fold_scaling(folded, statistics, B.NUMERIC, ["id"]), 5)


FORMULAS = {"price_per_month": ("totalprice", "order_month", 0), "price_per_balance": ("totalprice", "acctbal", 1),
            "balance_per_segment": ("acctbal", "segment", 1)}


@register("E7_ratio_features", f"""WITH {S.CLS_NULLS} SELECT id, round(totalprice / nullif(order_month, 0), 6) + 0.0 AS price_per_month,
  round(totalprice / nullif(acctbal + 1, 0), 6) + 0.0 AS price_per_balance, CAST(NULL AS DOUBLE) AS balance_per_segment FROM cls_nulls""")
def ratio_features(spark, sf_dir):
    return rounded(prepare.ratio_features(B.cls_nulls(spark, sf_dir), FORMULAS).select("id", *FORMULAS))


@register("E8_row_mean", f"""WITH {S.CLS_NULLS}, cells AS (SELECT id, unnest([totalprice, acctbal, CASE WHEN id % 5 = 0 THEN NULL ELSE order_year END]) AS v
  FROM cls_nulls) SELECT id, round(avg(v), 4) + 0.0 AS mean_value FROM cells GROUP BY id""")
def row_mean(spark, sf_dir):
    frame = B.cls_nulls(spark, sf_dir).withColumn("order_year", F.when(F.col("id") % 5 != 0, F.col("order_year")))
    return rounded(prepare.row_mean(frame, ["totalprice", "acctbal", "order_year"], "mean_value").select("id", "mean_value"), 4)


@register("E9_band", f"""WITH {S.CLS_NULLS} SELECT id, CASE WHEN acctbal > -500 AND acctbal <= 0 THEN 'low' WHEN acctbal > 0 AND acctbal <= 5000 THEN 'mid'
  WHEN acctbal > 5000 AND acctbal <= 9000 THEN 'high' END AS band FROM cls_nulls""")
def band(spark, sf_dir):
    return prepare.band(B.cls_nulls(spark, sf_dir), "acctbal", [-500, 0, 5000, 9000], ["low", "mid", "high"], "band").select("id", "band")
