"""Data contracts as one aggregation pass per kind: violations(rule, column, n_bad, sample_value)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.functions.scalars import blank, count_where
from binoscope.spec import TableSpec

VIOLATION = ["rule", "column", "n_bad", "sample_value"]
MIN_CLASS_ROWS = 10


class ContractError(ValueError):
    """A table breaks its contract; the message lists every broken rule."""


def check_columns(df: DataFrame, spec: TableSpec, mode: str = "train") -> dict[str, list[str]]:
    """Names only: missing, unexpected and repeated columns, and whether any row exists.

    Training needs exactly the contract's columns. Scoring needs the features and tolerates key and constants.
    """
    if mode not in ("train", "score"):
        raise ValueError("mode is 'train' or 'score'.")
    names = df.columns
    needed = set(spec.required if mode == "train" else spec.features)
    allowed = set(spec.required) if mode == "train" else needed | set(spec.constants) | {spec.key}
    found = {"missing": sorted(needed - set(names)), "unexpected": sorted(set(names) - allowed),
             "repeated": sorted(name for name, times in Counter(names).items() if times > 1)}
    broken = [f"{kind} columns: {', '.join(columns)}" for kind, columns in found.items() if columns]
    if not broken and df.isEmpty():
        broken = ["the table has no rows"]
    if broken:
        raise ContractError("; ".join(broken))
    return found


def violations(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Count the rows breaking each (rule, column, condition), all in one scan, with the smallest bad value."""
    counted = df.agg(*[count_where(F.coalesce(bad, F.lit(False))).alias(f"n_{i}") for i, (_, _, bad) in enumerate(rules)],
                     *[F.min(F.when(bad, F.col(column).cast("string"))).alias(f"s_{i}")
                       for i, (_, column, bad) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"n_{i}").alias("n_bad"),
                              F.col(f"s_{i}").alias("sample_value")) for i, (rule, column, _) in enumerate(rules)])
    return counted.select(F.explode(rows).alias("v")).select("v.*")


def numeric_violations(df: DataFrame, bounds: Mapping[str, tuple[float, float | None]]) -> DataFrame:
    """Per numeric column: finite, whole, inside its inclusive bounds; nulls pass, text and booleans do not."""
    rules = []
    for name, (low, high) in bounds.items():
        kind = df.schema[name].dataType
        if not isinstance(kind, T.NumericType):
            rules.append(("numeric", name, F.col(name).isNotNull()))
            continue
        value = F.col(name).cast("double")
        finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
        outside = (value < low) if high is None else ((value < low) | (value > high))
        rules += [("finite", name, value.isNotNull() & (F.abs(value) == F.lit(float("inf")))),
                  ("whole", name, finite & (value % 1 != 0)), ("bounds", name, finite & outside)]
    return violations(df, rules)


def category_violations(df: DataFrame, categories: Mapping[str, Sequence[str]], training: bool = True) -> DataFrame:
    """Per categorical column: text that is not blank; the value list binds in training only."""
    rules = []
    for name, allowed in categories.items():
        if not isinstance(df.schema[name].dataType, T.StringType):
            rules.append(("text", name, F.col(name).isNotNull()))
            continue
        rules.append(("blank", name, blank(F.col(name))))
        if training:
            rules.append(("known", name, ~F.col(name).isin(*allowed)))
    return violations(df, rules)


def unexpected_categories(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every value outside the allowed lists with its count: column, value, count."""
    from binoscope.functions.scalars import melt
    known = F.create_map(*[part for name, allowed in categories.items()
                           for part in (F.lit(name), F.array(*[F.lit(v) for v in allowed]))])
    long = melt(df, [], list(categories), "string", "column")
    return long.where(~F.array_contains(known[F.col("column")], F.col("value"))) \
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def label_violations(df: DataFrame, label: str, mapping: Mapping[object, int]) -> DataFrame:
    """No null labels, none outside the mapping, and both classes present."""
    known = F.col(label).isin(*mapping)
    base = violations(df, [("label_null", label, F.col(label).isNull()), ("label_known", label, ~known)])
    classes = df.agg(*[F.coalesce(F.max(F.col(label).isin(*[k for k, v in mapping.items() if v == c])), F.lit(False)).alias(f"c{c}")
                       for c in (0, 1)])
    missing = classes.select(F.lit("label_classes").alias("rule"), F.lit(label).alias("column"),
                             (2 - F.col("c0").cast("long") - F.col("c1").cast("long")).alias("n_bad"),
                             F.lit(None).cast("string").alias("sample_value"))
    return base.unionByName(missing)


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """The key is present, positive, whole and unique; n_bad of `key_unique` counts surplus copies.

    One grouping by key: every copy of a key gives the same answer to the other rules, so they are summed there.
    """
    # A key that is no number (a text, say) is a violation, not an error of the cast.
    value = F.col(key).try_cast("double")
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counted = groups.agg(
        F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(0)).alias("key_null"),
        F.sum(F.when(value <= 0, F.col("n")).otherwise(0)).alias("key_positive"),
        F.sum(F.when((value % 1 != 0) | (value.isNull() & F.col(key).isNotNull()), F.col("n")).otherwise(0)).alias("key_whole"),
        F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1).otherwise(0)).alias("key_unique"))
    long = counted.unpivot([], ["key_null", "key_positive", "key_whole", "key_unique"], "rule", "n_bad")
    return long.select("rule", F.lit(key).alias("column"), F.coalesce("n_bad", F.lit(0)).cast("long").alias("n_bad"),
                       F.lit(None).cast("string").alias("sample_value"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in every column, nulls equal: one row `duplicate_rows`.

    Rows are grouped by their columns, so equal means what Spark calls equal (two NaN are).
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).select(F.col("__n").alias("n")) \
             .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def constant_check(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Rows that differ from each assumed constant, null included, and the reason for leaving the column out."""
    return violations(df, [("constant", name, ~F.col(name).eqNullSafe(F.lit(value))) for name, value in constants.items()])


def feature_exclusions(df: DataFrame, spec: TableSpec) -> dict[str, str]:
    """Reasons for columns that never become features, after checking the constants on the given rows."""
    enforce(constant_check(df, spec.constants)) if spec.constants else None
    reasons = {spec.key: "Row identifier without a meaning outside this table."}
    return reasons | {name: f"Constant {value!r} on every training row." for name, value in spec.constants.items()}


def null_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells per column and whether the column is entirely missing: column, n_missing, all_missing."""
    columns = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"c_{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), (F.col("rows") - F.col(f"c_{i}")).alias("n_missing"),
                              (F.col(f"c_{i}") == 0).alias("all_missing")) for i, c in enumerate(columns)])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def check_scored(df: DataFrame) -> DataFrame:
    """A score table: y is 0 or 1, p is finite in [0, 1], and every id appears once."""
    p = F.col("p")
    base = violations(df, [("binary_label", "y", F.col("y").isNull() | ~F.col("y").isin(0, 1)),
                           ("score_range", "p", p.isNull() | F.isnan(p) | (p < 0) | (p > 1))])
    unique = key_violations(df, "id").where(F.col("rule") == "key_unique")
    return base.unionByName(unique)


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN cells of floating columns become null, the one form of a missing value."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def encode_label(df: DataFrame, label: str, mapping: Mapping[object, int], name: str = "y") -> DataFrame:
    """Map the raw label to 0 and 1; anything outside the mapping becomes null."""
    chain = F
    for raw, code in mapping.items():
        chain = chain.when(F.col(label) == F.lit(raw), F.lit(code))
    return df.withColumn(name, chain)


def select_features(df: DataFrame, spec: TableSpec, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns in training order, without the excluded ones, after the columns to keep."""
    return df.select(*keep, *[c for c in spec.features if c not in exclude])


def enforce(found: DataFrame) -> None:
    """Raise when any rule is broken; at most one row per rule and column reaches the driver."""
    broken = found.where(F.col("n_bad") > 0).orderBy("rule", "column").collect()
    if broken:
        raise ContractError("; ".join(f"{r['rule']} {r['column']}: {r['n_bad']} rows"
                                      + (f", such as {r['sample_value']!r}" if r["sample_value"] is not None else "")
                                      for r in broken))


def validate(df: DataFrame, spec: TableSpec, mode: str = "train") -> None:
    """The whole contract; any broken rule fails the table."""
    check_columns(df, spec, mode)
    training = mode == "train"
    clean = normalize_missing(df)
    found = numeric_violations(clean, spec.bounds).unionByName(category_violations(clean, spec.categories, training))
    if training:
        found = found.unionByName(label_violations(clean, spec.label, spec.labels)).unionByName(key_violations(clean, spec.key))
        if spec.constants:
            found = found.unionByName(constant_check(clean, spec.constants))
        copies = duplicate_rows(clean).select(F.lit("duplicate_rows").alias("rule"), F.lit("*").alias("column"),
                                              F.col("duplicate_rows").alias("n_bad"), F.lit(None).cast("string").alias("sample_value"))
        empty = null_columns(clean, spec.features).where("all_missing").select(
            F.lit("all_missing").alias("rule"), "column", F.lit(1).cast("long").alias("n_bad"),
            F.lit(None).cast("string").alias("sample_value"))
        found = found.unionByName(copies).unionByName(empty)
    enforce(found)


def check_class_sizes(counts: DataFrame, least: int = MIN_CLASS_ROWS) -> None:
    """Every class of a partition needs some rows; `counts` has y and count."""
    sizes = {row["y"]: row["count"] for row in counts.collect()}
    if set(sizes) != {0, 1} or min(sizes.values()) < least:
        raise ContractError(f"Each class needs at least {least} rows, found {sizes}.")
