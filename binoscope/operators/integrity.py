"""Comparing tables, records and recorded results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.functions.scalars import close_to, count_where, finite, same_keys, same_keys_full
from binoscope.operators.metrics import evaluate

# Comparison tolerances of regenerated results.
RTOL, ATOL = 1e-6, 1e-9


def _surplus(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows one side has more often than the other, how often each key occurs on either side).

    Equal rows cancel out in one grouping with map-side sums, so copies of a row never meet in one task.
    """
    sides = old.select("*", F.lit(1).alias("__o"), F.lit(0).alias("__n")).unionByName(new.select("*", F.lit(0).alias("__o"), F.lit(1).alias("__n")))
    net = sides.groupBy(*old.columns).agg(F.sum("__o").alias("__o"), F.sum("__n").alias("__n"))
    per_key = net.groupBy(*keys).agg(F.sum("__o").alias("__old_rows"), F.sum("__n").alias("__new_rows"))
    return net.where(F.col("__o") != F.col("__n")), per_key


def _numbered(surplus: DataFrame, more: str, less: str, keys: Sequence[str], values: Sequence[str], prefix: str) -> DataFrame:
    """The rows of one side, as often as it has more of them, numbered within their key in the order of their values."""
    copies = F.explode(F.sequence(F.lit(1), F.col(more) - F.col(less)))
    rows = surplus.where(F.col(more) > F.col(less)).withColumn("__copy", copies)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(v) for v in values] or [F.lit(1)]))
    return rows.select(*keys, place.alias("__place"), F.lit(True).alias(f"{prefix}__there"), *[F.col(v).alias(f"{prefix}_{v}") for v in values])


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], rtol: float = RTOL, atol: float = ATOL) -> DataFrame:
    """One row per differing column: (column, problem, n_rows); numbers within tolerance and two nulls are equal.

    Columns are compared first, then rows as a multiset. Rows that are equal cancel out; what is left of a key is matched in
    the order of its values. A key that only one side has gives missing or unexpected rows, one that both have in different
    numbers gives "repeated keys" for the rows without a partner. A table never differs from itself.
    """
    if list(old.columns) != list(new.columns):
        names = sorted(set(old.columns) ^ set(new.columns)) or list(new.columns)
        return old.sparkSession.createDataFrame([(name, "columns differ", 0) for name in names],
                                                "column string, problem string, n_rows long")
    values = [c for c in old.columns if c not in keys]
    numeric = {c for c in values if isinstance(old.schema[c].dataType, T.NumericType)
               and isinstance(new.schema[c].dataType, T.NumericType)}
    surplus, per_key = _surplus(old, new, keys)
    both = same_keys_full(_numbered(surplus, "__o", "__n", keys, values, "o"), _numbered(surplus, "__n", "__o", keys, values, "n"), [*keys, "__place"])
    both = same_keys(both, per_key, keys, "left")
    matched = F.col("o__there").isNotNull() & F.col("n__there").isNotNull()
    shared = (F.col("__old_rows") > 0) & (F.col("__new_rows") > 0)

    def differs(c: str) -> Column:
        same = close_to(f"o_{c}", f"n_{c}", rtol, atol) if c in numeric else F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
        return count_where(matched & ~same)

    counted = both.agg(count_where(F.col("n__there").isNull() & ~shared).alias("missing"),
                       count_where(F.col("o__there").isNull() & ~shared).alias("extra"),
                       count_where(~matched & shared).alias("repeated"), *[differs(c).alias(f"d_{i}") for i, c in enumerate(values)])
    names = ",".join(keys)
    told = [(names, "missing rows", "missing"), (names, "unexpected rows", "extra"), (names, "repeated keys", "repeated"),
            *[(c, "values differ", f"d_{i}") for i, c in enumerate(values)]]
    rows = [F.struct(F.lit(column).alias("column"), F.lit(problem).alias("problem"), F.col(n).alias("n_rows")) for column, problem, n in told]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where(F.col("n_rows") > 0)


def _leaves(column: Column, kind: T.DataType, path: Column) -> Column:
    """Array of (path, type, text, number) for every leaf below a column, as one native expression."""
    if isinstance(kind, T.StructType):
        parts = [_leaves(column[f.name], f.dataType, F.concat(path, F.lit(f"/{f.name}"))) for f in kind.fields]
        return F.when(column.isNull(), _leaf(path, "null", None, None)).otherwise(F.concat(*parts))
    if isinstance(kind, T.ArrayType):
        inner = F.flatten(F.transform(column, lambda x, i: _leaves(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        size = _leaf(F.concat(path, F.lit("/#")), "length", F.size(column).cast("string"), F.size(column).cast("double"))
        return F.when(column.isNull(), _leaf(path, "null", None, None)).otherwise(F.concat(size, inner))
    if isinstance(kind, T.MapType):
        inner = F.flatten(F.transform(F.map_entries(column), lambda e: _leaves(
            e["value"], kind.valueType, F.concat(path, F.lit("/"), e["key"].cast("string")))))
        return F.when(column.isNull(), _leaf(path, "null", None, None)).otherwise(inner)
    name = "boolean" if isinstance(kind, T.BooleanType) else "number" if isinstance(kind, T.NumericType) else "text"
    number = column.cast("double") if name == "number" else None
    return F.when(column.isNull(), _leaf(path, "null", None, None)).otherwise(_leaf(path, name, column.cast("string"), number))


def _leaf(path: Column, kind: str, text, number) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(kind).alias("type"),
                            (F.lit(None).cast("string") if text is None else text).alias("text"),
                            (F.lit(None).cast("double") if number is None else number).alias("number")))


def record_leaves(df: DataFrame, id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Nested cells as rows (id, path, type, text, number)."""
    columns = list(columns or [c for c in df.columns if c != id])
    leaves = F.concat(*[_leaves(F.col(c), df.schema[c].dataType, F.lit(f"/{c}")) for c in columns])
    return df.select(F.col(id), F.explode(leaves).alias("leaf")).select(id, "leaf.*")


def record_diff(old: DataFrame, new: DataFrame, id: str, ignore: Sequence[str] = (), rtol: float = RTOL, atol: float = ATOL) -> DataFrame:
    """Differing leaves of nested records: (id, path, problem, old, new).

    Ignored names are left out at any depth. A boolean never equals a number, numbers compare with tolerance.
    """
    def kept(df: DataFrame) -> DataFrame:
        leaves = record_leaves(df, id)
        if not ignore:
            return leaves
        steps = F.split(F.regexp_replace("path", r"\[\d+\]", ""), "/")
        return leaves.where(~F.arrays_overlap(steps, F.array(*[F.lit(name) for name in ignore])))

    left = kept(old).select(F.col(id), "path", F.col("type").alias("o_type"), F.col("text").alias("old"), F.col("number").alias("o_number"))
    right = kept(new).select(F.col(id).alias("__id"), F.col("path").alias("__path"), F.col("type").alias("n_type"),
                             F.col("text").alias("new"), F.col("number").alias("n_number"))
    both = left.join(right, [left[id].eqNullSafe(right["__id"]), left["path"] == right["__path"]], "full_outer")
    numbers = F.col("o_type").isin("number", "length") & (F.col("o_type") == F.col("n_type"))
    larger = F.greatest(F.abs("o_number"), F.abs("n_number"))
    within = F.abs(F.col("o_number") - F.col("n_number")) <= F.greatest(F.lit(rtol) * larger, F.lit(atol))
    near = (F.col("o_number") == F.col("n_number")) | (finite(F.col("o_number")) & finite(F.col("n_number")) & within)
    same = F.when(numbers, near).otherwise((F.col("o_type") == F.col("n_type")) & F.col("old").eqNullSafe(F.col("new")))
    problem = F.when(F.col("n_type").isNull(), "missing").when(F.col("o_type").isNull(), "unexpected") \
               .when(F.col("o_type") != F.col("n_type"), "type differs").when(~same, "value differs")
    return both.select(F.coalesce(F.col(id), F.col("__id")).alias(id), F.coalesce("path", "__path").alias("path"),
                       problem.alias("problem"), "old", "new").where(F.col("problem").isNotNull())


def set_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of only one side: (key, problem) with 'missing' for old only and 'unexpected' for new only.

    One grouping of both key lists instead of two anti joins; copies of a key collapse before the shuffle.
    """
    sides = old.select(F.col(key), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        new.select(F.col(key), F.lit(0).alias("a"), F.lit(1).alias("b")))
    seen = sides.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return seen.where(F.col("a") != F.col("b")).select(key, F.when(F.col("a") == 1, "missing").otherwise("unexpected").alias("problem"))


def cell_text(cell: Column, kind: T.DataType) -> Column:
    """A cell as text behind its length, so that neighbours cannot run into each other; null is a mark of its own.

    Nested cells are written element by element, by their types: instants as microseconds since 1970 whatever the session's
    time zone, map entries in sorted order, binary as hex digits.
    """
    if isinstance(kind, T.StructType):
        parts = F.concat(F.lit(""), *[cell_text(cell[f.name], f.dataType) for f in kind.fields])
        text = F.when(cell.isNotNull(), parts)
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(cell, lambda x: cell_text(x, kind.elementType)), "")
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(cell), lambda e: F.concat(cell_text(e["key"], kind.keyType), cell_text(e["value"], kind.valueType)))
        text = F.array_join(F.array_sort(entries), "")
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(cell).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(cell)
    else:
        text = cell.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit("="), text), F.lit("~"))


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, digest, schema_digest): changes with any value, id, label or column, not with the row order.

    The digest holds the sums of the four 32-bit parts of the rows' md5.
    """
    cells = [cell_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    row = F.md5(F.concat_ws("|", *cells))
    sums = [F.coalesce(F.sum(F.conv(F.substring(row, at, 8), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string") for at in (1, 9, 17, 25)]
    columns = "|".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", *sums).alias("digest")) \
             .withColumn("schema_digest", F.md5(F.lit(columns)))


def coverage_check(predictions: DataFrame, manifest: DataFrame, id: str = "id", fold: str = "fold", folds: int = 5) -> DataFrame:
    """One row: ids without a prediction, predictions without an id, surplus predictions, folds that never occur."""
    sides = predictions.select(F.col(id), F.lit(1).alias("got"), F.lit(0).alias("due"), F.col(fold).alias("fold")).unionByName(
        manifest.select(F.col(id), F.lit(0).alias("got"), F.lit(1).alias("due"), F.lit(None).cast("long").alias("fold")))
    per_id = sides.groupBy(id).agg(F.sum("got").alias("got"), F.sum("due").alias("due"))
    ids = per_id.agg(count_where((F.col("got") == 0)).alias("missing"), count_where(F.col("due") == 0).alias("unexpected"),
                     F.coalesce(F.sum(F.greatest(F.col("got") - 1, F.lit(0))), F.lit(0)).cast("long").alias("repeated"))
    seen = predictions.where(F.col(fold).between(0, folds - 1)).select(fold).distinct().agg(
        (F.lit(folds) - F.count(F.lit(1))).alias("missing_folds"))
    # Both sides are single rows.
    return ids.join(F.broadcast(seen), F.lit(True)).select("missing", "unexpected", "repeated", "missing_folds")


def recheck(scored: DataFrame, recorded: DataFrame, threshold: float, by: Sequence[str],
            metrics: Sequence[str] = ("roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score"),
            rtol: float = 1e-7, atol: float = 0.0) -> DataFrame:
    """Recompute recorded metrics from the scores: (by..., metric, recorded, recomputed, agrees).

    `recorded` is long: by..., metric, value and optionally lower and upper, which must enclose the value.
    """
    again = evaluate(scored, threshold, by).select(*by, *metrics).unpivot(list(by), list(metrics), "metric", "recomputed")
    joined = same_keys(recorded, again, [*by, "metric"], "left")
    agrees = close_to("recomputed", "value", rtol, atol)
    if "lower" in recorded.columns:
        agrees = agrees & (F.col("lower") <= F.col("value")) & (F.col("value") <= F.col("upper"))
    return joined.select(*by, "metric", F.col("value").alias("recorded"), "recomputed", F.coalesce(agrees, F.lit(False)).alias("agrees"))
