"""Ordered work without a single-task sort: ranges, running totals, exact quantiles and hash ranks.

A window over one hot group would sort that whole group in one task. Here a group is first cut into value
ranges of bounded size; windows run inside a range, and the small table of range totals carries the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binoscope.functions.scalars import same_keys
from binoscope.session import rows_per_bucket

# A table too large for one sort is cut into at least this many ranges, and at most into MOST_RANGES.
LEAST_RANGES, MOST_RANGES = 1_000, 20_000
SAMPLE_PER_RANGE = 200
# Rows of one hash bucket that are ranked together.
ROWS_PER_HASH_BUCKET = 500_000
# Up to this many strata, cutoffs are written into the plan as literals.
LITERAL_STRATA = 200
# Largest intermediate report, in rows, that is fetched and held as a local table.
LOCAL_ROWS = 10_000


def local_if_small(df: DataFrame, limit: int = LOCAL_ROWS) -> DataFrame:
    """A small result fetched once and held as a local table, marked for broadcast; a larger one is returned as it is.

    Whatever joins it then does not compute it again, and the broadcast size is known, not guessed.
    """
    rows = df.limit(limit + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= limit else df


def range_key(df: DataFrame, value: str) -> Column:
    """A double that never falls where the value rises: numbers themselves, and the first six bytes of a text."""
    if isinstance(df.schema[value].dataType, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
        return F.when(F.col(value).isNotNull(), F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(0.0)))
    return F.col(value).cast("double")


def split_points(df: DataFrame, value: str) -> list[float]:
    """Cut values after which no range holds many more than the allowed rows; none for a small table.

    The row count decides, and it needs no column. Only a large table is sampled for its quantiles, as in a range
    partitioning; cuts shape the ranges but never the result. A frequent value repeats among the quantiles and
    thereby stands alone in its range.
    """
    rows = df.count()
    needed = math.ceil(rows / rows_per_bucket(df.sparkSession))
    if needed <= 1:
        return []
    return value_cuts(df, value, min(max(needed, LEAST_RANGES), MOST_RANGES), rows)


def value_cuts(df: DataFrame, value: str, ranges: int, rows: int | None = None) -> list[float]:
    """At most ranges - 1 cuts at about equal shares of the rows, from a sample. `rows` is the size of the table, if known."""
    if ranges < 2:
        return []
    rows = df.count() if rows is None else rows
    sample = df.select(range_key(df, value).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    share = ranges * SAMPLE_PER_RANGE / rows
    sample = sample.sample(share, seed=1) if share < 1 else sample
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = sample.agg(F.percentile_approx("v", probabilities, 4 * ranges).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def with_range(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Add `value_range`, the number of the value range a row belongs to."""
    if not cuts:
        return df.withColumn("value_range", F.lit(0))
    places = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="__v", outputCol="__r", handleInvalid="keep")
    # NaN goes to a range of its own behind the last one, as it sorts.
    placed = places.transform(df.withColumn("__v", range_key(df, value)))
    # "keep" also sends a null behind the last range; nulls sort first.
    return placed.withColumn("value_range", F.when(F.col("__v").isNull(), -1).otherwise(F.col("__r").cast("int"))).drop("__v", "__r")


def running_totals(cells: DataFrame, by: Sequence[str], value: str, sums: Sequence[str], cuts: Sequence[float],
                   descending: bool = False) -> DataFrame:
    """Add run_<c> (total up to and including this row in value order) and total_<c> for every summed column.

    `cells` holds one row per (by, value). Without cuts one window per group does it; with cuts the window is
    per (group, range) and the offsets come from the table of range totals.
    """
    by = list(by)

    def ordered(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    def running(window_keys: list[str]) -> list[Column]:
        window = Window.partitionBy(*window_keys).orderBy(ordered(value)).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return [F.sum(c).over(window).alias(f"run_{c}") for c in sums]

    if not cuts:
        whole = Window.partitionBy(*by)
        return cells.select("*", *running(by), *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums])
    ranged = with_range(cells, value, cuts)
    keys = [*by, "value_range"]
    per_range = ranged.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(*by).orderBy(ordered("value_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per_range.select(*keys, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums],
                               *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums])
    inside = ranged.select("*", *running(keys))
    joined = same_keys(inside, offsets, keys)
    return joined.select(*cells.columns, *[(F.col(f"run_{c}") + F.col(f"before_{c}")).alias(f"run_{c}") for c in sums],
                         *[f"total_{c}" for c in sums])


def exact_quantiles(rows: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, float],
                    weight: str | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """Interpolating quantiles per group, exact at any size: columns by..., one per name in `probabilities`.

    `weight` names an integer column for tables that are already collapsed to (value, count). On a large table
    the ranges that hold the wanted ranks are found from range counts, and only their rows are sorted.
    """
    by = list(by)
    present = rows.where(F.col(value).isNotNull())
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    cuts = split_points(present, value) if cuts is None else cuts

    def low_rank(q: float, total: Column) -> Column:
        return F.floor(F.lit(q) * (total - 1)).cast("long")

    def high_rank(q: float, total: Column) -> Column:
        return F.least(low_rank(q, total) + 1, total - 1)

    if cuts:
        ranged = with_range(present, value, cuts)
        keys = [*by, "value_range"]
        counts = ranged.groupBy(*keys).agg(amount.alias("n"))
        spans = running_totals(counts, by, "value_range", ["n"], [])
        wanted = [((F.col("run_n") - F.col("n") <= rank(q, F.col("total_n"))) & (rank(q, F.col("total_n")) < F.col("run_n")))
                  for q in probabilities.values() for rank in (low_rank, high_rank)]
        holds = wanted[0]
        for condition in wanted[1:]:
            holds = holds | condition
        targets = spans.where(holds).select(*keys, (F.col("run_n") - F.col("n")).alias("before_n"), "total_n")
        near = same_keys(ranged, local_if_small(targets), keys)
        cells = near.groupBy(*keys, value).agg(amount.alias("n"), F.first("before_n").alias("before_n"),
                                               F.first("total_n").alias("total_n"))
        window = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = cells.withColumn("run_n", F.sum("n").over(window) + F.col("before_n"))
    else:
        cells = present.groupBy(*by, value).agg(amount.alias("n"))
        ranked = running_totals(cells, by, value, ["n"], [])

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("run_n") - F.col("n") <= rank) & (rank < F.col("run_n")), F.col(value)))

    total = F.col("total_n")
    parts = []
    for name, q in probabilities.items():
        parts += [at(low_rank(q, total)).alias(f"{name}__lo"), at(high_rank(q, total)).alias(f"{name}__hi"),
                  F.max(F.lit(q) * (total - 1) - low_rank(q, total)).alias(f"{name}__t")]
    picked = ranked.groupBy(*by).agg(*parts)
    return picked.select(*by, *[(F.col(f"{n}__lo") + (F.col(f"{n}__hi") - F.col(f"{n}__lo")) * F.col(f"{n}__t")).alias(n)
                                for n in probabilities])


def hash_digits(rows: int) -> int:
    """Leading hex digits that cut this many uniformly hashed rows into buckets of bounded size."""
    digits = 1
    while rows / 16 ** digits > ROWS_PER_HASH_BUCKET:
        digits += 1
    return digits


def hash_cutoffs(df: DataFrame, strata: Sequence[str], key: Column, ranks: Callable[[Column], list[Column]],
                 rows: int) -> DataFrame:
    """Per stratum, the hash values that stand at the given ranks of the hash order: (strata..., cuts array).

    The table is counted by hash bucket (a map-side combined aggregate) and only the buckets that hold a wanted
    rank are ranked. Comparing a row with the cuts later needs no shuffle at all. `rows` is the size of the table.
    """
    strata = list(strata)
    keyed = df.select(*strata, key.alias("h")).withColumn("bucket", F.substring("h", 1, hash_digits(rows)))
    counts = keyed.groupBy(*strata, "bucket").agg(F.count(F.lit(1)).alias("n"))
    spans = running_totals(counts, strata, "bucket", ["n"], [])
    slots = spans.select(*strata, "bucket", "run_n", "n", "total_n", F.posexplode(F.array(*[
        r.cast("long") for r in ranks(F.col("total_n"))])).alias("slot", "rank"))
    wanted = slots.where((F.col("run_n") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("run_n"))).select(
        *strata, "bucket", "slot", (F.col("rank") - F.col("run_n") + F.col("n")).alias("place"))
    # One row per stratum and wanted rank: strata are label classes (times folds or seeds), ranks a short list.
    places = wanted.groupBy(*strata, "bucket").agg(F.collect_list(F.struct("place", "slot")).alias("places"))
    inside = same_keys(keyed, F.broadcast(places), [*strata, "bucket"])
    inside = inside.withColumn("place", F.row_number().over(Window.partitionBy(*strata, "bucket").orderBy("h")))
    hits = inside.select(*strata, "h", F.explode(F.filter("places", lambda x: x["place"] == F.col("place"))).alias("hit"))
    # Rank zero lies before every row: the empty text sorts before any hash.
    zero = slots.where((F.col("rank") <= 0) & (F.col("run_n") == F.col("n"))).select(*strata, F.lit("").alias("h"))
    cuts = hits.select(*strata, "h").unionByName(zero)
    return cuts.groupBy(*strata).agg(F.sort_array(F.collect_list("h")).alias("cuts"))


def passed_cuts(df: DataFrame, strata: Sequence[str], key: Column, cutoffs: DataFrame) -> DataFrame:
    """Add `passed`, the number of cutoffs of the row's stratum that lie before its hash; a map-only step.

    The cutoffs are a few hashes per stratum. They are fetched once and become literals, so later jobs on the
    result never repeat the counting; only with very many strata are they joined instead.
    """
    few = cutoffs.limit(LITERAL_STRATA + 1).collect()
    if len(few) > LITERAL_STRATA:
        tagged = same_keys(df.withColumn("__h", key), cutoffs, strata, "left")
        cuts = F.coalesce(F.col("cuts"), F.array().cast("array<string>"))
        return tagged.withColumn("passed", F.size(F.filter(cuts, lambda c: c < F.col("__h"))).cast("long")).drop("__h", "cuts")

    def passed(cuts: list[str]) -> Column:
        return reduce(lambda a, b: a + b, [(F.lit(c) < F.col("__h")).cast("long") for c in cuts])

    chain = F
    for row in few:
        chain = chain.when(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in strata]), passed(row["cuts"]))
    counted = chain.otherwise(F.lit(0).cast("long")) if few else F.lit(0).cast("long")
    return df.withColumn("__h", key).withColumn("passed", counted).drop("__h")


def hash_rank(df: DataFrame, strata: Sequence[str], key: Column, rows: int | None = None) -> DataFrame:
    """Add `place` (1, 2, ... in hash order inside the stratum) and `stratum_rows`. `rows` is the size of the table, if known.

    Buckets of a uniform hash are equal in size whatever the data, so no stratum is ever sorted in one task.
    """
    strata = list(strata)
    keyed = df.withColumn("__h", key).withColumn("__b", F.substring("__h", 1, hash_digits(df.count() if rows is None else rows)))
    counts = keyed.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("n"))
    spans = running_totals(counts, strata, "__b", ["n"], [])
    offsets = spans.select(*strata, "__b", (F.col("run_n") - F.col("n")).alias("__before"),
                           F.col("total_n").alias("stratum_rows"))
    local = keyed.withColumn("__local", F.row_number().over(Window.partitionBy(*strata, "__b").orderBy("__h")))
    joined = same_keys(local, offsets, [*strata, "__b"])
    return joined.withColumn("place", F.col("__before") + F.col("__local")).drop("__h", "__b", "__before", "__local")
