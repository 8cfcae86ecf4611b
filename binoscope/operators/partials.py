"""Adding up arrays that tasks have summed over their rows: what is sent has the size of a model, not of the table."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMED_AT_ONCE = 64             # arrays of one key that a task adds up
FETCHED_BYTES = 32_000_000      # up to so many bytes of arrays in all, the driver adds them up itself


def _added(table: pa.Table) -> np.ndarray:
    total: np.ndarray | None = None
    for cell in table["sums"]:
        own = np.frombuffer(cell.as_py())
        total = own.copy() if total is None else total + own
    return total


def reduced(partials: DataFrame, keys: Sequence[str], partitions: int, arrays: int, numbers: int, use: Callable[[tuple, np.ndarray], dict],
            schema: str) -> list[dict]:
    """One row of `use(key, total)` for each key, from partials (keys..., sums): float64 arrays as bytes, one row per task and key.

    There are `arrays` keys with `numbers` numbers each. If those of all tasks are few bytes, they are fetched and added up at
    once; else tasks add them up, in groups of SUMMED_AT_ONCE first, so that none gets those of all tasks.
    """
    if partitions * arrays * numbers * 8 <= FETCHED_BYTES:
        totals: dict[tuple, np.ndarray] = {}
        for row in partials.select(*keys, "sums").collect():
            own, key = np.frombuffer(row["sums"]), tuple(row[k] for k in keys)
            totals[key] = totals[key] + own if key in totals else own
        return [use(key, total) for key, total in totals.items()]
    grouped = partials.withColumn("part", F.spark_partition_id())

    def add(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).set_column(table.schema.get_field_index("sums"), "sums", pa.array([_added(table).tobytes()], pa.binary()))

    while partitions > SUMMED_AT_ONCE:
        partitions = math.ceil(partitions / SUMMED_AT_ONCE)
        grouped = grouped.withColumn("part", F.pmod("part", F.lit(partitions))).groupBy(*keys, "part").applyInArrow(add, grouped.schema)

    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def last(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([use(tuple(table[k][0].as_py() for k in keys), _added(table))], schema=fields)

    return [r.asDict() for r in grouped.groupBy(*keys).applyInArrow(last, schema).collect()]
