"""Table contracts: what a table must look like, and the reader schema that follows from it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Columns of one binary-outcome table.

    `bounds` maps each numeric feature to its inclusive (lower, upper) range, where upper None is open;
    `categories` maps each categorical feature to its allowed values; `constants` are columns that carry
    one value only; `labels` maps the raw label values to 0 and 1.
    """

    key: str
    label: str
    bounds: Mapping[str, tuple[float, float | None]] = field(default_factory=dict)
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    constants: Mapping[str, object] = field(default_factory=dict)
    labels: Mapping[object, int] = field(default_factory=dict)

    @property
    def numeric(self) -> list[str]:
        return list(self.bounds)

    @property
    def categorical(self) -> list[str]:
        return list(self.categories)

    @property
    def features(self) -> list[str]:
        return [*self.bounds, *self.categories]

    @property
    def required(self) -> list[str]:
        return [*self.features, *self.constants, self.key, self.label]

    @property
    def struct(self) -> T.StructType:
        """Reader schema; numeric fields are read as doubles so that 35.5 is reported and not truncated."""
        kinds: dict[str, T.DataType] = {name: T.DoubleType() for name in self.bounds}
        kinds |= {name: T.StringType() for name in self.categories}
        kinds |= {name: T.StringType() if isinstance(value, str) else T.LongType()
                  for name, value in self.constants.items()}
        kinds[self.key] = T.LongType()
        kinds[self.label] = (T.StringType() if any(isinstance(v, str) for v in self.labels) else T.LongType())
        return T.StructType([T.StructField(name, kinds[name]) for name in self.required])
