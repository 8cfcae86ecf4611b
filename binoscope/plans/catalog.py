"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from binoscope.plans import catalog_scores, catalog_studies, catalog_tables  # noqa: F401  (they register on import)
from binoscope.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
