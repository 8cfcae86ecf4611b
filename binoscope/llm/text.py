"""Words of texts inside tasks, and small helpers that the operators of this folder share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# One byte of a word: 0-9, a-z after lower-casing, and every byte of a character beyond ASCII.
WORDY = bytes(LOWER[c] if chr(LOWER[c]).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of anything but white space (0x20 and 0x09 to 0x0D), A-Z lower-cased."""
    return text.translate(LOWER).split()


def plain_words(text: bytes) -> list[bytes]:
    """Runs of 0-9, a-z and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(WORDY).split()


def texts_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text; null stays None."""
    return column.cast(pa.binary()).to_pylist()


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def let(value: Column, use) -> Column:
    """use(value) with value computed once per row, also where use() names it several times."""
    return F.transform(F.array(value), use)[0]
