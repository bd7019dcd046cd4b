"""Order rows by an explicit list of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_position(c: Column | str, values: Sequence[str], unknown: int = 99) -> Column:
    """1-based position of ``c`` in ``values``; ``unknown`` when absent or null."""
    col = F.col(c) if isinstance(c, str) else c
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), col)
    return F.coalesce(F.nullif(pos, F.lit(0)), F.lit(unknown)).cast("int")
