"""Long lists as pages of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import group_position

#: elements of one collected array
PAGE_SIZE = 10_000


def paged(df: DataFrame, key: str, order, size: int = PAGE_SIZE) -> DataFrame:
    """Add ``page``: the position of a row within ``key`` in the order ``order``, divided by ``size``.

    ``order`` must tell the rows of a key apart. Collecting per (key, page) gives arrays of at most ``size``
    elements, and the pages of a key one after another are its whole sorted list, at any size.
    """
    placed = group_position(df, key, [F.col(c) if isinstance(c, str) else c for c in order], "_pos")
    return placed.withColumn("page", F.expr(f"CAST(_pos div {size} AS INT)")).drop("_pos")
