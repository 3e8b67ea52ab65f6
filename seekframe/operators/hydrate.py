"""Hits -> rows of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A page up to this many hits is sent to every task that reads the table.
MAX_BROADCAST_HITS = 10_000


def hydrate(
    hits: DataFrame, rows: DataFrame, key: str, *, hit_key: str | None = None, n_hits: int | None = None
) -> DataFrame:
    """Join hits to rows by key; hits without a row fall away.

    Columns of the hits whose names start with ``_`` travel along. ``n_hits`` is
    the page limit when there is one: only then is the broadcast bound known.
    """
    hit_key = hit_key or key
    cast = F.col(hit_key).cast(rows.schema[key].dataType)
    meta = [c for c in hits.columns if c.startswith("_") and c != key and c not in rows.columns]
    narrow = hits.select(cast.alias("__hit_key"), *meta)
    if n_hits is not None and n_hits <= MAX_BROADCAST_HITS:
        narrow = F.broadcast(narrow)
    joined = rows.join(narrow, rows[key] == F.col("__hit_key"), "inner")
    return joined.drop("__hit_key")
