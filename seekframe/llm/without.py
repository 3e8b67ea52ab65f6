"""Rows without those that a table of ids names, moving few texts."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.bloom import bloom


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose ``doc_id`` is not in ``gone``; rows without an id stay.

    A Bloom filter of the ids passes most others untouched; only what it holds is joined.
    """
    named = gone.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    filter_ = bloom(named.select(F.col("doc_id").alias("key")))

    @F.pandas_udf("boolean")
    def maybe(ids: pd.Series) -> pd.Series:
        return pd.Series(filter_.holds(ids.to_numpy(np.int64)))

    hit = F.coalesce(maybe(F.coalesce(F.col("doc_id").cast("long"), F.lit(0))) & F.col("doc_id").isNotNull(), F.lit(False))
    sure = docs.where(~hit)
    other = docs.where(hit).join(named, docs["doc_id"].cast("long") == named["doc_id"], "left_anti")
    return sure.union(other)
