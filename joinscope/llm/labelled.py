"""A bounded sample of labelled texts, the only rows that a classifier is fitted on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.llm.common import fold

#: Labelled rows that a fit uses at most, about 3 KB of text each on the driver.
SAMPLE = 8_000
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) == HELD_OUT


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, n: int = SAMPLE, columns: tuple[str, ...] = (), characters: int = 64 << 20) -> pd.DataFrame:
    """Texts and labels of at most ``n`` rows outside the held-out fold, by the hash of the id.

    Several labels of one document count as their maximum, null labels not at all. Texts are
    taken in the same order; one that does not fit into what is left of ``characters`` is passed over.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.xxhash64("doc_id")
    chosen = known.orderBy(order, "doc_id").limit(n)
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *columns)
    rows = slim.join(F.broadcast(chosen), "doc_id")  # n rows at most
    sizes = rows.select("doc_id", F.char_length("text").alias("c")).orderBy(F.xxhash64("doc_id"), "doc_id", "c").limit(n).toPandas()
    fits, most, left = [], 0, characters
    for doc_id, c in zip(sizes["doc_id"].tolist(), sizes["c"].tolist(), strict=True):
        if c <= left:
            fits.append(doc_id)
            most, left = max(most, c), left - c
    if len(fits) < len(sizes):
        rows = rows.where(F.col("doc_id").isin(fits) & (F.char_length("text") <= most))
    return rows.toPandas().sort_values(["doc_id", "text"], kind="stable").drop_duplicates("doc_id").reset_index(drop=True)
