"""Labelled documents to learn from: a bounded sample for fitting, the rest held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that a model is fitted on at most: those of the smallest
#: hash of their id, so that any layout of the table gives the same sample.
ROWS_PER_CLASS = 4_000


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: those whose id's CRC-32 leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitting_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int = ROWS_PER_CLASS) -> tuple[DataFrame, float]:
    """Texts and labels (column ``label``) to fit on, and the share of ones among all
    labelled rows that are not held out (0.5 if there are none)."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = usable.agg(F.avg("label")).first()[0]
    order = F.xxhash64("doc_id")
    chosen = [usable.filter(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in (0, 1)]
    # At most 2 * per_class rows of two numbers: small enough to send to every task.
    chosen = F.broadcast(chosen[0].unionAll(chosen[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(chosen, "doc_id").select("doc_id", "text", "label"), 0.5 if share is None else float(share)
