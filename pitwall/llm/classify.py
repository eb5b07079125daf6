"""What both classifiers share: the bounded training sample and its download."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.shared import held_out, slices

#: Bounds of the training sample: labelled rows, and bytes of their texts.
MOST_ROWS = 4_000
MOST_BYTES = 32 << 20


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> pa.Table:
    """At most ``most_rows`` labelled rows outside the held-out fold, half of
    each label if there are as many, those of smallest id hash.  Texts of any
    length take part, whole: in that order each label takes rows until their
    texts reach half of ``most_bytes``, so that only its last one can exceed it.
    Rows without an id or a label are no training rows; an id with several
    labels counts with the largest."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = (
        labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__label"))
        .where(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__id")))
        .groupBy("__id").agg(F.max("__label").alias("__label"))
    )
    # ids and sizes only, in two bounded top lists; the texts are looked up afterwards
    sizes = docs.groupBy(F.col(id_col).alias("__id")).agg(F.max(F.octet_length(text)).cast("long").alias("__size"))
    known = marks.join(sizes, "__id").withColumn("__hash", F.xxhash64("__id"))
    half = [known.where(F.col("__label") == v).orderBy("__hash", "__id").limit(most_rows // 2) for v in (0, 1)]
    earlier = Window.partitionBy("__label").orderBy("__hash", "__id").rowsBetween(Window.unboundedPreceding, -1)
    chosen = half[0].unionByName(half[1]).withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
    chosen = chosen.where(F.col("__before") < most_bytes // 2).select("__id", "__label")  # at most most_rows ids and labels
    keep = [F.col(id_col).alias("__id"), text.alias("text"), *[F.col(c) for c in extra or []]]
    found = docs.select(*keep).join(F.broadcast(chosen), "__id").groupBy("__id").agg(F.min(F.struct("text", "__label", *(extra or []))).alias("m"))
    return found.select("__id", "m.*").orderBy("__id").toArrow()


def by_bytes(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a column of texts with about ``most`` bytes each (one text at
    least), with the number of their first text."""
    lo = 0
    for batch in slices(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), "text", most):
        yield lo, batch.column(0)
        lo += batch.num_rows


def label_counts(labels: DataFrame, label: str, id_col: str = "doc_id") -> tuple[int, int]:
    """How many rows outside the held-out fold have label 0 and label 1."""
    y = F.col(label).cast("int")
    row = labels.where(~held_out(F.col(id_col))).agg(F.count(F.when(y == 0, 1)), F.count(F.when(y == 1, 1))).first()
    return row[0], row[1]


def logistic(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -40, 40)))
