"""Top rows, over all rows or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(
    df: DataFrame, by: str, n: int, tiebreak: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows with the largest ``by``, ties settled by ``tiebreak``.

    Either form keeps at most ``n`` rows per task (and group) before the
    shuffle, so a group of any size costs its shuffle only ``n`` rows a task.
    """
    order = [F.col(by).desc(), *[F.col(c).asc() for c in tiebreak]]
    if not partition_by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order))
    return (
        df.withColumn("_rank", rank)
        .where(F.col("_rank") <= n)
        .drop("_rank")
        .orderBy(*[F.col(c) for c in partition_by], *order)
    )
