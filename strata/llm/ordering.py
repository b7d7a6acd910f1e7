"""Places of rows in a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import saved

#: Values that part rows which are equal in all they are ordered by.
_SALTS = 4096
_ROW = 33  # bits of a row's number within its task


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("_o_")])


def numbered(df: DataFrame, group: list[str], order: list[Column | str], name: str) -> DataFrame:
    """``df`` with ``pos``, a row's place in its group from 0 on, and ``size``, the rows of the group; written.

    Rows are dealt to tasks by ranges of (group, order), nulls first, so a group
    of any size spreads over many; a salt spreads rows that are equal in all of
    it. A row's place in the whole order is its number within its task and the
    rows of the tasks before, one number per task; its group's first place is
    then taken off. Only the counts of tasks come to the driver.
    """
    salt = (F.monotonically_increasing_id() % _SALTS).alias("_o_salt")
    keys = [F.col(g).asc_nulls_first() for g in group] + [o if isinstance(o, Column) else F.col(o).asc_nulls_first() for o in order]
    keys += [F.col("_o_salt")]
    sorted_rows = df.select("*", salt).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = saved(sorted_rows.withColumn("_o_at", F.monotonically_increasing_id()), name)
    spark = df.sparkSession
    task = F.shiftrightunsigned("_o_at", _ROW)
    counts = sorted(map(tuple, rows.groupBy(task.alias("task")).count().collect()))
    starts, total = [], 0
    for no, count in counts:
        starts.append((no, total))
        total += count
    # a row per task of the sort, so the broadcast is bounded by its number of partitions
    first = F.broadcast(spark.createDataFrame(starts, "_o_task long, _o_start long"))
    placed = rows.withColumn("_o_task", task).join(first, "_o_task")
    placed = placed.withColumn("pos", F.col("_o_start") + F.col("_o_at").bitwiseAND(F.lit((1 << _ROW) - 1)))
    if not group:
        return _plain(placed).withColumn("size", F.lit(total).cast("long"))
    groups = placed.groupBy(*[F.col(g).alias(f"_o_{g}") for g in group]).agg(
        F.min("pos").alias("_o_first"), F.count(F.lit(1)).alias("_o_size")
    )
    same = [F.col(g).eqNullSafe(F.col(f"_o_{g}")) for g in group]
    joined = placed.join(groups, same).withColumns({"pos": F.col("pos") - F.col("_o_first"), "size": F.col("_o_size")})
    return _plain(joined)
