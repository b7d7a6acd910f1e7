"""Running totals, overall averages and the next row of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overall_average(
    df: DataFrame, value: str, alias: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Mean over the rows present, beside every row.

    For rows out of a calendar aggregate, whose number the calendar bounds:
    a window without partition columns brings them into one task.
    """
    window = Window.partitionBy(*partition_by)
    mean = F.sum(value).over(window).cast("double") / F.count(value).over(window)
    return df.withColumn(alias, mean)


def running_total(
    df: DataFrame,
    value: str,
    alias: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Sum of all rows up to this one; rows of equal order share a total.

    For rows out of a calendar aggregate, as ``overall_average``.
    """
    window = (
        Window.partitionBy(*partition_by)
        .orderBy(*order_by)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(alias, F.sum(value).over(window))


def next_in_group(
    df: DataFrame, group: Sequence[str], date: str, row_key: Sequence[str], alias: str
) -> DataFrame:
    """``date`` of the next row of the group, ordered by date, then ``row_key``.

    Rows equal in all columns count as often as they stand. A ``lead`` window would sort a whole group in
    one task, however large. Here only the last row of each (group, date) looks
    further, to the group's next date; every other row is followed by a row of
    its own date. So the window runs over the distinct dates of a group, whose
    number the calendar bounds, and the rows are joined on their own key, which
    spreads a hot group over all tasks. NULL groups form one group.
    """
    others = [c for c in df.columns if c not in (*group, date, *row_key)]
    # both uses read this one exchange
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    whole = [*row_key, *others]
    last = F.max(F.struct(*whole)).alias("_last")
    following = F.lead(date).over(Window.partitionBy(*group).orderBy(date))
    days = rows.groupBy(*group, date).agg(last).withColumn("_following", following)
    days = days.select(
        *[F.col(c).alias(f"_{i}") for i, c in enumerate([*group, date])],
        *[F.col("_last").getField(c).alias(f"_{i}") for i, c in enumerate(whole, len(group) + 1)],
        "_following",
        F.lit(True).alias("_is_last"),
    )
    same = F.lit(True)
    for i, c in enumerate([*group, date, *whole]):
        same = same & rows[c].eqNullSafe(days[f"_{i}"])
    ends = F.when(F.col("_is_last"), F.col("_following")).otherwise(F.col(date))
    # all but the last of equal rows are followed by a row of their own date
    each = F.concat(F.array_repeat(F.col(date), F.col("_times") - 1), F.array(ends))
    return rows.join(days, same, "left").select(*[rows[c] for c in df.columns], F.explode(each).alias(alias))
