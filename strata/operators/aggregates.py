"""Grouped sums. Each is one shuffle behind a map-side partial aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, by: Sequence[str | Column], value: str | Column, alias: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(alias))


def sum_having(
    df: DataFrame, by: Sequence[str | Column], value: str | Column, alias: str, minimum=None
) -> DataFrame:
    """Groups whose sum is positive, or reaches ``minimum`` if one is given."""
    total = F.col(alias)
    return sum_by(df, by, value, alias).where(
        total > 0 if minimum is None else total >= F.lit(minimum)
    )


def conditional_sums(
    df: DataFrame, by: Sequence[str | Column], value: str, named: Mapping[str, Column]
) -> DataFrame:
    """One sum per named condition, rows outside it counting as 0."""
    return df.groupBy(*by).agg(
        *[F.sum(F.when(test, F.col(value)).otherwise(0)).alias(name) for name, test in named.items()]
    )


def pivot_sum(
    df: DataFrame, by: Sequence[str | Column], on: str | Column, value: str, named: Mapping[str, object]
) -> DataFrame:
    """Pivot over a known list: one column of sums per named value, 0 if none.

    Written as sums under a condition: the groups are shuffled once, where
    ``pivot`` shuffles by group and value first and by group again.
    """
    on = F.col(on) if isinstance(on, str) else on
    return df.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(on == F.lit(match), F.col(value))), F.lit(0)).alias(name)
            for name, match in named.items()
        ]
    )


def union_sum(dfs: Sequence[DataFrame], by: Sequence[str], value: str, alias: str) -> DataFrame:
    """Sum over the rows of all inputs, duplicates kept."""
    rows = [df.select(*by, value) for df in dfs]
    return sum_by(reduce(DataFrame.unionByName, rows), by, value, alias)


def share_of_total(df: DataFrame, value: str, total: str, share: str) -> DataFrame:
    """The sum over all rows of an aggregate, and each row's part of it.

    The total is a scalar subquery: one row, held neither by the driver program
    nor by a join, and its input is the same exchange the rows come from.
    """
    whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(total, whole).withColumn(
        share, F.try_divide(F.col(value).cast("double"), F.col(total).cast("double"))
    )


def json_columns(
    df: DataFrame,
    by: Sequence[str],
    order_by: str,
    columns: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per group, one JSON array per named column, all in the same order.

    ``totals`` names sums to take of the same rows.

    The input is an aggregate with one row per ``order_by`` value: the arrays
    become a single text, so a group is as long as that text is meant to be.
    """
    fields = [order_by, *[c for c in dict.fromkeys(columns.values()) if c != order_by]]
    rows = F.array_sort(F.collect_list(F.struct(*fields)))
    sums = [F.sum(source).alias(name) for name, source in (totals or {}).items()]
    grouped = df.groupBy(*by).agg(rows.alias("_rows"), *sums)
    return grouped.select(
        *by,
        *(totals or {}),
        *[F.to_json(F.col("_rows").getField(source)).alias(name) for name, source in columns.items()],
    )
