"""Joins on either of several keys, and the size check before a broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 32 * 1024 * 1024


def explode_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row per distinct non-NULL value among ``keys``, called ``name``."""
    values = F.array_distinct(F.array(*keys))
    return df.withColumn(name, F.explode(values)).where(F.col(name).isNotNull())


def match_any_key(
    left: DataFrame, left_key: str, right: DataFrame, right_keys: Sequence[str]
) -> DataFrame:
    """Inner join where ``left_key`` equals any of ``right_keys``.

    Same rows as the OR of the equalities, each pair once even if several keys
    agree. The OR form can only be planned as a nested loop over both sides;
    giving each right row one copy per key leaves a plain equi-join, which
    Spark can broadcast, sort-merge and split where a key is hot.
    """
    return left.join(explode_keys(right, right_keys, left_key), left_key)


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's bytes in memory, for flat rows."""
    widths = [
        F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        if isinstance(field.dataType, T.StringType)
        else F.lit(16)
        for field in df.schema.fields
    ]
    return reduce(add, widths, F.lit(16)).cast("long")


def is_small(size: int) -> bool:
    return size <= BROADCAST_LIMIT


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if its rows measure at most the limit.

    The size is counted, not estimated: Spark's estimate for a filtered table
    is that of the unfiltered files. Above the limit ``df`` is left as it is,
    and Spark joins it by shuffle.
    """
    return F.broadcast(df) if is_small(measured_bytes(df)) else df
