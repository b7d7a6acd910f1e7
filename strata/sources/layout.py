"""Table layouts that let report filters skip files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.tables import Tables

#: Rows that a task sorts at most, about, where the number of rows is known.
ROWS_A_RANGE = 2_000_000

# role: (directory columns, sort columns); only the calendar makes directories,
# as buildings may be too many to have one each
LAYOUTS = {
    "payment": (["Anio", "Mes"], ["Fecha"]),
    "expense_ordinary": ([], ["ConsorcioID", "Periodo"]),
    "expense_extra": ([], ["ConsorcioID", "Periodo"]),
    "balance": ([], ["ConsorcioID", "Periodo"]),
    "unit": ([], ["ConsorcioID", "PropietarioID"]),
    "account": ([], ["PersonaID"]),
    "person": ([], ["PersonaID"]),
    "building": ([], ["ConsorcioID"]),
}


def write_layout(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    mode: str = "errorifexists",
    rows: int | None = None,
) -> None:
    """Write Parquet files sorted by ``sort_by``, in directories by ``partition_by``.

    With directories, rows are first gathered by a rebalance, so that a task
    does not leave a file in each; it splits a directory that holds much of the
    table over many tasks. Without, each task takes a range of ``sort_by``, so
    that a filter on it skips most files by their statistics; a hash of the row
    comes last and splits a value that holds much of the table, and a task that
    is run again deals its rows out as before. There are as many ranges as
    shuffle partitions, and more if ``rows``, the number of rows, asks for them.
    """
    if partition_by:
        spread = df.hint("rebalance", *partition_by)
    else:
        keys = [*map(F.col, sort_by), F.xxhash64(*df.columns)]
        ranges = (rows or 0) // ROWS_A_RANGE + 1
        # a number given is kept as it is, one left out may be lowered where rows are few
        more = ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = df.repartitionByRange(ranges, *keys) if more else df.repartitionByRange(*keys)
    writer = spread.sortWithinPartitions(*partition_by, *sort_by).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_tables(tables: Tables, path: str, roles: Sequence[str] = tuple(LAYOUTS)) -> None:
    """Write roles in their layouts, for ``Tables.from_parquet``."""
    for role in roles:
        df = tables[role]
        if role == "payment":
            df = df.withColumn("Anio", F.year("Fecha")).withColumn("Mes", F.month("Fecha"))
        partition_by, sort_by = LAYOUTS[role]
        write_layout(df, f"{path}/{role}", partition_by, sort_by)
