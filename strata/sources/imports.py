"""File imports that set bad rows aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    StructField,
    StructType,
)

MALFORMED = "malformed"
MISSING = "missing "
DUPLICATE = "duplicate key"

_LINE = "_line"


class Imported(NamedTuple):
    valid: DataFrame
    rejects: DataFrame  # Registro: line, or row as JSON; Motivo: why; Veces: how often
    log: DataFrame  # one row: Origen, Leidos, Aceptados, Rechazados
    lines: DataFrame | None = None  # every line once: its columns, Registro, Linea, and Motivo where it is set aside


def exact_amount(text: Column, amount: DecimalType) -> Column:
    """A number without rounding: NULL if the text is none, or needs more decimals or digits than there are."""
    decimals = F.length(F.regexp_extract(text, r"\.(\d*?)0*$", 1))
    plain = F.when(decimals <= amount.scale, text.try_cast(amount))
    # 12E-1 and the like
    fine, value = text.try_cast("decimal(38,18)"), text.try_cast(amount)
    number = r"^[+-]?(\d+\.?\d*|\.\d+)"
    power = text.rlike(number + r"[eE][+-]?\d+$")
    return F.when(text.rlike(number + "$"), plain).when(power & (fine == value), value)


def _typed(text: Column, kind: DataType, options: Mapping[str, str]) -> Column:
    """A field of a line as what it should be; NULL if it is something else."""
    if isinstance(kind, DecimalType):
        return exact_amount(text, kind)
    if isinstance(kind, DateType):
        return F.try_to_date(text, options.get("dateFormat", "yyyy-MM-dd"))
    if isinstance(kind, BooleanType):
        return F.when(F.lower(text).isin("true", "false"), text.try_cast(kind))
    if isinstance(kind, IntegralType):
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast(kind))
    return text.try_cast(kind)


def _parse(
    spark: SparkSession, path: str, fmt: str, schema: StructType, options: Mapping[str, str]
) -> DataFrame:
    """The typed columns, and as ``_line`` the line itself where it does not fit them."""
    columns = schema.fieldNames()
    line = StructField(_LINE, StringType())
    reading = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}
    if fmt == "json":
        # the file reader would parse only the columns a query asks for, and
        # so miss a bad value in another; an expression parses whole lines
        full = StructType([*schema.fields, line])
        lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
        return lines.select(F.from_json("value", full, reading).alias("r")).select("r.*")
    # all fields are read as text, whatever a query asks for, and each is judged
    # by itself; a header that names other columns, or in another order, is an error
    texts = StructType([*[StructField(c, StringType()) for c in columns], line])
    reading |= {"enforceSchema": "false", "columnPruning": "false"}
    fields = spark.read.format(fmt).schema(texts).options(**reading).load(path)
    typed = {f.name: _typed(F.col(f.name), f.dataType, options) for f in schema.fields}
    wrong = [F.col(c).isNotNull() & typed[c].isNull() for c in columns]
    own = F.to_csv(F.struct(*columns), {"sep": options.get("sep", ",")})
    bad = reduce(Column.__or__, wrong, F.col(_LINE).isNotNull())
    return fields.withColumns({**typed, _LINE: F.when(bad, F.coalesce(_LINE, own))})


def read_with_rejects(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    required: Sequence[str],
    key: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    name: str = "import",
    staging: str | None = None,
) -> Imported:
    """Read CSV, other delimited text or JSON lines, parting good rows from bad.

    Bad is a line that does not parse under ``schema``, with too many or too few
    fields or an amount of more decimals than its column has; a NULL in a
    ``required`` column; or one more row of a ``key`` already taken: of the rows
    under one key the smallest is kept. Every line is judged as a whole, once,
    so valid rows, rejects and log agree whatever a query asks for. Nothing runs
    until a part is used, unless ``staging`` names a folder: the file is then
    parsed once, into it, and all parts are taken from there.
    """
    if not required or not set(key) <= set(required):
        raise ValueError("name the required columns; key columns are among them")
    columns = schema.fieldNames()
    missing = [F.when(F.col(c).isNull(), F.lit(MISSING + c)) for c in required]
    rows = _parse(spark, path, fmt, schema, options or {}).select(
        *columns,
        F.coalesce(_LINE, F.to_json(F.struct(*columns))).alias("Registro"),
        F.coalesce(F.when(F.col(_LINE).isNotNull(), F.lit(MALFORMED)), *missing).alias("Motivo"),
        # files are cut into tasks in the same way at each reading, so this names a line
        F.monotonically_increasing_id().alias("Linea"),
    )
    rows = staged(rows, staging)
    return judged(_first_of_key(rows, columns, key) if key else rows, columns, name)


def judged(lines: DataFrame, columns: Sequence[str], name: str) -> Imported:
    """Valid rows, rejects and log of lines with Registro, Motivo and Linea.

    A line that is bad by itself is a reject of its own; of those that other
    lines rule out, equal ones are counted.
    """
    good = F.col("Motivo").isNull()
    alone = (F.col("Motivo") == MALFORMED) | F.col("Motivo").startswith(MISSING)
    rejects = lines.where(~good).groupBy("Registro", "Motivo", F.when(alone, F.col("Linea")).alias("Linea"))
    rejects = rejects.agg(F.count(F.lit(1)).alias("Veces")).drop("Linea")
    log = lines.agg(
        F.lit(name).alias("Origen"),
        F.count(F.lit(1)).alias("Leidos"),
        F.count_if(good).alias("Aceptados"),
        F.count_if(~good).alias("Rechazados"),
    )
    return Imported(lines.where(good).select(*columns), rejects, log, lines)


def _first_of_key(rows: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``rows`` with all good ones of a key but the smallest set aside; of equal ones the first line is kept.

    The smallest is an aggregate, so many rows of one key are never sorted in one
    task; the join with it is one that Spark may split where a key is hot.
    """
    good = rows.where(F.col("Motivo").isNull())
    first = good.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.min(F.struct(*columns, "Linea")).alias("_first"))
    same = [F.col("Motivo").isNull(), *[F.col(k) == F.col(f"_{k}") for k in key]]
    again = F.when(F.col("Linea") != F.col("_first.Linea"), F.lit(DUPLICATE))
    as_row = F.when(again.isNotNull(), F.to_json(F.struct(*columns)))
    return rows.join(first, same, "left").select(
        *columns,
        F.coalesce(as_row, "Registro").alias("Registro"),
        F.coalesce("Motivo", again).alias("Motivo"),
        "Linea",
    )


def staged(rows: DataFrame, path: str | None) -> DataFrame:
    """``rows`` written to ``path`` and read from there; as they are without a path.

    What an earlier run wrote there is written anew, from the same file.
    """
    if path is None:
        return rows
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def set_aside(got: Imported, rejects: DataFrame, name: str) -> Imported:
    """``got`` with further ``rejects``, of rows that its log counts as accepted."""
    moved = rejects.select(
        F.lit(name).alias("Origen"), F.lit(0).alias("l"), (-F.col("Veces")).alias("a"), F.col("Veces").alias("r")
    )
    before = got.log.select(
        "Origen", F.col("Leidos").alias("l"), F.col("Aceptados").alias("a"), F.col("Rechazados").alias("r")
    )
    log = before.unionByName(moved).groupBy("Origen").agg(
        F.sum("l").alias("Leidos"), F.sum("a").alias("Aceptados"), F.sum("r").alias("Rechazados")
    )
    return Imported(got.valid, got.rejects.unionByName(rejects), log, got.lines)


def read_amounts(
    spark: SparkSession,
    path: str,
    ids: StructType,
    amount: DecimalType,
    document: bool = False,
    name: str = "import",
    staging: str | None = None,
) -> Imported:
    """Amounts out of JSON objects with the columns ``ids`` and a field per category.

    Every field but the ids is a category; one without a value is no amount.
    An object stands on a line, or in a list on a line; with ``document``, each
    file is one list. Set aside are what is no object, an object that lacks an
    id, and, field by field, a value that is no amount of so many decimals. The
    log counts amounts, and each object or line set aside as one. ``valid`` has
    the ids, Categoria and Importe.
    """
    lines = spark.read.text(path, wholetext=document).where(F.length(F.trim("value")) > 0)
    # a single object becomes a list of one; values are kept as their text
    text = F.trim("value")
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    objects = F.from_json(listed, "array<map<string,string>>")
    names = ids.fieldNames()
    records = lines.select("value", F.explode_outer(objects).alias("_o")).withColumns(
        {f.name: F.col("_o")[f.name].try_cast(f.dataType) for f in ids.fields}
    )
    missing = [F.when(F.col(c).isNull(), F.lit(MISSING + c)) for c in names]
    records = records.withColumn(
        "Motivo", F.coalesce(F.when(F.col("_o").isNull(), F.lit(MALFORMED)), *missing)
    )
    records = staged(records, staging)
    whole = records.where(F.col("Motivo").isNotNull()).select(
        F.coalesce(F.to_json("_o"), "value").alias("Registro"), "Motivo"
    )
    fields = (
        records.where(F.col("Motivo").isNull())
        .select(*names, F.explode("_o").alias("Categoria", "_text"))
        .where(~F.col("Categoria").isin(names) & F.col("_text").isNotNull())
    )
    fields = fields.withColumn("Importe", exact_amount(F.col("_text"), amount))
    parts = fields.where(F.col("Importe").isNull()).select(
        F.to_json(F.struct(*names, F.create_map("Categoria", "_text").alias("Campo"))).alias("Registro"),
        F.concat(F.lit("malformed "), "Categoria").alias("Motivo"),
    )
    rejects = whole.unionByName(parts).groupBy("Registro", "Motivo").agg(F.count(F.lit(1)).alias("Veces"))
    valid = fields.where(F.col("Importe").isNotNull()).select(*names, "Categoria", "Importe")
    taken, left = valid.select(F.lit(1).alias("a"), F.lit(0).alias("r")), rejects.select(F.lit(0).alias("a"), F.col("Veces").alias("r"))
    log = taken.unionByName(left).agg(
        F.lit(name).alias("Origen"),
        F.coalesce(F.sum(F.col("a") + F.col("r")), F.lit(0)).alias("Leidos"),
        F.coalesce(F.sum("a").cast("long"), F.lit(0)).alias("Aceptados"),
        F.coalesce(F.sum("r").cast("long"), F.lit(0)).alias("Rechazados"),
    )
    return Imported(valid, rejects.select("Registro", "Motivo", "Veces"), log)


def wide_to_long(df: DataFrame, ids: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """One row per category column that holds a value: (ids, Categoria, Importe)."""
    return df.unpivot(list(ids), list(categories), "Categoria", "Importe").where(
        F.col("Importe").isNotNull()
    )
