"""Imports of people, units, payments and expenses from files.

The file columns are this library's own definition, given as ``FILES``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from strata.functions.fixed import DATE_FORMAT
from strata.plans.collection import ACCOUNT, PERSON
from strata.sources.imports import Imported, judged, read_amounts, read_with_rejects
from strata.sources.tables import AMOUNT, SCHEMAS, Tables, schema

FILES = {
    "people": StructType([*SCHEMAS["person"].fields, SCHEMAS["payment"][ACCOUNT]]),
    "units": StructType(
        [SCHEMAS["unit"][c] for c in ("UnidadFuncionalID", "ConsorcioID", "Piso", "Departamento")]
    ),
    "assignments": schema(
        NroClaveUniformeID=StringType(), UnidadFuncionalID=LongType(), EsInquilino=BooleanType()
    ),
    "payments": SCHEMAS["payment"],
}

CONFLICT = "conflicting person"
UNKNOWN_ACCOUNT, UNKNOWN_UNIT, SURPLUS = "unknown account", "unknown unit", "surplus person"

CSV = {"header": "true", "dateFormat": DATE_FORMAT}
TXT = {"header": "true", "sep": "\t"}


def import_people(
    spark: SparkSession, path: str, options: Mapping[str, str] = CSV, staging: str | None = None
) -> tuple[DataFrame, DataFrame, Imported]:
    """Persons and accounts out of one file with a line per account."""
    got = read_with_rejects(
        spark, path, "csv", FILES["people"], [PERSON, "DNI", ACCOUNT], [ACCOUNT], options, "people", staging
    )
    columns = SCHEMAS["person"].fieldNames()
    # a person with several accounts stands on several lines, which have to agree;
    # those that differ from the smallest are set aside, with their accounts
    own = F.struct(*columns)
    smallest = got.valid.groupBy(PERSON).agg(F.min(own).alias("_person"))
    named = smallest.select(F.col(PERSON).alias("_id"), "_person")
    good = F.col("Motivo").isNull()
    lines = got.lines.join(named, good & (F.col(PERSON) == F.col("_id")), "left").withColumn(
        "Motivo", F.coalesce("Motivo", F.when(~own.eqNullSafe(F.col("_person")), CONFLICT))
    )
    got = judged(lines.drop("_id", "_person"), FILES["people"].fieldNames(), "people")
    return smallest.select("_person.*"), got.valid.select(ACCOUNT, PERSON), got


def import_units(
    spark: SparkSession, path: str, options: Mapping[str, str] = TXT, staging: str | None = None
) -> tuple[DataFrame, Imported]:
    """Units, as yet without owner and tenant."""
    key = ["UnidadFuncionalID"]
    got = read_with_rejects(
        spark, path, "csv", FILES["units"], [*key, "ConsorcioID"], key, options, "units", staging
    )
    nobody = F.lit(None).cast("bigint")
    units = got.valid.withColumn("PropietarioID", nobody).withColumn("InquilinoID", nobody)
    return units.select(*SCHEMAS["unit"].fieldNames()), got


def import_assignments(
    spark: SparkSession, path: str, options: Mapping[str, str] = CSV, staging: str | None = None
) -> Imported:
    columns = FILES["assignments"]
    return read_with_rejects(
        spark, path, "csv", columns, columns.fieldNames(), (), options, "assignments", staging
    )


def assign_people(units: DataFrame, assignments: DataFrame, accounts: DataFrame) -> DataFrame:
    """Units with the owner and tenant that the account keys of the assignments name.

    Several of a kind for one unit: the highest person id. None, or an unknown
    account: the unit keeps what it had.
    """
    named = (
        assignments.join(accounts, ACCOUNT)
        .groupBy("UnidadFuncionalID")
        .agg(
            F.max(F.when(~F.col("EsInquilino"), F.col(PERSON))).alias("_owner"),
            F.max(F.when(F.col("EsInquilino"), F.col(PERSON))).alias("_tenant"),
        )
    )
    return (
        units.join(named, "UnidadFuncionalID", "left")
        .withColumn("PropietarioID", F.coalesce("_owner", "PropietarioID"))
        .withColumn("InquilinoID", F.coalesce("_tenant", "InquilinoID"))
        .select(*units.columns)
    )


def assignment_rejects(units: DataFrame, assignments: DataFrame, accounts: DataFrame) -> DataFrame:
    """The assignments that ``assign_people`` does not use, with the reason and how often each stands.

    Those of an unknown account or unit, and those of a person other than the
    one taken for the side of the unit.
    """
    columns = assignments.columns
    lines = assignments.groupBy(*columns).agg(F.count(F.lit(1)).alias("Veces"))
    named = lines.join(accounts, ACCOUNT, "left")
    known = units.select(F.col("UnidadFuncionalID"), F.lit(True).alias("_known")).distinct()
    named = named.join(known, "UnidadFuncionalID", "left")
    side = ["UnidadFuncionalID", "EsInquilino"]
    taken = named.groupBy(*side).agg(F.max(PERSON).alias("_taken"))
    judged = named.join(taken, side)
    reason = (
        F.when(F.col(PERSON).isNull(), UNKNOWN_ACCOUNT)
        .when(F.col("_known").isNull(), UNKNOWN_UNIT)
        .when(F.col(PERSON) != F.col("_taken"), SURPLUS)
    )
    return judged.withColumn("Motivo", reason).where(F.col("Motivo").isNotNull()).select(
        F.to_json(F.struct(*columns)).alias("Registro"), "Motivo", "Veces"
    )


def import_buildings(
    spark: SparkSession, path: str, options: Mapping[str, str] = CSV, staging: str | None = None
) -> tuple[DataFrame, Imported]:
    """Buildings out of a file with a line per building."""
    key = ["ConsorcioID"]
    got = read_with_rejects(spark, path, "csv", SCHEMAS["building"], key, key, options, "buildings", staging)
    return got.valid, got


def import_payments(
    spark: SparkSession,
    path: str,
    tables: Tables,
    options: Mapping[str, str] = CSV,
    staging: str | None = None,
) -> tuple[DataFrame, DataFrame, Imported]:
    """Payments of known accounts, and those of unknown ones."""
    key = ["PagoID"]
    required = [*key, "Fecha", "Importe", ACCOUNT]
    got = read_with_rejects(spark, path, "csv", FILES["payments"], required, key, options, "payments", staging)
    known = tables.account.select(ACCOUNT)
    return (
        got.valid.join(known, ACCOUNT, "left_semi").select(*got.valid.columns),
        got.valid.join(known, ACCOUNT, "left_anti").select(*got.valid.columns),
        got,
    )


def import_expenses(
    spark: SparkSession, path: str, document: bool = False, staging: str | None = None
) -> tuple[DataFrame, Imported]:
    """Ordinary expenses out of JSON objects with a field per category, whatever its name.

    Objects stand on lines; with ``document`` a file is one list of them.
    """
    ids = StructType([SCHEMAS["expense_ordinary"][c] for c in ("ConsorcioID", "Periodo")])
    got = read_amounts(spark, path, ids, AMOUNT, document, "expenses", staging)
    return got.valid, got
