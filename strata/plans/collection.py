"""Reports over collected payments.

A payment reaches a unit through its account: the account's person owns or
rents the unit. A person linked to several units brings the payment to each.
``building_id`` None means every building, each on its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import calendar_year, concept_is, iso_week, month_name_es, month_span, unit_label
from strata.functions.fixed import CONCEPT_EXTRAORDINARY, CONCEPT_ORDINARY, MONTH_NAMES
from strata.operators import (
    broadcast_if_small,
    date_range,
    explode_keys,
    is_small,
    measured_bytes,
    optional_equal,
    overall_average,
    row_bytes,
    running_total,
    top_n,
)
from strata.sources.tables import Tables

ACCOUNT = "NroClaveUniformeID"
PERSON = "PersonaID"
UNIT_NAME = "UnidadFuncionalNombre"
AMOUNT_TYPE = "decimal(38,2)"

MANY_VALUES = 32

_LINKS = "_links"


def scope(building_id: int | None) -> list[str]:
    """Grouping columns that keep buildings apart where all are asked for."""
    return ["ConsorcioID"] if building_id is None else []


def unit_people(tables: Tables, building_id: int | None = None, label: str | None = None) -> DataFrame:
    """One row per unit and person linked to it, with the unit's label if named."""
    units = optional_equal(tables.unit, "ConsorcioID", building_id)
    if label:
        units = units.join(tables.building, "ConsorcioID").withColumn(UNIT_NAME, unit_label(label))
    return explode_keys(units, ["PropietarioID", "InquilinoID"], PERSON)


def _accounts_of(tables: Tables, people: DataFrame, small: bool) -> DataFrame:
    """Accounts of ``people`` with the columns of theirs.

    For one building these are a short list beside the payments: marked for
    broadcast if they measure small, they let the payments be read in place.
    Nothing is measured where the people alone are too many; Spark then joins
    by shuffle, and splits an account that holds much of the payments.
    """
    if not small:
        return tables.account.join(people, PERSON)
    return broadcast_if_small(tables.account.join(F.broadcast(people), PERSON))


def collect_by(
    tables: Tables,
    periods: Mapping[str, Column],
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    label: str | None = None,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    half_open: bool = False,
    concept: str | None = None,
) -> DataFrame:
    """Sums of payment ``measures`` per period and ``by`` (columns of the unit).

    Links of a person to units are counted per ``by`` value and multiplied in,
    so a payment is not copied per unit, and the payments are joined once, with
    accounts that already carry the links. A person with many ``by`` values
    would put each of them on each account; such people's payments are summed
    per person and meet the links as sums (:func:`_sum_many`).
    """
    links = unit_people(tables, building_id, label).groupBy(PERSON, *by).agg(
        F.count(F.lit(1)).cast("decimal(10,0)").alias(_LINKS)
    )
    payments = date_range(
        tables.payment, "Fecha", start, end, half_open, tables.directories("payment")
    )
    payments = optional_equal(payments, "Concepto", concept).select(
        ACCOUNT,
        *[column.alias(name) for name, column in periods.items()],
        *[column.alias(name) for name, column in measures.items()],
    )
    # of all buildings nothing is measured, so that no job runs until rows are asked for
    small, many = False, bool(by)
    if building_id is not None:
        most, size = _measure_links(links)
        small, many = is_small(size), most > MANY_VALUES
    if not many:
        return _sum_links(payments.join(_accounts_of(tables, links, small), ACCOUNT), [*by, *periods], measures)
    return _sum_many(tables, payments, links, by, periods, measures, small)


def _sum_many(
    tables: Tables,
    payments: DataFrame,
    links: DataFrame,
    by: Sequence[str],
    periods: Sequence[str],
    measures: Sequence[str],
    small: bool,
) -> DataFrame:
    """Sums where persons may have many ``by`` values, in one pass over the payments.

    Accounts of other persons carry their links; one of such a person carries
    the person. Both kinds are summed by the same aggregate, and what it leaves
    of such persons meets their links. Sums of the others find none there; they
    pass through the same join, spread by a salt.
    """
    counted = links.join(links.groupBy(PERSON).agg(F.count(F.lit(1)).alias("_values")), PERSON)
    crowded = counted.where(F.col("_values") > MANY_VALUES)
    kinds = {f.name: f.dataType for f in links.schema.fields}
    person = F.lit(None).cast(kinds[PERSON]).alias("_many")
    own = counted.where(F.col("_values") <= MANY_VALUES).select(PERSON, *by, _LINKS, person)
    single = crowded.select(PERSON).distinct().select(
        PERSON,
        *[F.lit(None).cast(kinds[c]).alias(c) for c in by],
        F.lit(1).cast(kinds[_LINKS]).alias(_LINKS),
        F.col(PERSON).alias("_many"),
    )
    linked = payments.join(_accounts_of(tables, own.unionByName(single), small), ACCOUNT)
    sums = _sum_links(linked, [*by, "_many", *periods], measures)
    alone = F.col("_many").isNull()
    salt = F.when(alone, F.xxhash64(*by, *periods)).otherwise(F.lit(0))
    theirs = crowded.select(
        F.col(PERSON).alias("_many"),
        F.lit(0).cast("long").alias("_salt"),
        F.col(_LINKS).alias("_times"),
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
    )
    met = sums.withColumn("_salt", salt).join(theirs, ["_many", "_salt"], "left")
    shown = [F.when(alone, F.col(c)).otherwise(F.col(f"_by{i}")).alias(c) for i, c in enumerate(by)]
    times = F.coalesce("_times", F.lit(1).cast(kinds[_LINKS]))
    return (
        met.select(*shown, *periods, *[(F.col(name) * times).alias(name) for name in measures])
        .groupBy(*by, *periods)
        .agg(*[F.sum(name).cast(AMOUNT_TYPE).alias(name) for name in measures])
    )


def _measure_links(links: DataFrame) -> tuple[int, int]:
    """The number of links of the person who has most, and the bytes of all."""
    people = links.groupBy(PERSON).agg(
        F.count(F.lit(1)).alias("_values"), F.sum(row_bytes(links)).alias("_bytes")
    )
    most, size = people.agg(F.max("_values"), F.sum("_bytes")).first()
    return most or 0, size or 0


def _sum_links(linked: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return linked.groupBy(*by).agg(
        *[F.sum(F.col(name) * F.col(_LINKS)).cast(AMOUNT_TYPE).alias(name) for name in measures]
    )


def payments_by_unit(
    tables: Tables,
    label: str,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    half_open: bool = False,
) -> DataFrame:
    """Every payment once per unit it reaches, for reports that list payments."""
    people = unit_people(tables, building_id, label).select(
        PERSON, "ConsorcioID", "UnidadFuncionalID", UNIT_NAME
    )
    payments = date_range(
        tables.payment, "Fecha", start, end, half_open, tables.directories("payment")
    ).select(
        "PagoID", ACCOUNT, "Fecha", "Importe"
    )
    # of all buildings nothing is measured, so that no job runs until rows are asked for
    small = building_id is not None and is_small(measured_bytes(people))
    return payments.join(_accounts_of(tables, people, small), ACCOUNT).drop(ACCOUNT, PERSON)


def _amount_if(test: Column) -> Column:
    return F.when(test, F.col("Importe")).otherwise(0)


def _by_concept(ordinary: str, extraordinary: str, ignore_case: bool) -> dict[str, Column]:
    return {
        ordinary: _amount_if(concept_is(CONCEPT_ORDINARY, ignore_case)),
        extraordinary: _amount_if(concept_is(CONCEPT_EXTRAORDINARY, ignore_case)),
    }


def weekly_collection(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    iso_year: bool = False,
    ignore_case: bool = False,
) -> DataFrame:
    """Collection per ISO week, with the mean week and the running total.

    The year is the calendar year of the payment, so the last days of December
    may stand in week 1 of the old year; ``iso_year`` takes the week's year.
    """
    apart = scope(building_id)
    weeks = collect_by(
        tables,
        {"Anio": calendar_year(F.col("Fecha"), iso_year), "NroSemana": iso_week(F.col("Fecha"))},
        _by_concept("RecaudacionOrdinaria", "RecaudacionExtraordinaria", ignore_case),
        by=apart,
        building_id=building_id,
        start=start,
        end=end,
    )
    total = F.col("RecaudacionOrdinaria") + F.col("RecaudacionExtraordinaria")
    weeks = weeks.withColumn("TotalSemanal", total.cast(AMOUNT_TYPE))
    weeks = overall_average(weeks, "TotalSemanal", "PromedioSemanal", apart)
    weeks = running_total(
        weeks, "TotalSemanal", "AcumuladoProgresivo", ["Anio", "NroSemana"], apart
    )
    return weeks.orderBy(*apart, "Anio", "NroSemana")


def monthly_by_unit(
    tables: Tables, year: int, building_id: int | None = None, month: int | None = None
) -> DataFrame:
    """Collection per unit label: one column per month, or the one month asked for."""
    start, end = month_span(year, month)
    if month is None:
        named = {
            name: F.when(F.month("Fecha") == number, F.col("Importe"))
            for number, name in enumerate(MONTH_NAMES, start=1)
        }
    else:
        named = {"MesSolicitado": F.coalesce("Importe", F.lit(0))}
    sums = collect_by(
        tables,
        {},
        named,
        by=[UNIT_NAME],
        label="collection",
        building_id=building_id,
        start=start,
        end=end,
        half_open=True,
    )
    return sums.select(
        UNIT_NAME, *[F.coalesce(name, F.lit(0)).cast(AMOUNT_TYPE).alias(name) for name in named]
    ).orderBy(UNIT_NAME)


def collection_by_source(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """Collection per month and concept; the month's total counts every concept."""
    apart = scope(building_id)
    measures = _by_concept("TotalOrdinario", "TotalExtraordinario", ignore_case)
    months = collect_by(
        tables,
        {"Anio": F.year("Fecha"), "Mes": F.month("Fecha")},
        {**measures, "TotalGeneralMes": F.col("Importe")},
        by=apart,
        building_id=building_id,
        start=start,
        end=end,
    )
    return months.withColumn(
        "TotalGeneralMes", F.coalesce("TotalGeneralMes", F.lit(0)).cast(AMOUNT_TYPE)
    ).orderBy(*apart, "Anio", "Mes")


def monthly_income(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    return collect_by(
        tables,
        {"Anio": F.year("Fecha"), "Mes": F.month("Fecha")},
        {"TotalIngresos": F.col("Importe")},
        by=scope(building_id),
        building_id=building_id,
        start=start,
        end=end,
    )


def top_income_months(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    n: int = 5,
) -> DataFrame:
    apart = scope(building_id)
    months = monthly_income(tables, building_id, start, end)
    return top_n(months, "TotalIngresos", n, ["Anio", "Mes"], apart).withColumn(
        "Mes", month_name_es(F.col("Mes"))
    )
