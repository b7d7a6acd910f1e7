"""Owners with the largest debt."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import date_range, optional_equal, sum_having, top_n
from strata.plans.collection import PERSON, scope
from strata.sources.tables import Tables

CONTACT = ["DNI", "Nombre", "Apellido", "Mail", "Telefono"]


def _sums(
    tables: Tables,
    building_id: int | None,
    start: dt.date | None,
    end: dt.date | None,
    minimum: Decimal | None,
) -> DataFrame:
    balances = date_range(
        optional_equal(tables.balance, "ConsorcioID", building_id), "Periodo", start, end
    )
    return sum_having(
        balances, [*scope(building_id), PERSON], "SaldoActual", "SaldoNetoAcumulado", minimum
    )


def owner_debts(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    minimum: Decimal | None = None,
) -> DataFrame:
    """Debts of owners, with contact columns.

    Balances are summed and filtered before they meet the person table, which
    then serves both as the owner test and as the source of the contacts; the
    sum and the join use one partitioning when a single building is asked for.
    """
    apart = scope(building_id)
    debts = _sums(tables, building_id, start, end, minimum)
    owners = tables.person.where("EsPropietario").select(PERSON, *CONTACT)
    return debts.join(owners, PERSON).select(*apart, *CONTACT, "SaldoNetoAcumulado")


def top_debtors(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    minimum: Decimal | None = None,
    n: int = 3,
) -> DataFrame:
    """The owners of the largest debts; contacts meet only the rows that are kept."""
    apart = scope(building_id)
    debts = _sums(tables, building_id, start, end, minimum)
    owners = tables.person.where("EsPropietario").select(PERSON, "DNI")
    kept = top_n(debts.join(owners, PERSON), "SaldoNetoAcumulado", n, ["DNI"], apart)
    contacts = tables.person.select(PERSON, *CONTACT[1:])
    return (
        kept.join(contacts, PERSON)
        .select(*apart, *CONTACT, "SaldoNetoAcumulado")
        .orderBy(*apart, F.col("SaldoNetoAcumulado").desc(), "DNI")
    )
