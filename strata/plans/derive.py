"""Tables derived from payments and expenses, for all months in one job.

What these compute is this library's own definition, given per function.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.fixed import CONCEPT_EXTRAORDINARY, CONCEPT_ORDINARY
from strata.operators import date_range, explode_keys, running_total
from strata.plans.collection import ACCOUNT, AMOUNT_TYPE, PERSON, collect_by
from strata.plans.expenses import monthly_expenses
from strata.sources.tables import Tables

BUILDING = "ConsorcioID"

UNITS_A_PIECE = 10_000

_CENTS = "_cents"


def _month(column: str):
    return F.trunc(column, "month")


def _collected(
    tables: Tables, concept: str | None = None, end: dt.date | None = None, since: dt.date | None = None
) -> DataFrame:
    """Collection per building and month, as the reports count it, from ``since`` up to ``end``."""
    return collect_by(
        tables,
        {"Periodo": _month("Fecha")},
        {"Importe": F.col("Importe")},
        by=[BUILDING],
        concept=concept,
        start=since,
        end=end,
    ).where(F.col("Importe").isNotNull())


def derive_extra_expenses(tables: Tables, since: dt.date | None = None) -> DataFrame:
    """Extraordinary expense of a building and month: the extraordinary payments it collected."""
    return _collected(tables, CONCEPT_EXTRAORDINARY, since=since).select(BUILDING, "Periodo", "Importe")


def derive_ordinary_expenses(tables: Tables, category: str, since: dt.date | None = None) -> DataFrame:
    """Ordinary payments as expenses of ``category``, where it has none that month yet."""
    present = tables.expense_ordinary.where(F.col("Categoria") == category)
    return (
        _collected(tables, CONCEPT_ORDINARY, since=since)
        .join(present, [BUILDING, "Periodo"], "left_anti")
        .select(BUILDING, "Periodo", F.lit(category).alias("Categoria"), "Importe")
    )


def _month_end(period: dt.date | None) -> dt.date | None:
    """The last day of the month that begins with ``period``."""
    if period is None:
        return None
    return (period.replace(day=1) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def _building_months(tables: Tables, period: dt.date | None = None, since: dt.date | None = None) -> DataFrame:
    expenses = monthly_expenses(tables, start=since, end=period)
    return expenses.select(
        BUILDING, F.make_date("Anio", "Mes", F.lit(1)).alias("Periodo"), "TotalGastos"
    )


def _weighed(tables: Tables, weight: str | None) -> tuple[DataFrame, DataFrame]:
    """Units with their weight, and the whole weight of each building.

    Weights count to six decimals, and as whole millionths, so that a share is
    exact until it is rounded to cents, once per owner and month.
    """
    millionths = F.round((F.col(weight) if weight else F.lit(1)).cast("decimal(24,6)"), 6) * 1_000_000
    units = tables.unit.withColumn("_weight", millionths.cast("decimal(17,0)"))
    # a building of many units is cut into pieces, each of which meets its months in a task of its own
    whole = units.groupBy(BUILDING).agg(
        F.sum("_weight").cast("decimal(18,0)").alias("_whole"),
        F.expr(f"cast(1 + count(1) div {UNITS_A_PIECE} as int)").alias("_pieces"),
    )
    return units, whole


def _piece() -> Column:
    """The piece of its building that a person belongs to."""
    return F.pmod(F.xxhash64(PERSON), "_pieces").cast("int")


def _charged_months(
    tables: Tables, whole: DataFrame, period: dt.date | None, since: dt.date | None = None
) -> DataFrame:
    """The expense of a building and month, with what a share of it is computed from."""
    return _building_months(tables, period, since).join(whole, BUILDING).where("_whole > 0").select(
        BUILDING,
        "Periodo",
        "_whole",
        "_pieces",
        F.expr("cast(200 * abs(TotalGastos) as decimal(20,0))").alias("_twice"),
        F.expr("cast(sign(TotalGastos) as bigint)").alias("_sign"),
        # whether a share, of the whole at most, is exact in 64 bits, which is several times faster
        F.expr("200 * abs(cast(TotalGastos as double)) * cast(_whole as double) < 4e18").alias("_short"),
    )


def _each_piece(df: DataFrame) -> DataFrame:
    return df.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")


def _share(month: str = "") -> str:
    """Cents of the expense of a month that fall to an owner; half a cent goes away from zero."""
    share = "{0}_sign * (({1} * {2} + {3}) div (2 * {3}))"
    plain = share.format(month, f"{month}_twice", "_owned", "_whole")
    short = share.format(month, *[f"cast({c} as bigint)" for c in (f"{month}_twice", "_owned", "_whole")])
    return f"if({month}_short AND abs(_owned) <= _whole, {short}, {plain})"


def _charges(
    tables: Tables, weight: str | None, period: dt.date | None, since: dt.date | None = None
) -> DataFrame:
    """Each owner's share of the month's expense, by units owned or their weight."""
    units, whole = _weighed(tables, weight)
    owned = (
        units.where(F.col("PropietarioID").isNotNull())
        .groupBy(BUILDING, F.col("PropietarioID").alias(PERSON))
        .agg(F.sum("_weight").cast("decimal(17,0)").alias("_owned"))
    )
    months = _each_piece(_charged_months(tables, whole, period, since))
    owned = owned.join(whole.select(BUILDING, "_pieces"), BUILDING).withColumn("_piece", _piece())
    return owned.join(months, [BUILDING, "_piece"]).select(PERSON, BUILDING, "Periodo", F.expr(_share()).alias(_CENTS))


def _paid(tables: Tables, period: dt.date | None, since: dt.date | None = None) -> DataFrame:
    """Payments of a person and month, as cents that lower a balance."""
    payments = date_range(
        tables.payment, "Fecha", since, _month_end(period), directories=tables.directories("payment")
    )
    paid = payments.where(F.col("Importe").isNotNull()).select(
        ACCOUNT, _month("Fecha").alias("Periodo"), "Importe"
    )
    by_person = (
        paid.join(tables.account, ACCOUNT).groupBy(PERSON, "Periodo").agg(F.sum("Importe").alias("_sum"))
    )
    return by_person.select(PERSON, "Periodo", (-100 * F.col("_sum")).cast("long").alias(_CENTS))


def _credits(tables: Tables, period: dt.date | None, since: dt.date | None = None) -> DataFrame:
    """Payments of a person, once in each building where the person owns or rents."""
    links = (
        explode_keys(tables.unit, ["PropietarioID", "InquilinoID"], PERSON)
        .select(PERSON, BUILDING)
        .distinct()
    )
    return _paid(tables, period, since).join(links, PERSON).select(PERSON, BUILDING, "Periodo", _CENTS)


def _carried_on(
    tables: Tables, weight: str | None, since: dt.date | None = None, before: DataFrame | None = None
) -> DataFrame:
    """(person, building, Periodo, cents): the balance after each month of a person with a charge or payment.

    A person and building is one row up to the last step: the payments come as
    a list, so do the building's months, and only there the months become rows,
    which nothing shuffles, sorts or groups any more. The calendar bounds the
    lists. ``before`` has the cents that balances start from.
    """
    units, whole = _weighed(tables, weight)
    own = F.col("PropietarioID").eqNullSafe(F.col(PERSON))
    links = (
        explode_keys(units, ["PropietarioID", "InquilinoID"], PERSON)
        .groupBy(PERSON, BUILDING)
        .agg(F.sum(F.when(own, F.col("_weight"))).cast("decimal(17,0)").alias("_owned"), F.bool_or(own).alias("_owner"))
    )
    links = links.join(whole.select(BUILDING, "_pieces"), BUILDING, "left").withColumn("_piece", _piece())
    if before is not None:
        opening = before.select(F.col(PERSON).alias("_person"), F.col(BUILDING).alias("_building"), "_before")
        same = (F.col(PERSON) == F.col("_person")) & F.col(BUILDING).eqNullSafe(F.col("_building"))
        links = links.join(opening, same, "left")
    else:
        links = links.withColumn("_before", F.lit(None).cast("long"))
    paid = _paid(tables, None, since).groupBy(PERSON).agg(
        F.collect_list(F.struct("Periodo", _CENTS)).alias("_paid")
    )
    months = _charged_months(tables, whole, None, since).groupBy(BUILDING, "_pieces", "_whole").agg(
        F.collect_list(F.struct("Periodo", "_twice", "_sign", "_short")).alias("_months")
    )
    charged = F.expr(
        f"transform(if(_owner, _months, null), m -> struct(m.Periodo AS Periodo, cast({_share('m.')} as bigint) AS {_CENTS}))"
    )
    none = F.expr(f"cast(array() as array<struct<Periodo:date,{_CENTS}:bigint>>)")
    moves = F.sort_array(F.concat(F.coalesce(charged, none), F.coalesce("_paid", none)))
    # charge and payment of one month share the balance after both
    balances = F.expr(
        f"""aggregate(
            _moves,
            struct(_before AS total, cast(array() as array<struct<Periodo:date,total:bigint>>) AS months),
            (done, move) -> struct(
                coalesce(done.total + move.{_CENTS}, done.total, move.{_CENTS}) AS total,
                array_append(
                    if(try_element_at(done.months, -1).Periodo <=> move.Periodo,
                       slice(done.months, 1, greatest(size(done.months) - 1, 0)), done.months),
                    struct(move.Periodo AS Periodo, coalesce(done.total + move.{_CENTS}, done.total, move.{_CENTS}) AS total)
                ) AS months),
            done -> done.months)"""
    )
    listed = (
        links.join(paid, PERSON, "left")
        .join(_each_piece(months), [BUILDING, "_piece"], "left")
        .select(PERSON, BUILDING, "_before", moves.alias("_moves"))
    )
    return listed.select(PERSON, BUILDING, F.explode(balances).alias("_month")).select(
        PERSON, BUILDING, "_month.Periodo", F.col("_month.total").alias(_CENTS)
    )


def _amount(cents) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(AMOUNT_TYPE)


def prorate(tables: Tables, period: dt.date | None = None, weight: str | None = None) -> DataFrame:
    """Balance per person, building and month: charges less payments, carried forward.

    Owners are charged the building's expense by the share of units they own,
    or of ``weight``, a column of the units. A month stands where it has a
    charge or a payment. With ``period``, the first day of a month, that month
    alone is computed, without those before it.
    """
    if period is not None:
        moves = _charges(tables, weight, period).unionByName(_credits(tables, period))
        return (
            moves.groupBy(PERSON, BUILDING)
            .agg(F.max("Periodo").alias("Periodo"), _amount(F.sum(_CENTS)).alias("SaldoActual"))
            .where(F.col("Periodo") == F.lit(period))
        )
    totals = _carried_on(tables, weight)
    return totals.select(PERSON, BUILDING, "Periodo", _amount(F.col(_CENTS)).alias("SaldoActual"))


def _opening(closed: DataFrame, since: dt.date, group: Sequence[str], balance: str) -> DataFrame:
    """The last balance of each group before ``since``, as of the day before it."""
    last = closed.where(F.col("Periodo") < F.lit(since)).groupBy(*group).agg(F.max_by(balance, "Periodo").alias(balance))
    return last.withColumn("Periodo", F.lit(since - dt.timedelta(days=1)))


def prorate_since(tables: Tables, closed: DataFrame, since: dt.date, weight: str | None = None) -> DataFrame:
    """The balances of :func:`prorate` from the month ``since`` on, carried on from those of ``closed``.

    Only payments and expenses of these months are read. ``closed`` has balances
    of months before; they stay as they were, also where units have changed hands.
    """
    group = [PERSON, BUILDING]
    before = _opening(closed, since, group, "SaldoActual")
    before = before.select(*group, (F.col("SaldoActual") * 100).cast("long").alias("_before"))
    later = _carried_on(tables, weight, since, before).where(F.col("Periodo") >= F.lit(since))
    return later.select(*group, "Periodo", _amount(F.col(_CENTS)).alias("SaldoActual"))


def _state_months(tables: Tables, period: dt.date | None, since: dt.date | None = None) -> DataFrame:
    none = F.lit(0).cast(AMOUNT_TYPE)
    income = _collected(tables, end=_month_end(period), since=since).select(
        BUILDING, "Periodo", F.col("Importe").alias("Ingresos"), none.alias("Egresos")
    )
    expense = _building_months(tables, period, since).select(
        BUILDING, "Periodo", none.alias("Ingresos"), F.col("TotalGastos").cast(AMOUNT_TYPE).alias("Egresos")
    )
    return (
        income.unionByName(expense)
        .groupBy(BUILDING, "Periodo")
        .agg(
            F.sum("Ingresos").cast(AMOUNT_TYPE).alias("Ingresos"),
            F.sum("Egresos").cast(AMOUNT_TYPE).alias("Egresos"),
        )
        .withColumn("Resultado", (F.col("Ingresos") - F.col("Egresos")).cast(AMOUNT_TYPE))
    )


def financial_state_since(tables: Tables, closed: DataFrame, since: dt.date) -> DataFrame:
    """The rows of :func:`financial_state` from the month ``since`` on, carried on from those of ``closed``."""
    months = _state_months(tables, None, since)
    none = [F.lit(0).cast(AMOUNT_TYPE).alias(c) for c in ("Ingresos", "Egresos")]
    before = _opening(closed, since, [BUILDING], "SaldoCierre")
    carried = before.select(BUILDING, "Periodo", *none, F.col("SaldoCierre").cast(AMOUNT_TYPE).alias("Resultado"))
    totals = running_total(months.unionByName(carried), "Resultado", "SaldoCierre", ["Periodo"], [BUILDING])
    return totals.where(F.col("Periodo") >= F.lit(since))


def financial_state(tables: Tables, period: dt.date | None = None) -> DataFrame:
    """Income, expense, net and closing balance per building and month."""
    months = _state_months(tables, period)
    if period is None:
        return running_total(months, "Resultado", "SaldoCierre", ["Periodo"], [BUILDING])
    own = F.col("Periodo") == F.lit(period)
    shown = [F.max(F.when(own, F.col(c))).alias(c) for c in ("Ingresos", "Egresos", "Resultado")]
    return (
        months.groupBy(BUILDING)
        .agg(F.max("Periodo").alias("Periodo"), *shown, F.sum("Resultado").alias("SaldoCierre"))
        .where(own)
    )
