from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from strata import plans
from strata.plans.debtors import top_debtors
from strata.sources import Tables
from tests.conftest import bag, day, linked, money, rows


@pytest.fixture(scope="module")
def books(small, make):
    expenses = make(
        expense_ordinary=[
            (1, day("2025-01-01"), "LUZ", money("100.01")),
            (1, day("2025-03-01"), "LUZ", money("33.33")),
            (2, day("2025-01-01"), "LUZ", money(7)),
        ],
        expense_extra=[(1, day("2025-01-01"), money(50))],
    )
    parts = ("payment", "account", "unit", "building")
    return Tables.of(
        **{role: small[role] for role in parts},
        expense_ordinary=expenses.expense_ordinary,
        expense_extra=expenses.expense_extra,
    )


def month(date):
    return date.replace(day=1)


def test_expenses_out_of_payments(books):
    sums = defaultdict(Decimal)
    for payment, unit in linked(books):
        if payment[2] is not None:
            sums[payment[3], unit[1], month(payment[1])] += payment[2]
    extra = [(b, m, v) for (concept, b, m), v in sums.items() if concept == "EXTRAORDINARIO"]
    assert bag(plans.derive_extra_expenses(books)) == sorted(extra, key=repr)
    # building 1 has a LUZ expense in January and March already
    present = {(1, day("2025-01-01")), (1, day("2025-03-01")), (2, day("2025-01-01"))}
    ordinary = [
        (b, m, "LUZ", v) for (concept, b, m), v in sums.items() if concept == "ORDINARIO" and (b, m) not in present
    ]
    assert bag(plans.derive_ordinary_expenses(books, "LUZ")) == sorted(ordinary, key=repr)
    assert (1, day("2025-03-01"), "AGUA", money(24)) in rows(plans.derive_ordinary_expenses(books, "AGUA"))


def moves(tables):
    """Charges and payments per (person, building, month), from first principles."""
    units = rows(tables.unit)
    total = defaultdict(Decimal)
    for building, period, *_, amount in rows(tables.expense_ordinary) + rows(tables.expense_extra):
        total[building, period] += amount
    out = defaultdict(Decimal)
    for (building, period), amount in total.items():
        here = [u for u in units if u[1] == building]
        for owner in {u[2] for u in here if u[2] is not None}:
            owned = sum(u[2] == owner for u in here)
            share = (amount * owned / len(here)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            out[owner, building, period] += share
    people = {}
    for key, person in rows(tables.account):
        people[key] = person
    seen = set()
    for payment, unit in linked(tables):
        who = people[payment[4]]
        if (payment[0], unit[1]) in seen:
            continue
        seen.add((payment[0], unit[1]))
        if payment[2] is not None:
            out[who, unit[1], month(payment[1])] -= payment[2]
    return out


def test_proration(books):
    expected, running = [], defaultdict(Decimal)
    for (person, building, period), amount in sorted(moves(books).items(), key=lambda kv: kv[0][2]):
        running[person, building] += amount
        expected.append((person, building, period, running[person, building]))
    assert bag(plans.prorate(books)) == sorted(expected, key=repr)


def test_proration_of_one_month(books):
    every = rows(plans.prorate(books))
    for period in {r[2] for r in every}:
        one = bag(plans.prorate(books, period))
        assert one == sorted((r for r in every if r[2] == period), key=repr)


def test_proration_feeds_the_debtors(books, make):
    people = make(person=[(100, 5, "n", "a", None, None, True), (102, 6, "n", "a", None, None, True)]).person
    tables = Tables.of(person=people, balance=plans.prorate(books))
    got = rows(top_debtors(tables, 1, day("2025-01-01"), day("2025-01-31")))
    # 150.01 over five units: two are owned by 100, who paid 30 in December, one by 102
    assert [(r[0], r[5]) for r in got] == [(5, money("30.00")), (6, money("30.00"))]


def test_proration_by_weight(books, spark):
    from pyspark.sql import functions as F

    weighted = Tables.of(
        payment=books.payment,
        account=books.account,
        unit=books.unit.withColumn("Metros", F.when(F.col("UnidadFuncionalID") == 10, 6).otherwise(1)),
        expense_ordinary=books.expense_ordinary,
        expense_extra=books.expense_extra,
    )
    got = {(r[0], r[1], r[2]): r[3] for r in rows(plans.prorate(weighted, day("2025-01-01"), "Metros"))}
    assert got[102, 1, day("2025-01-01")] == money("15.00")  # 150.01 / 10
    assert got[100, 1, day("2025-01-01")] == money("75.01")  # 7 of 10 parts, less 30


def test_shares_of_fractional_weights_are_whole_cents(make, spark):
    base = make(
        unit=[(1, 1, 100, None, "1", "A"), (2, 1, 101, None, "1", "B")],
        expense_extra=[(1, day(f"2025-0{m}-01"), money("1055.00")) for m in (1, 2, 3)],
    )
    for kind in ("decimal(5,2)", "double"):
        share = spark.createDataFrame([(1, "2.35"), (2, "97.65")], "u int, s string").selectExpr(
            "u as UnidadFuncionalID", f"cast(s as {kind}) as Porcentaje"
        )
        parts = {r: base[r] for r in ("payment", "account", "expense_ordinary", "expense_extra")}
        tables = Tables.of(unit=base.unit.join(share, "UnidadFuncionalID"), **parts)
        got = sorted(r[3] for r in rows(plans.prorate(tables, weight="Porcentaje")) if r[0] == 100)
        assert got == [money("24.79"), money("49.58"), money("74.37")]
        assert sum(r[3] for r in rows(plans.prorate(tables, day("2025-02-01"), "Porcentaje"))) == money(2110)


def test_a_negative_month_rounds_away_from_zero(make):
    units = [(1, 1, 100, None, "1", "A"), (2, 1, 100, None, "1", "B"), (3, 1, 101, None, "1", "C")]
    tables = make(unit=units, expense_extra=[(1, day("2025-01-01"), money("-1.00"))])
    assert sorted((r[0], r[3]) for r in rows(plans.prorate(tables))) == [(100, money("-0.67")), (101, money("-0.33"))]


def test_financial_state(books):
    income, expense = defaultdict(Decimal), defaultdict(Decimal)
    for payment, unit in linked(books):
        if payment[2] is not None:
            income[unit[1], month(payment[1])] += payment[2]
    for building, period, *_, amount in rows(books.expense_ordinary) + rows(books.expense_extra):
        expense[building, period] += amount
    running, expected = defaultdict(Decimal), []
    for building, period in sorted({*income, *expense}):
        net = income[building, period] - expense[building, period]
        running[building] += net
        expected.append((building, period, income[building, period], expense[building, period], net, running[building]))
    got = bag(plans.financial_state(books))
    assert got == sorted(expected, key=repr)
    one = plans.financial_state(books, day("2025-01-01"))
    assert bag(one) == [r for r in got if r[1] == day("2025-01-01")]


def test_charges_of_a_large_building_are_spread_and_alike(make, monkeypatch):
    from strata.plans import derive

    units = [(i, 1, i, None, "1", "A") for i in range(400)] + [(400, 2, 5, 6, "1", "A"), (401, 3, None, 6, "1", "A")]
    spent = [(b, day(f"2025-{m:02}-01"), "LIMPIEZA", money(1000 + b)) for b in (1, 2, 3) for m in range(1, 7)]
    tables = make(unit=units, expense_ordinary=spent)
    whole = bag(plans.prorate(tables))
    assert len(whole) == 401 * 6
    monkeypatch.setattr(derive, "UNITS_A_PIECE", 40)
    assert bag(plans.prorate(tables)) == whole
    charges = derive._charges(tables, None, None)
    assert charges.count() == 401 * 6
    assert "_piece" in charges._jdf.queryExecution().optimizedPlan().toString()


def test_balances_are_carried_on_without_shuffling_months(books):
    plan = plans.prorate(books)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("aggregate(_moves")]
    # months become rows in the last step: nothing above sorts, groups or shuffles them
    assert not any(step in above for step in ("Window", "Sort", "Aggregate(", "Exchange"))


def test_shares_beyond_64_bits_are_exact(make):
    units = [(1, 1, 100, None, "1", "A"), (2, 1, 101, None, "1", "B"), (3, 1, 101, None, "1", "C")]
    tables = make(unit=units, expense_extra=[(1, day("2025-01-01"), money("9000000000000000.01")), (1, day("2025-02-01"), money("1.00"))])
    got = {(r[0], r[2]): r[3] for r in rows(plans.prorate(tables))}
    assert got[100, day("2025-01-01")] == money("3000000000000000.00")
    assert got[101, day("2025-01-01")] == money("6000000000000000.01")
    assert got[101, day("2025-02-01")] == money("6000000000000000.68")


def test_odd_moves_stand_as_before(make, spark):
    """Owners whose weight is null have months without amount until they pay; payments without day come first."""
    base = make(
        unit=[(1, 1, 100, None, "1", "A"), (2, 1, 101, 102, "1", "B"), (3, None, 103, None, "1", "C")],
        account=[("a", 100), ("c", 102), ("d", 103)],
        payment=[
            (1, day("2025-02-03"), money(4), "ORDINARIO", "a"),
            (2, None, money(1), "ORDINARIO", "c"),
            (3, day("2025-02-03"), money(2), "ORDINARIO", "c"),
            (4, day("2025-02-03"), money(6), "ORDINARIO", "d"),
        ],
        expense_extra=[(1, day(f"2025-0{m}-01"), money(10)) for m in (1, 2)],
    )
    weight = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "UnidadFuncionalID long, Peso int")
    parts = {r: base[r] for r in ("payment", "account", "expense_ordinary", "expense_extra")}
    tables = Tables.of(unit=base.unit.join(weight, "UnidadFuncionalID"), **parts)
    assert bag(plans.prorate(tables, weight="Peso")) == sorted(
        [
            (100, 1, day("2025-01-01"), None),
            (100, 1, day("2025-02-01"), money(-4)),
            (101, 1, day("2025-01-01"), money(10)),
            (101, 1, day("2025-02-01"), money(20)),
            (102, 1, None, money(-1)),
            (102, 1, day("2025-02-01"), money(-3)),
            (103, None, day("2025-02-01"), money(-6)),
        ],
        key=repr,
    )
