from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

import pytest

from strata import plans
from strata.functions.fixed import MONTH_NAMES
from tests.conftest import bag, day, linked, money, rows

ZERO = Decimal(0)


def test_weekly_pairs_calendar_year_with_iso_week(small):
    got = rows(plans.weekly_collection(small, 1))
    # 29 and 30 December fall in weeks 52 and 1; both keep the year 2024
    assert [(r[0], r[1]) for r in got] == [
        (2024, 1),
        (2024, 52),
        (2025, 1),
        (2025, 11),
        (2025, 14),
        (2025, 19),
    ]
    by_week = {(r[0], r[1]): r for r in got}
    # person 100 is linked to units 10 (once, though owner and tenant) and 11
    assert by_week[2024, 52][2:5] == (money(20), ZERO, money(20))
    assert by_week[2024, 1][2:5] == (money(40), ZERO, money(40))
    # the fine is neither ordinary nor extraordinary
    assert by_week[2025, 1][2:5] == (ZERO, money(60), money(60))


def test_weekly_mean_and_running_total(small):
    got = rows(plans.weekly_collection(small, 1))
    totals = [r[4] for r in got]
    # the week whose only amount is NULL has a NULL sum, and stands out of the mean
    assert totals[-1] is None
    present = [t for t in totals if t is not None]
    assert {r[5] for r in got} == {float(sum(present)) / len(present)}
    running, total = [], ZERO
    for value in totals:
        total += value or ZERO
        running.append(total)
    assert [r[6] for r in got] == running


def test_weekly_iso_year(small):
    got = rows(plans.weekly_collection(small, 1, iso_year=True))
    assert [(r[0], r[1]) for r in got][:2] == [(2024, 52), (2025, 1)]
    last = rows(plans.weekly_collection(small, 3, iso_year=True))
    assert [(r[0], r[1]) for r in last] == [(2026, 53)]


def test_range_bounds_are_inside(small):
    got = rows(plans.weekly_collection(small, 1, day("2025-03-15"), day("2025-03-31")))
    assert [(r[0], r[1], r[4]) for r in got] == [(2025, 11, money(15)), (2025, 14, money(9))]


def test_building_without_payments(small):
    assert rows(plans.weekly_collection(small, 77)) == []
    assert rows(plans.collection_by_source(small, 77)) == []
    assert rows(plans.payment_gaps(small, 77)) == []


def test_by_source_counts_every_concept(small):
    got = rows(plans.collection_by_source(small, 1))
    assert (2025, 1, ZERO, money(60), money(70)) in got
    assert got == sorted(got, key=lambda r: (r[0], r[1]))
    # a month of NULL amounts is a total of 0
    assert got[-1] == (2025, 5, None, ZERO, money(0))


def test_concepts_regardless_of_case(small, make, spark):
    lower = make(
        account=rows(small.account),
        unit=rows(small.unit),
        payment=[(1, day("2025-01-01"), money(4), "Ordinario", "k102")],
    )
    assert rows(plans.collection_by_source(lower, 1))[0][2] == ZERO
    assert rows(plans.collection_by_source(lower, 1, ignore_case=True))[0][2] == money(4)


def test_all_buildings_equal_each_building(small):
    every = bag(plans.weekly_collection(small))
    apart = [(b, *r) for b in (1, 2, 3, 9) for r in rows(plans.weekly_collection(small, b))]
    assert every == sorted(apart, key=repr)


def test_month_columns_per_label(small):
    got = {r[0]: r[1:] for r in rows(plans.monthly_by_unit(small, 2025, 1))}
    expected = defaultdict(lambda: [ZERO] * 12)
    for payment, unit in linked(small):
        if unit[1] == 1 and payment[1].year == 2025:
            label = None if unit[4] is None else f"Norte - Piso {unit[4]} Depto {unit[5]}"
            expected[label][payment[1].month - 1] += payment[2] or ZERO
    assert got == {label: tuple(sums) for label, sums in expected.items()}
    assert None in got  # the unit without a floor


def test_month_columns_are_in_calendar_order(small):
    assert plans.monthly_by_unit(small, 2025).columns[1:] == list(MONTH_NAMES)


def test_one_month_is_that_month_only(small):
    # up to 31 March, without 1 April
    got = rows(plans.monthly_by_unit(small, 2025, 1, 3))
    assert got == [("Norte - Piso 3 Depto D", money(24))]
    december = rows(plans.monthly_by_unit(small, 2024, 2, 12))
    assert december == [("Sur - Piso 1 Depto A", money(30))]


def test_null_amount_alone_is_zero(small):
    assert rows(plans.monthly_by_unit(small, 2025, 1, 5)) == [("Norte - Piso 3 Depto D", money(0))]


def test_unknown_building_has_no_label_rows(small):
    labels = [r[0] for r in rows(plans.monthly_by_unit(small, 2026))]
    assert labels == [None]  # building 3 has no name; building 9 is not listed


def test_top_months_and_ties(make):
    months = [(1, day(f"2024-{m:02d}-01"), "LUZ", money(v)) for m, v in enumerate([5, 9, 9, 1, 7, 9, 2], 1)]
    extra = [(1, day("2024-04-01"), money(100)), (2, day("2024-01-01"), money(1))]
    tables = make(expense_ordinary=months, expense_extra=extra)
    assert rows(plans.top_expense_months(tables, 1)) == [
        (2024, "Abril", money(101)),
        (2024, "Febrero", money(9)),
        (2024, "Marzo", money(9)),
        (2024, "Junio", money(9)),
        (2024, "Mayo", money(7)),
    ]
    assert rows(plans.top_expense_months(tables, 2)) == [(2024, "Enero", money(1))]
    assert len(rows(plans.top_expense_months(tables))) == 6


def test_top_income(small):
    got = rows(plans.top_income_months(small, 1, n=2))
    assert got == [(2025, "Enero", money(70)), (2024, "Diciembre", money(60))]


@pytest.fixture(scope="module")
def debts(make):
    people = [(i, 1000 + i, f"n{i}", "a", None, "t", i != 6) for i in range(1, 9)]
    when = day("2025-04-01")
    balances = [
        (1, 4, when, money(-5)),
        (2, 4, when, money(3)),
        (2, 4, day("2025-05-01"), money(-3)),
        (3, 4, when, money("0.01")),
        (4, 4, when, money(100)),
        (5, 4, when, money(70)),
        (5, 4, day("2025-05-01"), money(80)),
        (6, 4, when, money(999)),  # no owner
        (7, 4, day("2025-07-01"), money(999)),  # too late
        (8, 5, when, money(999)),  # another building
        (99, 4, when, money(999)),  # not a known person
    ]
    return make(person=people, balance=balances)


def test_debtors_without_threshold(debts):
    got = rows(plans.top_debtors(debts, 4, day("2025-04-01"), day("2025-06-15")))
    assert got == [
        (1005, "n5", "a", None, "t", money(150)),
        (1004, "n4", "a", None, "t", money(100)),
        (1003, "n3", "a", None, "t", money("0.01")),
    ]


@pytest.mark.parametrize("minimum, found", [("100", [1005, 1004]), ("100.01", [1005]), ("-10", [1005, 1004, 1003])])
def test_debtors_with_threshold(debts, minimum, found):
    got = plans.top_debtors(debts, 4, day("2025-04-01"), day("2025-06-15"), Decimal(minimum))
    assert [r[0] for r in rows(got)] == found


def test_threshold_below_zero_lets_non_debtors_pass(debts):
    got = plans.owner_debts(debts, 4, day("2025-04-01"), day("2025-06-15"), Decimal(-10))
    assert {r[0] for r in rows(got)} == {1001, 1002, 1003, 1004, 1005}


def test_debtors_of_every_building(debts):
    got = rows(plans.top_debtors(debts))
    assert [(r[0], r[1]) for r in got] == [(4, 1007), (4, 1005), (4, 1004), (5, 1008)]


def test_gaps(small):
    got = rows(plans.payment_gaps(small, 1, day("2025-01-01"), day("2025-04-30")))
    label = "Norte- Piso3 - DeptoD"
    assert [r for r in got if r[0] == label] == [
        (label, "15/03/2025", money(7), "15/03/2025", 0),
        (label, "15/03/2025", money(8), "31/03/2025", 16),
        (label, "31/03/2025", money(9), "01/04/2025", 1),
        (label, "01/04/2025", money(11), None, None),
    ]
    # every concept counts, and a unit without a floor has no label
    assert [r[2] for r in got if r[0] is None] == [money(30), money(5)]


def test_gaps_sort_by_date_not_by_text(make):
    tables = make(
        building=[(1, "N")],
        unit=[(1, 1, 1, None, "1", "A")],
        account=[("k", 1)],
        payment=[
            (1, day("2025-02-01"), money(1), "ORDINARIO", "k"),
            (2, day("2025-01-15"), money(1), "ORDINARIO", "k"),
        ],
    )
    assert [r[1] for r in rows(plans.payment_gaps(tables, 1))] == ["15/01/2025", "01/02/2025"]


@pytest.fixture(scope="module")
def expenses(make):
    when = day("2025-04-01")
    return make(
        building=[(2, "Torre"), (3, None), (4, 'La "Casa"')],
        expense_ordinary=[
            (2, when, "LUZ", money("10.50")),
            (2, when, "AGUA", money(1)),
            (2, day("2025-04-30"), "LUZ", money(2)),
            (2, day("2025-05-01"), "LUZ", money(70)),
            (3, when, "LUZ", money(1)),
            (4, when, 'a/b "c" ñ', money(1)),
            (4, when, None, money(2)),
            (5, when, "LUZ", money(5)),
            (5, when, "AGUA", money(-5)),
        ],
    )


def test_categories(expenses):
    assert bag(plans.category_expense(expenses, 2, 2025, 4)) == [
        (2, 2025, 4, "AGUA", money(1)),
        (2, 2025, 4, "LUZ", money("12.50")),
    ]


def test_chart_url(expenses):
    (row,) = rows(plans.category_chart(expenses, 2, 2025, 4))
    assert row[:3] == (2, 2025, 4)
    assert row[3] == (
        'https://quickchart.io/chart?c={"type":"doughnut","data":{"labels":["AGUA","LUZ"],'
        '"datasets":[{"label":"Gastos Ordinarios","data":[1.00,12.50],'
        '"backgroundColor":["rgb(54, 162, 235)","rgb(230, 32, 0)","rgb(42, 205, 86)",'
        '"rgb(255, 159, 64)","rgb(255, 200, 32)"]}]},'
        'options:{title:{display:true,text:"Distribucion de Gastos Ordinarios por Categoria'
        ' - Consorcio: Torre - Mes: 4 Año: 2025"}}}&width=512&height=512'
    )


def test_chart_of_nothing(expenses):
    assert rows(plans.category_chart(expenses, 2, 2025, 7)) == []
    assert rows(plans.category_chart(expenses, 5, 2025, 4)) == []  # sums to 0


def test_chart_without_building_name(expenses):
    assert rows(plans.category_chart(expenses, 3, 2025, 4)) == [(3, 2025, 4, None)]


def test_strict_chart_is_json(expenses):
    import json
    from urllib.parse import unquote_plus

    (row,) = rows(plans.category_chart(expenses, 4, 2025, 4, strict_json=True, encode=True))
    text = row[3].removeprefix("https://quickchart.io/chart?c=").removesuffix("&width=512&height=512")
    config = json.loads(unquote_plus(text))
    data = dict(zip(config["data"]["labels"], config["data"]["datasets"][0]["data"]))
    assert data == {None: 2.0, 'a/b "c" ñ': 1.0}
    assert config["options"]["title"]["text"].endswith('La "Casa" - Mes: 4 Año: 2025')
