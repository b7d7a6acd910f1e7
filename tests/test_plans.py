"""The plans Spark makes: what reaches the scan, how joins are done, where skew is split."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from strata import plans
from strata.operators import joins
from strata.plans import collection
from strata.sources import Tables, write_tables
from tests.conftest import bag, day, linked, money, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def crowd(make):
    """Many accounts, a person owning a third of all units, an account paying a third of all payments."""
    draw = random.Random(1)
    units = [
        (i, i % 5, 7 if i % 3 == 0 else draw.randrange(40), draw.choice([None, draw.randrange(40)]), str(i % 4), "A")
        for i in range(150)
    ]
    accounts = [(f"k{i}", i % 40) for i in range(60)]
    payments = [
        (
            i,
            day("2025-01-01") + dt.timedelta(draw.randrange(120)),
            money(draw.randint(1, 500)),
            draw.choice(["ORDINARIO", "EXTRAORDINARIO", "MULTA"]),
            "k7" if i % 3 == 0 else f"k{draw.randrange(60)}",
        )
        for i in range(900)
    ]
    names = [(i, f"n{i}") for i in range(5)]
    return make(unit=units, account=accounts, payment=payments, building=names)


def routes(monkeypatch):
    """All accounts broadcast; none broadcast; and people with many links summed apart."""
    yield "broadcast"
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 0)
    yield "shuffle"
    monkeypatch.setattr(collection, "MANY_VALUES", 2)
    yield "many"


def test_every_route_gives_the_same_rows(crowd, monkeypatch):
    monthly, weekly, gaps = {}, {}, {}
    for route in routes(monkeypatch):
        monthly[route] = bag(plans.monthly_by_unit(crowd, 2025))
        weekly[route] = bag(plans.weekly_collection(crowd))
        gaps[route] = bag(plans.payment_gaps(crowd, 2))
    assert monthly["broadcast"] == monthly["shuffle"] == monthly["many"]
    assert weekly["broadcast"] == weekly["shuffle"] == weekly["many"]
    assert gaps["broadcast"] == gaps["shuffle"]
    total = sum(payment[2] for payment, unit in linked(crowd))
    assert sum(sum(r[1:]) for r in monthly["many"]) == total


def test_no_nested_loops(crowd):
    for df in (
        plans.weekly_collection(crowd),
        plans.weekly_collection(crowd, 2),
        plans.monthly_by_unit(crowd, 2025),
        plans.payment_gaps(crowd),
        plans.prorate(crowd),
        plans.financial_state(crowd),
    ):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_payments_are_read_in_place_for_one_building(spark, crowd, tmp_path):
    write_tables(crowd, str(tmp_path), ["payment", "account", "unit"])
    tables = Tables.from_parquet(spark, str(tmp_path))
    text = plan(plans.collection_by_source(tables, 2, day("2025-02-01"), day("2025-03-31")))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "Concepto" in line)
    assert "GreaterThanOrEqual(Fecha,2025-02-01)" in scan and "LessThanOrEqual(Fecha,2025-03-31)" in scan
    directories = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "Anio#" in directories and "Mes#" in directories
    assert "PagoID" not in scan.split("ReadSchema")[1]
    units = next(line for line in text.splitlines() if "FileScan" in line and "PropietarioID" in line)
    assert "EqualTo(ConsorcioID,2)" in units.split("PushedFilters")[1]
    assert "SortMergeJoin" not in text


def test_hot_account_is_split(spark, crowd, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 0)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        spread = Tables.of(
            payment=crowd.payment.repartition(16, "PagoID"),
            account=crowd.account,
            unit=crowd.unit,
        )
        df = plans.collection_by_source(spread)
        got = bag(df)
        assert "skew=true" in plan(df)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert got == bag(plans.collection_by_source(crowd))


def test_next_payment_reads_its_input_once(crowd):
    df = plans.payment_gaps(crowd)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_top_keeps_few_rows_per_task(crowd):
    assert "TakeOrderedAndProject" in plan(plans.top_income_months(crowd, 2))
    assert "WindowGroupLimit" in plan(plans.top_income_months(crowd))


def test_the_month_asked_for_bounds_the_scans(spark, crowd, tmp_path):
    roles = ["payment", "account", "unit", "expense_ordinary", "expense_extra"]
    write_tables(crowd, str(tmp_path), roles)
    tables = Tables.from_parquet(spark, str(tmp_path))
    for df in (plans.prorate(tables, day("2025-02-01")), plans.financial_state(tables, day("2025-02-01"))):
        scans = [line for line in plan(df).splitlines() if "FileScan" in line and "Importe" in line]
        paid = [line for line in scans if "Fecha" in line]
        assert paid and all("LessThanOrEqual(Fecha,2025-02-28)" in line for line in paid)
        assert all("Mes#" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in paid)
        spent = [line for line in scans if "Periodo" in line]
        assert len(spent) == 2 and all("LessThanOrEqual(Periodo,2025-02-01)" in line for line in spent)


def test_contacts_meet_only_the_debtors_that_are_kept(make):
    tables = make(
        person=[(i, 100 + i, "n", "a", None, None, True) for i in range(9)],
        balance=[(i, i % 2, day("2025-01-01"), money(i)) for i in range(9)],
    )
    text = plan(plans.top_debtors(tables))
    first_join = text.rindex("_rank")
    assert "Telefono" not in "".join(l for l in text[first_join:].splitlines() if "Exchange" in l)


ALL_BUILDINGS = {
    "weekly_collection": lambda t: plans.weekly_collection(t),
    "monthly_by_unit": lambda t: plans.monthly_by_unit(t, 2024),
    "collection_by_source": lambda t: plans.collection_by_source(t),
    "top_income_months": lambda t: plans.top_income_months(t),
    "payment_gaps": lambda t: plans.payment_gaps(t),
    "financial_state": lambda t: plans.financial_state(t),
}


@pytest.mark.parametrize("name", ALL_BUILDINGS)
def test_no_job_runs_while_a_report_of_all_buildings_is_built(spark, small, name):
    context = spark.sparkContext
    context.setJobGroup(f"build {name}", name)
    try:
        report = ALL_BUILDINGS[name](small)
        assert list(context.statusTracker().getJobIdsForGroup(f"build {name}")) == []
        report.collect()
        assert len(list(context.statusTracker().getJobIdsForGroup(f"build {name}"))) > 0
    finally:
        context.setJobGroup("tests", "tests")


@pytest.mark.parametrize("bound", [0, 1])
def test_persons_of_many_buildings_sum_alike_at_every_bound(small, monkeypatch, bound):
    want = [bag(make(small)) for make in ALL_BUILDINGS.values()]
    monkeypatch.setattr(collection, "MANY_VALUES", bound)
    assert [bag(make(small)) for make in ALL_BUILDINGS.values()] == want


def test_payments_are_scanned_once_where_persons_have_many_buildings(spark, tmp_path, small):
    write_tables(small, str(tmp_path / "t"))
    tables = Tables.from_parquet(spark, str(tmp_path / "t"))
    shown = plan(plans.collection_by_source(tables))
    scans = [line for line in shown.splitlines() if "FileScan" in line and "NroClaveUniformeID" in line and "Importe" in line]
    assert len(scans) == 1
