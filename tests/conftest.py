from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

from strata.sources import SCHEMAS, Tables


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("strata-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def bag(df) -> list[tuple]:
    return sorted(rows(df), key=repr)


def money(text) -> Decimal:
    return Decimal(text).quantize(Decimal("0.01"))


@pytest.fixture(scope="session")
def make(spark):
    """Tables by role from plain tuples; roles not given are empty."""

    def build(**given) -> Tables:
        return Tables.of(
            **{role: spark.createDataFrame(given.get(role, []), SCHEMAS[role]) for role in SCHEMAS}
        )

    return build


@pytest.fixture(scope="session")
def small(make):
    """One building with the odd cases: shared, missing and repeated links."""
    buildings = [(1, "Norte"), (2, "Sur"), (3, None)]
    units = [
        (10, 1, 100, 100, "1", "A"),  # owner and tenant are one person
        (11, 1, 100, 101, "2", "B"),
        (12, 1, None, 101, None, "C"),  # no owner, no floor
        (13, 1, 102, None, "3", "D"),
        (14, 1, None, None, "4", "E"),
        (20, 2, 100, None, "1", "A"),
        (30, 3, 103, None, "1", "A"),
        (40, 9, 103, None, "1", "A"),  # its building is unknown
    ]
    accounts = [("k100", 100), ("k101", 101), ("k102", 102), ("j102", 102), ("k103", 103), ("k999", 999)]
    payments = [
        (1, day("2024-12-29"), money("10"), "ORDINARIO", "k100"),
        (2, day("2024-12-30"), money("20"), "ORDINARIO", "k100"),
        (3, day("2025-01-01"), money("30"), "EXTRAORDINARIO", "k101"),
        (4, day("2025-01-01"), money("5"), "MULTA", "k101"),
        (5, day("2025-03-15"), money("7"), "ORDINARIO", "k102"),
        (6, day("2025-03-15"), money("8"), "ORDINARIO", "j102"),
        (7, day("2025-03-31"), money("9"), "ORDINARIO", "k102"),
        (8, day("2025-04-01"), money("11"), "ORDINARIO", "k102"),
        (9, day("2025-02-01"), money("500"), "ORDINARIO", None),  # no account
        (10, day("2025-02-01"), money("500"), "ORDINARIO", "zzz"),  # unknown account
        (11, day("2025-02-01"), money("500"), "ORDINARIO", "k999"),  # person without unit
        (12, day("2025-05-05"), None, "ORDINARIO", "k102"),  # no amount
        (13, day("2026-12-31"), money("1"), "ORDINARIO", "k103"),
        (14, day("2027-01-01"), money("2"), "ORDINARIO", "k103"),
    ]
    return make(building=buildings, unit=units, account=accounts, payment=payments)


def linked(tables: Tables) -> list[tuple]:
    """(payment, unit) pairs, found by looking at every pair."""
    units = rows(tables.unit)
    people: dict = {}
    for key, person in rows(tables.account):
        people.setdefault(key, []).append(person)
    return [
        (payment, unit)
        for payment in rows(tables.payment)
        for person in people.get(payment[4], [])
        for unit in units
        if person in (unit[2], unit[3])
    ]
