from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from strata import operators as op
from strata.functions import (
    calendar_year,
    format_dmy,
    iso_week,
    month_bounds,
    month_name_es,
    month_span,
    unit_label,
)
from strata.operators import joins
from tests.conftest import bag, day, money, rows


def test_month_span():
    assert month_span(2025) == (dt.date(2025, 1, 1), dt.date(2026, 1, 1))
    assert month_span(2025, 5) == (dt.date(2025, 5, 1), dt.date(2025, 6, 1))
    assert month_span(2025, 12) == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))


def test_calendar_columns(spark):
    dates = [day("2024-12-29"), day("2024-12-30"), day("2025-01-01"), day("2026-12-31"), day("2027-01-01")]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    first, following, last = month_bounds(F.year("d"), F.month("d"))
    got = rows(
        df.select(
            iso_week(F.col("d")),
            calendar_year(F.col("d")),
            calendar_year(F.col("d"), iso=True),
            format_dmy(F.col("d")),
            month_name_es(F.month("d")),
            first,
            following,
            last,
        )
    )
    for d, r in zip(dates, got):
        iso = d.isocalendar()
        assert r[:4] == (iso.week, d.year, iso.year, d.strftime("%d/%m/%Y"))
        assert r[4] == ("Diciembre" if d.month == 12 else "Enero")
        assert (r[5], r[6]) == month_span(d.year, d.month)
        assert r[7] == r[6] - dt.timedelta(days=1)


def test_month_name_outside_the_year(spark):
    df = spark.createDataFrame([(0,), (13,), (None,)], "m int")
    assert rows(df.select(month_name_es(F.col("m")))) == [(None,)] * 3


def test_label_needs_every_part(spark):
    df = spark.createDataFrame(
        [("N", "1", "A"), (None, "1", "A"), ("N", None, "A"), ("N", "1", None)],
        "NombreDelConsorcio string, Piso string, Departamento string",
    )
    assert rows(df.select(unit_label("collection"), unit_label("gaps"))) == [
        ("N - Piso 1 Depto A", "N- Piso1 - DeptoA"),
        *[(None, None)] * 3,
    ]


@pytest.mark.parametrize("seed", range(4))
def test_match_any_key_is_the_or_join(spark, seed):
    draw = random.Random(seed)
    key = lambda: draw.choice([None, 1, 2, 3, 4])
    left = spark.createDataFrame([(i, key()) for i in range(30)], "l int, k int")
    right = spark.createDataFrame([(i, key(), key(), key()) for i in range(30)], "r int, a int, b int, c int")
    got = op.match_any_key(left, "k", right, ["a", "b", "c"]).select("l", "r")
    k = F.col("k")
    wanted = left.join(right, (k == F.col("a")) | (k == F.col("b")) | (k == F.col("c"))).select("l", "r")
    assert bag(got) == bag(wanted)


def test_date_range(spark):
    stamps = ["2025-01-31T23:59:00", "2025-02-01T00:00:00", "2025-02-28T18:00:00", "2025-03-01T00:00:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(s),) for s in stamps], "t timestamp")
    count = lambda *args, **kwargs: op.date_range(df, "t", *args, **kwargs).count()
    assert count(day("2025-02-01"), day("2025-02-28")) == 2  # the last day with its hours
    assert count(day("2025-02-01"), day("2025-03-01")) == 3
    assert count(day("2025-02-01"), day("2025-03-01"), half_open=True) == 2
    assert count() == 4 and count(end=day("2025-02-01")) == 2


def test_date_range_does_not_look_at_other_columns(spark):
    df = spark.createDataFrame([(day("2024-12-30"), 2025)], "Fecha date, Anio int")
    assert op.date_range(df, "Fecha", end=day("2024-12-31")).count() == 1


def test_optional_equal_and_guard(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert op.optional_equal(df, "a", None).count() == 2
    assert op.optional_equal(df, "a", 2).count() == 1
    assert op.unless_exists(df, df.where("a = 3")).count() == 2
    assert op.unless_exists(df, df.where("a = 2")).count() == 0


def test_pivot_sum_is_the_pivot(spark):
    draw = random.Random(5)
    data = [(draw.choice("xyz"), draw.randint(1, 4), money(draw.randint(-9, 9))) for _ in range(60)]
    df = spark.createDataFrame([*data, ("w", 9, money(1))], "g string, m int, v decimal(18,2)")
    wanted = df.groupBy("g").pivot("m", [1, 2, 3, 4]).sum("v").na.fill(0)
    got = op.pivot_sum(df, ["g"], "m", "v", {str(i): i for i in range(1, 5)})
    assert bag(got) == bag(wanted)


def test_sum_having(spark):
    df = spark.createDataFrame(
        [("a", money(-5)), ("b", money(0)), ("c", money("0.01")), ("d", money(10)), ("e", money(11))],
        "g string, v decimal(18,2)",
    )
    groups = lambda minimum: {r[0] for r in rows(op.sum_having(df, ["g"], "v", "s", minimum))}
    assert groups(None) == {"c", "d", "e"}
    assert groups(Decimal(10)) == {"d", "e"}
    assert groups(Decimal(0)) == {"b", "c", "d", "e"}


def test_union_sum_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, money(2)), (1, money(2))], "g int, v decimal(18,2)")
    assert rows(op.union_sum([df, df], ["g"], "v", "s")) == [(1, money(8))]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", money(1)), ("b", money(3))], "g string, v decimal(18,2)")
    assert bag(op.share_of_total(df, "v", "t", "p")) == [("a", money(1), money(4), 0.25), ("b", money(3), money(4), 0.75)]


def test_running_total_shares_ties(spark):
    df = spark.createDataFrame([(1, 1), (2, 10), (2, 20), (3, 5)], "o int, v int")
    assert bag(op.running_total(df, "v", "t", ["o"]).select("o", "t")) == [(1, 1), (2, 31), (2, 31), (3, 36)]


def test_top_n(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 3, 7), ("b", 4, None), ("b", 5, 1)], "g string, i int, v int")
    assert [r[1] for r in rows(op.top_n(df, "v", 2, ["i"]))] == [2, 3]
    assert [r[1] for r in rows(op.top_n(df, "v", 9, ["i"]))] == [2, 3, 1, 5, 4]
    assert [r[1] for r in rows(op.top_n(df, "v", 1, ["i"], ["g"]))] == [2, 5]


@pytest.mark.parametrize("seed", range(3))
def test_next_in_group_is_lead(spark, seed):
    draw = random.Random(seed)
    data = [
        (draw.choice(["a", "a", "a", None, "b"]), day("2025-01-01") + dt.timedelta(draw.randint(0, 6)), i // 2, i % 2, i)
        for i in range(200)
    ]
    df = spark.createDataFrame(data, "g string, d date, id int, part int, v int").repartition(8)
    lead = F.lead("d").over(Window.partitionBy("g").orderBy("d", "id", "part"))
    got = op.next_in_group(df, ["g"], "d", ["id", "part"], "n")
    assert bag(got) == bag(df.withColumn("n", lead))


def test_json_columns_align(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, None, 3)], "g int, k string, v int")
    got = op.json_columns(df, ["g"], "k", {"ks": "k", "vs": "v"})
    assert bag(got) == [(1, '["a","b"]', "[1,2]"), (2, "[null]", "[3]")]


def test_broadcast_only_below_the_limit(spark, monkeypatch):
    df = spark.createDataFrame([Row(a=i, s="x" * 100) for i in range(100)])
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert op.measured_bytes(df) >= 100 * 108
    assert hinted(op.broadcast_if_small(df))
    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 5000)
    assert not hinted(op.broadcast_if_small(df))


def test_conditional_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "k string, v int")
    got = op.conditional_sums(df, [], "v", {"a": F.col("k") == "a", "z": F.col("k") == "z"})
    assert rows(got) == [(3, 0)]


def test_overall_average_counts_rows_present(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "g string, v int")
    assert {r[2] for r in rows(op.overall_average(df, "v", "m"))} == {1.5}
    by_group = defaultdict(set)
    for g, _, m in rows(op.overall_average(df, "v", "m", ["g"])):
        by_group[g].add(m)
    assert by_group == {"a": {1.5}, "b": {None}}
