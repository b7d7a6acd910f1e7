"""Reports over expenses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import month_name_es, month_span
from strata.functions.chart import chart_config, chart_title, chart_url
from strata.operators import date_range, json_columns, optional_equal, sum_by, top_n, union_sum
from strata.plans.collection import scope
from strata.sources.tables import Tables


def monthly_expenses(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Ordinary and extraordinary expenses together, per month."""
    parts = [
        date_range(optional_equal(df, "ConsorcioID", building_id), "Periodo", start, end)
        .withColumn("Anio", F.year("Periodo"))
        .withColumn("Mes", F.month("Periodo"))
        for df in (tables.expense_ordinary, tables.expense_extra)
    ]
    return union_sum(parts, [*scope(building_id), "Anio", "Mes"], "Importe", "TotalGastos")


def top_expense_months(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    n: int = 5,
) -> DataFrame:
    months = monthly_expenses(tables, building_id, start, end)
    return top_n(months, "TotalGastos", n, ["Anio", "Mes"], scope(building_id)).withColumn(
        "Mes", month_name_es(F.col("Mes"))
    )


def _ordinary(tables: Tables, building_id: int | None, year: int | None, month: int | None) -> DataFrame:
    df = optional_equal(tables.expense_ordinary, "ConsorcioID", building_id)
    start, end = (None, None) if year is None else month_span(year, month)
    return date_range(df, "Periodo", start, end, half_open=True)


def category_expense(
    tables: Tables,
    building_id: int | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Ordinary expense per building, month and category."""
    return sum_by(
        _ordinary(tables, building_id, year, month),
        [
            "ConsorcioID",
            F.year("Periodo").alias("PeriodoAnio"),
            F.month("Periodo").alias("PeriodoMes"),
            "Categoria",
        ],
        "Importe",
        "Importe",
    )


def category_chart(
    tables: Tables,
    building_id: int | None = None,
    year: int | None = None,
    month: int | None = None,
    strict_json: bool = False,
    encode: bool = False,
) -> DataFrame:
    """Chart row per building and month; none where the expense is NULL or 0.

    Labels and values come from one sorted list per chart, so they agree in
    order. A chart of an unknown building has a NULL URL.
    """
    by = ["ConsorcioID", "PeriodoAnio", "PeriodoMes"]
    categories = category_expense(tables, building_id, year, month)
    texts = json_columns(
        categories,
        by,
        "Categoria",
        {"Etiquetas": "Categoria", "Importes": "Importe"},
        totals={"Total": "Importe"},
    ).where(F.col("Total") != 0)
    charts = texts.join(tables.building, "ConsorcioID", "left")
    title = chart_title(F.col("NombreDelConsorcio"), F.col("PeriodoAnio"), F.col("PeriodoMes"))
    config = chart_config(F.col("Etiquetas"), F.col("Importes"), title, strict_json)
    return charts.select(*by, chart_url(config, encode).alias("URLApi"))
