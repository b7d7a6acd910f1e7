"""Registered queries: each takes (spark, folder of the tables) and returns a DataFrame.

A key without suffix runs over the whole tables, every building apart. A key
ending in ``_one`` is the same report with the parameters a user gives.
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata import operators as op
from strata import plans, sources
from strata.functions import (
    concept_is,
    format_dmy,
    iso_week,
    month_bounds,
    month_name_es,
    unit_label,
)
from strata.functions.fixed import (
    CONCEPT_EXTRAORDINARY,
    CONCEPT_ORDINARY,
    MONTH_NAMES,
    XML_COLLECTION_BY_SOURCE,
    XML_COLLECTION_BY_UNIT,
)
from strata.operators.aggregates import json_columns
from strata.sources import (
    SCHEMAS,
    Tables,
    append_report,
    read_report,
    read_xml,
    write_tables,
    write_xml,
)
from strata.sources.standins import stand_ins

START, END = dt.date(1996, 1, 1), dt.date(1998, 6, 30)


def shared_path(spark: SparkSession, name: str) -> str:
    """As the library's; a local session without a shared folder gets a temporary one."""
    master = spark.conf.get("spark.master", "")
    if not spark.conf.get("spark.checkpoint.dir", None) and re.match(r"local(\[|$)", master):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-"))
    return sources.shared_path(spark, name)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Exact amounts become doubles at the very end, the type the checks share."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else f.name
            for f in df.schema.fields
        ]
    )


def query(name: str):
    def register(build: Callable[[SparkSession, Tables], DataFrame]):
        REGISTRY[name] = lambda spark, path: _plain(build(spark, stand_ins(spark, path)))
        return build

    return register


def report(name: str, build: Callable[..., DataFrame], **parameters) -> None:
    query(name)(lambda spark, tables: build(tables, **parameters))


# Reports

report("weekly_collection", plans.weekly_collection)
report("weekly_collection_one", plans.weekly_collection, building_id=3, start=START, end=END)
report("weekly_collection_iso_year", plans.weekly_collection, iso_year=True)
report("monthly_by_unit_year", plans.monthly_by_unit, year=1997)
report("monthly_by_unit_year_one", plans.monthly_by_unit, year=1997, building_id=2)
report("monthly_by_unit_month", plans.monthly_by_unit, year=1997, month=5)
report("monthly_by_unit_month_one", plans.monthly_by_unit, year=1997, month=5, building_id=2)
report("collection_by_source", plans.collection_by_source)
report("collection_by_source_one", plans.collection_by_source, building_id=3, start=START, end=END)
report("top_expense_months", plans.top_expense_months)
report("top_expense_months_one", plans.top_expense_months, building_id=1, start=START, end=END)
report("top_income_months", plans.top_income_months)
report("top_income_months_one", plans.top_income_months, building_id=1, start=START, end=END)
report("top_debtors", plans.top_debtors)
report(
    "top_debtors_one", plans.top_debtors, building_id=4, start=dt.date(1996, 1, 1), end=dt.date(1999, 6, 30)
)
report("top_debtors_min", plans.top_debtors, minimum=Decimal("500000"))
report("top_debtors_min_one", plans.top_debtors, building_id=4, minimum=Decimal("500000"))
report("owner_debts_min", plans.owner_debts, building_id=4, minimum=Decimal("500000"))
report("payment_gaps", plans.payment_gaps)
report("payment_gaps_one", plans.payment_gaps, building_id=4, start=START, end=END)
report("category_expense", plans.category_expense)
report("category_expense_one", plans.category_expense, building_id=2, year=1997, month=4)
report("category_chart_row", plans.category_chart)
report("category_chart_row_one", plans.category_chart, building_id=2, year=1997, month=4)
report("category_chart_strict", plans.category_chart, strict_json=True, encode=True)
report("category_chart_empty", plans.category_chart, building_id=2, year=1990, month=4)


# Sources and sinks


@query("scan_payment")
def _(spark, tables):
    return tables.payment


@query("append_report_rows")
def _(spark, tables):
    path = shared_path(spark, "chart_report")
    append_report(plans.category_chart(tables), path)
    append_report(plans.category_chart(tables, year=1997), path)
    return read_report(spark, path)


@query("xml_roundtrip")
def _(spark, tables):
    df = plans.collection_by_source(tables)
    path = shared_path(spark, "by_source_xml")
    write_xml(df, path, *XML_COLLECTION_BY_SOURCE)
    return read_xml(spark, path, XML_COLLECTION_BY_SOURCE[0], df.schema)


@query("xml_roundtrip_units")
def _(spark, tables):
    df = plans.monthly_by_unit(tables, 1997)
    path = shared_path(spark, "by_unit_xml")
    write_xml(df, path, *XML_COLLECTION_BY_UNIT)
    return read_xml(spark, path, XML_COLLECTION_BY_UNIT[0], df.schema)


@query("json_labels_values")
def _(spark, tables):
    by = ["ConsorcioID", "PeriodoAnio", "PeriodoMes"]
    return json_columns(
        plans.category_expense(tables), by, "Categoria", {"Etiquetas": "Categoria", "Importes": "Importe"}
    )


@query("category_share_total")
def _(spark, tables):
    sums = op.sum_by(tables.expense_ordinary, ["Categoria"], "Importe", "Importe")
    return op.share_of_total(sums, "Importe", "GastoTotal", "Parte")


@query("exists_guard")
def _(spark, tables):
    absent = tables.payment.where(F.col("Concepto") == "MULTA")
    sums = op.sum_by(tables.payment, ["Concepto"], "Importe", "Importe")
    return op.unless_exists(sums, absent)


@query("exists_guard_closed")
def _(spark, tables):
    present = tables.payment.where(concept_is(CONCEPT_EXTRAORDINARY))
    sums = op.sum_by(tables.payment, ["Concepto"], "Importe", "Importe")
    return op.unless_exists(sums, present)


@query("layout_roundtrip")
def _(spark, tables):
    path = shared_path(spark, "layout")
    write_tables(tables, path, ["payment"])
    return op.date_range(Tables.from_parquet(spark, path).payment, "Fecha", START)


@query("layout_weekly")
def _(spark, tables):
    path = shared_path(spark, "layout")
    write_tables(tables, path, ["payment", "account", "unit"])
    return plans.weekly_collection(Tables.from_parquet(spark, path))


# Operators


@query("filter_closed_range")
def _(spark, tables):
    return op.date_range(tables.payment, "Fecha", START, END)


@query("filter_half_open")
def _(spark, tables):
    return op.date_range(tables.payment, "Fecha", START, dt.date(1998, 6, 1), half_open=True)


@query("month_name")
def _(spark, tables):
    return tables.payment.select("PagoID", month_name_es(F.month("Fecha")).alias("Mes"))


@query("join_payment_account")
def _(spark, tables):
    return tables.payment.join(tables.account, "NroClaveUniformeID").select("PagoID", "PersonaID", "Importe")


@query("join_owner_or_tenant")
def _(spark, tables):
    joined = op.match_any_key(tables.account, "PersonaID", tables.unit, ["PropietarioID", "InquilinoID"])
    return joined.select("NroClaveUniformeID", "PersonaID", "UnidadFuncionalID")


@query("join_unit_building")
def _(spark, tables):
    return tables.unit.join(tables.building, "ConsorcioID").select("UnidadFuncionalID", "NombreDelConsorcio")


@query("join_owner_filter")
def _(spark, tables):
    return tables.balance.join(tables.person.where("EsPropietario"), "PersonaID", "left_semi").select(
        "PersonaID", "ConsorcioID", "Periodo", "SaldoActual"
    )


@query("payments_by_unit")
def _(spark, tables):
    return plans.payments_by_unit(tables, "collection")


@query("monthly_income")
def _(spark, tables):
    return plans.monthly_income(tables)


@query("monthly_expenses")
def _(spark, tables):
    return plans.monthly_expenses(tables)


@query("conditional_sum")
def _(spark, tables):
    return op.conditional_sums(
        tables.payment,
        [F.year("Fecha").alias("Anio")],
        "Importe",
        {
            "Ordinario": concept_is(CONCEPT_ORDINARY),
            "Extraordinario": concept_is(CONCEPT_EXTRAORDINARY),
        },
    )


@query("pivot_sum")
def _(spark, tables):
    months = {name: number for number, name in enumerate(MONTH_NAMES, start=1)}
    return op.pivot_sum(
        tables.payment, [F.year("Fecha").alias("Anio"), "Concepto"], F.month("Fecha"), "Importe", months
    )


@query("sum_having")
def _(spark, tables):
    return op.sum_having(tables.balance, ["PersonaID"], "SaldoActual", "Saldo")


@query("union_expenses")
def _(spark, tables):
    columns = ["ConsorcioID", "Periodo", "Importe"]
    return tables.expense_ordinary.select(*columns).unionByName(tables.expense_extra.select(*columns))


@query("union_sum")
def _(spark, tables):
    return op.union_sum(
        [tables.expense_ordinary, tables.expense_extra], ["ConsorcioID", "Periodo"], "Importe", "Total"
    )


@query("overall_average")
def _(spark, tables):
    return op.overall_average(
        plans.monthly_income(tables), "TotalIngresos", "Promedio", ["ConsorcioID"]
    )


@query("running_total")
def _(spark, tables):
    return op.running_total(
        plans.monthly_income(tables), "TotalIngresos", "Acumulado", ["Anio", "Mes"], ["ConsorcioID"]
    )


@query("next_payment")
def _(spark, tables):
    payments = tables.payment.select("NroClaveUniformeID", "Fecha", "PagoID")
    return op.next_in_group(payments, ["NroClaveUniformeID"], "Fecha", ["PagoID"], "Siguiente")


@query("date_parts")
def _(spark, tables):
    return tables.payment.select(
        "PagoID",
        F.year("Fecha").alias("Anio"),
        F.month("Fecha").alias("Mes"),
        iso_week(F.col("Fecha")).alias("NroSemana"),
        format_dmy(F.col("Fecha")).alias("Texto"),
    )


@query("month_bounds")
def _(spark, tables):
    first, following, last = month_bounds(F.year("Fecha"), F.month("Fecha"))
    return tables.payment.select(
        "PagoID", first.alias("Primero"), following.alias("Siguiente"), last.alias("Ultimo")
    )


@query("unit_label")
def _(spark, tables):
    named = tables.unit.join(tables.building, "ConsorcioID")
    return named.select(
        "UnidadFuncionalID",
        unit_label("collection").alias("Etiqueta"),
        unit_label("gaps").alias("EtiquetaPagos"),
    )


# Imports: Spark first writes the tables as files, with flaws that follow from the data


def _write(df: DataFrame, spark: SparkSession, name: str, sep: str = ",") -> str:
    path = shared_path(spark, name)
    df.write.option("header", "true").option("sep", sep).csv(path)
    return path


def _people_file(spark, tables):
    """Persons with no contact at all have no readable number either."""
    dni = F.when(F.coalesce("Mail", "Telefono").isNull(), F.lit("S/N")).otherwise(F.col("DNI").cast("string"))
    lines = tables.person.join(tables.account, "PersonaID")
    columns = plans.loading.FILES["people"].fieldNames()
    return _write(lines.withColumn("DNI", dni).select(*columns), spark, "people")


def _payments_file(spark, tables):
    """Dates on a 31st are miswritten; extraordinary payments were delivered twice."""
    date = F.when(
        F.dayofmonth("Fecha") == 31, F.concat(F.lit("31/02/"), F.year("Fecha").cast("string"))
    ).otherwise(format_dmy(F.col("Fecha")))
    twice = F.when(concept_is(CONCEPT_EXTRAORDINARY), F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    columns = plans.loading.FILES["payments"].fieldNames()
    lines = tables.payment.withColumn("_delivery", F.explode(twice)).withColumn("Fecha", date)
    return _write(lines.select(*columns), spark, "payments")


@query("import_csv_valid")
def _(spark, tables):
    return plans.import_people(spark, _people_file(spark, tables))[0]


@query("import_csv_accounts")
def _(spark, tables):
    return plans.import_people(spark, _people_file(spark, tables))[1]


@query("import_txt_valid")
def _(spark, tables):
    """Units without an owner have no readable building."""
    building = F.when(F.col("PropietarioID").isNull(), F.lit("?")).otherwise(
        F.col("ConsorcioID").cast("string")
    )
    lines = tables.unit.withColumn("ConsorcioID", building)
    columns = plans.loading.FILES["units"].fieldNames()
    path = _write(lines.select(*columns), spark, "units", sep="\t")
    return plans.import_units(spark, path)[0].select(*columns)


def _assignment_lines(tables):
    """Each person of a unit, by the least of the person's account keys."""
    keys = tables.account.groupBy("PersonaID").agg(F.min("NroClaveUniformeID").alias("NroClaveUniformeID"))
    sides = [
        tables.unit.join(keys, tables.unit[column] == keys["PersonaID"]).select(
            "NroClaveUniformeID", "UnidadFuncionalID", F.lit(tenant).alias("EsInquilino")
        )
        for column, tenant in (("PropietarioID", False), ("InquilinoID", True))
    ]
    return sides[0].unionByName(sides[1])


@query("assign_unit_person")
def _(spark, tables):
    path = _write(_assignment_lines(tables), spark, "assignments")
    nobody = F.lit(None).cast("bigint")
    blank = tables.unit.withColumn("PropietarioID", nobody).withColumn("InquilinoID", nobody)
    return plans.assign_people(blank, plans.import_assignments(spark, path).valid, tables.account)


@query("import_payments")
def _(spark, tables):
    return plans.import_payments(spark, _payments_file(spark, tables), tables)[0]


@query("import_rejects")
def _(spark, tables):
    return plans.import_payments(spark, _payments_file(spark, tables), tables)[2].rejects


@query("import_log")
def _(spark, tables):
    return plans.import_payments(spark, _payments_file(spark, tables), tables)[2].log


def _judged_lines(spark, tables, amount, tail):
    """How many lines of a payments file without header are valid, and how many are set aside for which reason."""
    path = shared_path(spark, "payments")
    dated = {"Fecha": format_dmy(F.col("Fecha")), "Importe": amount}
    fields = [dated.get(c, F.col(c)).cast("string") for c in plans.loading.FILES["payments"].fieldNames()]
    line = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
    tables.payment.select(F.concat(line, tail)).write.text(path)
    got = plans.import_payments(spark, path, tables, {**plans.loading.CSV, "header": "false"})[2]
    valid = got.valid.agg(F.lit("valid").alias("Motivo"), F.count(F.lit(1)).alias("Veces"))
    rejects = got.rejects.groupBy("Motivo").agg(F.sum("Veces").alias("Veces"))
    return valid.unionByName(rejects)


@query("import_surplus_field")
def _(spark, tables):
    return _judged_lines(spark, tables, F.col("Importe"), F.when(F.col("PagoID") % 7 == 0, ",x").otherwise(""))


@query("import_fraction_rejects")
def _(spark, tables):
    third = F.when(F.col("PagoID") % 5 == 0, "5").otherwise("0")
    return _judged_lines(spark, tables, F.concat(F.col("Importe").cast("string"), third), F.lit(""))


def _expenses_file(spark, expenses):
    """A JSON object per building and month."""
    ids = ["ConsorcioID", "Periodo"]
    # a category without expense is no field at all
    sums = op.sum_by(expenses, [*ids, "Categoria"], "Importe", "Importe").where("Importe <> 0")
    fields = F.map_from_entries(F.collect_list(F.struct("Categoria", F.col("Importe").cast("string"))))
    objects = sums.groupBy(*ids).agg(fields.alias("_fields"))
    known = F.create_map(*[x for c in ids for x in (F.lit(c), F.col(c).cast("string"))])
    path = shared_path(spark, "expenses_json")
    objects.select(F.to_json(F.map_concat(known, "_fields"))).write.text(path)
    return path


@query("import_json_expenses")
def _(spark, tables):
    return plans.import_expenses(spark, _expenses_file(spark, tables.expense_ordinary))[0]


@query("load_two_months")
def _(spark, tables):
    """The financial state of a ledger loaded from its files in two deliveries, up to a month and from it on."""
    cut = F.lit(dt.date(1997, 1, 1))
    columns = plans.loading.FILES["payments"].fieldNames()
    people = tables.person.join(tables.account, "PersonaID").select(*plans.loading.FILES["people"].fieldNames())
    units = tables.unit.select(*plans.loading.FILES["units"].fieldNames())

    def moves(part):
        payments = tables.payment.where(part(F.col("Fecha"))).withColumn("Fecha", format_dmy(F.col("Fecha")))
        return {
            "payments": _write(payments.select(*columns), spark, "payments"),
            "expenses": _expenses_file(spark, tables.expense_ordinary.where(part(F.col("Periodo")))),
        }

    fixed = {
        "buildings": _write(tables.building, spark, "buildings"),
        "people": _write(people, spark, "people"),
        "units": _write(units, spark, "units", sep="\t"),
        "assignments": _write(_assignment_lines(tables), spark, "assignments"),
    }
    path = shared_path(spark, "ledger")
    plans.load_ledger(spark, fixed | moves(lambda day: day < cut), path)
    plans.load_months(spark, moves(lambda day: day >= cut), path, "later")
    return spark.read.schema(SCHEMAS["financial_state"]).parquet(f"{path}/financial_state")


@query("import_json_rejects")
def _(spark, tables):
    """A field per category and month; amounts over 90000 are miswritten, and those of building 7 lack it."""
    amount = F.col("Importe").cast("string")
    text = F.when(F.col("Importe") > 90000, F.concat(amount, F.lit("$"))).otherwise(amount)
    building = F.when(F.col("ConsorcioID") != 7, F.col("ConsorcioID"))
    objects = tables.expense_ordinary.select(
        F.to_json(
            F.map_concat(
                F.create_map(F.lit("Periodo"), F.col("Periodo").cast("string")),
                F.create_map(F.lit("ConsorcioID"), building.cast("string")),
                F.create_map("Categoria", text),
            )
        )
    )
    path = shared_path(spark, "expenses_json")
    objects.write.text(path)
    return (
        plans.import_expenses(spark, path)[1].rejects.groupBy("Motivo").agg(F.sum("Veces").alias("Veces"))
    )


@query("import_people_conflicts")
def _(spark, tables):
    """Persons stand on a line per account; every fourth line names another document."""
    lines = tables.person.withColumn("PersonaID", F.col("PersonaID") - F.col("PersonaID") % 2).withColumn(
        "NroClaveUniformeID", F.col("DNI").cast("string")
    )
    shown = lines.select(*plans.loading.FILES["people"].fieldNames())
    rejects = plans.import_people(spark, _write(shown, spark, "people"))[2].rejects
    return rejects.select(F.get_json_object("Registro", "$.DNI").cast("long").alias("DNI"), "Motivo", "Veces")


@query("assign_rejects")
def _(spark, tables):
    """Every unit is claimed by two accounts, one of them unknown in some buildings; some units are unknown."""
    unit = F.when(F.col("Piso") == "0", -F.col("UnidadFuncionalID")).otherwise(F.col("UnidadFuncionalID"))
    known = F.lpad(F.col("UnidadFuncionalID").cast("string"), 22, "0")
    other = F.when(F.col("ConsorcioID") % 5 == 0, F.lit("none")).otherwise(F.lpad(F.lit("1"), 22, "0"))
    lines = tables.unit.select(unit.alias("UnidadFuncionalID"), F.explode(F.array(known, other)).alias("NroClaveUniformeID"))
    lines = lines.withColumn("EsInquilino", F.lit(False)).select(*plans.loading.FILES["assignments"].fieldNames())
    path = _write(lines, spark, "assignments")
    got = plans.assignment_rejects(tables.unit, plans.import_assignments(spark, path).valid, tables.account)
    return got.groupBy("Motivo").agg(F.sum("Veces").alias("Veces"))


@query("import_buildings")
def _(spark, tables):
    return plans.import_buildings(spark, _write(tables.building, spark, "buildings"))[0]


@query("payment_gaps_shared")
def _(spark, tables):
    """Accounts that the person of the next even number shares."""
    both = tables.account.unionByName(
        tables.account.where("PersonaID % 3 = 0").withColumn("PersonaID", F.col("PersonaID") + 2)
    )
    shared = Tables.of(payment=tables.payment, unit=tables.unit, building=tables.building, account=both)
    return plans.payment_gaps(shared)


@query("prorate_weighted")
def _(spark, tables):
    weighed = tables.unit.withColumn("Porcentaje", (F.col("UnidadFuncionalID") % 40 + 1) / F.lit(16.0))
    parts = {r: tables[r] for r in ("payment", "account", "expense_ordinary", "expense_extra")}
    return plans.prorate(Tables.of(unit=weighed, **parts), weight="Porcentaje")


# Derivations

report("derive_extra_expenses", plans.derive_extra_expenses)
report("derive_ordinary_expenses", plans.derive_ordinary_expenses, category="PROMO")
report("prorate_month", plans.prorate)
report("prorate_month_one", plans.prorate, period=dt.date(1997, 4, 1))
report("financial_state", plans.financial_state)
report("financial_state_one", plans.financial_state, period=dt.date(1997, 4, 1))
