"""A whole ledger out of its files: import, layout, derived tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.derive import (
    derive_extra_expenses,
    derive_ordinary_expenses,
    financial_state,
    financial_state_since,
    prorate,
    prorate_since,
)
from strata.plans.loading import (
    assign_people,
    assignment_rejects,
    import_assignments,
    import_buildings,
    import_expenses,
    import_payments,
    import_people,
    import_units,
)
from strata.sources.imports import DUPLICATE, Imported, judged, set_aside
from strata.sources.layout import LAYOUTS, write_layout, write_tables
from strata.sources.tables import SCHEMAS, Tables

FILES = ("buildings", "people", "units", "assignments", "payments", "expenses")


def load_ledger(
    spark: SparkSession,
    files: Mapping[str, str],
    path: str,
    weight: str | None = None,
    document: bool = False,
    category: str | None = None,
) -> Tables:
    """Import the files of ``FILES`` and write all tables under ``path``, for ``Tables.from_parquet``.

    Each file is parsed once, into ``path/_staging``. Payments of unknown
    accounts are kept in ``payment_unlinked``. What was set aside, and the counts
    per file, are in ``import_reject`` and ``import_log``. Extraordinary
    expenses, balances and the financial state are derived for all months, and,
    if a ``category`` is given for them, ordinary payments as ordinary expenses
    where that category has none. Later months are added by :func:`load_months`.
    """
    missing = set(FILES) - set(files)
    if missing:
        raise ValueError(f"no file for {', '.join(sorted(missing))}")

    def stage(name: str) -> str:
        return f"{path}/_staging/{name}"

    tables = Tables.from_parquet(spark, path)
    building, buildings = import_buildings(spark, files["buildings"], staging=stage("buildings"))
    person, account, people = import_people(spark, files["people"], staging=stage("people"))
    known = Tables.of(building=building, person=person, account=account)
    write_tables(known, path, ["building", "person", "account"])
    blank, units = import_units(spark, files["units"], staging=stage("units"))
    given = import_assignments(spark, files["assignments"], staging=stage("assignments"))
    write_tables(Tables.of(unit=assign_people(blank, given.valid, tables.account)), path, ["unit"])
    unused = assignment_rejects(blank, given.valid, tables.account)
    payment, unlinked, payments = import_payments(spark, files["payments"], tables, staging=stage("payments"))
    ordinary, expenses = import_expenses(spark, files["expenses"], document, staging=stage("expenses"))
    write_tables(Tables.of(payment=payment), path, ["payment"])
    unlinked.write.parquet(f"{path}/payment_unlinked")
    given_of = Tables.of(expense_ordinary=ordinary, **{r: tables[r] for r in ("payment", "account", "unit", "building")})
    write_tables(Tables.of(expense_ordinary=_with_derived(given_of, category)), path, ["expense_ordinary"])
    write_tables(Tables.of(expense_extra=_as(derive_extra_expenses(tables), "expense_extra")), path, ["expense_extra"])
    _replace(_as(prorate(tables, weight=weight), "balance"), f"{path}/balance", stage("balance"), LAYOUTS["balance"][1])
    state = _as(financial_state(tables), "financial_state")
    write_layout(state, f"{path}/financial_state", [], ["ConsorcioID", "Periodo"])
    _write_logs(
        {
            "buildings": buildings,
            "people": people,
            "units": units,
            "assignments": set_aside(given, unused, "assignments"),
            "payments": payments,
            "expenses": expenses,
        },
        path,
    )
    return tables


def _with_derived(tables: Tables, category: str | None, since: dt.date | None = None) -> DataFrame:
    """The ordinary expenses, and those derived from ordinary payments if they have a ``category``."""
    given = _as(tables.expense_ordinary, "expense_ordinary")
    if category is None:
        return given
    return given.unionByName(_as(derive_ordinary_expenses(tables, category, since), "expense_ordinary"))


def load_months(
    spark: SparkSession,
    files: Mapping[str, str],
    path: str,
    load: str,
    weight: str | None = None,
    document: bool = False,
    category: str | None = None,
) -> Tables:
    """Add files of ``payments`` and ``expenses`` to the ledger under ``path``; ``load`` names this delivery.

    Payments whose id the ledger has are set aside as duplicates; the others
    are written into the months they belong to, which are overwritten as a
    whole. Expenses replace those of the same building, month and category.
    From the earliest month on that changes, derived tables are computed anew
    and carried on from the closing balances of the month before; what lies
    before is kept. A load that failed can be repeated as it is, and leaves what
    it would have left the first time: its parsed files and the new payments
    are kept under ``path/_loads/<load>`` and taken from there, next to its log
    and rejects.
    """
    given = set(files)
    if not given or given - {"payments", "expenses"}:
        raise ValueError("give a file of payments, of expenses, or both")
    home = f"{path}/_loads/{load}"
    tables = Tables.from_parquet(spark, path)
    logs: dict[str, Imported] = {}
    months = []
    if "payments" in files:
        new, unlinked = _new_payments(spark, files["payments"], path, home, tables, logs)
        _merge_payments(spark, new, path, home)
        _replace(_kept(spark, f"{path}/payment_unlinked", ["PagoID"], unlinked), f"{path}/payment_unlinked", f"{home}/unlinked-all")
        months.append(new.agg(F.min(F.trunc("Fecha", "month"))).first()[0])
    tables = Tables.from_parquet(spark, path)
    ordinary = tables.expense_ordinary
    if "expenses" in files:
        more, logs["expenses"] = import_expenses(spark, files["expenses"], document, staging=f"{home}/_staging/expenses")
        more = _once(_as(more, "expense_ordinary"), f"{home}/expense_new")
        ordinary = _kept(spark, f"{path}/expense_ordinary", ["ConsorcioID", "Periodo", "Categoria"], more)
        months.append(more.agg(F.min(F.trunc("Periodo", "month"))).first()[0])
    since = min((m for m in months if m is not None), default=None)
    if since is not None:
        _derive_since(spark, tables, ordinary, path, home, since, weight, category)
    if logs:
        _write_logs(logs, home, "overwrite")
    return Tables.from_parquet(spark, path)




def _once(df: DataFrame, path: str) -> DataFrame:
    """``df`` as it was written at ``path`` by the first run that got so far."""
    spark = df.sparkSession
    if not _written(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _written(spark: SparkSession, path: str) -> bool:
    """Whether a job wrote all of ``path``; one that failed leaves no ``_SUCCESS``."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def _kept(spark: SparkSession, path: str, key: Sequence[str], more: DataFrame) -> DataFrame:
    """``more``, and the rows written at ``path`` whose key it has not."""
    old = spark.read.schema(more.schema).parquet(path)
    return old.join(more.select(*key).distinct(), list(key), "left_anti").select(*more.columns).unionByName(more)


def _replace(df: DataFrame, path: str, aside: str, layout: Sequence[str] = ()) -> None:
    """``path`` overwritten with ``df``, which may read it and so is written ``aside`` first."""
    df.write.mode("overwrite").parquet(aside)
    whole = df.sparkSession.read.schema(df.schema).parquet(aside)
    if layout:
        write_layout(whole, path, [], layout, mode="overwrite", rows=whole.count())
    else:
        whole.write.mode("overwrite").parquet(path)


def _new_payments(
    spark: SparkSession, file: str, path: str, home: str, tables: Tables, logs: dict[str, Imported]
) -> tuple[DataFrame, DataFrame]:
    """Payments of known and of unknown accounts that the ledger does not have."""
    *_, got = import_payments(spark, file, tables, staging=f"{home}/_staging/payments")
    known = tables.payment.select("PagoID").unionByName(spark.read.parquet(f"{path}/payment_unlinked").select("PagoID"))
    # judged once: a repeated run would find its own payments in the ledger
    again = got.lines.join(known.distinct().withColumn("_again", F.lit(DUPLICATE)), "PagoID", "left")
    record = F.to_json(F.struct(*got.valid.columns))
    repeated = F.col("Motivo").isNull() & F.col("_again").isNotNull()
    lines = again.select(
        *got.valid.columns,
        F.when(repeated, record).otherwise(F.col("Registro")).alias("Registro"),
        F.coalesce("Motivo", "_again").alias("Motivo"),
        "Linea",
    )
    logs["payments"] = got = judged(_once(lines, f"{home}/payment_lines"), got.valid.columns, "payments")
    accounts = tables.account.select("NroClaveUniformeID")
    columns = got.valid.columns
    new, unlinked = (got.valid.join(accounts, "NroClaveUniformeID", how).select(*columns) for how in ("left_semi", "left_anti"))
    return new, unlinked


def _merge_payments(spark: SparkSession, new: DataFrame, path: str, home: str) -> None:
    """The months that ``new`` payments belong to, overwritten with what they had and these."""
    directories, order = LAYOUTS["payment"]
    dated = new.withColumn("Anio", F.year("Fecha")).withColumn("Mes", F.month("Fecha"))
    touched = dated.select(*directories).distinct().collect()  # months, of which the calendar has few
    if not touched:
        return
    old = spark.read.schema(SCHEMAS["payment"]).parquet(f"{path}/payment")
    own = reduce(Column.__or__, [(F.col("Anio") == r["Anio"]) & (F.col("Mes") == r["Mes"]) for r in touched])
    kept = old.where(own).join(new.select("PagoID"), "PagoID", "left_anti").select(*dated.columns)
    aside = f"{home}/payment_months"
    kept.unionByName(dated).write.mode("overwrite").parquet(aside)
    whole = spark.read.schema(dated.schema).parquet(aside)
    spread = whole.hint("rebalance", *directories).sortWithinPartitions(*directories, *order)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*directories).parquet(f"{path}/payment")


def _derive_since(
    spark: SparkSession,
    tables: Tables,
    ordinary: DataFrame,
    path: str,
    home: str,
    since: dt.date,
    weight: str | None,
    category: str | None,
) -> None:
    """Expenses, balances and state from ``since`` on, after what was closed before."""
    before = F.col("Periodo") < F.lit(since)
    parts = {r: tables[r] for r in ("payment", "account", "unit", "building")}
    given = Tables.of(expense_ordinary=ordinary, **parts)
    _replace(_with_derived(given, category, since), f"{path}/expense_ordinary", f"{home}/expense_all", LAYOUTS["expense_ordinary"][1])
    tables = Tables.from_parquet(spark, path)
    extra = _as(derive_extra_expenses(tables, since), "expense_extra").unionByName(tables.expense_extra.where(before))
    _replace(extra, f"{path}/expense_extra", f"{home}/extra_all", LAYOUTS["expense_extra"][1])
    tables = Tables.from_parquet(spark, path)
    closed = tables.balance.where(before)
    balance = _as(prorate_since(tables, closed, since, weight), "balance").unionByName(closed)
    _replace(balance, f"{path}/balance", f"{home}/balance_all", LAYOUTS["balance"][1])
    closed = spark.read.schema(SCHEMAS["financial_state"]).parquet(f"{path}/financial_state").where(before)
    state = _as(financial_state_since(tables, closed, since), "financial_state").unionByName(closed)
    _replace(state, f"{path}/financial_state", f"{home}/state_all", ["ConsorcioID", "Periodo"])


def _as(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the columns and types of a table."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields])


def _write_logs(imports: Mapping[str, Imported], path: str, mode: str = "errorifexists") -> None:
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    log = union([got.log for got in imports.values()])
    rejects = union([got.rejects.withColumn("Origen", F.lit(name)) for name, got in imports.items()])
    for name, df in (("import_log", log), ("import_reject", rejects)):
        _as(df, name).write.mode(mode).parquet(f"{path}/{name}")
