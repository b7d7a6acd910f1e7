"""Files to reports: one import of all files, and what the reports say of it."""

from __future__ import annotations

from decimal import Decimal

import pytest

from strata import plans, sources
from strata.sources import SCHEMAS, Tables
from tests.conftest import bag, day, money, rows

FILES = {
    "buildings": "ConsorcioID,NombreDelConsorcio\n1,Norte\n2,Sur\nx,Este\n",
    "people": "PersonaID,DNI,Nombre,Apellido,Mail,Telefono,EsPropietario,NroClaveUniformeID\n"
    "10,110,Ana,Paz,,,true,k1\n20,120,Eva,Sol,,,false,k2\n30,130,Leo,Mar,,,true,k3\n30,131,Leo,Mar,,,true,k4\n",
    "units": "UnidadFuncionalID\tConsorcioID\tPiso\tDepartamento\n1\t1\t1\tA\n2\t1\t2\tB\n3\t2\t1\tA\n",
    "assignments": "NroClaveUniformeID,UnidadFuncionalID,EsInquilino\n"
    "k1,1,false\nk2,1,true\nk3,2,false\nk1,3,false\nzz,3,true\nk3,99,false\n",
    "payments": "PagoID,Fecha,Importe,Concepto,NroClaveUniformeID\n"
    "1,01/04/2025,100.00,ORDINARIO,k1\n2,10/04/2025,50.00,EXTRAORDINARIO,k2\n"
    "3,02/05/2025,70.50,ORDINARIO,k3\n4,99/05/2025,1.00,ORDINARIO,k3\n5,03/05/2025,9.00,ORDINARIO,none\n",
    "expenses": '{"ConsorcioID":1,"Periodo":"2025-04-01","LUZ":30.00,"GAS":60.00}\n'
    '{"ConsorcioID":2,"Periodo":"2025-05-01","LUZ":"mucho","AGUA":12.34}\n',
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for name, text in FILES.items():
        (folder / name).write_text(text)
    path = str(tmp_path_factory.mktemp("ledger"))
    plans.load_ledger(spark, {name: str(folder / name) for name in FILES}, path)
    return Tables.from_parquet(spark, path), path


def test_every_line_is_accepted_or_rejected(spark, loaded):
    log = {r[0]: r[1:] for r in rows(spark.read.schema(SCHEMAS["import_log"]).parquet(f"{loaded[1]}/import_log"))}
    assert log == {
        "buildings": (3, 2, 1),
        "people": (4, 3, 1),
        "units": (3, 3, 0),
        "assignments": (6, 4, 2),
        "payments": (5, 4, 1),
        "expenses": (4, 3, 1),
    }
    rejects = spark.read.schema(SCHEMAS["import_reject"]).parquet(f"{loaded[1]}/import_reject")
    assert sorted((r["Origen"], r["Motivo"]) for r in rejects.collect()) == [
        ("assignments", "unknown account"),
        ("assignments", "unknown unit"),
        ("buildings", "malformed"),
        ("expenses", "malformed LUZ"),
        ("payments", "malformed"),
        ("people", "conflicting person"),
    ]


def test_no_money_is_lost(spark, loaded):
    tables, path = loaded
    total = lambda df: sum((r["Importe"] for r in df.collect()), Decimal(0))
    unlinked = spark.read.parquet(f"{path}/payment_unlinked")
    assert total(tables.payment) + total(unlinked) == money("229.50")
    assert total(tables.expense_ordinary) == money("102.34")


def test_reports_of_the_loaded_ledger(spark, loaded):
    tables, path = loaded
    start, end = day("2025-04-01"), day("2025-06-30")
    weeks = rows(plans.weekly_collection(tables, 1, start, end))
    assert sum(r[4] for r in weeks) == money("220.50")
    assert plans.monthly_by_unit(tables, 2025, building_id=1).count() == 2
    assert bag(plans.collection_by_source(tables, 2, start, end))
    assert rows(plans.top_expense_months(tables, 1))[0][2] == money("140.00")  # 30 + 60 and the 50 collected
    assert rows(plans.top_income_months(tables, 1, start, end))[0][2] == money("150.00")
    # half of April's 140 is each owner's; 10 paid 100, 30 paid 70.50
    assert bag(tables.balance.where("ConsorcioID = 1 AND Periodo = '2025-04-01'").select("PersonaID", "SaldoActual")) == [
        (10, money("-30.00")),
        (20, money("-50.00")),
        (30, money("70.00")),
    ]
    assert [r[0] for r in rows(plans.top_debtors(tables, 1, start, day("2025-04-30")))][0] == 130
    assert [r[4] for r in rows(plans.payment_gaps(tables, 1, start, end))].count(9) == 1
    sources.append_report(plans.category_chart(tables), f"{path}/chart_report")
    assert sources.read_report(spark, f"{path}/chart_report").count() == 2
    state = spark.read.schema(SCHEMAS["financial_state"]).parquet(f"{path}/financial_state")
    assert state.where("ConsorcioID = 1 AND Periodo = '2025-04-01'").first()["SaldoCierre"] == money("10.00")


ROLES = ("payment", "payment_unlinked", "expense_ordinary", "expense_extra", "balance", "financial_state")


def parts_of(text: str, months: tuple[str, ...], head: bool) -> str:
    """The lines of a file that name one of the months, and its header."""
    first, *lines = text.splitlines() if head else ["", *text.splitlines()]
    kept = [x for x in lines if any(m in x for m in months)]
    return "\n".join([first, *kept][not head :]) + "\n"


def contents(spark, path: str) -> dict[str, list]:
    return {r: bag(spark.read.schema(SCHEMAS.get(r, SCHEMAS["payment"])).parquet(f"{path}/{r}")) for r in ROLES}


APRIL, MAY = ("/04/2025", "2025-04"), ("/05/2025", "2025-05")


@pytest.fixture(scope="module")
def two_months(spark, tmp_path_factory):
    """The files of April and of May, and the ledger of both together, with ordinary expenses derived."""
    folders = {}
    for name, months in (("both", APRIL + MAY), ("april", APRIL), ("may", MAY)):
        folder = folders[name] = tmp_path_factory.mktemp(name)
        for file, text in FILES.items():
            if file in ("payments", "expenses"):
                text = parts_of(text, months, file == "payments")
            (folder / file).write_text(text)
    path = str(tmp_path_factory.mktemp("whole"))
    plans.load_ledger(spark, {f: str(folders["both"] / f) for f in FILES}, path, category="CUOTA")
    return folders, contents(spark, path)


def test_month_after_month_is_as_both_together(spark, two_months, tmp_path):
    folders, whole = two_months
    path = str(tmp_path / "ledger")
    plans.load_ledger(spark, {f: str(folders["april"] / f) for f in FILES}, path, category="CUOTA")
    may = {f: str(folders["may"] / f) for f in ("payments", "expenses")}
    plans.load_months(spark, may, path, "2025-05", category="CUOTA")
    assert contents(spark, path) == whole
    assert ("CUOTA" in {r[2] for r in whole["expense_ordinary"]}) and len(whole["balance"]) > 3
    log = lambda: bag(spark.read.schema(SCHEMAS["import_log"]).parquet(f"{path}/_loads/2025-05/import_log"))
    assert log() == [("expenses", 2, 1, 1), ("payments", 3, 2, 1)]
    # the same delivery again, as after a failure, changes nothing
    plans.load_months(spark, may, path, "2025-05", category="CUOTA")
    assert contents(spark, path) == whole and log() == [("expenses", 2, 1, 1), ("payments", 3, 2, 1)]
    # under another name its payments are duplicates
    plans.load_months(spark, may, path, "2025-05 again", category="CUOTA")
    assert contents(spark, path) == whole
    rejects = spark.read.schema(SCHEMAS["import_reject"]).parquet(f"{path}/_loads/2025-05 again/import_reject")
    assert sorted(r["Motivo"] for r in rejects.collect()) == ["duplicate key", "duplicate key", "malformed", "malformed LUZ"]


def test_late_payments_change_their_month_and_later_ones(spark, two_months, tmp_path):
    folders, whole = two_months
    path = str(tmp_path / "ledger")
    plans.load_ledger(spark, {f: str(folders["may"] / f) for f in FILES}, path)
    plans.load_months(spark, {f: str(folders["april"] / f) for f in ("payments", "expenses")}, path, "late", category="CUOTA")
    assert contents(spark, path) == whole
    with pytest.raises(ValueError, match="payments"):
        plans.load_months(spark, {"people": "x"}, path, "other")


def test_balances_carried_on_equal_those_of_all_months(spark, loaded):
    tables, path = loaded
    may = day("2025-05-01")
    carried = plans.prorate_since(tables, tables.balance, may)
    assert bag(carried) == bag(plans.prorate(tables).where("Periodo >= '2025-05-01'"))
    closed = spark.read.schema(SCHEMAS["financial_state"]).parquet(f"{path}/financial_state")
    state = plans.financial_state_since(tables, closed, may)
    assert bag(state) == bag(plans.financial_state(tables).where("Periodo >= '2025-05-01'").select(*state.columns))
    # of the payments only the directory of May is read
    scans = carried._jdf.queryExecution().executedPlan().toString()
    assert "Mes" in scans and "2025-05-01" in scans
