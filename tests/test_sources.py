from __future__ import annotations

import glob
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from strata import plans, sources
from strata.functions.fixed import XML_COLLECTION_BY_UNIT
from strata.sources import LAYOUTS, SCHEMAS, Tables, write_layout, write_tables
from strata.sources.tables import AMOUNT, schema
from tests.conftest import bag, day, money, rows


def test_tables_open_once_and_on_demand(spark):
    opened = []
    tables = Tables(lambda role: opened.append(role) or spark.range(1))
    assert opened == []
    assert tables.payment is tables.payment and opened == ["payment"]


def test_tables_from_catalog(spark, small):
    small.building.createOrReplaceTempView("torres")
    assert bag(Tables.from_catalog(spark, {"building": "torres"}).building) == bag(small.building)


def test_layout_round_trip(spark, small, tmp_path):
    write_tables(small, str(tmp_path))
    again = Tables.from_parquet(spark, str(tmp_path))
    for role in LAYOUTS:
        assert bag(again[role].select(*SCHEMAS[role].fieldNames())) == bag(small[role])
    assert glob.glob(f"{tmp_path}/payment/Anio=2025/Mes=3/*.parquet")
    report = plans.weekly_collection(again, 1, day("2025-01-01"), day("2025-03-31"))
    assert rows(report) == rows(plans.weekly_collection(small, 1, day("2025-01-01"), day("2025-03-31")))


def test_layout_splits_a_hot_directory(spark, tmp_path):
    """Nearly all rows in one directory are written by several tasks, each file sorted."""
    df = spark.range(0, 200_000, numPartitions=16).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 5).otherwise(1).alias("g"),
        F.xxhash64("id").alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        write_layout(df, f"{tmp_path}/t", ["g"], ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = glob.glob(f"{tmp_path}/t/g=1/*.parquet")
    assert len(files) > 2
    values = [r.v for r in spark.read.parquet(files[0]).collect()]
    assert values == sorted(values)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 200_000


def test_layout_splits_a_hot_value(spark, tmp_path):
    """Without directories each file holds a range, and a frequent value several files."""
    df = spark.range(0, 200_000, numPartitions=16).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 50).otherwise(20).alias("g"), F.col("id").alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_layout(df, f"{tmp_path}/t", [], ["g"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for file in glob.glob(f"{tmp_path}/t/*.parquet"):
        values = [r.g for r in spark.read.parquet(file).collect()]
        assert values == sorted(values)
        spans.append((values[0], values[-1]))
    spans.sort()
    assert len(spans) == 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(low <= 20 <= high for low, high in spans) >= 3
    assert spark.read.parquet(f"{tmp_path}/t").count() == 200_000


def test_xml_document(spark, small, tmp_path):
    df = plans.monthly_by_unit(small, 2025, 1)
    row_tag, root_tag = XML_COLLECTION_BY_UNIT
    sources.write_xml(df, f"{tmp_path}/x", row_tag, root_tag)
    (path,) = glob.glob(f"{tmp_path}/x/part-*")
    root = ET.parse(path).getroot()
    assert root.tag == root_tag and {child.tag for child in root} == {row_tag}
    unlabelled = [c for c in root if c.find("UnidadFuncionalNombre") is None]
    assert len(unlabelled) == 1 and unlabelled[0].find("Enero").text == "35.00"
    assert bag(sources.read_xml(spark, f"{tmp_path}/x", row_tag, df.schema)) == bag(df)


def test_xml_escapes_and_null(spark, tmp_path):
    df = spark.createDataFrame([("a<b & c>", None), (None, money("2.50"))], schema(t=SCHEMAS["payment"]["Concepto"].dataType, v=AMOUNT))
    sources.write_xml(df, f"{tmp_path}/x", "r", "rs")
    assert bag(sources.read_xml(spark, f"{tmp_path}/x", "r", df.schema)) == bag(df)


def test_long_xml_is_not_one_task(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=4)
    sources.write_xml(df, f"{tmp_path}/x", "r", "rs")
    assert len(glob.glob(f"{tmp_path}/x/part-*")) == 4
    assert sources.read_xml(spark, f"{tmp_path}/x", "r", df.schema).count() == 1000


def test_reports_are_appended(spark, tmp_path):
    row = spark.createDataFrame([(1, 2025, 4, "u")], SCHEMAS["chart_report"])
    for _ in range(2):
        sources.append_report(row, f"{tmp_path}/r")
    assert rows(sources.read_report(spark, f"{tmp_path}/r")) == [(1, 2025, 4, "u")] * 2


class Session:
    """The settings of a session, without the session."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_shared_path_is_where_the_session_says():
    session = Session(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    one, two = (sources.shared_path(session, "t") for _ in range(2))
    assert one != two and one.startswith("hdfs://shared/t-")


def test_shared_path_without_a_setting():
    with pytest.raises(ValueError):
        sources.shared_path(Session(spark_master="local[2]"), "t")


LINES = """PagoID,Fecha,Importe,Concepto,NroClaveUniformeID
1,01/04/2025,10.50,ORDINARIO,k1
2,31/02/2025,1.00,ORDINARIO,k1
3,01/04/2025,abc,ORDINARIO,k1
4,01/04/2025
5,01/04/2025,1.00,ORDINARIO,
6,02/04/2025,2.00,EXTRAORDINARIO,k2
6,02/04/2025,2.00,EXTRAORDINARIO,k2
6,02/04/2025,2.00,EXTRAORDINARIO,k2
7,03/04/2025,5.00,ORDINARIO,k1
7,03/04/2025,4.00,ORDINARIO,k1
8,04/04/2025,1.00,ORDINARIO,zz
"""


@pytest.fixture(scope="module")
def payments_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "payments.csv"
    path.write_text(LINES)
    return str(path)


def test_bad_payment_lines_are_set_aside(spark, make, payments_file):
    tables = make(account=[("k1", 1), ("k2", 2)])
    known, unknown, got = plans.import_payments(spark, payments_file, tables)
    april = lambda d: day(f"2025-04-{d:02d}")
    assert bag(known) == [
        (1, april(1), money("10.50"), "ORDINARIO", "k1"),
        (6, april(2), money(2), "EXTRAORDINARIO", "k2"),
        (7, april(3), money(4), "ORDINARIO", "k1"),
    ]
    assert [r[0] for r in rows(unknown)] == [8]
    rejects = {(r[0], r[1]): r[2] for r in rows(got.rejects)}
    assert rejects == {
        ("2,31/02/2025,1.00,ORDINARIO,k1", "malformed"): 1,
        ("3,01/04/2025,abc,ORDINARIO,k1", "malformed"): 1,
        ("4,01/04/2025", "malformed"): 1,
        ('{"PagoID":5,"Fecha":"2025-04-01","Importe":1.00,"Concepto":"ORDINARIO"}', "missing NroClaveUniformeID"): 1,
        ('{"PagoID":6,"Fecha":"2025-04-02","Importe":2.00,"Concepto":"EXTRAORDINARIO","NroClaveUniformeID":"k2"}', "duplicate key"): 2,
        ('{"PagoID":7,"Fecha":"2025-04-03","Importe":5.00,"Concepto":"ORDINARIO","NroClaveUniformeID":"k1"}', "duplicate key"): 1,
    }
    assert rows(got.log) == [("payments", 11, 4, 7)]


KINDS = {
    "good": lambda i: f"{i},01/04/2025,10.50,ORDINARIO,k{i % 3}",
    "surplus field": lambda i: f"{i},01/04/2025,10.50,ORDINARIO,k1,more",
    "field too few": lambda i: f"{i},01/04/2025,10.50",
    "fraction": lambda i: f"{i},01/04/2025,{i}.005,ORDINARIO,k1",
    "date": lambda i: f"{i},30/02/2025,1.00,ORDINARIO,k1",
    "number": lambda i: f"{i}x,01/04/2025,1.00,ORDINARIO,k1",
    "missing": lambda i: f"{i},01/04/2025,,ORDINARIO,k1",
    "again": lambda i: f"{i % 4},01/04/2025,{i % 2}.50,ORDINARIO,k1",
}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("staging", [False, True])
def test_every_line_is_once_in_valid_or_rejects(spark, make, tmp_path, seed, staging):
    rng = random.Random(seed)
    kinds = [rng.choice([*KINDS]) for _ in range(120)]
    (tmp_path / "p").mkdir()
    for part in range(3):
        lines = [KINDS[k](i) for i, k in enumerate(kinds) if i % 3 == part]
        (tmp_path / "p" / f"{part}.csv").write_text("\n".join(["PagoID,Fecha,Importe,Concepto,NroClaveUniformeID", *lines, ""]))
    tables = make(account=[("k0", 1), ("k1", 2)])
    stage = f"{tmp_path}/stage" if staging else None
    known, unknown, got = plans.import_payments(spark, str(tmp_path / "p"), tables, staging=stage)
    good = {str(i) for i, k in enumerate(kinds) if k == "good"}
    bad = sum(k not in ("good", "again") for k in kinds)
    ids = {i % 4 for i, k in enumerate(kinds) if k == "again"}
    taken = sorted({*map(int, good), *ids})
    assert sorted(r[0] for r in rows(got.valid)) == taken
    assert sorted(r[0] for r in [*rows(known.select("PagoID")), *rows(unknown.select("PagoID"))]) == taken
    assert sum(r["Veces"] for r in got.rejects.collect()) == len(kinds) - len(taken)
    assert got.rejects.where("Motivo <> 'duplicate key'").agg(F.sum("Veces")).first()[0] == bad
    assert rows(got.log) == [("payments", len(kinds), len(taken), len(kinds) - len(taken))]
    lines = got.lines.select("Linea", "Motivo").collect()
    assert len(lines) == len({r["Linea"] for r in lines}) == len(kinds)
    # the line of a valid row is none of a rejected one
    accepted = got.lines.where("Motivo IS NULL").select("Linea", *got.valid.columns)
    set_aside = got.lines.where("Motivo IS NOT NULL").select("Linea")
    assert accepted.join(set_aside, "Linea").count() == 0
    assert bag(accepted.drop("Linea")) == bag(got.valid)


def test_amounts_are_not_rounded(spark):
    texts = ["100.005", "7.123456", "7.10", "7.1000", "-3", "+.5", "5.", "1e2", "12E-1", "1e-3", "9" * 17, "1,5", "", " 1", "0.00000000000000000001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sources.exact_amount(F.col("t"), AMOUNT).alias("a"))
    got = {r["t"]: r["a"] for r in df.collect()}
    assert {t: v for t, v in got.items() if v is not None} == {
        "7.10": money("7.10"), "7.1000": money("7.10"), "-3": money(-3), "+.5": money("0.5"), "5.": money(5), "1e2": money(100), "12E-1": money("1.2"),
    } | ({"9" * 17: money("9" * 17)} if AMOUNT.precision - AMOUNT.scale >= 17 else {})


def test_surplus_fields_of_every_import_are_set_aside(spark, make, tmp_path):
    for name, read in {
        "units": lambda p: plans.import_units(spark, p, plans.loading.CSV)[1],
        "people": lambda p: plans.import_people(spark, p)[2],
        "assignments": lambda p: plans.import_assignments(spark, p),
        "payments": lambda p: plans.import_payments(spark, p, make(account=[("k", 1)]))[2],
    }.items():
        columns = plans.loading.FILES[name].fields
        fill = {"date": "01/04/2025", "boolean": "true", "string": "k"}
        line = ",".join(fill.get(f.dataType.simpleString(), "1") for f in columns)
        (tmp_path / f"{name}.csv").write_text(",".join(f.name for f in columns) + f"\n{line}\n{line},more\n")
        got = read(str(tmp_path / f"{name}.csv"))
        assert (got.valid.count(), [r[:2] for r in rows(got.rejects)]) == (1, [(f"{line},more", "malformed")])
        assert rows(got.log) == [(name, 2, 1, 1)]


def test_choice_of_columns_does_not_change_the_rows(spark, make, payments_file):
    known, _, got = plans.import_payments(spark, payments_file, make(account=[("k1", 1), ("k2", 2)]))
    assert sorted(r[0] for r in rows(known.select("PagoID"))) == [1, 6, 7]
    assert got.valid.count() == 4 and got.rejects.count() == 6


def test_people_and_accounts(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "PersonaID,DNI,Nombre,Apellido,Mail,Telefono,EsPropietario,NroClaveUniformeID\n"
        "1,11,Ana,Paz,a@x,,true,k1\n1,11,Ana,Paz,a@x,,true,k2\n2,veinte,Bo,Paz,,,false,k3\n3,33,Cy,Paz,,5,false,k4\n"
    )
    person, account, got = plans.import_people(spark, str(tmp_path / "p.csv"))
    assert bag(person) == [(1, 11, "Ana", "Paz", "a@x", None, True), (3, 33, "Cy", "Paz", None, "5", False)]
    assert bag(account) == [("k1", 1), ("k2", 1), ("k4", 3)]
    assert rows(got.log) == [("people", 4, 3, 1)]


def test_units_and_their_people(spark, make, tmp_path):
    (tmp_path / "u.txt").write_text("UnidadFuncionalID\tConsorcioID\tPiso\tDepartamento\n1\t7\t2\tA\n2\t7\t\tB\nx\t7\t1\tC\n")
    units, got = plans.import_units(spark, str(tmp_path / "u.txt"))
    assert bag(units) == [(1, 7, None, None, "2", "A"), (2, 7, None, None, None, "B")]
    assert rows(got.rejects) == [("x\t7\t1\tC", "malformed", 1)]
    (tmp_path / "a.csv").write_text(
        "NroClaveUniformeID,UnidadFuncionalID,EsInquilino\nk1,1,false\nk2,1,true\nzz,2,false\nk1,2,quizas\n"
    )
    assignments = plans.import_assignments(spark, str(tmp_path / "a.csv"))
    accounts = make(account=[("k1", 10), ("k2", 20)]).account
    assigned = plans.assign_people(units, assignments.valid, accounts)
    assert bag(assigned) == [(1, 7, 10, 20, "2", "A"), (2, 7, None, None, None, "B")]
    # an assignment that names nobody known leaves the unit as it was
    again = plans.assign_people(assigned, assignments.valid.where("UnidadFuncionalID = 2"), accounts)
    assert bag(again) == bag(assigned)


def test_json_expenses(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '{"ConsorcioID":1,"Periodo":"2025-04-01","LUZ":10.25,"AGUA":3}\n'
        '{"ConsorcioID":1,"Periodo":"2025-05-01","LUZ":1.10}\n'
        '{"ConsorcioID":1,"Periodo":"2025-06-01","LUZ":"mucho"}\n'
        '{"Periodo":"2025-06-01","LUZ":1}\n'
        "{not json\n\n"
    )
    long, got = plans.import_expenses(spark, str(tmp_path / "e.json"))
    april, may = day("2025-04-01"), day("2025-05-01")
    assert bag(long) == [(1, april, "AGUA", money(3)), (1, april, "LUZ", money("10.25")), (1, may, "LUZ", money("1.10"))]
    assert sorted(r[1] for r in rows(got.rejects)) == ["malformed", "malformed LUZ", "missing ConsorcioID"]
    assert rows(got.log) == [("expenses", 6, 3, 3)]


def test_json_amounts_of_any_field_are_kept_or_set_aside(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '[{"ConsorcioID":1,"Periodo":"2025-04-01","LUZ":10.00,"GAS":7.50},\n'
        ' {"ConsorcioID":1,"Periodo":"2025-05-01","Luz ":3,"AGUA":1.005,"X":null,"GAS":"x"}]\n'
    )
    long, got = plans.import_expenses(spark, str(tmp_path / "e.json"), document=True)
    assert sorted((r[2], r[3]) for r in rows(long)) == [("GAS", money("7.50")), ("LUZ", money(10)), ("Luz ", money(3))]
    assert sorted(r[1] for r in rows(got.rejects)) == ["malformed AGUA", "malformed GAS"]
    assert rows(got.log) == [("expenses", 5, 3, 2)]


def test_conflicting_persons_are_set_aside(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "PersonaID,DNI,Nombre,Apellido,Mail,Telefono,EsPropietario,NroClaveUniformeID\n"
        "1,10,Ana,Paz,,,true,k1\n1,10,Ana,Paz,,,true,k2\n1,11,Eva,Paz,,,true,k3\n"
    )
    person, account, got = plans.import_people(spark, str(tmp_path / "p.csv"))
    assert [r[:3] for r in bag(person)] == [(1, 10, "Ana")]
    assert bag(account) == [("k1", 1), ("k2", 1)]
    assert [r[1:] for r in rows(got.rejects)] == [("conflicting person", 1)]
    assert rows(got.log) == [("people", 3, 2, 1)]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    (tmp_path / "u.txt").write_text("ConsorcioID\tUnidadFuncionalID\tPiso\tDepartamento\n7\t1\t2\tA\n")
    with pytest.raises(Exception, match="header"):
        plans.import_units(spark, str(tmp_path / "u.txt"))[0].collect()


def test_assignments_not_used_have_a_reason(spark):
    units = spark.createDataFrame([(1, 7, None, None, "2", "A")], SCHEMAS["unit"])
    accounts = spark.createDataFrame([("k1", 10), ("k2", 20)], SCHEMAS["account"])
    lines = spark.createDataFrame(
        [("k1", 1, False), ("k2", 1, False), ("zz", 1, False), ("k1", 9, True), ("k1", 1, False)],
        plans.loading.FILES["assignments"],
    )
    got = plans.assignment_rejects(units, lines, accounts)
    assert sorted((r[1], r[2]) for r in rows(got)) == [("surplus person", 2), ("unknown account", 1), ("unknown unit", 1)]


def test_buildings(spark, tmp_path):
    (tmp_path / "b.csv").write_text("ConsorcioID,NombreDelConsorcio\n1,Norte\n1,Otro\nx,Sur\n")
    buildings, got = plans.import_buildings(spark, str(tmp_path / "b.csv"))
    assert bag(buildings) == [(1, "Norte")]
    assert rows(got.log) == [("buildings", 3, 1, 2)]


def test_required_columns_are_needed(spark):
    with pytest.raises(ValueError):
        sources.read_with_rejects(spark, "x", "csv", SCHEMAS["account"], [])
    with pytest.raises(ValueError):
        sources.read_with_rejects(spark, "x", "csv", SCHEMAS["account"], ["PersonaID"], ["NroClaveUniformeID"])


def test_a_report_run_again_replaces_its_own_rows(spark, tmp_path):
    def row(building):
        return spark.createDataFrame([(building, 2025, 4, "u")], SCHEMAS["chart_report"])

    path = f"{tmp_path}/r"
    sources.append_report(row(1), path, "abril")
    sources.append_report(row(2), path, "mayo")
    sources.append_report(row(1), path, "abril")
    assert bag(sources.read_report(spark, path)) == [(1, 2025, 4, "u"), (2, 2025, 4, "u")]
    sources.append_report(row(3), path)
    sources.append_report(row(3), path)
    assert [r[0] for r in bag(sources.read_report(spark, path))] == [1, 2, 3, 3]
    sources.append_report(row(1).limit(0), path, "abril")
    assert [r[0] for r in bag(sources.read_report(spark, path))] == [2, 3, 3]
    with pytest.raises(ValueError):
        sources.append_report(row(1), path, "../other")


def test_ranges_grow_with_the_rows_where_these_are_known(spark, tmp_path, monkeypatch):
    from strata.sources import layout

    monkeypatch.setattr(layout, "ROWS_A_RANGE", 100)
    df = spark.range(2000).withColumn("half", F.col("id") % 2)
    write_layout(df, str(tmp_path / "t"), [], ["half", "id"], rows=df.count())
    files = glob.glob(f"{tmp_path}/t/*.parquet")
    assert len(files) >= 20 and spark.read.parquet(str(tmp_path / "t")).count() == 2000
    assert max(spark.read.parquet(f).count() for f in files) < 400
