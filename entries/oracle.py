"""Check SQL per registered query, over the same tables, in the plainest form.

It states each result directly: OR joins, one-step aggregates and windows over
whole groups.
"""

from __future__ import annotations

import re

from strata.functions.fixed import (
    CHART_COLORS,
    CHART_DATASET,
    CHART_ENDPOINT,
    CHART_SIZE,
    CHART_TITLE,
    CHART_TITLE_MONTH,
    CHART_TITLE_YEAR,
    MONTH_NAMES,
)
from strata.sources.standins import COLUMNS, SOURCES


def _role_sql(role: str) -> str:
    fact, condition, dimensions = SOURCES[role]
    select = ", ".join(f'{sql} AS {name}' for name, sql in COLUMNS[role].items())
    joins = "".join(f" JOIN {t} ON {a} = {b}" for t, a, b in dimensions)
    where = f" WHERE {condition}" if condition else ""
    return f"SELECT {select} FROM {fact}{joins}{where}"


MONTH_CASE = "CASE {} " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTH_NAMES, 1)) + " END"
LABEL = "b.NombreDelConsorcio || ' - Piso ' || u.Piso || ' Depto ' || u.Departamento"
LABEL_GAPS = "b.NombreDelConsorcio || '- Piso' || u.Piso || ' - Depto' || u.Departamento"

# Relations the queries share, each over the ones before it
VIEWS = {role: _role_sql(role) for role in SOURCES} | {
    "paid": """SELECT p.*, u.UnidadFuncionalID, u.ConsorcioID, u.Piso, u.Departamento, a.PersonaID
        FROM payment p JOIN account a ON p.NroClaveUniformeID = a.NroClaveUniformeID
        JOIN unit u ON a.PersonaID = u.PropietarioID OR a.PersonaID = u.InquilinoID""",
    "named": f"""SELECT u.*, b.NombreDelConsorcio, {LABEL} AS UnidadFuncionalNombre, {LABEL_GAPS} AS Etiqueta
        FROM paid u JOIN building b ON u.ConsorcioID = b.ConsorcioID""",
    "expense": """SELECT ConsorcioID, Periodo, Importe FROM expense_ordinary
        UNION ALL SELECT ConsorcioID, Periodo, Importe FROM expense_extra""",
    "category": """SELECT ConsorcioID, cast(year(Periodo) AS INTEGER) AS PeriodoAnio,
        cast(month(Periodo) AS INTEGER) AS PeriodoMes, Categoria, sum(Importe) AS Importe
        FROM expense_ordinary GROUP BY ALL""",
    "income": """SELECT ConsorcioID, cast(year(Fecha) AS INTEGER) AS Anio, cast(month(Fecha) AS INTEGER) AS Mes,
        sum(Importe) AS TotalIngresos FROM paid GROUP BY ALL""",
    "texts": """SELECT ConsorcioID, PeriodoAnio, PeriodoMes, sum(Importe) AS Total,
        '[' || string_agg('"' || Categoria || '"', ',' ORDER BY Categoria) || ']' AS Etiquetas,
        '[' || string_agg(cast(cast(Importe AS DECIMAL(38,2)) AS VARCHAR), ',' ORDER BY Categoria) || ']' AS Importes
        FROM category GROUP BY ALL""",
    "title": f"""SELECT t.*, '{CHART_TITLE}' || b.NombreDelConsorcio || '{CHART_TITLE_MONTH}' || t.PeriodoMes
        || '{CHART_TITLE_YEAR}' || t.PeriodoAnio AS Titulo
        FROM texts t LEFT JOIN building b ON t.ConsorcioID = b.ConsorcioID WHERE Total <> 0""",
    "delivered": """SELECT p.*, day(Fecha) = 31 AS Mal FROM payment p
        UNION ALL SELECT p.*, day(Fecha) = 31 AS Mal FROM payment p WHERE Concepto = 'EXTRAORDINARIO'""",
    "reject": """SELECT PagoID || ',31/02/' || year(Fecha) || ',' || Importe || ',' || Concepto || ','
            || coalesce(NroClaveUniformeID, '') AS Registro, 'malformed' AS Motivo, 1 AS Veces
        FROM delivered WHERE Mal
        UNION ALL SELECT '{"PagoID":' || PagoID || ',"Fecha":"' || strftime(Fecha, '%Y-%m-%d') || '","Importe":'
            || Importe || ',"Concepto":"' || Concepto || '"}', 'missing NroClaveUniformeID', 1
        FROM delivered WHERE NOT Mal AND NroClaveUniformeID IS NULL
        UNION ALL SELECT '{"PagoID":' || PagoID || ',"Fecha":"' || strftime(Fecha, '%Y-%m-%d') || '","Importe":'
            || Importe || ',"Concepto":"' || Concepto || '","NroClaveUniformeID":"' || NroClaveUniformeID || '"}',
            'duplicate key', count(*) - 1
        FROM delivered WHERE NOT Mal AND NroClaveUniformeID IS NOT NULL
        GROUP BY PagoID, Fecha, Importe, Concepto, NroClaveUniformeID HAVING count(*) > 1""",
    "charge": """SELECT o.PersonaID, o.ConsorcioID, e.Periodo,
            cast((2 * cast(100 * e.Total AS HUGEINT) * o.n + w.n) // (2 * w.n) AS DECIMAL(38,0)) / 100.0 AS Importe
        FROM (SELECT ConsorcioID, PropietarioID AS PersonaID, count(*) AS n FROM unit
              WHERE PropietarioID IS NOT NULL GROUP BY ALL) o
        JOIN (SELECT ConsorcioID, count(*) AS n FROM unit GROUP BY ALL) w ON o.ConsorcioID = w.ConsorcioID
        JOIN (SELECT ConsorcioID, Periodo, sum(Importe) AS Total FROM expense GROUP BY ALL) e
            ON o.ConsorcioID = e.ConsorcioID""",
    "move": """SELECT PersonaID, ConsorcioID, Periodo, cast(sum(Importe) AS DECIMAL(38,2)) AS Importe FROM (
            SELECT PersonaID, ConsorcioID, Periodo, cast(Importe AS DECIMAL(38,2)) AS Importe FROM charge
            UNION ALL SELECT PersonaID, ConsorcioID, cast(date_trunc('month', Fecha) AS DATE), -Importe
            FROM (SELECT DISTINCT PagoID, PersonaID, ConsorcioID, Fecha, Importe FROM paid)) GROUP BY ALL""",
    "state": """SELECT *, Ingresos - Egresos AS Resultado FROM (
            SELECT ConsorcioID, Periodo, sum(Ingresos) AS Ingresos, sum(Egresos) AS Egresos FROM (
                SELECT ConsorcioID, cast(date_trunc('month', Fecha) AS DATE) AS Periodo,
                    Importe AS Ingresos, 0 AS Egresos FROM paid
                UNION ALL SELECT ConsorcioID, Periodo, 0, Importe FROM expense) GROUP BY ALL)""",
    "expense_loaded": """SELECT ConsorcioID, Periodo, Importe FROM expense_ordinary
        UNION ALL SELECT ConsorcioID, cast(date_trunc('month', Fecha) AS DATE), Importe FROM paid
        WHERE Concepto = 'EXTRAORDINARIO'""",
    "state_loaded": """SELECT *, Ingresos - Egresos AS Resultado FROM (
            SELECT ConsorcioID, Periodo, sum(Ingresos) AS Ingresos, sum(Egresos) AS Egresos FROM (
                SELECT ConsorcioID, cast(date_trunc('month', Fecha) AS DATE) AS Periodo,
                    Importe AS Ingresos, 0 AS Egresos FROM paid
                UNION ALL SELECT ConsorcioID, Periodo, 0, Importe FROM expense_loaded) GROUP BY ALL)""",
}
# The same relations over accounts that two persons share, and over units of different weight
VIEWS |= {
    "account_shared": """SELECT NroClaveUniformeID, PersonaID FROM account
        UNION ALL SELECT NroClaveUniformeID, PersonaID + 2 FROM account WHERE PersonaID % 3 = 0""",
    "paid_shared": VIEWS["paid"].replace("JOIN account a", "JOIN account_shared a"),
    "named_shared": VIEWS["named"].replace("FROM paid u", "FROM paid_shared u"),
    "charge_weighted": VIEWS["charge"].replace("count(*) AS n", "sum(UnidadFuncionalID % 40 + 1) AS n"),
    "move_weighted": VIEWS["move"].replace("FROM charge", "FROM charge_weighted"),
}


def _with_views(sql: str) -> str:
    """``sql`` after the views it names, directly or through another view."""
    needed: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        fresh = (words & VIEWS.keys()) - needed
        needed |= fresh
        open_texts += [VIEWS[name] for name in fresh]
    views = ", ".join(f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed)
    return f"WITH {views} {sql}"


def _weekly(where: str, apart: bool, year: str = "year") -> str:
    by = "ConsorcioID, " if apart else ""
    part = "PARTITION BY ConsorcioID" if apart else ""
    return f"""SELECT {by}Anio, NroSemana, o::DOUBLE AS RecaudacionOrdinaria, e::DOUBLE AS RecaudacionExtraordinaria,
        (o + e)::DOUBLE AS TotalSemanal,
        (sum(o + e) OVER ({part}))::DOUBLE / count(o + e) OVER ({part}) AS PromedioSemanal,
        (sum(o + e) OVER ({part} ORDER BY Anio, NroSemana))::DOUBLE AS AcumuladoProgresivo
        FROM (SELECT {by}cast({year}(Fecha) AS INTEGER) AS Anio, cast(week(Fecha) AS INTEGER) AS NroSemana,
            sum(CASE WHEN Concepto = 'ORDINARIO' THEN Importe ELSE 0 END) AS o,
            sum(CASE WHEN Concepto = 'EXTRAORDINARIO' THEN Importe ELSE 0 END) AS e
            FROM paid {where} GROUP BY ALL)"""


def _by_month(where: str) -> str:
    columns = ", ".join(
        f"coalesce(sum(Importe) FILTER (WHERE month(Fecha) = {i}), 0)::DOUBLE AS {m}"
        for i, m in enumerate(MONTH_NAMES, 1)
    )
    return f"SELECT UnidadFuncionalNombre, {columns} FROM named {where} GROUP BY ALL"


def _one_month(where: str) -> str:
    return f"""SELECT UnidadFuncionalNombre, sum(coalesce(Importe, 0))::DOUBLE AS MesSolicitado
        FROM named {where} GROUP BY ALL"""


def _by_source(where: str, apart: bool) -> str:
    by = "ConsorcioID, " if apart else ""
    return f"""SELECT {by}cast(year(Fecha) AS INTEGER) AS Anio, cast(month(Fecha) AS INTEGER) AS Mes,
        sum(CASE WHEN Concepto = 'ORDINARIO' THEN Importe ELSE 0 END)::DOUBLE AS TotalOrdinario,
        sum(CASE WHEN Concepto = 'EXTRAORDINARIO' THEN Importe ELSE 0 END)::DOUBLE AS TotalExtraordinario,
        sum(Importe)::DOUBLE AS TotalGeneralMes FROM paid {where} GROUP BY ALL"""


def _top_months(table: str, date: str, total: str, where: str, apart: bool) -> str:
    by = "ConsorcioID, " if apart else ""
    part = "PARTITION BY ConsorcioID " if apart else ""
    return f"""SELECT {by}Anio, {MONTH_CASE.format("Mes")} AS Mes, {total}::DOUBLE AS {total}
        FROM (SELECT *, row_number() OVER ({part}ORDER BY {total} DESC, Anio, Mes) AS r FROM (
            SELECT {by}cast(year({date}) AS INTEGER) AS Anio, cast(month({date}) AS INTEGER) AS Mes,
            sum(Importe) AS {total} FROM {table} {where} GROUP BY ALL)) WHERE r <= 5"""


def _debtors(where: str, having: str, apart: bool, top: str = "WHERE r <= 3") -> str:
    by = "ConsorcioID, " if apart else ""
    part = "PARTITION BY ConsorcioID " if apart else ""
    return f"""SELECT {by}DNI, Nombre, Apellido, Mail, Telefono, s::DOUBLE AS SaldoNetoAcumulado
        FROM (SELECT *, row_number() OVER ({part}ORDER BY s DESC, DNI) AS r FROM (
            SELECT {by}DNI, Nombre, Apellido, Mail, Telefono, sum(SaldoActual) AS s
            FROM balance JOIN person USING (PersonaID) WHERE EsPropietario {where}
            GROUP BY ALL HAVING sum(SaldoActual) {having})) {top}"""


def _gaps(where: str, apart: bool) -> str:
    by = "ConsorcioID, " if apart else ""
    return f"""SELECT {by}Etiqueta AS UnidadFuncionalNombre, strftime(Fecha, '%d/%m/%Y') AS FechaDePago,
        Importe::DOUBLE AS Importe, strftime(s, '%d/%m/%Y') AS FechaSiguientePago,
        cast(date_diff('day', Fecha, s) AS INTEGER) AS DiasHastaSiguientePago
        FROM (SELECT *, lead(Fecha) OVER (PARTITION BY ConsorcioID, Etiqueta
            ORDER BY Fecha, PagoID, UnidadFuncionalID) AS s FROM named {where})"""


def _chart(where: str = "", strict: bool = False) -> str:
    colors = "[" + ",".join(f'"{c}"' for c in CHART_COLORS) + "]"
    options = (
        """'"options":{"title":{"display":true,"text":"' || Titulo || '"'"""
        if strict
        else """'options:{title:{display:true,text:"' || Titulo || '"'"""
    )
    config = f"""'{{"type":"doughnut","data":{{"labels":' || Etiquetas || ',"datasets":[{{"label":"{CHART_DATASET}","data":'
        || Importes || ',"backgroundColor":{colors}}}]}},' || {options} || '}}}}}}'"""
    if strict:
        # the form encoding of a space, and of the characters only one of the encoders leaves alone
        config = f"replace(replace(url_encode({config}), '%20', '+'), '~', '%7E')"
    return f"""SELECT ConsorcioID, PeriodoAnio, PeriodoMes, '{CHART_ENDPOINT}' || {config} || '{CHART_SIZE}' AS URLApi
        FROM title {where}"""


def _prorated() -> str:
    return """SELECT PersonaID, ConsorcioID, Periodo,
        (sum(Importe) OVER (PARTITION BY PersonaID, ConsorcioID ORDER BY Periodo))::DOUBLE AS SaldoActual FROM move"""


def _state() -> str:
    return """SELECT ConsorcioID, Periodo, Ingresos::DOUBLE AS Ingresos, Egresos::DOUBLE AS Egresos,
        Resultado::DOUBLE AS Resultado,
        (sum(Resultado) OVER (PARTITION BY ConsorcioID ORDER BY Periodo))::DOUBLE AS SaldoCierre FROM state"""


PAYMENT = "PagoID, Fecha, Importe::DOUBLE AS Importe, Concepto, NroClaveUniformeID"
RANGE = "BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'"
BY_CONCEPT = "SELECT Concepto, sum(Importe)::DOUBLE AS Importe FROM payment"

QUERIES = {
    "weekly_collection": _weekly("", True),
    "weekly_collection_one": _weekly(f"WHERE ConsorcioID = 3 AND Fecha {RANGE}", False),
    "weekly_collection_iso_year": _weekly("", True, "isoyear"),
    "monthly_by_unit_year": _by_month("WHERE year(Fecha) = 1997"),
    "monthly_by_unit_year_one": _by_month("WHERE year(Fecha) = 1997 AND ConsorcioID = 2"),
    "monthly_by_unit_month": _one_month("WHERE year(Fecha) = 1997 AND month(Fecha) = 5"),
    "monthly_by_unit_month_one": _one_month(
        "WHERE year(Fecha) = 1997 AND month(Fecha) = 5 AND ConsorcioID = 2"
    ),
    "collection_by_source": _by_source("", True),
    "collection_by_source_one": _by_source(f"WHERE ConsorcioID = 3 AND Fecha {RANGE}", False),
    "top_expense_months": _top_months("expense", "Periodo", "TotalGastos", "", True),
    "top_expense_months_one": _top_months(
        "expense", "Periodo", "TotalGastos", f"WHERE ConsorcioID = 1 AND Periodo {RANGE}", False
    ),
    "top_income_months": _top_months("paid", "Fecha", "TotalIngresos", "", True),
    "top_income_months_one": _top_months(
        "paid", "Fecha", "TotalIngresos", f"WHERE ConsorcioID = 1 AND Fecha {RANGE}", False
    ),
    "top_debtors": _debtors("", "> 0", True),
    "top_debtors_one": _debtors(
        "AND ConsorcioID = 4 AND Periodo BETWEEN DATE '1996-01-01' AND DATE '1999-06-30'", "> 0", False
    ),
    "top_debtors_min": _debtors("", ">= 500000", True),
    "top_debtors_min_one": _debtors("AND ConsorcioID = 4", ">= 500000", False),
    "owner_debts_min": _debtors("AND ConsorcioID = 4", ">= 500000", False, ""),
    "payment_gaps": _gaps("", True),
    "payment_gaps_one": _gaps(f"WHERE ConsorcioID = 4 AND Fecha {RANGE}", False),
    "category_expense": """SELECT ConsorcioID, PeriodoAnio, PeriodoMes, Categoria, Importe::DOUBLE AS Importe
        FROM category""",
    "category_expense_one": """SELECT ConsorcioID, PeriodoAnio, PeriodoMes, Categoria, Importe::DOUBLE AS Importe
        FROM category WHERE ConsorcioID = 2 AND PeriodoAnio = 1997 AND PeriodoMes = 4""",
    "category_chart_row": _chart(),
    "category_chart_row_one": _chart("WHERE ConsorcioID = 2 AND PeriodoAnio = 1997 AND PeriodoMes = 4"),
    "category_chart_strict": _chart("", True),
    "category_chart_empty": _chart("WHERE ConsorcioID = 2 AND PeriodoAnio = 1990 AND PeriodoMes = 4"),
    "scan_payment": f"SELECT {PAYMENT} FROM payment",
    "append_report_rows": f"{_chart()} UNION ALL {_chart('WHERE PeriodoAnio = 1997')}",
    "xml_roundtrip": _by_source("", True),
    "xml_roundtrip_units": _by_month("WHERE year(Fecha) = 1997"),
    "json_labels_values": "SELECT ConsorcioID, PeriodoAnio, PeriodoMes, Etiquetas, Importes FROM texts",
    "category_share_total": """SELECT Categoria, s::DOUBLE AS Importe, t::DOUBLE AS GastoTotal,
        s::DOUBLE / t::DOUBLE AS Parte FROM (SELECT Categoria, sum(Importe) AS s FROM expense_ordinary GROUP BY ALL),
        (SELECT sum(Importe) AS t FROM expense_ordinary)""",
    "exists_guard": f"""{BY_CONCEPT} WHERE NOT EXISTS (SELECT 1 FROM payment WHERE Concepto = 'MULTA')
        GROUP BY ALL""",
    "exists_guard_closed": f"""{BY_CONCEPT} WHERE NOT EXISTS (SELECT 1 FROM payment
        WHERE Concepto = 'EXTRAORDINARIO') GROUP BY ALL""",
    "layout_roundtrip": f"""SELECT {PAYMENT}, cast(year(Fecha) AS INTEGER) AS Anio, cast(month(Fecha) AS INTEGER) AS Mes
        FROM payment WHERE Fecha >= DATE '1996-01-01'""",
    "layout_weekly": _weekly("", True),
    "filter_closed_range": f"SELECT {PAYMENT} FROM payment WHERE Fecha {RANGE}",
    "filter_half_open": f"""SELECT {PAYMENT} FROM payment
        WHERE Fecha >= DATE '1996-01-01' AND Fecha < DATE '1998-06-01'""",
    "month_name": f"SELECT PagoID, {MONTH_CASE.format('month(Fecha)')} AS Mes FROM payment",
    "join_payment_account": """SELECT PagoID, PersonaID, Importe::DOUBLE AS Importe
        FROM payment JOIN account USING (NroClaveUniformeID)""",
    "join_owner_or_tenant": """SELECT NroClaveUniformeID, PersonaID, UnidadFuncionalID FROM account a
        JOIN unit u ON a.PersonaID = u.PropietarioID OR a.PersonaID = u.InquilinoID""",
    "join_unit_building": """SELECT UnidadFuncionalID, NombreDelConsorcio
        FROM unit JOIN building USING (ConsorcioID)""",
    "join_owner_filter": """SELECT b.PersonaID, ConsorcioID, Periodo, SaldoActual::DOUBLE AS SaldoActual
        FROM balance b JOIN person p ON b.PersonaID = p.PersonaID WHERE EsPropietario""",
    "payments_by_unit": """SELECT PagoID, Fecha, Importe::DOUBLE AS Importe, ConsorcioID, UnidadFuncionalID,
        UnidadFuncionalNombre FROM named""",
    "monthly_income": "SELECT ConsorcioID, Anio, Mes, TotalIngresos::DOUBLE AS TotalIngresos FROM income",
    "monthly_expenses": """SELECT ConsorcioID, cast(year(Periodo) AS INTEGER) AS Anio,
        cast(month(Periodo) AS INTEGER) AS Mes, sum(Importe)::DOUBLE AS TotalGastos FROM expense GROUP BY ALL""",
    "conditional_sum": """SELECT cast(year(Fecha) AS INTEGER) AS Anio,
        sum(CASE WHEN Concepto = 'ORDINARIO' THEN Importe ELSE 0 END)::DOUBLE AS Ordinario,
        sum(CASE WHEN Concepto = 'EXTRAORDINARIO' THEN Importe ELSE 0 END)::DOUBLE AS Extraordinario
        FROM payment GROUP BY ALL""",
    "pivot_sum": "SELECT cast(year(Fecha) AS INTEGER) AS Anio, Concepto, "
    + ", ".join(
        f"coalesce(sum(Importe) FILTER (WHERE month(Fecha) = {i}), 0)::DOUBLE AS {m}"
        for i, m in enumerate(MONTH_NAMES, 1)
    )
    + " FROM payment GROUP BY ALL",
    "sum_having": """SELECT PersonaID, sum(SaldoActual)::DOUBLE AS Saldo FROM balance
        GROUP BY ALL HAVING sum(SaldoActual) > 0""",
    "union_expenses": "SELECT ConsorcioID, Periodo, Importe::DOUBLE AS Importe FROM expense",
    "union_sum": "SELECT ConsorcioID, Periodo, sum(Importe)::DOUBLE AS Total FROM expense GROUP BY ALL",
    "overall_average": """SELECT ConsorcioID, Anio, Mes, TotalIngresos::DOUBLE AS TotalIngresos,
        (sum(TotalIngresos) OVER (PARTITION BY ConsorcioID))::DOUBLE
        / count(*) OVER (PARTITION BY ConsorcioID) AS Promedio FROM income""",
    "running_total": """SELECT ConsorcioID, Anio, Mes, TotalIngresos::DOUBLE AS TotalIngresos,
        (sum(TotalIngresos) OVER (PARTITION BY ConsorcioID ORDER BY Anio, Mes))::DOUBLE AS Acumulado FROM income""",
    "next_payment": """SELECT NroClaveUniformeID, Fecha, PagoID, lead(Fecha) OVER (
        PARTITION BY NroClaveUniformeID ORDER BY Fecha, PagoID) AS Siguiente FROM payment""",
    "date_parts": """SELECT PagoID, cast(year(Fecha) AS INTEGER) AS Anio, cast(month(Fecha) AS INTEGER) AS Mes,
        cast(week(Fecha) AS INTEGER) AS NroSemana, strftime(Fecha, '%d/%m/%Y') AS Texto FROM payment""",
    "month_bounds": """SELECT PagoID, cast(date_trunc('month', Fecha) AS DATE) AS Primero,
        cast(date_trunc('month', Fecha) + INTERVAL 1 MONTH AS DATE) AS Siguiente, last_day(Fecha) AS Ultimo
        FROM payment""",
    "unit_label": f"""SELECT UnidadFuncionalID, {LABEL} AS Etiqueta, {LABEL_GAPS} AS EtiquetaPagos
        FROM unit u JOIN building b ON u.ConsorcioID = b.ConsorcioID""",
    "import_csv_valid": """SELECT PersonaID, DNI, Nombre, Apellido, Mail, Telefono, EsPropietario FROM person
        WHERE coalesce(Mail, Telefono) IS NOT NULL AND PersonaID IN (SELECT PersonaID FROM account)""",
    "import_csv_accounts": """SELECT NroClaveUniformeID, PersonaID FROM account JOIN person USING (PersonaID)
        WHERE coalesce(Mail, Telefono) IS NOT NULL""",
    "import_txt_valid": """SELECT UnidadFuncionalID, ConsorcioID, Piso, Departamento FROM unit
        WHERE PropietarioID IS NOT NULL""",
    "assign_unit_person": """SELECT UnidadFuncionalID, ConsorcioID,
        CASE WHEN PropietarioID IN (SELECT PersonaID FROM account) THEN PropietarioID END AS PropietarioID,
        CASE WHEN InquilinoID IN (SELECT PersonaID FROM account) THEN InquilinoID END AS InquilinoID,
        Piso, Departamento FROM unit""",
    "import_payments": f"""SELECT {PAYMENT} FROM payment
        WHERE day(Fecha) <> 31 AND NroClaveUniformeID IN (SELECT NroClaveUniformeID FROM account)""",
    "import_rejects": "SELECT Registro, Motivo, cast(Veces AS BIGINT) AS Veces FROM reject",
    "import_log": """SELECT 'payments' AS Origen, n AS Leidos, n - r AS Aceptados, r AS Rechazados FROM
        (SELECT count(*) AS n FROM delivered), (SELECT cast(sum(Veces) AS BIGINT) AS r FROM reject)""",
    "import_surplus_field": """SELECT CASE WHEN PagoID % 7 = 0 THEN 'malformed'
        WHEN NroClaveUniformeID IS NULL THEN 'missing NroClaveUniformeID' ELSE 'valid' END AS Motivo,
        count(*) AS Veces FROM payment GROUP BY ALL""",
    "import_fraction_rejects": """SELECT CASE WHEN PagoID % 5 = 0 THEN 'malformed'
        WHEN NroClaveUniformeID IS NULL THEN 'missing NroClaveUniformeID' ELSE 'valid' END AS Motivo,
        count(*) AS Veces FROM payment GROUP BY ALL""",
    "import_json_expenses": """SELECT ConsorcioID, Periodo, Categoria, sum(Importe)::DOUBLE AS Importe
        FROM expense_ordinary GROUP BY ALL HAVING sum(Importe) <> 0""",
    "import_json_rejects": """SELECT Motivo, count(*) AS Veces FROM (SELECT CASE
            WHEN ConsorcioID = 7 THEN 'missing ConsorcioID'
            WHEN Importe > 90000 THEN 'malformed ' || Categoria END AS Motivo FROM expense_ordinary)
        WHERE Motivo IS NOT NULL GROUP BY ALL""",
    "import_people_conflicts": """SELECT DNI, 'conflicting person' AS Motivo, cast(1 AS BIGINT) AS Veces
        FROM person WHERE PersonaID % 2 = 1 AND PersonaID - 1 IN (SELECT PersonaID FROM person)""",
    "assign_rejects": """SELECT Motivo, count(*) AS Veces FROM (SELECT CASE WHEN p IS NULL THEN 'unknown account'
            WHEN u < 0 THEN 'unknown unit'
            WHEN p <> max(p) OVER (PARTITION BY u) THEN 'surplus person' END AS Motivo
        FROM (SELECT CASE WHEN Piso = '0' THEN -UnidadFuncionalID ELSE UnidadFuncionalID END AS u,
            unnest([UnidadFuncionalID - UnidadFuncionalID % 2, CASE WHEN ConsorcioID % 5 <> 0 THEN 0 END]) AS p
            FROM unit)) WHERE Motivo IS NOT NULL GROUP BY ALL""",
    "import_buildings": "SELECT ConsorcioID, NombreDelConsorcio FROM building",
    "payment_gaps_shared": _gaps("", True).replace("FROM named", "FROM named_shared"),
    "prorate_weighted": _prorated().replace("FROM move", "FROM move_weighted"),
    "derive_extra_expenses": """SELECT ConsorcioID, cast(date_trunc('month', Fecha) AS DATE) AS Periodo,
        sum(Importe)::DOUBLE AS Importe FROM paid WHERE Concepto = 'EXTRAORDINARIO' GROUP BY ALL""",
    "derive_ordinary_expenses": """SELECT * FROM (SELECT ConsorcioID,
        cast(date_trunc('month', Fecha) AS DATE) AS Periodo, 'PROMO' AS Categoria, sum(Importe)::DOUBLE AS Importe
        FROM paid WHERE Concepto = 'ORDINARIO' GROUP BY ALL) d WHERE NOT EXISTS (SELECT 1 FROM expense_ordinary e
        WHERE e.ConsorcioID = d.ConsorcioID AND e.Periodo = d.Periodo AND e.Categoria = d.Categoria)""",
    "prorate_month": _prorated(),
    "prorate_month_one": f"SELECT * FROM ({_prorated()}) WHERE Periodo = DATE '1997-04-01'",
    "financial_state": _state(),
    "load_two_months": _state().replace("FROM state", "FROM state_loaded"),
    "financial_state_one": f"SELECT * FROM ({_state()}) WHERE Periodo = DATE '1997-04-01'",
}


def oracle() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in QUERIES.items()}
