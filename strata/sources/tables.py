"""The ledger's tables by role, and their schemas."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

AMOUNT = DecimalType(18, 2)


def schema(**columns: DataType) -> StructType:
    made = StructType()
    for name, kind in columns.items():
        made.add(name, kind)
    return made


SCHEMAS = {
    "payment": schema(
        PagoID=LongType(),
        Fecha=DateType(),
        Importe=AMOUNT,
        Concepto=StringType(),
        NroClaveUniformeID=StringType(),
    ),
    "account": schema(NroClaveUniformeID=StringType(), PersonaID=LongType()),
    "unit": schema(
        UnidadFuncionalID=LongType(),
        ConsorcioID=IntegerType(),
        PropietarioID=LongType(),
        InquilinoID=LongType(),
        Piso=StringType(),
        Departamento=StringType(),
    ),
    "building": schema(ConsorcioID=IntegerType(), NombreDelConsorcio=StringType()),
    "person": schema(
        PersonaID=LongType(),
        DNI=LongType(),
        Nombre=StringType(),
        Apellido=StringType(),
        Mail=StringType(),
        Telefono=StringType(),
        EsPropietario=BooleanType(),
    ),
    "expense_ordinary": schema(
        ConsorcioID=IntegerType(), Periodo=DateType(), Categoria=StringType(), Importe=AMOUNT
    ),
    "expense_extra": schema(ConsorcioID=IntegerType(), Periodo=DateType(), Importe=AMOUNT),
    "balance": schema(
        PersonaID=LongType(), ConsorcioID=IntegerType(), Periodo=DateType(), SaldoActual=AMOUNT
    ),
    "financial_state": schema(
        ConsorcioID=IntegerType(),
        Periodo=DateType(),
        Ingresos=AMOUNT,
        Egresos=AMOUNT,
        Resultado=AMOUNT,
        SaldoCierre=AMOUNT,
    ),
    "import_log": schema(
        Origen=StringType(), Leidos=LongType(), Aceptados=LongType(), Rechazados=LongType()
    ),
    "import_reject": schema(
        Origen=StringType(), Registro=StringType(), Motivo=StringType(), Veces=LongType()
    ),
    "chart_report": schema(
        ConsorcioID=IntegerType(),
        PeriodoAnio=IntegerType(),
        PeriodoMes=IntegerType(),
        URLApi=StringType(),
    ),
}


DIRECTORIES = ("Anio", "Mes")


def _role(name: str) -> property:
    return property(lambda self: self[name])


class Tables:
    """One DataFrame per role, opened on first use."""

    def __init__(self, read: Callable[[str], DataFrame], laid_out: bool = False):
        self._read = read
        self._laid_out = laid_out
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, role: str) -> DataFrame:
        if role not in self._opened:
            self._opened[role] = self._read(role)
        return self._opened[role]

    def directories(self, role: str) -> tuple[str, str] | None:
        """The year and month columns that a role's directories are named by, if it has such."""
        found = set(self[role].columns) - set(SCHEMAS[role].fieldNames()) if self._laid_out else set()
        return DIRECTORIES if set(DIRECTORIES) <= found else None

    payment = _role("payment")
    account = _role("account")
    unit = _role("unit")
    building = _role("building")
    person = _role("person")
    expense_ordinary = _role("expense_ordinary")
    expense_extra = _role("expense_extra")
    balance = _role("balance")

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> Tables:
        """Tables written as ``path/<role>``; the schema is given, not read from footers."""
        return cls(lambda role: spark.read.schema(SCHEMAS[role]).parquet(f"{path}/{role}"), laid_out=True)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Tables:
        """Catalog tables, by role."""
        return cls(lambda role: spark.table(names[role]))

    @classmethod
    def of(cls, **frames: DataFrame) -> Tables:
        return cls(frames.__getitem__)
