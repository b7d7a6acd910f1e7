"""The ledger's roles over star-schema tables of orders, customers and shipments.

Every role is a projection (and for expenses a key join) of whole tables. The
column expressions are plain SQL that other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
)

from strata.sources.tables import Tables, schema

# the columns the roles use, so that no file footer is read to plan a query
FILES = {
    "nation": schema(n_nationkey=IntegerType(), n_name=StringType()),
    "customer": schema(
        c_custkey=LongType(), c_name=StringType(), c_nationkey=IntegerType(), c_mktsegment=StringType()
    ),
    "supplier": schema(s_suppkey=LongType(), s_nationkey=IntegerType()),
    "part": schema(p_partkey=LongType(), p_type=StringType()),
    "orders": schema(
        o_orderkey=LongType(),
        o_custkey=LongType(),
        o_orderstatus=StringType(),
        o_totalprice=DoubleType(),
        o_orderdate=TimestampNTZType(),
        o_orderpriority=StringType(),
    ),
    "lineitem": schema(
        l_partkey=LongType(),
        l_suppkey=LongType(),
        l_extendedprice=DoubleType(),
        l_linestatus=StringType(),
        l_shipdate=TimestampNTZType(),
    ),
}

COLUMNS = {
    "payment": {
        "PagoID": "o_orderkey",
        "Fecha": "cast(o_orderdate as date)",
        "Importe": "cast(o_totalprice as decimal(18,2))",
        "Concepto": "case when o_orderpriority in ('1-URGENT','2-HIGH') then 'EXTRAORDINARIO' else 'ORDINARIO' end",
        "NroClaveUniformeID": "case when o_orderkey % 97 = 0 then null else lpad(cast(o_custkey as string),22,'0') end",
    },
    "account": {
        "NroClaveUniformeID": "lpad(cast(c_custkey as string),22,'0')",
        "PersonaID": "c_custkey - c_custkey % 2",
    },
    "person": {
        "PersonaID": "c_custkey",
        "DNI": "c_custkey + 10000000",
        "Nombre": "c_name",
        "Apellido": "c_mktsegment",
        "Mail": "case when c_custkey % 4 = 0 then null else concat(cast(c_custkey as string),'@example.org') end",
        "Telefono": "case when c_custkey % 6 = 0 then null else lpad(cast(c_custkey as string),10,'1') end",
        "EsPropietario": "c_custkey % 3 <> 0",
    },
    "unit": {
        "UnidadFuncionalID": "c_custkey",
        "ConsorcioID": "c_nationkey",
        "PropietarioID": "case when c_custkey % 11 = 0 then null else c_custkey - c_custkey % 2 end",
        "InquilinoID": "case when c_custkey % 5 = 0 then null when c_custkey % 7 = 0 then c_custkey - c_custkey % 2 else c_custkey - c_custkey % 2 + 2 end",
        "Piso": "case when c_custkey % 13 = 0 then null else cast(c_custkey % 10 as string) end",
        "Departamento": "substr('ABCDEF', cast(1 + c_custkey % 6 as int), 1)",
    },
    "building": {"ConsorcioID": "n_nationkey", "NombreDelConsorcio": "n_name"},
    "expense_ordinary": {
        "ConsorcioID": "s_nationkey",
        "Periodo": "cast(date_trunc('month', l_shipdate) as date)",
        "Categoria": "p_type",
        "Importe": "cast(l_extendedprice as decimal(18,2))",
    },
    "expense_extra": {
        "ConsorcioID": "s_nationkey",
        "Periodo": "cast(date_trunc('month', l_shipdate) as date)",
        "Importe": "cast(l_extendedprice as decimal(18,2))",
    },
    "balance": {
        "PersonaID": "o_custkey - o_custkey % 2",
        "ConsorcioID": "c_nationkey",
        "Periodo": "cast(date_trunc('month', o_orderdate) as date)",
        "SaldoActual": "cast(case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end as decimal(18,2))",
    },
}

# role: (fact table, condition on it, [(table, fact key, table key)])
SOURCES = {
    "payment": ("orders", None, []),
    "account": ("customer", None, []),
    "person": ("customer", None, []),
    "unit": ("customer", None, []),
    "building": ("nation", None, []),
    "expense_ordinary": (
        "lineitem",
        "l_linestatus = 'O'",
        [("supplier", "l_suppkey", "s_suppkey"), ("part", "l_partkey", "p_partkey")],
    ),
    "expense_extra": ("lineitem", "l_linestatus = 'F'", [("supplier", "l_suppkey", "s_suppkey")]),
    "balance": ("orders", None, [("customer", "o_custkey", "c_custkey")]),
}


def stand_ins(spark: SparkSession, path: str) -> Tables:
    def table(name: str) -> DataFrame:
        return spark.read.schema(FILES[name]).parquet(f"{path}/{name}.parquet")

    def read(role: str) -> DataFrame:
        fact, condition, dimensions = SOURCES[role]
        df = table(fact)
        if condition:
            df = df.where(condition)
        for dimension, fact_key, key in dimensions:
            other = table(dimension)
            df = df.join(other, df[fact_key] == other[key])
        return df.selectExpr(*[f"{sql} AS {name}" for name, sql in COLUMNS[role].items()])

    return Tables(read)
