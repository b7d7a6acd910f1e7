"""XML documents and the report table."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sources.tables import SCHEMAS

_REPORT = re.compile(r"[A-Za-z0-9_-]+")


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str, mode: str = "errorifexists") -> None:
    """Write rows as XML elements under a root; NULL fields are left out.

    Every task writes a document of its own with the same root. A short report
    is one task and one document; a long one is not forced through one task.
    """
    df.write.mode(mode).format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType) -> DataFrame:
    """The rows of all documents under ``path``; the schema keeps decimals exact."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def append_report(df: DataFrame, path: str, report: str | None = None) -> None:
    """Add rows to the chart report table, under the name of a ``report``.

    A job that is run again under its name, after a failure or by mistake,
    replaces the rows it added before, also by none; other reports keep theirs.
    Without a name the rows are added as often as this is called.
    """
    name = uuid.uuid4().hex if report is None else report
    if not _REPORT.fullmatch(name):
        raise ValueError("a report's name is made of letters, digits, - and _")
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/Informe=r-{name}")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all reports under ``path``."""
    columns = SCHEMAS["chart_report"]
    return spark.read.schema(columns).parquet(path).select(*columns.fieldNames())
