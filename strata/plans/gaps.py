"""Days between the payments of a unit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import format_dmy
from strata.operators import next_in_group
from strata.plans.collection import UNIT_NAME, payments_by_unit, scope
from strata.sources.tables import Tables


def payment_gaps(
    tables: Tables,
    building_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Each payment with the next one of the same unit label, ordered by date."""
    payments = payments_by_unit(tables, "gaps", building_id, start, end)
    key = ["PagoID", "UnidadFuncionalID"]
    paired = next_in_group(payments, ["ConsorcioID", UNIT_NAME], "Fecha", key, "_next")
    shown = paired.orderBy(*scope(building_id), UNIT_NAME, "Fecha", *key)
    return shown.select(
        *scope(building_id),
        UNIT_NAME,
        format_dmy(F.col("Fecha")).alias("FechaDePago"),
        "Importe",
        format_dmy(F.col("_next")).alias("FechaSiguientePago"),
        F.datediff("_next", "Fecha").alias("DiasHastaSiguientePago"),
    )
