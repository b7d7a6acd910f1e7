"""Text expressions: unit labels and concept tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.fixed import LABEL_STYLES


def unit_label(style: str) -> Column:
    """Building name, floor and letter in one text; NULL if any part is NULL."""
    before_floor, before_letter = LABEL_STYLES[style]
    return F.concat(
        F.col("NombreDelConsorcio"),
        F.lit(before_floor),
        F.col("Piso"),
        F.lit(before_letter),
        F.col("Departamento"),
    )


def concept_is(concept: str, ignore_case: bool = False) -> Column:
    column = F.col("Concepto")
    return F.upper(column) == concept.upper() if ignore_case else column == concept
