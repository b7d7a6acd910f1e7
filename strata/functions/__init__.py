from strata.functions.calendar import (
    calendar_year,
    format_dmy,
    iso_week,
    month_bounds,
    month_name_es,
    month_span,
)
from strata.functions.labels import concept_is, unit_label

__all__ = [
    "calendar_year",
    "concept_is",
    "format_dmy",
    "iso_week",
    "month_bounds",
    "month_name_es",
    "month_span",
    "unit_label",
]
