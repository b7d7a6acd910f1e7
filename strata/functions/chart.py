"""Text of the doughnut chart: configuration and URL, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.fixed import (
    CHART_BACKGROUND,
    CHART_CLOSE,
    CHART_COLORS,
    CHART_DATA,
    CHART_DATA_END,
    CHART_ENDPOINT,
    CHART_OPEN,
    CHART_OPTIONS,
    CHART_OPTIONS_END,
    CHART_OPTIONS_STRICT,
    CHART_SIZE,
    CHART_TITLE,
    CHART_TITLE_MONTH,
    CHART_TITLE_YEAR,
)


def chart_title(building: Column, year: Column, month: Column) -> Column:
    return F.concat(
        F.lit(CHART_TITLE),
        building,
        F.lit(CHART_TITLE_MONTH),
        month.try_cast("string"),
        F.lit(CHART_TITLE_YEAR),
        year.try_cast("string"),
    )


def chart_config(labels: Column, values: Column, title: Column, strict: bool = False) -> Column:
    """Chart configuration around two JSON arrays.

    The plain form leaves the option keys unquoted and the title as it is;
    ``strict`` quotes both, so that the text parses as JSON.
    """
    colors = "[" + ",".join(f'"{color}"' for color in CHART_COLORS) + "]"
    if strict:
        # a JSON string literal is what stands between the brackets of a one-element array
        quoted = F.regexp_replace(F.to_json(F.array(title)), r"^\[|\]$", "")
        options = F.concat(F.lit(CHART_OPTIONS_STRICT), quoted)
    else:
        options = F.concat(F.lit(CHART_OPTIONS), title, F.lit(CHART_OPTIONS_END))
    return F.concat(
        F.lit(CHART_OPEN),
        labels,
        F.lit(CHART_DATA),
        values,
        F.lit(CHART_BACKGROUND + colors + CHART_DATA_END),
        options,
        F.lit(CHART_CLOSE),
    )


def chart_url(config: Column, encode: bool = False) -> Column:
    return F.concat(
        F.lit(CHART_ENDPOINT), F.url_encode(config) if encode else config, F.lit(CHART_SIZE)
    )
