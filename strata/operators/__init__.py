from strata.operators.aggregates import (
    conditional_sums,
    json_columns,
    pivot_sum,
    share_of_total,
    sum_by,
    sum_having,
    union_sum,
)
from strata.operators.filters import date_range, optional_equal, unless_exists
from strata.operators.joins import (
    broadcast_if_small,
    explode_keys,
    is_small,
    match_any_key,
    measured_bytes,
    row_bytes,
)
from strata.operators.ranking import top_n
from strata.operators.windows import next_in_group, overall_average, running_total

__all__ = [
    "broadcast_if_small",
    "conditional_sums",
    "date_range",
    "explode_keys",
    "is_small",
    "json_columns",
    "match_any_key",
    "measured_bytes",
    "next_in_group",
    "optional_equal",
    "overall_average",
    "pivot_sum",
    "row_bytes",
    "running_total",
    "share_of_total",
    "sum_by",
    "sum_having",
    "top_n",
    "union_sum",
    "unless_exists",
]
