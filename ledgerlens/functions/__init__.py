from ledgerlens.functions.exprs import (  # noqa: F401
    INF, clip, count_if, days_to_years, fill, flag, ieee_div, inf_to_null,
    map_values, null_if_sentinel, product, row_max, row_mean, row_min,
    row_sum0, safe_div, safe_log1p, safe_sqrt, sentinel_flag, smooth_div, sum0, weighted_sum0,
)
