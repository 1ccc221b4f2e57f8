"""DataFrame operators: DataFrame in, DataFrame out, no actions unless marked †."""

from .monthly import (require, with_year_month, rename_all, monthly_mean, pivot_mean,
                      monthly_events, global_quantile, quantile_flag, quantile_table)
from .windows import (panel_window, add_lags, add_lead, pct_change, pct_change_col, rolling,
                      rolling_col, streak, with_group_mean, anomaly_vs_mean, latest_row)
from .dense import carry_forward, densify, interpolate, period_of
from .joins import join_master, with_labels, panel_spine, std_region_table
from .aggregates import (distribution, distinct_count, distinct_values, min_max, mean_by, sum_by,
                         count_where_by, kpis, entity_profile, period_series, histogram,
                         column_profile, non_null_counts)
from .sketches import distinct_from, distinct_sketches, label_counts, sketch_error
from .slices import (period_index, latest_period, trailing_months, top_k, sample_rows,
                     filter_positive, filter_abs_le, filter_panel, fill_zero,
                     lag_rolling_flag_columns, col_or, one_hot, month_cycle, time_trend,
                     select_features, select_covered, select_by_keyword, first_viable,
                     display_projection, FEED_COLUMNS, SNAPSHOT_COLUMNS,
                     DOWNLOAD_COLUMNS)

__all__ = [n for n in dir() if not n.startswith("_")]
