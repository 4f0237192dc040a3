from .detectors import cap_per_key_per_day, fail_pairs, fail_runs, order_pay_status, running_count_per_day
from .distinct import first_sights, merged_unique_count, running_unique_count, unique_count, window_bitmaps
from .joins import connected, interval_join, prefixed, reconcile, window_join
from .outputs import parquet_sink, split_outputs, tagged, write_outputs
from .patterns import Step, match_sequence
from .ranking import latest_per_key, ranked_report, top_n
from .windows import (
    page_views,
    sliding_ends,
    windowed_agg,
    windowed_avg,
    windowed_count,
    windowed_distinct,
    windowed_extremes,
)

__all__ = [
    "Step",
    "cap_per_key_per_day",
    "connected",
    "fail_pairs",
    "fail_runs",
    "first_sights",
    "interval_join",
    "latest_per_key",
    "merged_unique_count",
    "match_sequence",
    "order_pay_status",
    "page_views",
    "parquet_sink",
    "prefixed",
    "ranked_report",
    "reconcile",
    "running_count_per_day",
    "running_unique_count",
    "sliding_ends",
    "split_outputs",
    "tagged",
    "top_n",
    "unique_count",
    "window_bitmaps",
    "window_join",
    "windowed_agg",
    "windowed_avg",
    "windowed_count",
    "windowed_distinct",
    "windowed_extremes",
    "write_outputs",
]
