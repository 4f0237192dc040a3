from .hashing import BITMAP_BITS, HASH_BASE, bitmap_position
from .text import ITEM_REPORT, URL_REPORT, ReportFormat
from .time import (
    as_text,
    event_time,
    gap_seconds,
    next_utc_midnight,
    reject_future,
    seconds,
    utc_day,
    window_ends,
    with_event_time,
)

__all__ = [
    "BITMAP_BITS",
    "HASH_BASE",
    "ITEM_REPORT",
    "URL_REPORT",
    "ReportFormat",
    "as_text",
    "bitmap_position",
    "event_time",
    "gap_seconds",
    "next_utc_midnight",
    "reject_future",
    "seconds",
    "utc_day",
    "window_ends",
    "with_event_time",
]
