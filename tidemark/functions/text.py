"""Ranked text reports and alert messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import as_text


@dataclass(frozen=True)
class ReportFormat:
    """Text pieces around the values of a ranked report."""

    header: str
    entry: str
    metric: str
    footer: str


# The two report layouts.
ITEM_REPORT = ReportFormat(header="时间: ", entry=":商品ID", metric="点击量=", footer="=" * 14)
URL_REPORT = ReportFormat(header="时间", entry=": URL=", metric=" 点击量=", footer="=" * 15)

# Result messages.
PAID = "payed successfully"
PAID_LATE = "payed but already timeout"
TIMED_OUT = "time out"
PAID_UNKNOWN = "already payed but not found created log"


def over_limit_message(limit: int) -> str:
    return f"click over{limit}times today"


def login_fail_message(within_s: int) -> str:
    return f"login fail in {within_s} seconds"


def ranked_line(rank: Column, entry: Column, metric: Column, fmt: ReportFormat) -> Column:
    text = lambda c: c.cast("string")
    return F.concat(F.lit("NO"), text(rank), F.lit(fmt.entry), text(entry), F.lit(fmt.metric), text(metric))


def report_text(window_end: Column, lines: Column, fmt: ReportFormat) -> Column:
    """Header with the window end, one line per rank (already in order), closing rule."""
    head = F.concat(F.lit(fmt.header), as_text(window_end))
    return F.concat_ws("\n", head, lines, F.lit(fmt.footer))
