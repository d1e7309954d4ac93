"""Numbers as people read them; what is missing is a dash or n/a."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(n: float | None) -> str:
    return "–" if n is None else f"{n:,.0f}"


def percent(share: float | None, digits: int = 0) -> str:
    return "n/a" if share is None else f"{100 * share:.{digits}f}%"


def ratio(part: float | None, whole: float | None, digits: int = 0) -> str:
    """part of whole in percent."""
    return "n/a" if part is None or not whole else percent(part / whole, digits)


def clock(seconds: float | None) -> str:
    """Minutes and seconds."""
    return "–" if seconds is None else f"{int(seconds) // 60}:{int(seconds) % 60:02d}"


def thousands_column(n: Column) -> Column:
    return F.coalesce(F.format_number(n, 0), F.lit("–"))


def percent_column(part: Column, whole: Column, digits: int = 0) -> Column:
    share = F.try_divide(part * 100, whole)
    return F.coalesce(F.concat(F.format_number(share, digits), F.lit("%")), F.lit("n/a"))
