"""Time expressions: tolerant parsing, local days and half-open periods."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Layouts besides ISO ones, without a weekday before them.
LAYOUTS = ("MMM d HH:mm:ss Z yyyy", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")


@dataclass(frozen=True)
class Period:
    """[start, end); an open end only in the last one."""

    name: str
    start: date
    end: date | None = None


def checked(periods: Sequence[Period]) -> list[Period]:
    """The periods in order; raises on empty or repeated names, disorder, overlap and an open end before the last."""
    out = sorted(periods, key=lambda p: p.start)
    if not out:
        raise ValueError("no periods")
    if len({p.name for p in out}) < len(out) or not all(p.name.strip() for p in out):
        raise ValueError("period names must be unique and not empty")
    for k, p in enumerate(out):
        if p.end is None and k < len(out) - 1:
            raise ValueError(f"only the last period may be open: {p.name}")
        if p.end is not None and p.end <= p.start:
            raise ValueError(f"period {p.name} ends before it starts")
        if k and out[k - 1].end > p.start:
            raise ValueError(f"periods {out[k - 1].name} and {p.name} overlap")
    return out


def utc(x: Column) -> Column:
    """A timestamp from text of mixed layouts, in UTC where it names no zone: ISO dates and times, month/day/year, and dates with the
    name of the month before or after the day; null where it cannot be read."""
    bare = F.regexp_replace(F.trim(x.cast("string")), r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+", "")
    return F.coalesce(x.try_cast("timestamp"), *[F.try_to_timestamp(bare, F.lit(f)) for f in LAYOUTS])


def zone(name: str) -> str:
    """The zone if it is known, else UTC."""
    try:
        ZoneInfo(name)
    except Exception:  # noqa: BLE001  zoneinfo raises several kinds
        return "UTC"
    return name


def local_day(ts: Column, zone_name: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone(zone_name)))


def period_of(day: Column, periods: Sequence[Period]) -> Column:
    """The name of the first period that holds the day, null outside all: a CASE, so no range join."""
    out = None
    for p in periods:
        inside = day >= F.lit(p.start)
        inside = inside if p.end is None else inside & (day < F.lit(p.end))
        out = F.when(inside, p.name) if out is None else out.when(inside, p.name)
    return F.lit(None).cast("string") if out is None else out
