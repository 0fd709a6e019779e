"""Date helpers (H1-H7) and the four week conventions of the reference.

All week functions are pure date arithmetic on ``dayofweek`` (1 = Sunday ..
7 = Saturday), so they do not depend on the session time zone and stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_MODES = ("monday", "sunday_start", "mon_sun_label", "sunday_end")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c) -> Column:
    """H3: timestamp -> date."""
    return F.to_date(_col(c))


def week_monday(c) -> Column:
    """H1: Monday of the week containing the date."""
    d = F.to_date(_col(c))
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


def week_sunday_start(c) -> Column:
    """H2: Sunday on or before the date (week starts on Sunday)."""
    d = F.to_date(_col(c))
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_sunday_end(c) -> Column:
    """Sunday on or after the date (weeks labelled by their closing Sunday)."""
    d = F.to_date(_col(c))
    return F.date_add(d, (8 - F.dayofweek(d)) % 7)


def week_mon_sun_label(c) -> Column:
    """H7: ``'YYYY-MM-DD/YYYY-MM-DD'`` label of the Monday-Sunday period."""
    m = week_monday(c)
    return F.concat_ws("/", F.date_format(m, "yyyy-MM-dd"),
                       F.date_format(F.date_add(m, 6), "yyyy-MM-dd"))


def week_key(c, mode: str) -> Column:
    """Dispatch on the week convention name."""
    if mode == "monday":
        return week_monday(c)
    if mode == "sunday_start":
        return week_sunday_start(c)
    if mode == "sunday_end":
        return week_sunday_end(c)
    if mode == "mon_sun_label":
        return week_mon_sun_label(c)
    raise ValueError(f"week mode must be one of {WEEK_MODES}")


def day_string(c) -> Column:
    """H4: ``formatDateTime('%Y-%m-%d')``."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def days_between(start, end) -> Column:
    """H5: ``dateDiff('day', start, end)`` = end - start in days."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def parse_time(c, day_first: bool = False) -> Column:
    """A2: parse a timestamp string; unparsable values become NULL."""
    fmts = (["dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy"] if day_first
            else ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd"])
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)) for f in fmts])
