"""Site timestamps: ``Fri Nov 18 16:39:14 +0800 2022``.

Spark 3+ cannot parse the weekday field, so the parse drops the first four
characters.  Year and month are read from the text, in the written offset,
exactly like splitting the string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations and their numbers.
MONTHS = {
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6,
    "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}
# Fixed value: the site's text pattern without the weekday.
SITE_PATTERN = "MMM dd HH:mm:ss Z yyyy"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def created_ts(s: Column | str) -> Column:
    """Instant (TIMESTAMP) of a site time text; NULL when it is not one."""
    return F.try_to_timestamp(F.substring(_c(s), 5, 1 << 20), F.lit(SITE_PATTERN))


def created_year(s: Column | str) -> Column:
    """Year as written: the last four characters as a number."""
    return F.right(_c(s), F.lit(4)).try_cast("int")


def created_month(s: Column | str) -> Column:
    """Month as written: the second space-separated word, by name."""
    month_map = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(month_map, F.try_element_at(F.split(_c(s), " "), F.lit(2)))


def parse_created_at(s: Column | str) -> Column:
    """``struct(ts, year, month)`` of a site time text."""
    return F.struct(created_ts(s).alias("ts"), created_year(s).alias("year"),
                    created_month(s).alias("month"))


def site_time_text(ts: Column | str, offset_hours: int = 8) -> Column:
    """Render an instant (or UTC wall time) as site text in a fixed offset."""
    sign = "+" if offset_hours >= 0 else "-"
    zone = f"{sign}{abs(offset_hours):02d}:00"
    label = f"{sign}{abs(offset_hours):02d}00"
    local = F.from_utc_timestamp(_c(ts).cast("timestamp"), zone)
    return F.date_format(local, f"EEE MMM dd HH:mm:ss '{label}' yyyy")
