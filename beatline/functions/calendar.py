"""Calendar column functions (E1-E10). All are built-in expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season of each month (1=winter, 2=spring, 3=summer, 4=fall).
SEASON_OF_MONTH = {12: 1, 1: 1, 2: 1,
                   3: 2, 4: 2, 5: 2,
                   6: 3, 7: 3, 8: 3,
                   9: 4, 10: 4, 11: 4}

# Rush-hour windows, hours inclusive at both ends.
RUSH_HOURS = [(7, 9), (16, 19)]
# Weekend days in 1=Sunday .. 7=Saturday numbering.
WEEKEND_DAYS = [1, 7]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_parts(ts) -> list[Column]:
    """year, month, day_of_week (1=Sunday..7=Saturday) and hour_of_day."""
    ts = _c(ts)
    return [F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofweek(ts).alias("day_of_week"), F.hour(ts).alias("hour_of_day")]


def as_flag(c) -> Column:
    """Boolean as 0/1 integer (null stays null)."""
    return _c(c).cast("int")


def is_rush_hour(hour) -> Column:
    hour = _c(hour)
    cond = None
    for lo, hi in RUSH_HOURS:
        part = hour.between(lo, hi)
        cond = part if cond is None else (cond | part)
    return F.when(cond, 1).otherwise(0)


def is_weekend(day_of_week) -> Column:
    return F.when(_c(day_of_week).isin(WEEKEND_DAYS), 1).otherwise(0)


def season(month, strict: bool = False) -> Column:
    """Season number of a month.

    ``strict=False`` is the CASE chain: any month outside winter, spring and
    summer is fall (4). ``strict=True`` is the dictionary lookup: a month
    outside 1..12 gives null.
    """
    month = _c(month)
    if strict:
        lookup = F.create_map(*[F.lit(x) for x in chain(*SEASON_OF_MONTH.items())])
        return lookup[month]
    by_season: dict[int, list[int]] = {}
    for m, s in SEASON_OF_MONTH.items():
        by_season.setdefault(s, []).append(m)
    last = max(by_season)
    expr = None
    for s in sorted(by_season):
        if s == last:
            break
        cond = month.isin(by_season[s])
        expr = F.when(cond, s) if expr is None else expr.when(cond, s)
    return expr.otherwise(last)


def district_hour(district, hour) -> Column:
    """Interaction code district * 100 + hour."""
    return _c(district) * 100 + _c(hour)
