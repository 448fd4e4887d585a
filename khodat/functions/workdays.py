"""Working days: not Saturday, not Sunday, not a US federal holiday.

Everything is computed from the date itself, so the functions need no calendar table,
no join and no shuffle, whatever the number of rows.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers of the weekdays as dayofweek gives them.
SUNDAY, MONDAY, THURSDAY, FRIDAY, SATURDAY = 1, 2, 5, 6, 7

# Holidays on a weekday of a month as (month, weekday, first day, last day, first year).
WEEKDAY_HOLIDAYS = (
    (1, MONDAY, 15, 21, 1986),  # Martin Luther King Jr.
    (2, MONDAY, 15, 21, 0),  # Washington's Birthday
    (5, MONDAY, 25, 31, 0),  # Memorial Day
    (9, MONDAY, 1, 7, 0),  # Labor Day
    (10, MONDAY, 8, 14, 0),  # Columbus Day
    (11, THURSDAY, 22, 28, 0),  # Thanksgiving
)
# Holidays on a date as (month, day, day before, day after, first year). One that falls on a
# Saturday is kept on the Friday before, one on a Sunday on the Monday after.
DATE_HOLIDAYS = (
    (1, 1, 1231, 102, 0),
    (6, 19, 618, 620, 2021),
    (7, 4, 703, 705, 0),
    (11, 11, 1110, 1112, 0),
    (12, 25, 1224, 1226, 0),
)

# Keys are weekday * 10000 + month * 100 + day. No holiday, and no day next to one, touches the end of
# February, so the days around a key follow from any year.


def _key(weekday: int, month_day: int) -> int:
    return weekday * 10000 + month_day


def _shifted(key: int, days: int) -> int:
    """The key of the date ``days`` later."""
    weekday, month_day = divmod(key, 10000)
    later = dt.date(2001, *divmod(month_day, 100)) + dt.timedelta(days)
    return _key((weekday - 1 + days) % 7 + 1, later.month * 100 + later.day)


def _holidays() -> dict[int, list[int]]:
    """First year -> keys of the weekdays that are holidays from that year on."""
    keys: dict[int, list[int]] = {}
    for month, weekday, lo, hi, since in WEEKDAY_HOLIDAYS:
        keys.setdefault(since, []).extend(_key(weekday, month * 100 + d) for d in range(lo, hi + 1))
    for month, day, before, after, since in DATE_HOLIDAYS:
        found = keys.setdefault(since, [])
        found.extend(_key(weekday, month * 100 + day) for weekday in range(MONDAY, FRIDAY + 1))
        found += [_key(FRIDAY, before), _key(MONDAY, after)]
    return keys


HOLIDAY_KEYS = _holidays()


def _weekend_keys(weekday: int, shifts: tuple[int, int]) -> dict[int, list[int]]:
    """Keys of the Saturdays and Sundays next to a holiday on the given weekday."""
    return {
        since: [_shifted(k, n) for k in keys if k // 10000 == weekday for n in shifts]
        for since, keys in HOLIDAY_KEYS.items()
    }


BEFORE_MONDAY_HOLIDAY = _weekend_keys(MONDAY, (-2, -1))
AFTER_FRIDAY_HOLIDAY = _weekend_keys(FRIDAY, (1, 2))


def _col(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("date")


def _in(d: Column, keys_since: dict[int, list[int]]) -> Column:
    key = F.dayofweek(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return reduce(or_, [
        key.isin(*keys) if since == 0 else (F.year(d) >= since) & key.isin(*keys)
        for since, keys in keys_since.items()
    ])


def is_federal_holiday(date: Column | str) -> Column:
    return _in(_col(date), HOLIDAY_KEYS)


def is_workday(date: Column | str) -> Column:
    d = _col(date)
    return F.dayofweek(d).between(MONDAY, FRIDAY) & ~is_federal_holiday(d)


def next_workday(date: Column | str) -> Column:
    """First working day on or after the date.

    A weekend is at most one day longer than usual, and a holiday's next working day is the day after it or,
    from a Friday, the Monday: no two holidays lie that close together.
    """
    d = _col(date)
    weekday = F.dayofweek(d)
    weekend = F.when(weekday == SATURDAY, 2).otherwise(1) + F.when(_in(d, BEFORE_MONDAY_HOLIDAY), 1).otherwise(0)
    holiday = F.when(weekday == FRIDAY, 3).otherwise(1)
    return F.date_add(
        d, F.when(weekday.isin(SATURDAY, SUNDAY), weekend).when(is_federal_holiday(d), holiday).otherwise(0)
    )


def previous_workday(date: Column | str) -> Column:
    """Last working day on or before the date."""
    d = _col(date)
    weekday = F.dayofweek(d)
    weekend = F.when(weekday == SUNDAY, 2).otherwise(1) + F.when(_in(d, AFTER_FRIDAY_HOLIDAY), 1).otherwise(0)
    holiday = F.when(weekday == MONDAY, 3).otherwise(1)
    return F.date_sub(
        d, F.when(weekday.isin(SATURDAY, SUNDAY), weekend).when(is_federal_holiday(d), holiday).otherwise(0)
    )


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _one_day_from(start: Column) -> Column:
    return F.when(
        start.isNotNull(), F.struct(start.alias("start"), (start + F.expr("interval 1 day")).alias("end"))
    )


def previous_workday_interval(run_after: Column | str) -> Column:
    """The day a run at ``run_after`` covers: the last working day before it, as (start, end)."""
    return _bound(_ntz(previous_workday(F.date_sub(_col(run_after), 1))), _one_day_from)


def next_run_interval(
    last_start: Column | str,
    earliest: Column | str | None = None,
    latest: Column | str | None = None,
    today: Column | str | None = None,
) -> Column:
    """The next day to run as (start, end), NULL when there is none.

    After a previous run it is the first working day after ``last_start``. Without one it is the first working
    day from ``earliest``, moved up to midnight; with ``today`` given (no catching up) from the later of
    ``earliest`` and today's midnight, keeping the time of day. Nothing is due after ``latest``.
    """
    first = F.lit(None).cast("timestamp_ntz")
    if earliest is not None:
        first = _ntz(earliest)
        if today is not None:
            first = F.when(first.isNotNull(), F.greatest(first, _ntz(_col(today))))
        else:
            first = _ntz(F.date_add(first.cast("date"), F.when(first > _ntz(first.cast("date")), 1).otherwise(0)))
    moment = F.coalesce(_ntz(F.date_add(_col(last_start), 1)), first)

    def on_workday(m: Column) -> Column:
        day = m.cast("date")
        return _ntz(next_workday(day)) + (m - _ntz(day))

    start = _bound(moment, on_workday)
    if latest is not None:
        bound = _ntz(latest)
        start = _bound(start, lambda s: F.when(bound.isNull() | (s <= bound), s))
    return _bound(start, _one_day_from)
