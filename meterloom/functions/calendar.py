"""Calendar columns.  Keys stay in UTC; local time is derived, never joined on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import LOCAL_TZ

# Display names.
MONTH_NAMES = (
    "Jan", "Feb", "Mär", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dez",
)
WEEKDAY_HEADERS = ("Mo", "Di", "Mi", "Do", "Fr", "Sa", "So")
WEEKDAY_NAMES = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)

# Base column and period of each cyclic feature pair.
CYCLES = (
    ("month", "month", 12),
    ("weekday", "weekday", 7),
    ("hour", "local_hour", 24),
    ("day_of_year", "day_of_year", 365),
)

# National Swiss holidays as (month, day), and as days after Easter Sunday.
FIXED_HOLIDAYS = {"new_year": (1, 1), "national_day": (8, 1), "christmas": (12, 25)}
EASTER_HOLIDAYS = {"ascension": 39}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_local(ts: str | Column, tz: str = LOCAL_TZ) -> Column:
    """Wall-clock stamp of a UTC stamp (the session zone is UTC)."""
    return F.from_utc_timestamp(_col(ts), tz)


def to_utc(local: str | Column, tz: str = LOCAL_TZ) -> Column:
    """UTC stamp of a wall-clock stamp."""
    return F.to_utc_timestamp(_col(local), tz)


def without_zone(ts: str | Column) -> Column:
    """The same stamp as a type without zone."""
    return _col(ts).cast("timestamp_ntz")


def calendar_parts(ts: str | Column) -> dict[str, Column]:
    """Year, month, day, weekday (0 = Monday), day of year, quarter and ISO week of a stamp."""
    t = _col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "weekday": F.weekday(t),
        "day_of_year": F.dayofyear(t),
        "quarter": F.quarter(t),
        "week": F.weekofyear(t),
    }


def local_parts(ts: str | Column = "ts", tz: str = LOCAL_TZ) -> dict[str, Column]:
    """Local date, local time of day and local hour."""
    local = to_local(ts, tz)
    return {
        "local_date": F.to_date(local),
        "local_time": F.date_format(local, "HH:mm:ss"),
        "local_hour": F.hour(local),
    }


def day_flags(weekday: str | Column = "weekday") -> dict[str, Column]:
    """Sunday is weekday 6, a workday is Monday to Friday; Saturday is neither."""
    w = _col(weekday)
    return {"is_sunday": (w == 6).cast("int"), "is_workday": (w < 5).cast("int")}


def day_name(ts: str | Column) -> Column:
    """English weekday name."""
    return F.date_format(_col(ts), "EEEE")


def month_name(month: str | Column) -> Column:
    """Short month name of a month number."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), _col(month).cast("int"))


def season(month: str | Column) -> Column:
    """Season number of a month: winter (December to February) 1 … autumn 4."""
    return F.floor((_col(month) % 12) / 3).cast("int") + 1


def cyclic(value: str | Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of the position of ``value`` in its period."""
    angle = F.lit(2.0) * F.pi() * _col(value) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def add_cyclic(df: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Add the missing ``<name>_sin`` / ``<name>_cos`` pairs; an absent base column is an error.

    ``only`` names the wanted feature columns; by default all four pairs.
    """
    new: dict[str, Column] = {}
    for name, base, period in CYCLES:
        pair = (f"{name}_sin", f"{name}_cos")
        wanted = [p for p in pair if p not in df.columns and (only is None or p in only)]
        if not wanted:
            continue
        if base not in df.columns:
            raise KeyError(f"column {base!r} is needed for {wanted}")
        new.update({p: c for p, c in zip(pair, cyclic(base, period)) if p in wanted})
    return df.withColumns(new) if new else df


def easter_sunday(year: str | Column) -> Column:
    """Date of Easter Sunday by the Gregorian computus."""
    y = _col(year)

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b)

    golden = y % 19
    century = div(y, 100)
    in_century = y % 100
    skipped = century - div(century, 4) - div(century * 8 + 13, 25)
    epact = (golden * 19 + skipped + 15) % 30
    moon = epact - F.when(
        (epact == 29) | ((epact == 28) & (golden > 10)), F.lit(1)
    ).otherwise(F.lit(0))
    # Weekday of the Paschal full moon (0 = Sunday), counted from 21 March.
    march21 = (in_century + div(in_century, 4) + div(century, 4) - century * 2 + 2) % 7
    moon_day = F.pmod(march21 + moon, F.lit(7))
    return F.date_add(F.make_date(y, F.lit(3), F.lit(21)), (moon + 7 - moon_day).cast("int"))


def holiday_flags(day: str | Column) -> dict[str, Column]:
    """0/1 column for each national Swiss holiday."""
    d = _col(day)
    flags = {
        name: ((F.month(d) == m) & (F.dayofmonth(d) == dd)).cast("int")
        for name, (m, dd) in FIXED_HOLIDAYS.items()
    }
    easter = easter_sunday(F.year(d))
    for name, offset in EASTER_HOLIDAYS.items():
        flags[name] = (d == F.date_add(easter, offset)).cast("int")
    return flags


def is_holiday(day: str | Column) -> Column:
    """1 on a national Swiss holiday, else 0."""
    return F.greatest(*holiday_flags(day).values())
