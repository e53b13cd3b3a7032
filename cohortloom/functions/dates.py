"""Partial, mixed and local dates. All parsing is tolerant: bad text becomes NULL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
ISO_MONTH = r"^\d{4}-\d{2}$"
YEAR_ONLY = r"^\d{4}$"
GERMAN_DAY = r"^\d{2}\.\d{2}\.\d{4}$"
GERMAN_MONTH = r"^\d{2}\.\d{4}$"


def date_precision(text: Column | str) -> Column:
    c = _col(text)
    return (
        F.when(c.rlike(ISO_DAY) | c.rlike(GERMAN_DAY), F.lit("DAY"))
        .when(c.rlike(ISO_MONTH) | c.rlike(GERMAN_MONTH), F.lit("MONTH"))
        .when(c.rlike(YEAR_ONLY), F.lit("YEAR"))
    )


def parse_partial_date(text: Column | str, allow_datetime: bool = False) -> Column:
    """Exact day; the 15th of a month; 1 July of a year. An ISO datetime counts only on request."""
    c = _col(text)
    if allow_datetime:
        c = F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2})[T ].*$", "$1")
    return (
        F.when(c.rlike(ISO_DAY), F.try_to_date(c, "yyyy-MM-dd"))
        .when(c.rlike(ISO_MONTH), F.try_to_date(F.concat(c, F.lit("-15")), "yyyy-MM-dd"))
        .when(c.rlike(YEAR_ONLY), F.try_to_date(F.concat(c, F.lit("-07-01")), "yyyy-MM-dd"))
        .when(c.rlike(GERMAN_DAY), F.try_to_date(c, "dd.MM.yyyy"))
        .when(c.rlike(GERMAN_MONTH), F.try_to_date(F.concat(F.lit("15."), c), "dd.MM.yyyy"))
    )


def parse_mixed_date(text: Column | str, fill: str = "mid") -> Column:
    """Date text of unknown origin -> struct(raw, full, date, precision).

    Accepts ISO dates and datetimes, months and years (completed to the middle or the start),
    day-first text with dots, slashes or dashes, month-first where day-first is impossible,
    spreadsheet serials (20000 to 80000), and Unix seconds or milliseconds. Zero is not a date.
    """
    if fill not in ("mid", "start"):
        raise ValueError(f"fill must be 'mid' or 'start', not {fill!r}")
    month, year = ("-15", "-07-01") if fill == "mid" else ("-01", "-01-01")

    def parsed(full: Column) -> Column:
        number = F.when(full.rlike(r"^\d{1,15}$"), full.cast("bigint"))
        eight = F.when(
            full.rlike(r"^\d{8}$"),
            F.coalesce(F.try_to_date(full, "yyyyMMdd"), F.try_to_date(full, "ddMMyyyy")),
        )
        return F.coalesce(
            _let(F.regexp_replace(full, r"[./ ]", "-"), _dashed_date),
            eight,
            _let(number, _numeric_date),
        )

    def described(raw: Column, norm: Column) -> Column:
        precision = (
            F.when(norm.rlike(ISO_DAY), F.lit("day"))
            .when(norm.rlike(ISO_MONTH), F.lit("month"))
            .when(norm.rlike(YEAR_ONLY), F.lit("year"))
            .otherwise(F.lit("unknown"))
        )
        full = (
            F.when(norm.rlike(ISO_MONTH), F.concat(norm, F.lit(month)))
            .when(norm.rlike(YEAR_ONLY), F.concat(norm, F.lit(year)))
            .otherwise(norm)
        )
        return _let(
            full,
            lambda f: F.struct(
                raw.alias("raw"), f.alias("full"), parsed(f).alias("date"), precision.alias("precision")
            ),
        )

    return _let(
        F.nullif(F.trim(_col(text).cast("string")), F.lit("")),
        lambda raw: _let(
            F.regexp_replace(raw, r"^(\d{4}-\d{2}-\d{2}).*$", "$1"), lambda norm: described(raw, norm)
        ),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value computed once per row; without it every use repeats the expression,
    and a plan with several such columns outgrows what Spark compiles."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _dashed_date(dashed: Column) -> Column:
    return F.when(
        dashed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(dashed, "yyyy-M-d")
    ).when(
        dashed.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"),
        F.coalesce(F.try_to_date(dashed, "d-M-yyyy"), F.try_to_date(dashed, "M-d-yyyy")),
    )


def _numeric_date(number: Column) -> Column:
    return (
        F.when(
            number.between(20_000, 80_000),
            F.date_add(F.lit("1899-12-30").cast("date"), number.cast("int")),
        )
        .when(
            (number > 100_000_000) & (number <= 100_000_000_000),
            F.timestamp_seconds(number).cast("date"),
        )
        .when(number > 100_000_000_000, F.timestamp_millis(number).cast("date"))
    )


# How times are written, with the pattern that reads them and what they cover. A time
# of day alone is none of them: it says nothing of the day.
TIME_FORMS = [
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{1,2}:\d{2}", None, "instant"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd", "day"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy", "day"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}$", "d.M.yyyy H:mm", "instant"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}:\d{2}$", "d.M.yyyy H:mm:ss", "instant"),
    (r"^\d{4}-\d{2}$", "yyyy-MM", "month"),
    (r"^\d{1,2}\.\d{4}$", "M.yyyy", "month"),
    (r"^\d{4}$", "yyyy", "year"),
]


def time_span(value: Column | str, kind: str = "string") -> Column:
    """What a time covers, as struct(start, end, precision); NULL where it is none.

    ``start`` and ``end`` are the first and last microsecond since 1970, ``precision`` is instant,
    day, month or year. ``kind`` is the type of ``value``: timestamps, dates, or text in ISO or
    German form. Days that no calendar has are no times.
    """
    c = _col(value)
    if kind.startswith("timestamp"):
        return _let(F.unix_micros(c.cast("timestamp")), lambda t: F.when(t.isNotNull(), _span(t, t, "instant")))
    if kind == "date":
        return _let(c, lambda d: F.when(d.isNotNull(), _span(_midnight(d), _midnight(F.date_add(d, 1)) - 1, "day")))

    length = {
        "day": F.make_dt_interval(F.lit(1)),
        "month": F.make_ym_interval(F.lit(0), F.lit(1)),
        "year": F.make_ym_interval(F.lit(1), F.lit(0)),
    }

    def covered(precision: str) -> Callable[[Column], Column]:
        def body(at: Column) -> Column:
            end = F.unix_micros(at + length[precision]) - 1 if precision in length else F.unix_micros(at)
            return F.when(at.isNotNull(), _span(F.unix_micros(at), end, precision))

        return body

    def read(text: Column) -> Column:
        out: Column | None = None
        for pattern, form, precision in TIME_FORMS:
            at = text.try_cast("timestamp") if form is None else F.try_to_timestamp(text, F.lit(form))
            found = _let(at, covered(precision))
            test = text.rlike(pattern)
            out = F.when(test, found) if out is None else out.when(test, found)
        return out

    return _let(F.trim(c.cast("string")), read)


def _span(start: Column, end: Column, precision: str) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), F.lit(precision).alias("precision"))


def _midnight(day: Column) -> Column:
    return F.unix_micros(day.cast("timestamp"))


def prefix_date(text: Column | str) -> Column:
    """Date from the first ten characters."""
    return F.try_to_date(F.substring(_col(text), 1, 10), "yyyy-MM-dd")


def age_at(ref: Column | str, birth: Column | str, digits: int | None = 2) -> Column:
    years = F.datediff(_col(ref), _col(birth)) / F.lit(365.25)
    return years if digits is None else F.round(years, digits)


def months_since(later: Column | str, earlier: Column | str, digits: int = 2) -> Column:
    return F.round(F.months_between(_col(later), _col(earlier)), digits).cast("double")


def at_least_months_before(a: Column | str, b: Column | str, months: int) -> Column:
    """``a`` lies ``months`` calendar months or more before ``b`` (month ends clamped)."""
    return _col(a) <= F.add_months(_col(b), -months)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def shift_days(value: Column | str, days: int) -> Column:
    """Move a timestamp by whole days."""
    return _col(value) + F.make_dt_interval(F.lit(days))


def combine_date_time(date: Column | str, time: Column | str) -> Column:
    return F.try_to_timestamp(
        F.concat_ws(" ", _col(date), _col(time)), F.lit("dd.MM.yyyy HH:mm")
    )


def localize(local: Column | str, zone: str = "Europe/Berlin") -> Column:
    """Wall-clock time -> instant (session zone UTC).

    A time that occurs twice gives NULL; a time that was skipped gives the first valid instant.
    """
    x = _col(local).cast("timestamp")
    utc = F.to_utc_timestamp(x, zone)
    hour = F.make_dt_interval(hours=F.lit(1))
    twice = (F.from_utc_timestamp(utc + hour, zone) == x) | (
        F.from_utc_timestamp(utc - hour, zone) == x
    )
    skipped = F.from_utc_timestamp(utc, zone) != x
    return F.when(skipped, F.to_utc_timestamp(F.date_trunc("hour", x), zone)).when(~twice, utc)


def split_datetime(text: Column | str) -> tuple[Column, Column]:
    """``dd.MM.yyyy HH:mm`` -> (date text, time text)."""
    ts = F.try_to_timestamp(_col(text), F.lit("dd.MM.yyyy HH:mm"))
    return F.date_format(ts, "dd.MM.yyyy"), F.date_format(ts, "HH:mm")


# Range of 64-bit nanosecond clocks; dates outside (such as 9999-12-31) count as unparsable.
EARLIEST, LATEST = "1677-09-22", "2262-04-11"


def parse_iso(text: Column | str, mode: str = "coerce") -> Column:
    """ISO 8601 text -> timestamp. ``raise`` fails on bad text, ``coerce`` gives NULL."""
    c = _col(text)
    if mode == "raise":
        return c.cast("timestamp")
    ts = F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(c, F.lit("yyyy-MM")))
    return F.when(
        (ts >= F.lit(EARLIEST).cast("timestamp")) & (ts < F.lit(LATEST).cast("timestamp")), ts
    )


def parse_failed(text: Column | str) -> Column:
    """Text that is present but gives no timestamp."""
    return _col(text).isNotNull() & parse_iso(text).isNull()


def default_time_zone(text: Column | str, suffix: str = "T00:00:00+01:00") -> Column:
    """Date-only text is midnight of the given offset; full datetimes keep their own."""
    c = F.trim(_col(text))
    return parse_iso(F.when(c.rlike(r"[T ]"), c).otherwise(F.concat(c, F.lit(suffix))))


DAY_FIRST = [
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy HH:mm",
    "dd.MM.yyyy",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
]


def mixed_dayfirst(text: Column | str) -> Column:
    """ISO or German text, the day before the month."""
    c = _col(text)
    tries = [F.try_to_timestamp(c, F.lit(p)) for p in DAY_FIRST]
    return F.coalesce(F.when(c.rlike(r"^\d{4}-"), c.try_cast("timestamp")), *tries)


def birth_year(value: Column | str) -> Column:
    return F.year(_col(value))
