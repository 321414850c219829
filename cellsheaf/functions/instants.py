"""Time expressions. All instants are TIMESTAMP_NTZ holding UTC, whatever the session zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(s: Column) -> Column:
    """ISO text to UTC; text without an offset counts as UTC, unparsable text gives NULL."""
    with_zone = F.when(s.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), s).otherwise(F.concat(s, F.lit("Z")))
    micros = F.unix_micros(F.try_to_timestamp(with_zone))
    return _epoch_plus(micros)


def _epoch_plus(micros: Column) -> Column:
    seconds = micros.cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def month_start(t: Column) -> Column:
    return F.trunc(t, "MM").cast("timestamp_ntz")


def year_start(t: Column) -> Column:
    return F.trunc(t, "YYYY").cast("timestamp_ntz")


def day_start(t: Column) -> Column:
    return t.cast("date").cast("timestamp_ntz")


def slot_of(t: Column, cadence: Column) -> Column:
    """First instant of the period t falls in, by the cadence of its source."""
    return (
        F.when(cadence == "monthly", month_start(t))
        .when(cadence == "yearly", year_start(t))
        .when(cadence == "daily", day_start(t))
    )


def slot_stamp(year: Column, month: Column | None = None) -> Column:
    return F.make_date(year, F.lit(1) if month is None else month, F.lit(1)).cast("timestamp_ntz")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def in_days(t: Column, first: Column, last: Column) -> Column:
    """Both end days count whole. Comparing raw t keeps the filter pushable."""
    after = F.date_add(last.cast("date"), 1).cast("timestamp_ntz")
    return (t >= day_start(first)) & (t < after)


def contained(start: Column, end: Column, first: Column, last: Column) -> Column:
    return (start >= first) & (end <= last)


def in_extent(t: Column, first: Column, last: Column) -> Column:
    """Day extent closed on the left and open on the right."""
    return (t >= day_start(first)) & (t < day_start(last))


def stamp(t: Column) -> Column:
    """Compact time text (yyyyMMddTHHmmss) used in output names, free of the session zone."""
    return F.translate(F.substring(t.cast("string"), 1, 19), " -:", "T")


def year_text(t: Column) -> Column:
    return F.substring(stamp(t), 1, 4)


def month_text(t: Column) -> Column:
    return F.substring(stamp(t), 1, 6)


def parse_stamp(s: Column) -> Column:
    """Inverse of stamp; NULL when the text has another form."""
    ok = s.rlike(r"^\d{8}T\d{6}$")
    iso = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6")
    return F.when(ok, parse_iso(iso))


def parse_day(s: Column) -> Column:
    ok = s.rlike(r"^\d{8}$")
    iso = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3T00:00:00")
    return F.when(ok, parse_iso(iso))
