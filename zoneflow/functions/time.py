"""Wall-clock time expressions.

Every event time is ``TIMESTAMP_NTZ``.  Nothing here reads the session time
zone, so results are the same under UTC and under zones with daylight saving.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names in calendar order and the bounds of a business hour.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
FIRST_BUSINESS_HOUR, LAST_BUSINESS_HOUR = 8, 17
TWELVE_HOUR = (
    r"^(\d{1,2}/\d{1,2}/\d{4}|\d{4} [A-Za-z]{3} \d{1,2}) (0?[1-9]|1[0-2]):\d{2}:\d{2} [AaPp][Mm]$"
)

# Holidays on a set day of the year as (month, day) ...
FIXED_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))
# ... and holidays on a set weekday as (month, weekday, first day, last day).
FLOATING_HOLIDAYS = (
    (1, 0, 15, 21),   # third Monday of January
    (2, 0, 15, 21),   # third Monday of February
    (5, 0, 25, 31),   # last Monday of May
    (9, 0, 1, 7),     # first Monday of September
    (10, 0, 8, 14),   # second Monday of October
    (11, 3, 22, 28),  # fourth Thursday of November
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pick(names: tuple[str, ...], index: Column) -> Column:
    return F.get(F.split(F.lit(",".join(names)), ","), index.cast("int"))


def parse_timestamp(c: Column | str) -> Column:
    """Timestamp from ``06/02/2009 03:43:08 AM``, ``2026 Jul 04 01:02:03 PM`` or ISO text, else null.

    A 12-hour text is first turned into ISO text, then everything is cast to a
    timestamp without time zone; impossible dates give null instead of an error.
    """
    text = F.trim(_col(c))
    names = ",".join(m[:3].lower() for m in MONTHS)
    month = F.find_in_set(F.lower(F.substring(text, 6, 3)), F.lit(names)).cast("string")
    named = F.concat_ws("-", F.substring(text, 1, 4), month, F.substring_index(F.substring(text, 10, 2), " ", 1))
    slashed = F.regexp_replace(text, r"^(\d+)/(\d+)/(\d+) .*", "$3-$1-$2")
    day = F.when(F.substring(text, 5, 1) == " ", named).otherwise(slashed)
    clock = F.substring_index(text, " ", -2)
    hour = F.substring_index(clock, ":", 1).cast("int") % 12
    hour = hour + F.when(F.upper(F.right(text, F.lit(2))) == "PM", 12).otherwise(0)
    iso = F.concat(day, F.lit(" "), hour.cast("string"), F.substring(F.right(text, F.lit(9)), 1, 6))
    return F.when(text.rlike(TWELVE_HOUR), iso).otherwise(text).try_cast("timestamp_ntz")


def hour_of(day: str, hour: str) -> Column:
    """Wall-clock timestamp of an hour of a day, both given as SQL text."""
    return F.expr(f"cast({day} as timestamp_ntz) + make_dt_interval(0, {hour}, 0, 0)")


def floor_hour(ts: Column | str) -> Column:
    """Start of the wall-clock hour; ``date_trunc`` would return a zoned timestamp."""
    start = _col(ts).cast("date").cast("timestamp_ntz")
    zero = F.lit(0)
    return start + F.make_dt_interval(zero, F.hour(_col(ts)), zero, zero)


def day_name(weekday: Column | str) -> Column:
    """Name of a Monday-based weekday number; ``Unknown`` for anything else."""
    return F.coalesce(_pick(WEEKDAYS, _col(weekday)), F.lit("Unknown"))


def season(month: str) -> Column:
    """Season of a month number given as SQL text."""
    cases = " ".join(f"when {month} in {months} then '{name}'" for name, months in SEASONS.items())
    return F.expr(f"case {cases} end")


def _holiday_sql(day: str) -> str:
    codes = ", ".join(str(m * 100 + n) for m, n in FIXED_HOLIDAYS)

    def on_fixed(d: str) -> str:
        return f"month({d}) * 100 + day({d}) in ({codes})"

    floating = [
        f"(month({day}) = {m} and weekday({day}) = {w} and day({day}) between {first} and {last})"
        for m, w, first, last in FLOATING_HOLIDAYS
    ]
    observed = [
        f"(weekday({day}) = 4 and {on_fixed(f'date_add({day}, 1)')})",
        f"(weekday({day}) = 0 and {on_fixed(f'date_add({day}, -1)')})",
    ]
    return "(" + " or ".join([on_fixed(day), *observed, *floating]) + ")"


def is_holiday(day: str) -> Column:
    """US federal holiday by rule, the observed days of Saturday and Sunday holidays included.

    A closed form on the date, given as SQL text: no list of years to keep,
    broadcast or join.
    """
    return F.expr(_holiday_sql(day))


def holiday_dates(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Every holiday from the first to the last year, one row each."""
    days = spark.sql(
        "select explode(sequence(make_date(:first, 1, 1), make_date(:last, 12, 31))) holiday",
        args={"first": first_year, "last": last_year},
    )
    return days.filter(is_holiday("holiday"))


CALENDAR_PARTS = [
    "weekday", "month", "quarter", "is_weekend", "is_holiday", "is_business_hour", "is_after_hours",
]


def add_calendar_parts(df: DataFrame, day: str, hour: str) -> DataFrame:
    """Add calendar parts and flags of a date column and an hour column; null when these are null.

    The flags build on each other step by step, so the holiday rule is
    evaluated once per row and the generated code stays small enough for the
    JVM to compile.
    """
    parts = df.withColumns(
        {
            "weekday": F.weekday(day),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "is_weekend": F.weekday(day).isin(5, 6),
            "is_holiday": is_holiday(day),
        }
    )
    busy = F.col(hour).between(FIRST_BUSINESS_HOUR, LAST_BUSINESS_HOUR)
    return parts.withColumn("is_business_hour", busy & ~F.col("is_weekend") & ~F.col("is_holiday")).withColumn(
        "is_after_hours", ~F.col("is_business_hour")
    )


def add_calendar(df: DataFrame, ts: str = "event_datetime") -> DataFrame:
    """Add the hour key, date, calendar parts, season and the four time flags of an event time."""
    dated = df.withColumns(
        {"weather_hour": floor_hour(ts), "event_date": F.col(ts).cast("date"), "event_hour": F.hour(ts)}
    )
    named = {
        "weekday_name": _pick(WEEKDAYS, F.weekday("event_date")),
        "month_name": _pick(MONTHS, F.month("event_date") - 1),
        "year": F.year("event_date"),
        "season": season("month(event_date)"),
    }
    return add_calendar_parts(dated.withColumns(named), "event_date", "event_hour")


def period(day: Column | str) -> Column:
    """``YYYY-MM`` of a date."""
    return F.substring(_col(day).cast("date").cast("string"), 1, 7)


def add_period(df: DataFrame, day: str = "date") -> DataFrame:
    """Add period, year and month of a date column."""
    d = F.col(day).cast("date")
    return df.withColumns({"period": period(day), "year": F.year(d), "month": F.month(d)})


def iso_text(c: Column | str) -> Column:
    """Timestamp as ``YYYY-MM-DD HH:MM:SS`` text."""
    return F.substring(_col(c).cast("timestamp_ntz").cast("string"), 1, 19)


def epoch_seconds(c: Column | str) -> Column:
    """Seconds since 1970-01-01 of a wall-clock timestamp, read as if it were UTC."""
    return F.unix_seconds(ntz_to_instant(c))


def ntz_to_instant(c: Column | str) -> Column:
    """Zoned timestamp with the same UTC clock reading, for operators that refuse NTZ."""
    return F.concat(_col(c).cast("string"), F.lit("Z")).cast("timestamp")


def instant_to_ntz(c: Column | str) -> Column:
    """Inverse of :func:`ntz_to_instant`."""
    micros = F.unix_micros(_col(c)).cast("decimal(20,0)")
    zero = F.lit(0)
    seconds = (micros / 1000000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
