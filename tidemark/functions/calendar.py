"""Calendar rules as Columns: report days, weeks, fortnights, presets. Weekdays count from Monday = 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Downloads before this local hour belong to the day before.
CUTOFF_HOUR = 3
#: Month names in file names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
THURSDAY = 3


def report_day(report_date: Column, published_at: Column) -> Column:
    """The one report day: the stored date, or else the UTC day of publication (session time zone UTC)."""
    return F.coalesce(report_date, F.to_date(published_at))


def _month_number(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(name)).cast("int")


def named_day(file_name: Column) -> Column:
    """struct(day, month, year) that a file name tells, or null: `_DDMM.pdf`, then `D Month YYYY`, then `Month D, YYYY`; year is null in the first form."""
    months = "|".join(MONTHS)
    #: The three forms.
    forms = [
        (r"(?i)_(\d{2})(\d{2})\.pdf$", (1, 2, None)),
        (rf"(?i)(\d{{1,2}})\s+({months})\s+(\d{{4}})", (1, 2, 3)),
        (rf"(?i)({months})\s+(\d{{1,2}}),?\s+(\d{{4}})", (2, 1, 3)),
    ]
    out = F.lit(None).cast("struct<day:int,month:int,year:int>")
    for pattern, (day, month, year) in reversed(forms):
        part = lambda k, pattern=pattern: F.regexp_extract(file_name, pattern, k)
        number = part(month).try_cast("int") if year is None else _month_number(part(month))
        found = F.struct(part(day).try_cast("int").alias("day"), number.alias("month"), (part(year).try_cast("int") if year else F.lit(None).cast("int")).alias("year"))
        out = F.when(file_name.rlike(pattern), found).otherwise(out)
    return out


def download_day(downloaded_at: Column, file_name: Column, zone: str) -> Column:
    """Local day of a UTC download time. Before the cutoff hour it is the day before, unless the file name tells which of the two days it is."""
    local = F.from_utc_timestamp(downloaded_at, zone)
    day, before, told = F.to_date(local), F.date_sub(F.to_date(local), 1), named_day(file_name)
    names = lambda d: F.coalesce((F.dayofmonth(d) == told["day"]) & (F.month(d) == told["month"]) & (told["year"].isNull() | (F.year(d) == told["year"])), F.lit(False))
    return F.when(F.hour(local) >= CUTOFF_HOUR, day).when(names(day), day).otherwise(before)


def week_index(day: Column, first: Column, length: int = 7) -> Column:
    """Which run of `length` days from `first` on holds day; below zero before it."""
    return F.floor(F.datediff(day, first) / length).cast("int")


def week_bounds(index: Column, first: Column, last: Column | None = None, length: int = 7) -> tuple[Column, Column]:
    """First and last day of a run; the last run ends with `last`."""
    start = F.date_add(first, (index * length).cast("int"))
    end = F.date_add(start, length - 1)
    return start, end if last is None else F.least(end, last)


def rolling_window(day: Column, length: int = 14) -> tuple[Column, Column]:
    """The `length` days that end the day before."""
    return F.date_sub(day, length), F.date_sub(day, 1)


def latest_weekday(day: Column, weekday: int = THURSDAY) -> Column:
    """The latest such weekday on or before day."""
    return F.date_sub(day, F.pmod(F.weekday(day) - weekday, F.lit(7)).cast("int"))


def fortnight(day: Column, anchor: Column) -> tuple[Column, Column]:
    """The fixed 14-day period that holds day, also before the anchor."""
    return week_bounds(week_index(day, anchor, 14), anchor, None, 14)


def fortnight_closing_on(day: Column, anchor: Column) -> tuple[Column, Column]:
    """First and last day of the period that ends on this very day; nulls on other days."""
    start, end = fortnight(day, anchor)
    return F.when(end == day, start), F.when(end == day, end)


def closed_fortnights(day: Column, anchor: Column) -> Column:
    """All periods from the anchor on that have ended by the end of day, oldest first, as array<struct<start, stop>>."""
    n = week_index(F.date_add(day, 1), anchor, 14)
    start = lambda k: F.date_add(anchor, (k * 14).cast("int"))
    numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda k: F.struct(start(k).alias("start"), F.date_add(start(k), 13).alias("stop")))


def latest_closed_fortnight_end(day: Column, anchor: Column, most_age: int | None = None) -> Column:
    """Last day of the newest period that has ended before day; null before the first one, or if it ended more than most_age days ago."""
    closed = week_index(day, anchor, 14)
    end = F.when(closed > 0, F.date_sub(week_bounds(closed, anchor, None, 14)[0], 1))
    return end if most_age is None else F.when(F.datediff(day, end) <= most_age, end)


def preset(name: str, latest: Column) -> tuple[Column, Column]:
    """Date presets relative to the latest day: last7, last30, month (to the latest day), previous_month."""
    if name == "previous_month":
        start = F.add_months(F.trunc(latest, "month"), -1).cast("date")
        return start, F.last_day(start)
    starts = {"last7": F.date_sub(latest, 6), "last30": F.date_sub(latest, 29), "month": F.trunc(latest, "month").cast("date")}
    return starts[name], latest


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def age_limit(text: Column, latest: Column) -> Column:
    """First day that a request for so many days reaches: 1 to 365, 30 if unreadable, null (no limit) for 'all'."""
    days = F.coalesce(F.trim(text).try_cast("int"), F.lit(30))
    return F.when(F.lower(F.trim(text)) == "all", F.lit(None).cast("date")).otherwise(F.date_sub(latest, F.greatest(F.lit(1), F.least(F.lit(365), days))))


def cadence(rate: Column) -> Column:
    return F.when(rate < 0.35, "weekly").otherwise("daily")


def is_active(rate: Column, seen: Column, expected: Column) -> Column:
    """Weekly sources need one issue, daily ones half of those expected and at least one; nothing is active where none is expected."""
    need = F.when(rate < 0.35, F.lit(1.0)).otherwise(F.greatest(F.lit(1.0), 0.5 * expected))
    return F.when(expected <= 0, F.lit(False)).otherwise(seen >= need)


def kept_snapshot(day: Column, today: Column, newest: Column) -> Column:
    """Retention: all up to 14 days, Sundays up to 60, and the newest always."""
    age = F.datediff(today, day)
    return (age <= 14) | ((age <= 60) & (F.weekday(day) == 6)) | (day == newest)


def scan_limit(days_since: Column) -> Column:
    """Messages to look at after a gap: 50 a day, at least 200, and 200 without history."""
    return F.coalesce(F.greatest(F.lit(200), days_since * 50), F.lit(200)).cast("long")


#: Month names.
MONTH_NAMES = {
    "en": tuple(m.capitalize() for m in MONTHS),
    "de": ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"),
    "he": ("ינואר", "פברואר", "מרץ", "אפריל", "מאי", "יוני", "יולי", "אוגוסט", "ספטמבר", "אוקטובר", "נובמבר", "דצמבר"),
}


def _month_name(day: Column, lang: str) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES[lang])), F.month(day))


def long_form(day: Column, lang: str) -> Column:
    """A date written out in English, German or Hebrew (months from a fixed list, as the engine's locale may differ)."""
    return F.concat(F.dayofmonth(day).cast("string"), F.lit({"en": " ", "de": ". ", "he": " ב"}[lang]), _month_name(day, lang), F.lit(" "), F.year(day).cast("string"))


def range_form(start: Column, stop: Column, lang: str) -> Column:
    """A period written out: the later day's month and year in German, the earlier one's month in English, numbers in Hebrew."""
    day, month = (lambda c: F.dayofmonth(c).cast("string")), (lambda c: F.month(c).cast("string"))
    year = F.year(stop).cast("string")
    if lang == "he":
        return F.concat(day(start), F.lit("."), month(start), F.lit("–"), day(stop), F.lit("."), month(stop), F.lit("."), year)
    if lang == "de":
        return F.concat(day(start), F.lit(".–"), day(stop), F.lit(". "), _month_name(stop, "de"), F.lit(" "), year)
    return F.concat(_month_name(start, "en"), F.lit(" "), day(start), F.lit("–"), day(stop), F.lit(", "), year)
