"""The half-month filing calendar and dates in free text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..rules import once

_MONTH = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"


def fifteenth(d: Column) -> Column:
    return F.date_add(F.trunc(d, "MM"), 14)


def filing_slice(d: Column) -> Column:
    """A filing's day to its slice: 13 to 16 the 15th, the last days the month's end, else null."""
    day, last = F.dayofmonth(d), F.dayofmonth(F.last_day(d))
    return F.when(day.between(13, 16), fifteenth(d)).when((day >= 27) | (day >= last - 3), F.last_day(d))


def target_slice(d: Column) -> Column:
    """A requested day to its slice: to the 16th the 15th, else the month's end."""
    return F.when(F.dayofmonth(d) <= 16, fifteenth(d)).otherwise(F.last_day(d))


def cadence(d: Column) -> Column:
    day = F.dayofmonth(d)
    return F.when(day == 15, "fortnightly").when(d == F.last_day(d), "monthly").when(day < 15, "fortnightly").otherwise("monthly")


def previous_filing(d: Column, kind: Column) -> Column:
    month_before = F.last_day(F.add_months(F.trunc(d, "MM"), -1))
    return F.when(kind == "monthly", month_before).when(F.dayofmonth(d) > 15, fifteenth(d)).otherwise(month_before)


def next_filing(d: Column, kind: Column) -> Column:
    following = F.add_months(F.trunc(d, "MM"), 1)
    return F.when(kind == "monthly", F.last_day(following)).when(F.dayofmonth(d) <= 15, F.last_day(d)).otherwise(F.date_add(following, 14))


def period_keys(month: Column, kind: Column) -> Column:
    """A first-of-month date to its storage keys."""
    return F.when(kind == "monthly", F.array(F.last_day(month))).otherwise(F.array(fifteenth(month), F.last_day(month)))


def serial_date(n: Column) -> Column:
    """A spreadsheet's day number; outside 30000 to 80000 null."""
    return F.when(n.between(30000, 80000), F.date_add(F.lit("1899-12-30").cast("date"), n))


def retention_cutoff(newest_month_end: Column, months: int) -> Column:
    return F.trunc(F.add_months(newest_month_end, -(months - 1)), "MM")


def _group(text: Column, pattern: str, *groups: int) -> Column:
    return F.concat_ws("-", *[F.regexp_extract(text, pattern, g) for g in groups])


def _named(text: Column, pattern: str, day: int, month: int, year: int) -> Column:
    y = F.regexp_extract(text, pattern, year)
    y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    s = F.concat_ws("-", F.regexp_extract(text, pattern, day), F.initcap(F.substring(F.regexp_extract(text, pattern, month), 1, 3)), y)
    return F.try_to_date(s, "d-MMM-yyyy")


def parse_as_of(text: Column) -> Column:
    """The as-of date of a banner: labelled day number, ISO, day-month-year, month-day-year, numeric (day first), else the last month and year, as its end."""
    return once(F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("_"), F.lit(" ")), r"(?i)(\d)(?:st|nd|rd|th)\b", "$1"), _as_of)


def _as_of(t: Column) -> Column:
    serial = serial_date(F.regexp_extract(t, r"(?i)as\s+(?:on|at|of)\D{0,12}\b(\d{5})\b", 1).try_cast("int"))
    iso = F.try_to_date(_group(t, r"\b(20\d{2})-(\d{2})-(\d{2})\b", 1, 2, 3), "yyyy-MM-dd")
    dmy = _named(t, rf"(?i)\b(\d{{1,2}})[\s\-.,]*({_MONTH})[\s\-.,]*(20\d{{2}}|\d{{2}})\b", 1, 2, 3)
    mdy = _named(t, rf"(?i)\b({_MONTH})[\s\-.,]*(\d{{1,2}})[\s\-.,]+(20\d{{2}})\b", 2, 1, 3)
    num = r"\b(\d{1,2})[/.\-](\d{1,2})[/.\-](20\d{2})\b"
    a, b, y = (F.regexp_extract(t, num, g).try_cast("int") for g in (1, 2, 3))
    day, month = F.when(b > 12, b).otherwise(a), F.when(b > 12, a).otherwise(b)
    numeric = F.try_to_date(F.concat_ws("-", y, month, day), "yyyy-M-d")
    numeric = F.when(y.isNotNull(), numeric)
    return F.coalesce(serial, iso, dmy, mdy, numeric, F.last_day(last_month(t)))


def last_month(t: Column) -> Column:
    """First day of the last "Month YYYY" in a text, or null."""
    found = F.regexp_extract_all(t, F.lit(rf"(?i)({_MONTH})[\s\-.,']*(20\d{{2}})"), F.lit(0))
    last = F.try_element_at(found, F.lit(-1))
    return F.try_to_date(F.concat_ws("-", F.lit("1"), F.initcap(F.substring(last, 1, 3)), F.right(last, F.lit(4))), "d-MMM-yyyy")


def normalize_as_of(raw: Column) -> Column:
    """ISO, year-month (its end), day/month/year, day Mon year; else null."""
    t = F.trim(raw)
    month = F.last_day(F.try_to_date(F.when(t.rlike(r"^\d{4}-\d{2}$"), F.concat(t, F.lit("-01"))), "yyyy-MM-dd"))
    return F.coalesce(F.try_to_date(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t), "yyyy-MM-dd"), month, F.try_to_date(F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), t), "d/M/yyyy"), F.try_to_date(F.when(t.rlike(r"(?i)^\d{1,2} [a-z]{3} \d{4}$"), F.initcap(t)), "d MMM yyyy"))


def nav_date(c: Column) -> Column:
    return F.coalesce(F.try_to_date(c, "d-MMM-yyyy"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def month_match(months: Column, month: Column) -> Column:
    """True or false where any month is known, else null."""
    return F.when(F.size(months) > 0, F.array_contains(months, month))


def all_months(t: Column) -> Column:
    """Distinct first-of-month dates named in a text, in order."""
    found = F.regexp_extract_all(F.replace(t, F.lit("_"), F.lit(" ")), F.lit(rf"(?i)({_MONTH})[\s\-.,']*(20\d{{2}})"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.try_to_date(F.concat_ws("-", F.lit("1"), F.initcap(F.substring(x, 1, 3)), F.right(x, F.lit(4))), "d-MMM-yyyy")))


def financial_year(d: Column) -> Column:
    """April to March, as "2026-27"."""
    y = F.year(d) - F.when(F.month(d) >= 4, 0).otherwise(1)
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(F.pmod(y + 1, F.lit(100)).cast("string"), 2, "0"))


_SHORT = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"


def _each(t: Column, pattern: str, made) -> Column:
    """Dates of every match of a pattern (look-arounds keep matches apart)."""
    return F.transform(F.regexp_extract_all(t, F.lit(f"(?i){pattern}"), F.lit(0)), lambda m: F.try_to_date(made(m), "yyyy-M-d"))


def _part(m: Column, pattern: str, day: int, month: int, year: int) -> Column:
    """yyyy-M-d of a match with a named month."""
    y = F.regexp_extract(m, f"(?i){pattern}", year)
    name = F.lower(F.substring(F.regexp_extract(m, f"(?i){pattern}", month), 1, 3))
    number = F.array_position(F.array(*[F.lit(x) for x in _SHORT.split("|")]), name)
    y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    return F.concat_ws("-", y, number.cast("string"), F.regexp_extract(m, f"(?i){pattern}", day))


def extract_dates(text: Column) -> Column:
    """All valid days from 1990 to 2100 named in a label, address or file name, sorted and distinct."""
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("_"), F.lit(" "))
    iso = _each(t, r"(?<!\d)(?:19|20)\d{2}-\d{1,2}-\d{1,2}(?!\d)", lambda m: m)
    dmy_p = rf"(?<!\d)(\d{{1,2}})(?:st|nd|rd|th)?[\s\-.,]*({_MONTH})[\s\-.,]*(20\d{{2}}|\d{{2}})(?!\d)"
    mdy_p = rf"(?<![a-z])({_MONTH})[\s\-.,]*(\d{{1,2}}),?[\s\-.,]+(20\d{{2}})(?!\d)"
    glued_p = rf"({_MONTH})(\d{{2}})(20\d{{2}})(?!\d)"
    num_p = r"(?<!\d)(\d{1,2})[ /.\-](\d{1,2})[ /.\-](20\d{2})(?!\d)"

    def numeric(m: Column) -> Column:
        a, b = (F.regexp_extract(m, num_p, g).cast("int") for g in (1, 2))
        day, month = F.when((b > 12) & (a <= 12), b).otherwise(a), F.when((b > 12) & (a <= 12), a).otherwise(b)
        return F.concat_ws("-", F.regexp_extract(m, num_p, 3), month.cast("string"), day.cast("string"))

    compact_p = r"(?<!\d)(\d{2})(\d{2})(20\d{2})(?!\d)"
    named = [_each(t, p, lambda m, p=p, g=g: _part(m, p, *g)) for p, g in ((dmy_p, (1, 2, 3)), (mdy_p, (2, 1, 3)), (glued_p, (2, 1, 3)))]
    plain = [_each(t, num_p, numeric), _each(t, compact_p, lambda m: F.concat_ws("-", *[F.regexp_extract(m, compact_p, g) for g in (3, 2, 1)]))]
    # a month and a two-digit year between underscores: the month's end
    short_p = rf"(?<![a-z])({_MONTH})_(2[0-9])(?=_|\.|$)"
    ends = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?i){short_p}"), F.lit(0)), lambda m: F.last_day(F.try_to_date(F.concat(F.lit("20"), F.right(m, F.lit(2)), F.lit("-"), F.array_position(F.array(*[F.lit(x) for x in _SHORT.split("|")]), F.lower(F.substring(m, 1, 3))).cast("string"), F.lit("-1")), "yyyy-M-d")))
    path_p = r"(?:^|/)monthly/(20\d{2})/(\d{1,2})(?:/|$)"
    paths = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?i){path_p}"), F.lit(0)), lambda m: F.last_day(F.try_to_date(F.concat_ws("-", F.regexp_extract(m, f"(?i){path_p}", 1), F.regexp_extract(m, f"(?i){path_p}", 2), F.lit("1")), "yyyy-M-d")))
    every = F.flatten(F.array(iso, *named, *plain, ends, paths))
    return F.array_sort(F.array_distinct(F.filter(every, lambda d: d.isNotNull() & F.year(d).between(1990, 2100))))


def matches_as_of(text: Column, as_of: Column) -> Column:
    """True where a named day's slice is the wanted one; null where no day is named."""
    found = extract_dates(text)
    return F.when(F.size(found) > 0, F.exists(found, lambda d: F.coalesce(filing_slice(d) == as_of, F.lit(False))))


def clamp_to_folder(extracted: Column, folder: Column) -> Column:
    """The folder's date rules wherever it is one."""
    return F.coalesce(folder, extracted)


def has_explicit_day(name: Column) -> Column:
    """Whether a file's name tells a day, not only a month."""
    t = F.regexp_replace(F.replace(F.coalesce(name, F.lit("")), F.lit("_"), F.lit(" ")), r"(?i)(\d)(?:st|nd|rd|th)\b", "$1")
    named = rf"(?i)\b\d{{1,2}}[-/ .](?:{_MONTH})[-/ . ]?(?:20\d{{2}}|\d{{2}})\b|\b(?:{_MONTH})[-/ .]+\d{{1,2}}[-/ .,]+(?:20\d{{2}}|\d{{2}})\b"
    return t.rlike(named) | t.rlike(r"\b\d{1,2}[./-]\d{1,2}[./-](?:20)?\d{2}\b")


def choose_as_of(from_rows: Column, from_name: Column, name: Column) -> Column:
    """The sheet's date before the file name's, but for a name that tells another day."""
    return F.when(from_rows.isNotNull() & from_name.isNotNull() & (from_rows != from_name) & has_explicit_day(name), from_name).otherwise(F.coalesce(from_rows, from_name))


def strict_as_of(raw: Column) -> Column:
    """An ISO day as it stands, unchecked, or a year-month's end; else an empty text."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    end = F.last_day(F.try_to_date(F.when(t.rlike(r"^\d{4}-\d{2}$"), F.concat(t, F.lit("-01"))), "yyyy-MM-dd")).cast("string")
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t).otherwise(F.coalesce(end, F.lit("")))


# Source names that belong to another cadence's slice
_MID_MONTH = r"(?:^|[^0-9])15(?:st|th)?(?:[^0-9]|$)|as[_ -]?on[_ -]?15|portfolio[_ -]?15[_ -]"
_MONTH_END = r"(?i)(?:^|[^0-9])31[-_./ ]?(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)|(?:january|february|march|april|may|june|july|august|september|october|november|december)[-_./ ]*31(?:st)?"
_MONTHLY_PACK = r"in_mf_monthly_|monthly-portfolio-|monthly portfolio|equity exposure"
_FORTNIGHT_END = r"fortnightlyportfolio(?:of)?july31|fortnightly.*31[-_ ]?jul|31st[-_ ]july.*fortnight"


def source_fits_cadence(source: Column, as_of: Column, kind: Column) -> Column:
    """Whether a source file's name goes with the slice it is filed under; an unnamed source does."""
    low = F.lower(F.coalesce(source, F.lit("")))
    monthly_wrong = (kind == "monthly") & (as_of == F.last_day(as_of)) & low.rlike("fortnightly|fortnight") & low.rlike(_MID_MONTH)
    ends = source.rlike(_MONTH_END) & ~low.rlike(r"\b15\b|15th|15[-_./ ]")
    mid_wrong = (kind == "fortnightly") & (F.dayofmonth(as_of) == 15) & (ends | low.rlike(_MONTHLY_PACK) | low.rlike(_FORTNIGHT_END))
    return (low == "") | as_of.isNull() | ~F.coalesce(monthly_wrong | mid_wrong, F.lit(False))


def stale_label(as_of: Column, period: Column) -> Column:
    """Whether a label's month is not the period's: for the two periods that were looked into."""
    t = F.upper(F.replace(F.coalesce(as_of, F.lit("")), F.lit(" "), F.lit("")))
    june = t.rlike(r"MAY|APR|MAR|JUL|31[\-/]?JUL|JULY") & ~t.contains("JUN")
    july = t.contains("JUN") | t.contains("MAY") | t.rlike(r"31|JULY\s*31")
    return F.when(t == "", F.lit(False)).when(period == "2026-06", june).when(period == "2026-07-15", july).otherwise(F.lit(False))


def year_guard(token: Column) -> Column:
    """A two-digit number after a month is a year from 20 to 29 only where no day could be meant: "Jul_31" is a day."""
    n = F.regexp_extract(token, r"(?i)^[a-z]+[_\-. ](\d{2})$", 1).try_cast("int")
    return F.coalesce(n.between(20, 29), F.lit(False))


def in_sync_order(months, keys: list[str]):
    """The slices of months (column ``m``, first days) with cadence, rank and place in each key's safe order: all mid-month slices, then month ends, then monthly ones."""
    three = F.array(*[F.struct(d.alias("as_of"), F.lit(c).alias("cadence"), F.lit(k).alias("rank")) for k, (d, c) in enumerate(((fifteenth(F.col("m")), "fortnightly"), (F.last_day("m"), "fortnightly"), (F.last_day("m"), "monthly")))])
    slices = months.select(*keys, F.explode(three).alias("x")).select(*keys, "x.*")
    return slices.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "as_of")))


def months_between(first: Column, last: Column) -> Column:
    """The first days of all months from one day's to another's."""
    return F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
