"""Dates as they stand in documents, as ordered attempts. What none of them reads is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_whitespace

#: Dates that stand for none.
NO_DATE, UNREADABLE = "1000-01-01", "9999-01-01"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
# Welsh names of months, from January on.
WELSH = ["Ionawr", "Chwefror", "Mawrth", "Ebrill", "Mai", "Mehefin", "Gorffennaf", "Awst", "Medi", "Hydref", "Tachwedd", "Rhagfyr"]
_WEEKDAY = r"(?i)\b(?:Sun|Mon|Tues|Wednes|Thurs|Fri|Satur)day,?\s*"
#: What a date in running text looks like.
IN_TEXT = rf"(?i)\b\d{{1,2}}(?:st|nd|rd|th)?(?: of)? +(?:{MONTHS}),? +\d{{4}}\b|\b(?:{MONTHS}) +\d{{1,2}}(?:st|nd|rd|th)?,? +\d{{4}}\b|\b\d{{1,2}}[/.-]\d{{1,2}}[/.-]\d{{2,4}}\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b"


def parse(c: Column) -> Column:
    """A date from British, ordinal, American, numeric (day first) or ISO form, weekday and commas set aside."""
    s = F.regexp_replace(clean_whitespace(c), _WEEKDAY, "")
    s = F.regexp_replace(s, r"(?i)\b(\d{1,2})\s*(st|nd|rd|th)\b(?: of\b)?", "$1")
    s = clean_whitespace(F.regexp_replace(F.regexp_replace(s, r"[.,;:*]+$", ""), ",", " "))
    as_ = lambda shape, fmt: F.when(s.rlike(shape), F.try_to_date(s, fmt))
    return F.coalesce(
        as_(r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
        as_(r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
        as_(r"^[A-Za-z]{4,} \d{1,2} \d{4}$", "MMMM d yyyy"),
        as_(r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
        as_(r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
        as_(r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"),
        as_(r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
        as_(r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
        as_(r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    )


def find(line: Column) -> Column:
    """The first date in a line."""
    return parse(F.nullif(F.regexp_extract(line, IN_TEXT, 0), F.lit("")))


def parse_header(c: Column) -> Column:
    """A date of an assessment's header: notes in brackets and stars dropped, days over 31 mended, month and year alone
    being the first of the month."""
    s = F.regexp_replace(clean_whitespace(c), r"\*+$", "")
    s = F.regexp_replace(s, r"\s*\(.*\)\s*$", "")
    s = F.trim(F.regexp_replace(s, r"[.,;:]+$", ""))
    day = F.regexp_extract(s, r"^(\d{2,3})/(\d{1,2})/(\d{4})$", 1).try_cast("int")
    rest = F.regexp_extract(s, r"^\d{2,3}(/\d{1,2}/\d{4})$", 1)
    mended = F.try_to_date(F.concat(F.when(day > 31, day % 100).otherwise(day).cast("string"), rest), "d/M/yyyy")
    month = F.regexp_extract(s, r"^([A-Za-z]+\s+\d{4})", 1)
    month = F.regexp_replace(month, r"\s+", " ")
    named = lambda shape, fmt: F.when(month.rlike(shape), F.try_to_date(F.concat(F.lit("1 "), month), fmt))
    return F.coalesce(mended, parse(s), named("^[A-Za-z]{4,} ", "d MMMM yyyy"), named("^[A-Za-z]{3} ", "d MMM yyyy"))


def parse_bilingual(c: Column) -> Column:
    """`d Month yyyy` or `yyyy` in English or Welsh; stars are an open date (null), anything else the unreadable date."""
    s = clean_whitespace(c)
    english = s
    for i, name in enumerate(WELSH):
        english = F.regexp_replace(english, rf"(?i)\b{name}\b", MONTHS.split("|")[i])
    year = F.when(s.rlike(r"^\d{4}$"), F.try_to_date(F.concat(s, F.lit("-01-01")), "yyyy-MM-dd"))
    found = F.coalesce(F.when(english.rlike(r"^\d{1,2} [A-Za-z]+ \d{4}$"), F.try_to_date(english, "d MMMM yyyy")), year)
    return F.when(s.contains("***"), None).otherwise(F.coalesce(found, F.lit(UNREADABLE).cast("date")))


def date_name(court: Column) -> Column:
    """What a date is called: a decision in tribunals, else a judgment."""
    return F.when(court.rlike("^(UKUT|UKFTT|FTT)"), "decision").otherwise("judgment")
