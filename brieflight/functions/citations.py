"""Neutral citations: normal form, address path and its parts. The rules are ordered tables; the first that fits wins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_whitespace

UPPER_CHAMBERS, FIRST_CHAMBERS = "AAC|IAC|LC|TCC", "TC|GRC|PC"
DIVISIONS = "Admin|Admlty|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC"

# Shapes of citations as (pattern, normal form). In a form {n} is a group, {n:u} upper case, {n:c} first
# letter upper, {n:z} without leading zeros; a number of zeros only means that the shape does not fit.
SHAPES = [
    (r"^\[(\d{4})\] (UKSC|UKPC) (\d+)$", "[{1}] {2:u} {3:z}"),
    (r"^\[(\d{4})[\]\[] (EWCA) (Civ|Crim) (\d+)$", "[{1}] {2:u} {3:c} {4:z}"),
    (r"^\[(\d{4})\] (EWCA) (\d+) \(?(Civ|Crim)\)?$", "[{1}] {2:u} {4:c} {3:z}"),
    (r"^\[?(\d{4})\]? (EWHC|EWCH|EHWC) \[?(\d+)\]? \(?(Admin|Admlty|Ch|Comm|Costs|Fam|Pat)\)?$", "[{1}] EWHC {3:z} ({4:c})"),
    (r"^\[(\d{4})\] (EWHC|EWCH) \[?(\d+)\]? \(?(IPEC|KB|QB|SCCO|TCC)\)?$", "[{1}] EWHC {3:z} ({4:u})"),
    (r"^\[(\d{4})\] (EWFC|EWCOP) (\d+)$", "[{1}] {2:u} {3:z}"),
    (r"^\[(\d{4})\] EWFC (\d+) \(B\)$", "[{1}] EWFC {2:z} (B)"),
    (r"^\[(\d{4})\] EWCOP (\d+) \((T[1-3])\)$", "[{1}] EWCOP {2:z} ({3:u})"),
    (r"^\[(\d{4})\] EWCC (\d+)$", "[{1}] EWCC {2:z}"),
    (r"^\[(\d{4})\] EWCR (\d+)$", "[{1}] EWCR {2:z}"),
    (rf"^\[?(\d{{4}})[\]\[] UKUT (\d+) ?\(({UPPER_CHAMBERS})\)$", "[{1}] UKUT {2:z} ({3:u})"),
    (r"^\[?(\d{4})\]? (UKAIT) (\d+)$", "[{1}] {2:u} {3:z}"),
    (r"^\[?(\d{4})\]? (EAT) (\d+)$", "[{1}] {2:u} {3:z}"),
    (rf"^\[(\d{{4}})\] UKFTT (\d+) \(({FIRST_CHAMBERS})\)$", "[{1}] UKFTT {2:z} ({3:u})"),
    (r"^\[(\d{4})\] UKIPTrib (\d+)$", "[{1}] UKIPTrib {2:z}"),
]
# Address paths of normal forms, lower-cased in the end.
PATHS = [
    (r"^\[(\d{4})\] (UKSC|UKPC) (\d+)$", "{2}/{1}/{3}"),
    (r"^\[(\d{4})\] (EWCA) (Civ|Crim) (\d+)$", "{2}/{3}/{1}/{4}"),
    (rf"^\[(\d{{4}})\] (EWHC) (\d+) \(({DIVISIONS})\)$", "{2}/{4}/{1}/{3}"),
    (r"^\[(\d{4})\] (EWFC|EWCOP) (\d+)$", "{2}/{1}/{3}"),
    (r"^\[(\d{4})\] EWFC (\d+) \(B\)$", "EWFC/B/{1}/{2}"),
    (r"^\[(\d{4})\] EWCOP (\d+) \((T[1-3])\)$", "EWCOP/{3}/{1}/{2}"),
    (r"^\[(\d{4})\] EWCC (\d+)$", "EWCC/{1}/{2}"),
    (r"^\[(\d{4})\] EWCR (\d+)$", "EWCR/{1}/{2}"),
    (rf"^\[(\d{{4}})\] (UKUT) (\d+) \(({UPPER_CHAMBERS})\)$", "{2}/{4}/{1}/{3}"),
    (r"^\[(\d{4})\] (UKAIT) (\d+)$", "{2}/{1}/{3}"),
    (r"^\[(\d{4})\] (EAT) (\d+)$", "{2}/{1}/{3}"),
    (rf"^\[(\d{{4}})\] (UKFTT) (\d+) \(({FIRST_CHAMBERS})\)$", "{2}/{4}/{1}/{3}"),
    (r"^\[(\d{4})\] (UKIPTrib) (\d+)$", "{2}/{1}/{3}"),
]
PATH_SHAPE = r"^[a-z]+(/[a-z]+[1-3]?)?/\d{4}/\d+(/press-summary/\d+)?$"
PATH_PARTS = r"^[a-z]+(?:/[a-z]+[1-3]?)?/(\d{4})/(\d+)"


def _form(c: Column, pattern: str, form: str) -> Column:
    """The form filled from the groups, null if a stripped number is empty."""
    parts, ok = [], F.lit(True)
    for literal, group, how in re.findall(r"([^{]*)(?:\{(\d)(?::(\w))?\})?", form):
        if literal:
            parts.append(F.lit(literal))
        if group:
            x = F.regexp_extract(c, pattern, int(group))
            if how == "u":
                x = F.upper(x)
            elif how == "c":
                x = F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 99)))
            elif how == "z":
                x = F.regexp_replace(x, "^0+", "")
                ok = ok & (x != "")
            parts.append(x)
    return F.when(c.rlike(pattern) & ok, F.concat(*parts))


def normalize_citation(c: Column) -> Column:
    """The normal form, or null."""
    c = clean_whitespace(c)
    return F.coalesce(*(_form(c, "(?i)" + p, form) for p, form in SHAPES))


def citation_path(normal: Column) -> Column:
    """The address path of a normal form, or null."""
    return F.lower(F.coalesce(*(_form(normal, p, form) for p, form in PATHS)))


def is_path(path: Column) -> Column:
    return path.rlike(PATH_SHAPE)


def year_of_path(path: Column) -> Column:
    """The year in a path; null, not an error, where the shape is another."""
    return F.regexp_extract(path, PATH_PARTS, 1).try_cast("int")


def number_of_path(path: Column) -> Column:
    return F.regexp_extract(path, PATH_PARTS, 2).try_cast("int")


# Citations in running text, with a label (group 2) and bare (group 1).
_DIV = r"\((Admin|Admlty|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC)\.?\)"
LABELLED = [
    r"^ ?Neutral Citation( Number| No)?[:\.]? *(\[\d{4}\] EWCA (Civ|Crim) \d+)",
    rf"^ *Neutral [Cc]itation( +[Nn]umber| No)? ?[:\.]? *(\[\d{{4}}\]? EWHC +\d+ +{_DIV})",
    r"^Neutral Citation( Number| No)?:? +(\[\d{4}\] EWHC \d+ (Admin|Admlty|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC))",
    r"^Neutral Citation( Number| No)?:? +(\[\d{4}\] EWCH \d+ \((Admin|Admlty|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC)\))",
    r"^Neutral Citation( Number| No)?:? +(\[\d{4}\] EHWC \d+ \((Admin|Admlty|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC)\))",
    r"^Neutral Citation( Number| No)?:? (\[\d{4}\] EWCOP \d+( \(T[1-3]\))?)",
    r"^Neutral Citation( Number)?:? (\[\d{4}\] EWFC \d+( \(B\))?)",
    r"^Neutral Citation( Number)?:? (\[\d{4}\] EWCA \d+ \((Civ|Crim)\))",
    r"^Neutral Citation( Number)?:? (\[\d{4}\] EWCA \d+ (Civ|Crim))",
    r"^Neutral Citation( Number)?:? +(\[\d{4}\] EWCC \d+)",
    r"^Neutral Citation( Number)?:? +(\[\d{4}\] EWCR \d+)",
    r"^Neutral Citation( Number)?:? (\[\d{4}\] EAT \d+)",
]
BARE = [
    r"^\s*(\[\d{4}\] EWCA (Civ|Crim) \d+)",
    r"^ *(\[?\d{4}\] EWHC \d+ \((Admin|Admlty\.?|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC)\))",
    r"^\s(\[\d{4}\] EWHC \d+ \(Admin\))",
    r"^(\[\d{4}\] EWHC \[\d+\] \((Admin|Admlty|Ch|Comm|Costs|Fam|IPEC|KB|Pat|QB|SCCO|TCC)\))$",
    r"^Neutral Citation Nunber: (\[\d{4}\] EWCA (Civ|Crim) \d+)",
    r"^Neutral Citation Numer: (\[\d{4}\] EWHC \d+ \(Ch\))$",
    r"^NCN:? (\[\d{4}\] EWCA (Civ|Crim) \d+)$",
    r"^NCN No: (\[\d{4}\] EWCA (Civ|Crim) \d+)$",
    r"(\[\d{4}\] EWFC \d+( \(B\))?)",
    r"^Neutral Citation Number: (\[\d{4}\[ EWCA (Civ|Crim) \d+)",
    r"^(\[\d{4}\] EWCOP \d+( \(T[1-3]\))?)$",
    r"^(\[\d{4}\] EWCC \d+)",
    r"^(\[\d{4}\] EWCR \d+)",
    r"^ *(\[?\d{4}\]? EAT \d+)$",
    r"^Neutral Citation Number:? (\[\d{4}\] UKIPTrib \d+)",
]
TRIBUNAL = [
    rf"(\[?\d{{4}}[\]\[] UKUT \d+ ?\(({UPPER_CHAMBERS})\))",
    rf"(\[\d{{4}}\] UKFTT \d+ \(({FIRST_CHAMBERS})\))",
    r"(\[?\d{4}\]? UKAIT \d+)",
    r"(\[\d{4}\] (UKSC|UKPC) \d+)",
]


def find_citation(line: Column) -> Column:
    """The citation in a line of a header: labelled rules, bare rules, then those of tribunals and the top courts."""
    of = lambda rules, g: [F.nullif(F.regexp_extract(line, "(?iU)" + p, g), F.lit("")) for p in rules]
    return F.coalesce(*of(LABELLED, 2), *of(BARE, 1), *of(TRIBUNAL, 1))


# Statutory-instrument numbers
# Complete numbers with their type, and shapes whose number is still open.
REGULATIONS = [
    (r"^(\d{4})\s+No\.\s*(\d+)$", "uksi"),
    (r"^(\d{4})\s+No\.\s*(\d+)\s+\(?[LS]\.\s*\d+\)?$", "uksi"),
    (r"^S\.?R\.?\s+(\d{4})\s+No\.\s*(\d+)$", "nisr"),
    (r"^(\d{4})\s+S\.?R\.?\s+No\.\s*(\d+)$", "nisr"),
    (r"^S\.?S\.?I\.?\s+(\d{4})/(\d+)$", "ssi"),
    (r"^S\.?S\.?I\.?\s+(\d{4})/(\d+)\s+\(?C\.\s*\d+\)?$", "ssi"),
]
OPEN_REGULATIONS = [
    r"^\d{4}\s+No\.?(\s*\[[^\]]+\])?\s*$",
    r"^\d{4}\s+No\.\s*X+$",
    r"^\d{4}\s+No\.\s*\*+$",
    r"^\d{4}\s+No\.\s*\[\d+$",
    r"^\d{4}\s+\[[^\]]+\]$",
    r"^S\.?R\.?\s+\d{4}\s+No\.?(\s*\[[^\]]+\])?\s*$",
    r"^S\.?R\.?\s+\d{4}\s+No\.\s*X+$",
    r"^S\.?R\.?\s+No\.\s*\d+$",
    r"^No\.\s*$",
]
SERIES = [r"^S\.?S\.?I\.?\s+\d{4}/\d+\s+\(?(C)\.\s*(\d+)\)?$", r"^\d{4}\s+No\.\s*\d+\s+\(?([LS])\.\s*(\d+)\)?$"]


def repair_regulation(c: Column) -> Column:
    """Gaps in digits, in dotted initials and in `No.` closed, then single spaces."""
    c = F.regexp_replace(c, r"(\d)\s+(\d)", "$1$2")
    c = F.regexp_replace(c, r"([A-Z]\.)\s+([A-Z]\.)", "$1$2")
    c = F.regexp_replace(c, r"(?i)\bN\s+o\.", "No.")
    return clean_whitespace(c)


def regulation_path(c: Column) -> Column:
    """type/year/number of a complete number, else null; a number of zeros is 0."""
    c = repair_regulation(c)
    out = []
    for p, kind in REGULATIONS:
        p = "(?i)" + p
        n = F.regexp_replace(F.regexp_extract(c, p, 2), "^0+", "")
        out.append(F.when(c.rlike(p), F.concat_ws("/", F.lit(kind), F.regexp_extract(c, p, 1), F.when(n == "", "0").otherwise(n))))
    return F.coalesce(*out)


def is_regulation(c: Column) -> Column:
    n = repair_regulation(c)
    out = regulation_path(c).isNotNull()
    for p in OPEN_REGULATIONS:
        out = out | n.rlike("(?i)" + p)
    return out


def regulation_series(c: Column) -> Column:
    """Letter and number of a subseries, like `L17`, else null."""
    c = repair_regulation(c)
    return F.coalesce(*(F.when(c.rlike("(?i)" + p), F.concat(F.regexp_extract(c, "(?i)" + p, 1), F.regexp_extract(c, "(?i)" + p, 2).try_cast("int").cast("string"))) for p in SERIES))


LEGISLATION = r"(?i)^https?://www\.legislation\.gov\.uk/id/([^/]+)/(\d{4})/(.+)$"
# Stages of impact assessments in their path form.
STAGES = ["final", "enactment", "consultation", "development", "implementation", "options", "post-implementation"]


def assessment_path(year: Column, number: Column, legislation: Column) -> Column:
    """Path of an impact assessment under its legislation, or under ukia where that is missing or of another shape."""
    own = F.concat_ws("/", F.lit("ukia"), year.cast("string"), number.cast("string"))
    under = F.concat_ws("/", F.regexp_extract(legislation, LEGISLATION, 1), F.regexp_extract(legislation, LEGISLATION, 2), F.regexp_extract(legislation, LEGISLATION, 3), F.lit("impacts"), year.cast("string"), number.cast("string"))
    return F.when(F.coalesce(legislation.rlike(LEGISLATION), F.lit(False)), under).otherwise(own)


def assessment_stage(stage: Column) -> Column:
    s = F.lower(F.trim(stage))
    s = F.when(s.isin("postimplementation", "post implementation"), "post-implementation").otherwise(s)
    return F.when(s.isin(STAGES), s)


def assessment_key(year: Column, number: Column) -> Column:
    """File stem of an impact assessment."""
    return F.format_string("ukia_%04d%04d_en", year, number)


def assessment_of_file(name: Column) -> Column:
    """struct(year, number) of a file name, null fields if it has another shape."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    part = lambda g: F.regexp_extract(stem, r"(?i)^ukia_(\d{4})(\d+)_en$", g).try_cast("int")
    return F.struct(part(1).alias("year"), part(2).alias("number"))
