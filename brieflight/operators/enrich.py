"""Enrichers: DataFrame -> DataFrame over blocks, composed with `enrich`. Rules are tables; a new one is a row."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import citations, dates, text
from . import sequence as seq

Enricher = Callable[[DataFrame], DataFrame]


def enrich(df: DataFrame, *steps: Enricher) -> DataFrame:
    """The steps one after the other."""
    return reduce(lambda d, step: d.transform(step), steps, df)


def rule_chain(c: Column, rules: list[tuple[str, int]], flags: str = "(?i)") -> Column:
    """The group of the first rule (pattern, group) that matches."""
    return F.coalesce(*(F.nullif(F.regexp_extract(c, flags + p, g), F.lit("")) for p, g in rules))


# citations and case numbers


def neutral_citation(blocks: DataFrame, limit: int = 10) -> DataFrame:
    """cite on the first of the first `limit` blocks that has one."""
    found = blocks.where(F.col("pos") < limit).withColumn("cite", citations.find_citation(F.col("text"))).where("cite is not null")
    first = found.groupBy("doc_id").agg(F.min(F.struct("pos", "cite")).alias("s")).select("doc_id", F.col("s.pos").alias("pos"), F.col("s.cite").alias("cite"))
    return blocks.join(first, ["doc_id", "pos"], "left")


#: Own rules for case numbers: labelled ones, then bare ones of known forms.
CASE_NUMBERS = [
    (r"\b(?:Case|Claim|Appeal|Application|Ref(?:erence)?)(?: Nos?| Numbers?)?\s*[:.]?\s+([A-Z0-9][A-Z0-9/.\- ]*\d[A-Z0-9/.\-]*)", 1),
    (r"\bNos?\s*[:.]\s*([A-Z0-9][A-Z0-9/.\- ]*\d[A-Z0-9/.\-]*)", 1),
    (r"\b((?:[A-Z]{1,4}[-/])?\d{2,4}[-/]\d{3,6}(?:[-/][A-Z]{1,4})?)\b", 1),
    (r"\b([A-Z]{2}\d{2}[A-Z]\d{5})\b", 1),
    (r"\b(\d{4}/\d{4,5}/[A-Z]\d)\b", 1),
]


def case_numbers(c: Column) -> Column:
    """The case numbers of a line: after the first rule that fits, further ones after commas, `and` or &."""
    first = F.trim(F.regexp_replace(rule_chain(c, CASE_NUMBERS), r"(?i)\s*(?:,|&|\band\b).*$", ""))
    rest = F.regexp_extract_all(c, F.lit(r"(?:,|&|\band\b)\s*([A-Z0-9][A-Z0-9/.\-]*\d[A-Z0-9/.\-]*)"), 1)
    return F.when(first.isNotNull(), F.array_distinct(F.concat(F.array(first), rest)))


# courts by lines

#: Own rules: consecutive lines of a header and the court they stand for.
COURT_LINES = [
    (1, "EWHC-KBD-Admin", ["IN THE HIGH COURT OF JUSTICE", "KING'S BENCH DIVISION", "ADMINISTRATIVE COURT"]),
    (2, "EWHC-KBD", ["IN THE HIGH COURT OF JUSTICE", "KING'S BENCH DIVISION"]),
    (3, "EWHC-Chancery", ["IN THE HIGH COURT OF JUSTICE", "CHANCERY DIVISION"]),
    (4, "EWHC-Family", ["IN THE HIGH COURT OF JUSTICE", "FAMILY DIVISION"]),
    (5, "EWCA-Civil", ["IN THE COURT OF APPEAL", "CIVIL DIVISION"]),
    (6, "EWCA-Civil", ["IN THE COURT OF APPEAL (CIVIL DIVISION)"]),
    (7, "EWCA-Criminal", ["IN THE COURT OF APPEAL", "CRIMINAL DIVISION"]),
    (8, "EWCA-Criminal", ["IN THE COURT OF APPEAL (CRIMINAL DIVISION)"]),
    (9, "UKUT-LC", ["UPPER TRIBUNAL (LANDS CHAMBER)"]),
    (10, "UKFTT-GRC", ["FIRST-TIER TRIBUNAL", "GENERAL REGULATORY CHAMBER"]),
    (11, "EAT", ["EMPLOYMENT APPEAL TRIBUNAL"]),
]


def with_queens(rules: list) -> list:
    """The rules and the same ones as they stood under a queen, with codes of that time."""
    older = [(n + 1000, code.replace("KBD", "QBD"), [x.replace("KING'S", "QUEEN'S") for x in lines]) for n, code, lines in rules if any("KING'S" in x for x in lines)]
    return rules + older


def court_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(with_queens(COURT_LINES), "rule int, code string, lines array<string>")


def court_of_lines(blocks: DataFrame, rules: DataFrame) -> DataFrame:
    clean = blocks.withColumn("__text", F.upper(F.replace(text.clean_whitespace(F.col("text")), F.lit("’"), F.lit("'"))))
    return seq.kgram_match(clean, rules, "__text")


def court_of_citation(blocks: DataFrame) -> DataFrame:
    """Where no lines tell the court, the citation does."""
    from .courts import code_of_citation

    return blocks.withColumn("code", code_of_citation(citations.normalize_citation(F.col("cite"))))


# Jurisdictions of the General Regulatory Chamber as (short name, beginnings of lines).
JURISDICTIONS = [
    ("Charity", ["Charity", "Charities"]),
    ("CommunityRightToBid", ["Community", "Right to Bid", "Assets of Community Value"]),
    ("NetworkInformationSystems", ["Electronic communications", "postal services", "Network Information Systems"]),
    ("Environment", ["Environment"]),
    ("EstateAgents", ["Estate agent"]),
    ("ExamBoards", ["Examination boards", "Exam boards"]),
    ("FoodSafety", ["Food safety", "Food labelling"]),
    ("Gambling", ["Gambling"]),
    ("ImmigrationServices", ["Immigration services"]),
    ("IndividualElectoralRegistration", ["individual electoral registration"]),
    ("InformationRights", ["Information Rights", "Freedom of Information", "Section 166 DPA 1998"]),
    ("Pensions", ["Pensions Regulation", "Pensions"]),
    ("StandardsAndLicensing", ["Standards and Licensing", "Standards & Licensing", "Professional Regulation"]),
    ("Transport", ["Transport"]),
    ("WelfareOfAnimals", ["Welfare of animals", "Animal Welfare"]),
]


def jurisdiction(c: Column) -> Column:
    line = F.lower(F.regexp_replace(text.clean_whitespace(c), r"^\(*\[*", ""))
    out = []
    for name, starts in JURISDICTIONS:
        out += [F.when(line.startswith(s.lower()), name) for s in starts]
    return F.coalesce(*out)


# parties

# Roles by the words that name them.
ROLES = {
    "appellant": "Appellant", "applicant": "Applicant", "claimant": "Claimant", "defendant": "Defendant", "petitioner": "Petitioner", "respondent": "Respondent",
    "interested party": "InterestedParty", "intervener": "Intervener", "requested person": "RequestedPerson", "requesting state": "RequestingState", "third party": "ThirdParty",
}
PLURALS = {"interested parties": "InterestedParty"} | {k + "s": v for k, v in ROLES.items() if v in ("Appellant", "Applicant", "Claimant", "Defendant", "Petitioner", "Respondent", "Intervener", "RequestedPerson")}
ORDINALS = "1st|2nd|3rd|4th|5th|6th|First|Second|Third|Fourth|Fifth|Sixth|Inquiry"


def single_role(c: Column) -> Column:
    s = F.regexp_replace(text.clean_whitespace(c), r"^[ /()]+|[ /()]+$", "")
    s = F.regexp_replace(s, "(?i)^Part 20 ", "")
    third = F.lower(s) == "third party"
    s = F.when(third, s).otherwise(F.regexp_replace(s, f"(?i)^(?:{ORDINALS}) ", ""))
    table = F.create_map(*(F.lit(x) for kv in ({k: v for k, v in ROLES.items() if v != "ThirdParty"} | PLURALS).items() for x in kv))
    return F.when(third, "ThirdParty").otherwise(F.element_at(table, F.lower(s)))


def role(c: Column) -> Column:
    """The role a line names. Of two, parted by / or `and`: an appellant or else a respondent wins, claimant and defendant
    is a claimant, defendant and applicant an applicant, and other pairs are none."""

    def parted(sep: str, c: Column):
        at = F.instr(c, sep)
        a, b = F.substring(c, F.lit(1), at - 1), F.substring(c, at + len(sep), F.length(c))
        return (at > 0) & ~text.is_blank(a) & ~text.is_blank(b), a, b

    def pair(a: Column, b: Column) -> Column:
        has = lambda r: (a == r) | (b == r)
        rule = F.when(has("Appellant"), "Appellant").when(has("Respondent"), "Respondent").when((a == "Claimant") & (b == "Defendant"), "Claimant").when((a == "Defendant") & (b == "Applicant"), "Applicant")
        return F.when(a.isNotNull() & b.isNotNull(), rule)

    slash, a1, b1 = parted("/", c)
    and_, a2, b2 = parted(" and ", c)
    inner = lambda x: F.when(parted(" and ", x)[0], pair(single_role(parted(" and ", x)[1]), single_role(parted(" and ", x)[2]))).otherwise(single_role(x))
    return F.when(slash, pair(inner(a1), inner(b1))).when(and_, pair(single_role(a2), single_role(b2))).otherwise(single_role(c))


def parties(blocks: DataFrame) -> DataFrame:
    """doc_id, pos, name, role: each role line with the name lines since the last role, `v` or marker line before it."""
    c = text.clean_whitespace(F.col("text"))
    rows = blocks.select("doc_id", "pos", c.alias("line"), role(c).alias("role"))
    marker = F.col("line").rlike(r"(?i)^(?:-?\s*(?:v|and|between)\s*-?\s*[:.]?|[-_=\s]*)$")
    rows = rows.withColumn("stop", F.col("role").isNotNull() | marker)
    group = F.sum(F.when(F.coalesce(F.lag("stop").over(seq.window()), F.lit(True)), 1).otherwise(0)).over(seq.up_to_here())
    rows = rows.withColumn("g", group)
    named = rows.groupBy("doc_id", "g").agg(F.max("role").alias("role"), F.max(F.when(F.col("role").isNull() & ~marker, F.struct("pos", "line"))).alias("s"))
    return named.where("role is not null and s is not null").select("doc_id", F.col("s.pos").alias("pos"), F.regexp_replace(F.col("s.line"), r"^\(?\d+\)?[.)]\s*", "").alias("name"), "role")


def case_name(parties_: DataFrame, titles: DataFrame | None = None, locations: DataFrame | None = None) -> DataFrame:
    """doc_id, case_name from parties(doc_id, pos, name, role): the first party against the first of another role. A king or
    queen `on the application of` gives way to the next party of that role. Without two sides the document's title lines
    (doc_id, pos, text) serve, up to one that begins a new matter; a location (doc_id, text) is put behind."""
    w = seq.window()
    crown = r"(?i)^THE (?:KING|QUEEN)(?: \(?on the application of\)?)?$"
    rows = parties_.withColumn("n", F.row_number().over(w)).withColumn("first_role", F.first("role").over(Window.partitionBy("doc_id").orderBy("pos")))
    rows = rows.withColumn("side", F.when(F.col("role").eqNullSafe(F.col("first_role")), 1).otherwise(2))
    # of the other side only the role that comes first counts
    rows = rows.withColumn("other", F.min(F.when(F.col("side") == 2, F.struct("pos", "role"))).over(Window.partitionBy("doc_id"))["role"])
    rows = rows.where((F.col("side") == 1) | F.col("role").eqNullSafe(F.col("other")))
    side = Window.partitionBy("doc_id", "side").orderBy("pos")
    rows = rows.withColumn("next", F.lead("name").over(side)).withColumn("next2", F.lead("name", 2).over(side)).withColumn("k", F.row_number().over(side)).where("k = 1")
    bare = F.regexp_replace(text.clean_whitespace(F.col("next")), r"^[ ()\-]+|[ ()\-]+$", "")
    of = " (R on the application of)"
    inline = F.nullif(F.regexp_extract(bare, r"(?i)^on the application of ([A-Z][A-Z0-9 ]*)$", 1), F.lit(""))
    name = (
        F.when(~F.col("name").rlike(crown) | F.col("next").isNull(), F.col("name"))
        .when(F.col("name").rlike("(?i)application"), F.concat("next", F.lit(of)))
        .when((F.col("side") == 1) & inline.isNotNull(), F.concat(inline, F.lit(of)))
        .when((F.col("side") == 1) & (F.lower(bare) == "on the application of") & F.col("next2").isNotNull(), F.concat("next2", F.lit(of)))
        .otherwise(F.col("name"))
    )
    sides = rows.groupBy("doc_id").agg(F.max(F.when(F.col("side") == 1, name)).alias("a"), F.max(F.when(F.col("side") == 2, name)).alias("b"))
    out = sides.select("doc_id", F.when(F.col("b").isNotNull(), F.concat("a", F.lit(" v "), "b")).alias("of_parties"))
    if titles is not None:
        t = titles.withColumn("line", text.clean_whitespace(F.col("text")))
        stop = F.col("line").rlike("(?i)^(?:In the matter of |Re:? )") & (F.row_number().over(w) > 1)
        t = t.withColumn("stopped", seq.island(stop)).where("stopped = 0")
        t = t.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("of_title"))
        out = out.join(t, "doc_id", "full")
    else:
        out = out.withColumn("of_title", F.lit(None).cast("string"))
    if locations is not None:
        at = locations.groupBy("doc_id").agg(F.min("text").alias("at"))
        out = out.join(at, "doc_id", "left").withColumn("of_parties", F.when(F.col("at").isNotNull(), F.concat("of_parties", F.lit(" ("), "at", F.lit(")"))).otherwise(F.col("of_parties")))
    return out.select("doc_id", F.coalesce("of_parties", "of_title").alias("case_name"))


# judges, lawyers, dates

# Forms of a titled judge's name.
JUDGE_NAMES = [
    r"^MRS?\.? JUSTICE( [A-Z]+)+$",
    r"^(Lord|Lady|Mrs?|The Honourable Mrs?) Justice ([A-Z][a-z]* )?[A-Z][a-z]+(-[A-Z][a-z]+)?( VP)?$",
    r"^Mrs? ([A-Z]\.){1,3} [A-Z][a-z]+$",
    r"^[A-Z][a-z]+ [A-Z][a-z]+ QC, Deputy High Court Judge$",
]
SPEECHES = [p[:-1] + ":" for p in JUDGE_NAMES] + [r"^(LORD|LADY|MRS?) JUSTICE( [A-Z]+)+:", r"^LORD [A-Z]+ \(Concurring"]


def is_judge_name(c: Column) -> Column:
    s = F.regexp_replace(text.clean_whitespace(c), r"\s*:$", "")
    return reduce(lambda a, b: a | b, (s.rlike(p) for p in JUDGE_NAMES))


def begins_speech(c: Column) -> Column:
    s = text.clean_whitespace(c)
    return reduce(lambda a, b: a | b, (s.rlike(p) for p in SPEECHES))


def judges(blocks: DataFrame) -> DataFrame:
    """Names after a `Before` line, up to six, until dashes or a line that is no name."""
    c = text.clean_whitespace(F.col("text"))
    name = c.rlike(r"(?i)justice|judge|lord|lady|master|\bQC\b|\bKC\b|^MRS? |^SIR |^DAME ")
    return seq.until_marker(blocks, c.rlike(r"(?i)^before\s*:?$"), c.rlike(r"^[-_=\s]+$") | ~name, 6, "is_judge")


def lawyers(c: Column) -> Column:
    """The lawyers' names of an `X (instructed by Y) for the Z` line."""
    return F.nullif(F.regexp_extract(c, r"(?i)^(.*?)\s*\(instructed by .*?\)\s*(?:appeared )?(?:for|on behalf of) the ", 1), F.lit(""))


def location(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?i)^(?:From the (?:Court of Appeal|High Court|Supreme Court) of|Heard at|Sitting at|At)\s*:?\s*([A-Z][\w ,'-]+?)\.?$", 1), F.lit(""))


def on_appeal_from(c: Column) -> Column:
    return citations.normalize_citation(F.nullif(F.regexp_extract(c, r"(?i)on appeal from:?\s*(\[\d{4}\].*\d(?: \([A-Za-z]+\))?)", 1), F.lit("")))


def decision_date(blocks: DataFrame, limit: int | None = None, last: bool = False) -> DataFrame:
    """doc_id, pos, date: the first date of a document, of its first `limit` blocks if given; or the last one."""
    found = blocks.withColumn("date", dates.find(F.col("text")))
    hit = F.col("date").isNotNull()
    return (seq.last_match(found, hit) if last else seq.first_match(found, hit, limit)).select("doc_id", "pos", "date")


def labelled_date(blocks: DataFrame, labels: str = r"(?i)^(?:date of )?(?:hearing|decision|judgment|promulgat\w+)(?: date)?\s*:?$") -> DataFrame:
    """doc_id, pos, label, date: a label row with the date in the row after it."""
    rows = blocks.withColumn("next", F.lead("text").over(seq.window()))
    c = text.clean_whitespace(F.col("text"))
    return rows.where(c.rlike(labels)).select("doc_id", "pos", c.alias("label"), dates.find(F.col("next")).alias("date")).where("date is not null")


def restrictions(blocks: DataFrame) -> DataFrame:
    """is_restriction: red text before anything else that tells of a restriction, or such a line of its own."""
    c = text.clean_whitespace(F.col("text"))
    words = c.rlike(r"(?i)\b(?:reporting restrictions?|anonymity|must not be (?:published|disclosed)|this judgment was (?:delivered|handed down) in private|contempt of court)\b")
    red = F.exists("inlines", lambda i: F.upper(i["color"]).isin("FF0000", "RED", "C00000")) if "inlines" in blocks.columns else F.lit(False)
    return blocks.withColumn("is_restriction", F.coalesce(words | (red & (F.col("pos") < 10)), F.lit(False)))


def press_summary_fields(blocks: DataFrame) -> DataFrame:
    """doc_id with date, doc_type, case_name, cite, on_appeal_from and justices of a press summary's first lines."""
    c = text.clean_whitespace(F.col("text"))
    head = blocks.where(F.col("pos") < 20).withColumn("c", c)
    first = lambda hit, v: F.min(F.when(hit, F.struct("pos", v.alias("v"))))["v"]
    kind = F.col("c").rlike("(?i)^press summary$")
    n = citations.normalize_citation(F.regexp_extract("c", r"(\[\d{4}\] UK(?:SC|PC) \d+)", 1))
    return head.groupBy("doc_id").agg(
        first(dates.find(F.col("c")).isNotNull(), dates.find(F.col("c"))).alias("date"),
        first(kind, F.col("c")).alias("doc_type"),
        first(F.col("c").rlike(r"(?i)\s+(?:v|\(Respondents?\))\s+|^R \("), F.regexp_replace("c", r"\s*\[\d{4}\].*$", "")).alias("case_name"),
        first(n.isNotNull(), n).alias("cite"),
        first(F.col("c").rlike("(?i)^on appeal from"), F.col("c")).alias("on_appeal_from"),
        first(F.col("c").rlike("(?i)^justices:"), F.regexp_replace("c", "(?i)^justices:\\s*", "")).alias("justices"),
    )


def press_summary_header(blocks: DataFrame) -> DataFrame:
    """stage of the first blocks of a press summary: date, type, case, appeal, justices; null where there is no such header."""
    c = text.clean_whitespace(F.col("text"))
    early = F.col("pos") < 30
    steps = [
        ("date", early & dates.find(c).isNotNull()), ("type", early & c.rlike("(?i)^press summary$")), ("cite", early & c.rlike(r"\[\d{4}\] UK(?:SC|PC) \d+")),
        ("appeal", early & c.rlike("(?i)^on appeal from")), ("justices", early & c.rlike("(?i)^justices:?")), ("body", F.upper(c).isin("BACKGROUND TO THE APPEAL", "BACKGROUND TO THE APPEALS", "BACKGROUND", "JUDGMENT")),
    ]
    return seq.stages(blocks, steps, optional=("date", "appeal", "body"))


def without_crest(blocks: DataFrame) -> DataFrame:
    """Without a first block that holds an image only (a crest or seal) before the court's name."""
    only = (F.col("pos") == 0) & F.exists("inlines", lambda i: i["kind"] == "image") & text.is_blank(F.col("text"))
    return blocks.where(~F.coalesce(only, F.lit(False)))


def label_values(c: Column, labels: list[str]) -> Column:
    """struct(label, value) of a `Label: value` line."""
    p = r"(?i)^\s*(" + "|".join(labels) + r")\s*[:\t]\s*(.*)$"
    return F.when(c.rlike(p), F.struct(F.initcap(F.regexp_extract(c, p, 1)).alias("label"), F.trim(F.regexp_extract(c, p, 2)).alias("value")))


def quotes(c: Column) -> Column:
    """struct(opens, closes): numbers of opening and closing double quotes."""
    return F.struct(F.regexp_count(c, F.lit("“")).alias("opens"), F.regexp_count(c, F.lit("”")).alias("closes"))


def defined_terms(c: Column) -> Column:
    """Terms in double quotes that the text goes on to define."""
    return F.regexp_extract_all(c, F.lit(r"“([^”]+)”\s+(?:means|includes|has the (?:same )?meaning|in relation to)"), 1)


def split_span(c: Column, pattern: str, group: int = 1) -> Column:
    """struct(before, span, after) of a match in joined text."""
    m = F.regexp_extract(c, pattern, group)
    at = F.instr(c, m)
    return F.when(m != "", F.struct(F.substring(c, F.lit(1), at - 1).alias("before"), m.alias("span"), F.substring(c, at + F.length(m), F.length(c)).alias("after")))


def heading_depth(outline: Column, style: Column, bold: Column, half_points: Column) -> Column:
    """struct(depth, signal): outline level, else `Heading N`, else bold and large."""
    named = F.regexp_extract(style, r"(?i)^heading\s*([1-6])$", 1).try_cast("int")
    sure = F.coalesce(F.when(outline.between(0, 5), outline + 1), named)
    seen = F.when(bold & (half_points >= 36), 1).when(bold & (half_points >= 30), 2).when(bold & (half_points >= 26), 3)
    depth = F.coalesce(sure, seen)
    return F.when(depth.isNotNull(), F.struct(depth.alias("depth"), F.when(sure.isNotNull(), "authoritative").otherwise("visual").alias("signal")))
