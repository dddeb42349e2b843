"""Queries over the test tables, by name: each as a Spark plan, with SQL where SQL can express it.

There is no legal text in those tables, so operators over lines, runs, roles and the like are shown on documents,
conversations, events and pages; rules for citations, courts and parties run over small tables of their own values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import citations, dates, numbers, text
from ..operators import courts, enrich, legislation, manifest, reconcile, requests, structure, tracking
from ..operators import sequence as seq
from ..sources import files

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).upper() if isinstance(v, bool) else str(v)


def values_sql(rows: list[tuple], columns: str) -> str:
    """A SQL table of literal rows; columns as `name type, ...`, types cast so that nulls have one."""
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
    casts = ", ".join(f"{n}::{kinds[c.split()[1]]} AS {n}" for n, c in zip(names, columns.split(", ")))
    return f"(SELECT {casts} FROM (VALUES {', '.join('(' + ', '.join(map(quoted, r)) + ')' for r in rows)}) v({', '.join(names)}))"


def values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def sql_case(rules: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in rules) + f" ELSE {otherwise} END"


LINES_SQL = """lines AS (SELECT doc_id, (i - 1)::INTEGER AS pos, parts[i] AS text FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)) WHERE trim(regexp_replace(parts[i], '\\s+', ' ', 'g')) <> '')"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.lines(table(spark, sf_dir, "documents"))


# scans, text and hashes


@query(f"""WITH {LINES_SQL},
    cut AS (SELECT doc_id, min(pos) FILTER (length(text) < 60) AS cut FROM lines GROUP BY doc_id),
    per AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (pos < cut) AS n_header, coalesce(sum(length(text)) FILTER (pos < cut), 0)::BIGINT AS header_chars FROM lines l JOIN cut USING (doc_id) GROUP BY l.doc_id)
    SELECT doc_id, lang, coalesce(n_lines, 0) AS n_lines, coalesce(n_header, 0) AS n_header, coalesce(header_chars, 0) AS header_chars, sha256(regexp_replace(text, '\\s', '', 'g')) AS content_hash FROM documents LEFT JOIN per USING (doc_id)""")
def flagship_document_metadata(spark, sf_dir):
    """Block scan, header split and one metadata row per document."""
    docs = table(spark, sf_dir, "documents")
    rows = seq.cut_before_first(lines(spark, sf_dir), F.length("text") < 60)
    head = F.col("pos") < F.col("cut")
    per = rows.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count(F.when(head, 1)).alias("n_header"), F.coalesce(F.sum(F.when(head, F.length("text"))), F.lit(0)).alias("header_chars"))
    out = docs.join(per, "doc_id", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("doc_id", "lang", n("n_lines"), n("n_header"), n("header_chars"), F.sha2(F.regexp_replace("text", r"[ \t\n\x0B\f\r]", ""), 256).alias("content_hash"))


@query(f"WITH {LINES_SQL} SELECT doc_id, pos, text FROM lines")
def s2_block_scan(spark, sf_dir):
    return lines(spark, sf_dir)


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM documents")
def fn_clean_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_whitespace(F.col("text")).alias("clean"))


PATHS = [("a/b/c.docx",), ("x\\y\\z.pdf",), ("plain.doc",), ("a/b\\c.txt",)]


@query("SELECT path, list_extract(string_split(path, CASE WHEN contains(path, '/') THEN '/' ELSE '\\' END), -1) AS name, CASE regexp_extract(path, '(\\.[a-z]+)$', 1) WHEN '.pdf' THEN 'application/pdf' WHEN '.doc' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN '.docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' END AS mime FROM " + values_sql(PATHS, "path string"))
def fn_file_name_and_mime(spark, sf_dir):
    return values(spark, PATHS, "path string").select("path", text.file_name(F.col("path")).alias("name"), text.mime_type(F.regexp_extract("path", r"(\.[a-z]+)$", 1)).alias("mime"))


LISTS = [("1; 2,3 ,, ;4",), ("",), (None,), (" a ",)]


@query("SELECT v, list_aggregate(list_filter(list_transform(string_split_regex(coalesce(v, ''), '[,;]'), lambda x: trim(x)), lambda x: x <> ''), 'string_agg', '|') AS parts FROM " + values_sql(LISTS, "v string"))
def fn_delimited(spark, sf_dir):
    return values(spark, LISTS, "v string").select("v", F.nullif(F.array_join(text.delimited(F.col("v")), "|"), F.lit("")).alias("parts"))


NAMES = [("Mr. John  Smith (Jr.)",), ("“A”, B",), ("X",)]


@query(r"SELECT name, lower(regexp_replace(regexp_replace(name, '\s', '-', 'g'), '[.()“”‘’,]+', '', 'g')) AS id FROM " + values_sql(NAMES, "name string"))
def fn_party_id(spark, sf_dir):
    return values(spark, NAMES, "name string").select("name", text.party_id(F.col("name")).alias("id"))


URIS = [(text.DOMAIN + "id/uksc/2023/1",), (text.DOMAIN + "ewhc/ch/2020/5/data.xml",), ("id/eat/2020/1/data.akn",), ("",), (None,), ("d-123",)]


@query("SELECT uri, nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(uri, '^https://caselaw\\.example\\.org/', ''), '^id/', ''), '/data\\.xml$', ''), '/data\\.akn$', ''), '') AS short FROM " + values_sql(URIS, "uri string"))
def fn_short_uri(spark, sf_dir):
    return values(spark, URIS, "uri string").select("uri", text.short_uri(F.col("uri")).alias("short"))


# citations

CITES = [
    ("[2023]  UKSC 007",), ("[2020] ewca civ 12",), ("[2018[ EWCA Civ 1744",), ("[2017] EWCA 1798 (Civ)",), ("2021 EWHC 3505 (ipec)",), ("[2021] EWHC [3505] (IPEC)",), ("[2006] EWCH 2373 (admin)",), ("[2022] EHWC 950 (Ch)",),
    ("[2022] EWFC 0012 (B)",), ("[2024] EWCOP 3 (t2)",), ("[2021] EWCOP 9",), ("[2023] EWCC 1",), ("[2023] EWCR 02",), ("[2015] UKUT 10(IAC)",), ("[2010[ UKUT 7 (lc)",), ("2007 UKAIT 00034",), ("[2020] EAT 5",), ("[2024] UKFTT 721 (GRC)",), ("[2023] UKIPTrib 3",), ("[2020] UKSC 000",), ("nonsense",), (None,),
]


def _form_sql(c: str, pattern: str, form: str, ignore_case: bool) -> tuple[str, str]:
    import re

    flags = "'i'" if ignore_case else "''"
    p, parts, ok = quoted(pattern), [], f"regexp_matches({c}, {quoted(pattern)}, {flags})"
    for literal, group, how in re.findall(r"([^{]*)(?:\{(\d)(?::(\w))?\})?", form):
        if literal:
            parts.append(quoted(literal))
        if group:
            x = f"regexp_extract({c}, {p}, {group}, {flags})"
            x = {"u": f"upper({x})", "c": f"upper(left({x}, 1)) || lower(substr({x}, 2))", "z": f"ltrim({x}, '0')"}.get(how, x)
            ok += f" AND {x} <> ''" if how == "z" else ""
            parts.append(x)
    return ok, " || ".join(parts)


NORMAL_SQL = sql_case([_form_sql("c", p, f, True) for p, f in citations.SHAPES])
PATH_SQL = "lower(" + sql_case([_form_sql("normal", p, f, False) for p, f in citations.PATHS]) + ")"


@query(f"SELECT cite, normal, path, try_cast(regexp_extract(path, '{citations.PATH_PARTS}', 1) AS INTEGER) AS year, try_cast(regexp_extract(path, '{citations.PATH_PARTS}', 2) AS INTEGER) AS number, regexp_matches(path, '{citations.PATH_SHAPE}') AS is_path FROM (SELECT cite, normal, {PATH_SQL} AS path FROM (SELECT cite, {NORMAL_SQL} AS normal FROM (SELECT cite, trim(regexp_replace(cite, '\\s+', ' ', 'g')) AS c FROM {values_sql(CITES, 'cite string')})))")
def fn_citations(spark, sf_dir):
    n = values(spark, CITES, "cite string").withColumn("normal", citations.normalize_citation(F.col("cite"))).withColumn("path", citations.citation_path(F.col("normal")))
    return n.select("cite", "normal", "path", citations.year_of_path(F.col("path")).alias("year"), citations.number_of_path(F.col("path")).alias("number"), citations.is_path(F.col("path")).alias("is_path"))


HEADS = [("Neutral Citation Number: [2020] EWCA Civ 12",), ("Neutral Citation Number: [2020] EWHC 12 (Ch)",), ("  [2021] EWHC 7 (QB)",), ("NCN: [2021] EWCA Crim 1412",), ("Neutral Citation Nunber: [2006] EWCA Civ 1507",), ("see [2022] EWFC 3 (B)",), ("[2019] EAT 4",), ("nothing",)]
_FIND = [(p, 2) for p in citations.LABELLED] + [(p, 1) for p in citations.BARE + citations.TRIBUNAL]


@query("SELECT line, coalesce(" + ", ".join(f"nullif(regexp_extract(line, {quoted(p)}, {g}, 'i'), '')" for p, g in _FIND) + ") AS cite FROM " + values_sql(HEADS, "line string"))
def e1_neutral_citation(spark, sf_dir):
    return values(spark, HEADS, "line string").select("line", citations.find_citation(F.col("line")).alias("cite"))


SIS = [("2013 No. 1669",), ("201 3 N o. 0012",), ("2013 No. 5 (L. 17)",), ("S. R. 2016 No. 32",), ("2016 SR No. 32",), ("S.S.I. 2014/123",), ("SSI 2014/9 (C. 12)",), ("2013 No. [XXXX]",), ("2013 No. ****",), ("No.",), ("R. No. 5",), ("text",)]
_SI = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(v, '(\\d)\\s+(\\d)', '\\1\\2', 'g'), '([A-Z]\\.)\\s+([A-Z]\\.)', '\\1\\2', 'g'), '\\bN\\s+o\\.', 'No.', 'gi'), '\\s+', ' ', 'g'))"
_SI_PATH = sql_case([(f"regexp_matches(n, {quoted(p)}, 'i')", f"'{k}/' || regexp_extract(n, {quoted(p)}, 1, 'i') || '/' || coalesce(nullif(ltrim(regexp_extract(n, {quoted(p)}, 2, 'i'), '0'), ''), '0')") for p, k in citations.REGULATIONS])


@query(f"SELECT v, n AS clean, {_SI_PATH} AS path, ({_SI_PATH}) IS NOT NULL OR " + " OR ".join(f"regexp_matches(n, {quoted(p)}, 'i')" for p in citations.OPEN_REGULATIONS) + f" AS is_number FROM (SELECT v, {_SI} AS n FROM {values_sql(SIS, 'v string')})")
def fn_regulation_numbers(spark, sf_dir):
    c = F.col("v")
    return values(spark, SIS, "v string").select("v", citations.repair_regulation(c).alias("clean"), citations.regulation_path(c).alias("path"), citations.is_regulation(c).alias("is_number"))


@query("SELECT code, court FROM (SELECT cite AS code, min(court) AS court FROM (SELECT cite, c.code AS court FROM " + values_sql(CITES, "cite string") + " LEFT JOIN " + values_sql([(a, c) for a, _, c in courts.COURTS], "code string, pattern string") + " c ON regexp_matches(trim(regexp_replace(cite, '\\s+', ' ', 'g')), '^(?:' || pattern || ')$')) GROUP BY cite)")
def j3_court_of_citation(spark, sf_dir):
    return values(spark, CITES, "cite string").select(F.col("cite").alias("code"), courts.code_of_citation(F.col("cite")).alias("court"))


PATTERNS = [("ECO", "ECON.*"), ("PROMO", "^PROMO$"), ("S", "^S[A-Z]+"), ("SMALL", "SMALL$"), ("none", "MO")]


@query("SELECT p_partkey, min(code) AS code FROM part LEFT JOIN " + values_sql(PATTERNS, "code string, pattern string") + " ON regexp_full_match(p_type, pattern) GROUP BY p_partkey")
def j3_pattern_join(spark, sf_dir):
    """The regex join with patterns from a table, whole values only, smallest code first."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return courts.by_citation(part, values(spark, PATTERNS, "code string, ncn_pattern string"), ["p_partkey"], "p_type").select("p_partkey", F.col("court_code").alias("code"))


CODES = [("uksc",), ("EWHC-kbd",), ("none",)]


@query("SELECT c, code AS court_code FROM " + values_sql(CODES, "c string") + " LEFT JOIN " + values_sql([(a,) for a, _, _ in courts.COURTS], "code string") + " ON lower(c) = lower(code)")
def j2_court_by_code(spark, sf_dir):
    return courts.by_code(values(spark, CODES, "c string"), courts.table(spark), "c").select("c", "court_code")


# numbers and dates


@query("SELECT n::INTEGER AS n, repeat(chr((97 + (n - 1) % 26)::INTEGER), ((n - 1) // 26 + 1)::INTEGER) AS letters, roman, n::INTEGER AS back FROM (SELECT unnest(range(1, 120)) AS n) JOIN (SELECT h || t || o AS roman, a * 100 + b * 10 + c AS m FROM (VALUES ('', 0), ('c', 1)) h(h, a), (VALUES ('', 0), ('x', 1), ('xx', 2), ('xxx', 3), ('xl', 4), ('l', 5), ('lx', 6), ('lxx', 7), ('lxxx', 8), ('xc', 9)) t(t, b), (VALUES ('', 0), ('i', 1), ('ii', 2), ('iii', 3), ('iv', 4), ('v', 5), ('vi', 6), ('vii', 7), ('viii', 8), ('ix', 9)) o(o, c)) ON n = m")
def fn_roman_and_letters(spark, sf_dir):
    n = spark.range(1, 120).select(F.col("id").cast("int").alias("n"))
    r = n.withColumn("roman", numbers.int_to_roman(F.col("n")))
    return r.select("n", numbers.int_to_letters(F.col("n")).alias("letters"), "roman", numbers.roman_to_int(F.col("roman")).alias("back"))


PAIRS = [("1", "2", True), ("1A", "1B", True), ("1", "1A", True), ("1B", "2", True), ("3", "3ZA", True), ("A1", "1", True), ("AZ1", "A1", True), ("1N", "1P", True), ("1Z", "1Z1", True), ("3Z10", "4", True), ("5ZC", "5A", False), ("1", "3", False), ("2", "1", False), ("7", "7ZZA", True), ("", "1", False)]


@query("SELECT * FROM " + values_sql(PAIRS, "low string, high string, follows boolean"))
def w26_follows(spark, sf_dir):
    return values(spark, PAIRS, "low string, high string, follows boolean").select("low", "high", numbers.follows_column(F.col("low"), F.col("high")).alias("follows"))


DATES = [("Wednesday, 14th January 2025", "2025-01-14"), ("1 March 2020", "2020-03-01"), ("March 3, 2021", "2021-03-03"), ("05/06/2019", "2019-06-05"), ("1.2.2018", "2018-02-01"), ("2020-12-31", "2020-12-31"), ("3rd of May 2011.", "2011-05-03"), ("7 Sep 2010", "2010-09-07"), ("31 February 2020", None), ("soon", None)]


@query("SELECT v, d AS date FROM " + values_sql(DATES, "v string, d string"))
def e6_dates(spark, sf_dir):
    return values(spark, DATES, "v string, d string").select("v", dates.parse(F.col("v")).cast("string").alias("date"))


HEADER_DATES = [("113/12/2012*", "2012-12-13"), ("May 2017 (updated June 2017)", "2017-05-01"), ("13/12/2012", "2012-12-13"), ("14th January 2025;", "2025-01-14"), ("Dec 2014", "2014-12-01"), ("x", None)]


@query("SELECT v, d AS date FROM " + values_sql(HEADER_DATES, "v string, d string"))
def fn_header_dates(spark, sf_dir):
    return values(spark, HEADER_DATES, "v string, d string").select("v", dates.parse_header(F.col("v")).cast("string").alias("date"))


TWO_TONGUES = [("1 Ionawr 2020", "2020-01-01"), ("5 March 2021", "2021-03-05"), ("2019", "2019-01-01"), ("***", None), ("later", "9999-01-01")]


@query("SELECT v, d AS date FROM " + values_sql(TWO_TONGUES, "v string, d string"))
def fn_bilingual_dates(spark, sf_dir):
    return values(spark, TWO_TONGUES, "v string, d string").select("v", dates.parse_bilingual(F.col("v")).cast("string").alias("date"))


# manifest

MANIFEST_COLUMNS = "line_no int, id string, court string, FilePath string, Extension string, decision_datetime string, case_no string, jurisdictions string, claimants string, appellants string, respondent string, main_category string, main_subcategory string, ncn string, uuid string, skip string"
U = "0b0b0b0b-0000-4000-8000-00000000000"
MANIFEST = [
    (2, "1", "UKFTT-GRC", "a\\b\\one.doc", ".doc", "2020-01-02", "EA/1; EA/2", "Transport,Charity", "Smith", None, "HMRC", "Tax", "VAT", "[2020] UKFTT 012 (GRC)", U + "1", ""),
    (3, "2", "EAT", "a/b/two, x.pdf", ".pdf", "1000-01-01 00:00:00", None, None, None, "Jones ", "Crown", None, None, None, U + "2", "no"),
    (4, "3", "EAT", "c.docx", ".docx", "2021-05-06", "", "", "A", "B", "C", None, None, None, U + "3", "F"),
    (5, "4", "", "c.docx", ".docx", "06/05/2021", "", "", None, None, "C", None, "Sub", None, "bad", None),
    (6, "5", "nope", "", "", "", "", "", "", "", "", "", "", "", "", "yes"),
    (7, "6", "UKUT-LC", "d.docx", ".docx", "2019-07-08T10:11:12", None, None, "  ", "D", "E", None, None, "[2019] UKUT 5 (LC)", "{" + U + "6}", "0"),
    (8, "7", "UKUT-LC", "d.docx", ".docx", "2019-17-08", None, None, None, "D", "E", None, None, None, U + "7", "N"),
]


def manifest_rows(spark) -> DataFrame:
    return manifest.from_raw(values(spark, MANIFEST, MANIFEST_COLUMNS))


@query("SELECT line_no, status, n_errors FROM " + values_sql([(2, "valid", 0), (3, "valid", 0), (4, "failed", 1), (5, "failed", 5), (6, "skipped", 0), (7, "valid", 0), (8, "failed", 1)], "line_no int, status string, n_errors int"))
def f1_to_f6_manifest_validation(spark, sf_dir):
    return manifest.validate(manifest_rows(spark)).select("line_no", "status", F.size("errors").alias("n_errors"))


@query("SELECT line_no, file_name, ncn, n_cases, n_categories, first_party, year FROM " + values_sql([(2, "one.doc", "[2020] UKFTT 12 (GRC)", 2, 2, "Smith:Claimant", 2020), (3, "two, x.pdf", None, 0, 0, "Jones:Appellant", 1000), (7, "d.docx", "[2019] UKUT 5 (LC)", 0, 0, "D:Appellant", 2019)], "line_no int, file_name string, ncn string, n_cases int, n_categories int, first_party string, year int"))
def s4_typed_manifest(spark, sf_dir):
    t = manifest.typed(manifest.validate(manifest_rows(spark)))
    return t.select("line_no", "file_name", "ncn", F.size("case_no").alias("n_cases"), F.size("categories").alias("n_categories"), F.concat_ws(":", F.col("parties")[0]["name"], F.col("parties")[0]["role"]).alias("first_party"), F.year("decision_ts").alias("year"))


@query("SELECT * FROM " + values_sql([(U + "1", "ukftt/grc/2020/12", 2020, 12, "decision", "Smith v HMRC"), (U + "2", None, None, None, "dummy", "Jones v Crown"), (U + "6", "ukut/lc/2019/5", 2019, 5, "decision", "D v E")], "uuid string, uri string, year int, number int, date_name string, name string"))
def m7_stub_metadata(spark, sf_dir):
    return reconcile.stub_metadata(manifest.typed(manifest.validate(manifest_rows(spark)))).select("uuid", "uri", "year", "number", "date_name", "name")


@query()
def metadata_fields(spark, sf_dir):
    return manifest.metadata_fields(manifest.typed(manifest.validate(manifest_rows(spark))), F.to_timestamp(F.lit("2024-01-01 00:00:00"))).drop("timestamp")


FLAGS = [(None, False), ("", False), (" N ", False), ("No", False), ("f", False), ("FALSE", False), ("0", False), ("y", True), ("1", True), ("skip me", True)]


@query("SELECT * FROM " + values_sql(FLAGS, "flag string, skipped boolean"))
def f1_skip_flags(spark, sf_dir):
    return values(spark, FLAGS, "flag string, skipped boolean").select("flag", text.is_skipped(F.col("flag")).alias("skipped"))


# run history


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j1_not_yet_processed(spark, sf_dir):
    """Documents without a label, labels taken as a run that sent them."""
    states = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("source_uuid"), F.lit("run1").alias("parser_run_id"), F.lit(tracking.SENT).alias("status"))
    return tracking.not_yet_sent(table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("uuid")), states, "run2").select("doc_id")


#: Events as run history: the hash of a user picks the document, the day parts the runs, the type is the status.
RUN_SQL = "h AS (SELECT user_id::VARCHAR AS source_uuid, CASE WHEN event_id % 3 = 0 THEN 'run1' ELSE 'run2' END AS parser_run_id, CASE event_id % 5 WHEN 0 THEN 'Started' WHEN 1 THEN 'Parsed' WHEN 2 THEN 'ParserFailed' ELSE 'SentToIngester' END AS status, ts AS last_updated, event_id, CASE WHEN event_id % 5 = 2 THEN CASE event_id % 7 WHEN 0 THEN 'Could not find file ' || event_id WHEN 1 THEN 'x ' || event_id || ' was not recognized as a valid DateTime.' ELSE 'boom' END END AS error_message FROM events)"
LATEST_SQL = "l AS (SELECT source_uuid, parser_run_id, arg_max(status, (last_updated, CASE status WHEN 'Started' THEN 1 WHEN 'Parsed' THEN 2 WHEN 'ParserFailed' THEN 3 ELSE 4 END)) AS status, max(last_updated) AS last_updated FROM h GROUP BY ALL)"


def history(spark, sf_dir) -> DataFrame:
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    status = F.when(i % 5 == 0, "Started").when(i % 5 == 1, "Parsed").when(i % 5 == 2, "ParserFailed").otherwise("SentToIngester")
    error = F.when(i % 7 == 0, F.concat(F.lit("Could not find file "), i.cast("string"))).when(i % 7 == 1, F.concat(F.lit("x "), i.cast("string"), F.lit(" was not recognized as a valid DateTime."))).otherwise("boom")
    return e.select(F.col("user_id").cast("string").alias("source_uuid"), F.when(i % 3 == 0, "run1").otherwise("run2").alias("parser_run_id"), status.alias("status"), F.col("ts").alias("last_updated"), F.when(i % 5 == 2, error).alias("error_message"), F.col("event_type").alias("file_extension"))


@query(f"WITH {RUN_SQL}, {LATEST_SQL} SELECT * FROM l")
def k9_latest_state(spark, sf_dir):
    return tracking.latest(history(spark, sf_dir)).select("source_uuid", "parser_run_id", "status", "last_updated")


@query(f"WITH {RUN_SQL}, {LATEST_SQL} SELECT source_uuid AS uuid FROM (SELECT DISTINCT source_uuid FROM h) WHERE source_uuid NOT IN (SELECT source_uuid FROM l WHERE status = 'SentToIngester' AND parser_run_id <> 'run2')")
def j1_not_yet_sent(spark, sf_dir):
    h = history(spark, sf_dir)
    return tracking.not_yet_sent(h.select(F.col("source_uuid").alias("uuid")).distinct(), tracking.latest(h), "run2")


_GROUP = "CASE WHEN starts_with(error_message, 'Could not find file') THEN 'Could not find file' WHEN ends_with(error_message, 'was not recognized as a valid DateTime.') THEN 'String was not recognized as a valid DateTime' ELSE error_message END"


@query(f"WITH {RUN_SQL}, f AS (SELECT {_GROUP} AS error, source_uuid FROM h WHERE status = 'ParserFailed' AND parser_run_id = 'run2'), r AS (SELECT *, row_number() OVER (PARTITION BY error ORDER BY source_uuid) AS n FROM f) SELECT error, count(*) AS n, string_agg(source_uuid, ', ' ORDER BY source_uuid) FILTER (n <= 5) || CASE WHEN count(*) > 5 THEN '...' ELSE '' END AS ids FROM r GROUP BY error")
def a2_failures_by_error(spark, sf_dir):
    return tracking.failures(history(spark, sf_dir), "run2")


@query(f"WITH {RUN_SQL} SELECT event_type AS file_extension, count(*) AS n FROM events WHERE event_id % 3 <> 0 AND event_id % 5 IN (3, 4) GROUP BY event_type")
def a1_by_extension(spark, sf_dir):
    return tracking.by_extension(history(spark, sf_dir), "run2")


@query("SELECT * FROM " + values_sql([(7, 1, 3, 1, 1, 0)], "n_lines long, n_skipped long, n_unreadable long, n_already_done long, n_new long, n_failed long"))
def a3_run_totals(spark, sf_dir):
    states = values(spark, [(U + "1", "r2", "SentToIngester"), (U + "2", "r1", "SentToIngester"), ("other", "r1", "SentToIngester")], "source_uuid string, parser_run_id string, status string")
    return tracking.totals(manifest.validate(manifest_rows(spark)), states, "r2")


@query("""SELECT user_id AS request_id, min(nullif(regexp_extract(props, '"k": *(\\d+)', 1), '')) AS reference, max(CASE WHEN event_type = 'error' THEN ts::VARCHAR END) IS NOT NULL AS has_error, arg_max(event_type, (ts, event_id)) AS report FROM events GROUP BY user_id""")
def a11_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.nullif(F.regexp_extract("props", r'"k": *(\d+)', 1), F.lit(""))
    return e.groupBy(F.col("user_id").alias("request_id")).agg(F.min(k).alias("reference"), (F.count(F.when(F.col("event_type") == "error", 1)) > 0).alias("has_error"), F.max_by("event_type", F.struct("ts", "event_id")).alias("report"))


LOGS = [
    ("r1", 1, "[INFO]  2024-01-01T00:00:01Z  00000000-0000  start d-0b0b0b0b-0000-4000-8000-000000000001"), ("r1", 2, "[ERROR]  2024-01-01T00:00:03Z  00000000-0000  failed 0b0b0b0b-0000-4000-8000-000000000002.tar.gz"),
    ("r1", 3, "[INFO]  2024-01-01T00:00:04Z  00000000-0000  about [2020] EWHC 5 (CH)"), ("r2", 4, "plain"), (None, 5, "lost"),
]


@query("SELECT * FROM " + values_sql([("r1", "d-0b0b0b0b-0000-4000-8000-000000000001", "0b0b0b0b-0000-4000-8000-000000000002", "[2020] EWHC 5 (CH)", "2024-01-01T00:00:04Z | about [2020] EWHC 5 (CH)", None, "2024-01-01T00:00:03Z | failed 0b0b0b0b-0000-4000-8000-000000000002.tar.gz", LOGS[2][2]), ("r2", None, None, None, None, None, None, "plain")], "request_id string, document_uri string, reference string, ncn string, last_info string, last_warning string, last_error string, report string"))
def a11_log_rollup(spark, sf_dir):
    return tracking.log_rollup(values(spark, LOGS, "request_id string, ts int, message string"))


STATES = [("u1", "r1", "t1", "SentToIngester"), ("u2", "r1", "t2", "SentToIngester"), ("u3", "r1", None, "ParserFailed")]
SUMMARIES = [("q1", "t1", "", "rep"), ("q2", "t2", "bad", None), ("", "t9", "", "")]
STATUSES = [("f1", "/a.xml", "Yes", "q1"), ("f2", "/b.xml", "no", "q2"), ("", "/c.xml", "1", "q3")]


@query("SELECT s.source_uuid, m.request_id, nullif(m.last_error, '') AS last_error, document_uri, lower(published) IN ('true', '1', 'yes') AS published FROM " + values_sql(STATES, "source_uuid string, parser_run_id string, tre_reference string, status string") + " s LEFT JOIN (SELECT * FROM " + values_sql(SUMMARIES, "request_id string, tre_reference string, last_error string, lambda_report string") + " WHERE request_id <> '') m USING (tre_reference) LEFT JOIN (SELECT * FROM " + values_sql(STATUSES, "fake_tre_uuid string, document_uri string, published string, aws_request_id string") + " WHERE fake_tre_uuid <> '') d ON d.aws_request_id = m.request_id")
def j14_consolidation(spark, sf_dir):
    states = values(spark, STATES, "source_uuid string, parser_run_id string, tre_reference string, status string")
    s = tracking.run_summaries(values(spark, SUMMARIES, "request_id string, tre_reference string, last_error string, lambda_report string"))
    d = tracking.document_statuses(values(spark, STATUSES, "fake_tre_uuid string, document_uri string, published string, aws_request_id string"))
    return tracking.consolidate(states, s, d).select("source_uuid", "request_id", "last_error", "document_uri", "published")


@query("SELECT coalesce(nullif(lower(lang), 'de'), 'Other') AS extension, count(*) AS expected, count(l.doc_id) AS copied, count(*) - count(l.doc_id) AS failed FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY 1")
def a4_files_by_extension(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("uuid"), F.when(F.col("lang") == "de", "").otherwise(F.col("lang")).alias("extension"))
    return tracking.files_by_extension(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("uuid")))


# ordered rows

TURNS = "SELECT conv_id AS doc_id, turn AS pos, role, text FROM conversations"


def turns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), "role", "text")


@query("WITH r AS (SELECT *, sum(CASE WHEN b THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)) SELECT user_id, event_type, min(event_id) AS first_id, count(*) AS n FROM r GROUP BY user_id, g, event_type")
def w10_merge_runs(spark, sf_dir):
    """Runs of events of one type."""
    e = table(spark, sf_dir, "events")
    by, order = ["user_id"], ["ts", "event_id"]
    r = e.withColumn("g", seq.island(seq.changed("event_type", by=by, order=order), by, order))
    return r.groupBy("user_id", "g", "event_type").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n")).drop("g")


@query(f"WITH t AS ({TURNS}), r AS (SELECT *, sum(CASE WHEN coalesce(f, FALSE) THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM (SELECT *, lag(role = 'user') OVER (PARTITION BY doc_id ORDER BY pos) AS f FROM t)) SELECT doc_id, min(pos) AS pos, string_agg(text, ' ' ORDER BY pos) AS text, count(*) AS n_merged FROM r GROUP BY doc_id, g")
def w6_merge_with_next(spark, sf_dir):
    """A user's turn flows into the next one."""
    t = turns(spark, sf_dir).withColumn("merged_with_next", F.col("role") == "user")
    return seq.merge_flagged(t, separator=" ")


@query(f"WITH {LINES_SQL}, k AS (SELECT *, length(text) % 3 <> 0 AS kept, contains(text, ',') AS v FROM lines), g AS (SELECT *, sum(kept::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) - kept::INTEGER AS g FROM k), m AS (SELECT *, bool_or(v) OVER (PARTITION BY doc_id, g) AS carried FROM g) SELECT doc_id, pos, carried FROM m WHERE kept")
def w7_carry_forward(spark, sf_dir):
    """What dropped lines hold goes to the next line that is kept."""
    return seq.carry_to_next_kept(lines(spark, sf_dir), F.length("text") % 3 != 0, F.col("text").contains(","), "carried").select("doc_id", "pos", "carried")


@query(f"WITH {LINES_SQL}, c AS (SELECT *, coalesce(min(pos) FILTER (starts_with(text, 'The')) OVER w, min(pos) FILTER (length(text) < 40) OVER w) AS cut FROM lines WINDOW w AS (PARTITION BY doc_id)) SELECT doc_id, pos, cut, pos < cut AS is_header FROM c")
def w1_header_cut(spark, sf_dir):
    """The first rule that fits anywhere gives the cut."""
    c = seq.cut_before_first(lines(spark, sf_dir), F.col("text").startswith("The"), F.length("text") < 40)
    return c.select("doc_id", "pos", "cut", (F.col("pos") < F.col("cut")).alias("is_header"))


@query(f"WITH {LINES_SQL}, b AS (SELECT *, sum((length(text) < 60)::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM lines), c AS (SELECT *, min(pos) FILTER (length(text) < 60 AND (n = 2 OR (n = 1 AND starts_with(text, 'A')))) OVER (PARTITION BY doc_id) AS cut FROM b) SELECT doc_id, pos, CASE WHEN pos < cut THEN 'header' ELSE 'body' END AS part FROM c")
def w2_second_break(spark, sf_dir):
    return seq.second_break_split(lines(spark, sf_dir), F.length("text") < 60, F.col("text").startswith("A")).select("doc_id", "pos", "part")


@query(f"WITH {LINES_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM lines WHERE pos < 10 AND contains(text, ',')) SELECT doc_id, pos, text FROM f WHERE n = 1")
def w16_first_match(spark, sf_dir):
    return seq.first_match(lines(spark, sf_dir), F.col("text").contains(","), 10).select("doc_id", "pos", "text")


@query(f"WITH {LINES_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos DESC) AS n FROM lines WHERE contains(text, ',')) SELECT doc_id, pos, text FROM f WHERE n = 1")
def w21_last_match(spark, sf_dir):
    return seq.last_match(lines(spark, sf_dir), F.col("text").contains(",")).select("doc_id", "pos", "text")


GRAM_RULES = [(1, "a", ["user", "assistant", "user"]), (2, "b", ["system", "user"]), (3, "c", ["assistant"]), (4, "d", ["user", "assistant"])]


@query(f"WITH t AS ({TURNS}), g AS (SELECT doc_id, pos, k, list_slice([role, lead(role, 1) OVER w, lead(role, 2) OVER w], 1, k) AS gram FROM t, (SELECT unnest([1, 2, 3]) AS k) ks WINDOW w AS (PARTITION BY doc_id, k ORDER BY pos)), h AS (SELECT doc_id, pos, k, r.rule, r.code, row_number() OVER (PARTITION BY doc_id ORDER BY pos, k DESC, r.rule) AS n FROM g JOIN (VALUES (1, 'a', ['user', 'assistant', 'user']), (2, 'b', ['system', 'user']), (3, 'c', ['assistant']), (4, 'd', ['user', 'assistant'])) r(rule, code, lines) ON gram = lines WHERE pos < 10) SELECT doc_id, pos, k AS n_lines, rule, code FROM h WHERE n = 1")
def w18_kgram_match(spark, sf_dir):
    rules = values(spark, GRAM_RULES, "rule int, code string, lines array<string>")
    return seq.kgram_match(turns(spark, sf_dir), rules, "role", longest=3)


@query("WITH w AS (SELECT user_id, event_id, event_type, lead(event_type, 1) OVER w AS b, lead(event_type, 2) OVER w AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT user_id, count(*) FILTER (event_type <> b AND b <> c AND event_type <> c) AS n FROM w GROUP BY user_id")
def w18_event_triples(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.lead("event_type").over(w).alias("b"), F.lead("event_type", 2).over(w).alias("c"))
    return e.groupBy("user_id").agg(F.count(F.when((F.col("event_type") != F.col("b")) & (F.col("b") != F.col("c")) & (F.col("event_type") != F.col("c")), 1)).alias("n"))


@query(f"WITH {LINES_SQL}, n AS (SELECT *, row_number() OVER w AS n FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), f AS (SELECT *, min(n) FILTER (length(text) < 60) OVER (PARTITION BY doc_id) AS a FROM n), t AS (SELECT *, min(n) FILTER (contains(text, ',') AND n > a) OVER (PARTITION BY doc_id) AS b FROM f) SELECT doc_id, pos, coalesce(n > a AND n <= a + 6 AND (b IS NULL OR n < b), FALSE) AS marked FROM t")
def w20_until_marker(spark, sf_dir):
    return seq.until_marker(lines(spark, sf_dir), F.length("text") < 60, F.col("text").contains(",")).select("doc_id", "pos", "marked")


@query(f"WITH t AS ({TURNS}), b AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 WHEN role = 'assistant' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM t), c AS (SELECT *, coalesce(lag(after) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS before FROM b) SELECT doc_id, pos, after > 0 OR before > 0 AS in_span FROM c")
def w9_spans(spark, sf_dir):
    return seq.spans(turns(spark, sf_dir), F.col("role") == "user", F.col("role") == "assistant").select("doc_id", "pos", "in_span")


@query(f"WITH t AS ({TURNS}), r AS (SELECT *, sum(CASE WHEN role = 'user' OR length(text) >= 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM t), h AS (SELECT *, bool_or(role = 'user') OVER (PARTITION BY doc_id, g) AS has FROM r) SELECT doc_id, min(pos) AS pos, string_agg(text, ' ' ORDER BY pos) AS text FROM h WHERE has GROUP BY doc_id, g")
def w23_continuations(spark, sf_dir):
    return seq.continuations(turns(spark, sf_dir), F.col("role") == "user", F.length("text") < 200)


@query(f"WITH t AS ({TURNS}), e AS (SELECT *, min(pos) FILTER (role <> 'system') OVER w AS a, max(pos) FILTER (role <> 'system') OVER w AS b FROM t WINDOW w AS (PARTITION BY doc_id)) SELECT doc_id, pos FROM e WHERE pos BETWEEN a AND b")
def w11_trim_ends(spark, sf_dir):
    return seq.trim_blank_ends(turns(spark, sf_dir), F.col("role") == "system").select("doc_id", "pos")


@query("SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)::INTEGER AS n, (count(*) FILTER (event_type = 'click') OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS clicks FROM events")
def w14_w15_w24_numbering(spark, sf_dir):
    by, order = ["user_id"], ["ts", "event_id"]
    return table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", seq.attachment_number("event_type", by, order).alias("n"), seq.preceding_count(F.col("event_type") == "click", by, order).alias("clicks"))


NUMBERED = [(1, 0, "1. First"), (1, 1, "(a) sub"), (1, 2, "  12) twelve"), (1, 3, "A. Heading"), (1, 4, "no number"), (1, 5, "(iv) roman"), (1, 6, "3.2 compound"), (1, 7, "12A. section"), (1, 8, "“5. quoted"), (1, 9, "7\ttabbed"), (1, 10, "4.—dash"), (1, 11, "Hello there")]
NUMBERED_OUT = [(0, "1.", "First"), (1, "(a)", "sub"), (2, "12)", "twelve"), (3, "A.", "Heading"), (4, None, "no number"), (5, "(iv)", "roman"), (6, "3.2", "compound"), (7, "12A.", "section"), (8, "“5.", "quoted"), (9, "7", "tabbed"), (10, "4.", "—dash"), (11, None, "Hello there")]


@query("SELECT * FROM " + values_sql(NUMBERED_OUT, "pos int, number string, rest string"))
def w12_hard_numbers(spark, sf_dir):
    return seq.hard_number(values(spark, NUMBERED, "doc_id int, pos int, text string")).select("pos", "number", "rest")


LETTERS = [(1, i, n, 0.0) for i, n in enumerate(["A.", "B.", "D.", "C.", "A.", "1.", "C.", "A.", "B."])]
LETTERS_OUT = [(0, "A."), (1, "B."), (2, None), (3, "C."), (4, None), (5, "1."), (6, None), (7, "A."), (8, "B.")]


@query("SELECT * FROM " + values_sql(LETTERS_OUT, "pos int, number string"))
def w13_letters_in_order(spark, sf_dir):
    return seq.revert_letters(values(spark, LETTERS, "doc_id int, pos int, number string, left_in double")).select("pos", "number")


LISTS_IN = [(1, 0, 1, 0, 1, None), (1, 1, 1, 1, 1, None), (1, 2, 1, 1, 1, None), (1, 3, 1, 0, 1, None), (1, 4, 1, 1, 1, None), (1, 5, 2, 0, 5, None), (1, 6, 2, 0, 5, 9), (1, 7, 2, 0, 5, 9), (1, 8, None, None, None, None)]


@query("SELECT * FROM " + values_sql([(0, 1), (1, 1), (2, 2), (3, 2), (4, 1), (5, 5), (6, 9), (7, 10), (8, None)], "pos int, n int"))
def w14_list_counters(spark, sf_dir):
    return seq.list_counters(values(spark, LISTS_IN, "doc_id int, pos int, list_id int, level int, start int, restart int")).select("pos", "n")


@query("WITH o AS (SELECT conv_id AS doc_id, turn AS pos, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS depth FROM conversations), u AS (SELECT *, sum((depth < 1)::INTEGER) OVER w AS u1, sum((depth < 2)::INTEGER) OVER w AS u2, sum((depth < 3)::INTEGER) OVER w AS u3 FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) SELECT doc_id, pos, concat_ws('_', (sum((depth = 1)::INTEGER) OVER (PARTITION BY doc_id, u1 ORDER BY pos))::VARCHAR, CASE WHEN depth >= 2 THEN (sum((depth = 2)::INTEGER) OVER (PARTITION BY doc_id, u2 ORDER BY pos))::VARCHAR END, CASE WHEN depth >= 3 THEN (sum((depth = 3)::INTEGER) OVER (PARTITION BY doc_id, u3 ORDER BY pos))::VARCHAR END) AS path FROM u")
def w25_level_paths(spark, sf_dir):
    d = turns(spark, sf_dir).withColumn("depth", F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(3))
    return seq.level_path(d, deepest=3).select("doc_id", "pos", "path")


PARAS = [(1, 0, "1."), (1, 1, "2."), (1, 2, "1."), (1, 3, None), (1, 4, "(a)"), (2, 0, "1")]


@query("SELECT * FROM " + values_sql([(1, 0, "para_1"), (1, 1, "para_2"), (1, 2, "lvl_3"), (1, 3, "lvl_4"), (1, 4, "lvl_5"), (2, 0, "para_1")], "doc_id int, pos int, eid string"))
def w25_paragraph_ids(spark, sf_dir):
    return seq.paragraph_ids(values(spark, PARAS, "doc_id int, pos int, number string")).select("doc_id", "pos", "eid")


@query(f"WITH {LINES_SQL} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos)::INTEGER AS entry, pos, trim(text) AS heading FROM lines WHERE length(text) < 60 UNION ALL SELECT DISTINCT doc_id, 0, -1, 'Whole document' FROM lines")
def w27_toc(spark, sf_dir):
    return seq.toc(lines(spark, sf_dir), F.length("text") < 60)


CELLS_IN = [(1, 0, 0, 0, 2, None), (1, 0, 0, 1, 1, "restart"), (1, 0, 1, 0, 1, None), (1, 0, 1, 1, 1, None), (1, 0, 1, 2, 1, "continue"), (1, 0, 2, 0, 3, None)]


@query("SELECT * FROM " + values_sql([(0, 0, 0, 1), (0, 1, 2, 2), (1, 0, 0, 1), (1, 1, 1, 1), (2, 0, 0, 1)], "row int, cell int, grid_col int, rowspan int"))
def w28_table_grid(spark, sf_dir):
    return seq.table_grid(values(spark, CELLS_IN, "doc_id int, tbl int, row int, cell int, colspan int, vmerge string")).select("row", "cell", "grid_col", "rowspan")


@query("SELECT o_custkey, o_orderkey, (sum(o_totalprice::DECIMAL(28,6)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE AS sum_above FROM orders")
def a10_sum_above(spark, sf_dir):
    """Orders of a customer as a column of a table."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.lit(0).alias("tbl"), F.lit(0).alias("col"), F.col("o_orderkey").alias("row"), F.col("o_totalprice").cast("string").alias("text"))
    return seq.column_sums(o).select(F.col("doc_id").alias("o_custkey"), F.col("row").alias("o_orderkey"), "sum_above")


HEADINGS = [(1, 0, "Head", 1, "visual"), (1, 1, "x" * 50, None, None), (1, 2, "Thin", 2, "visual"), (1, 3, "y", None, None), (1, 4, "Next", 1, "authoritative"), (1, 5, "z", None, None)]


@query("SELECT * FROM " + values_sql([(0, 1), (1, None), (2, None), (3, None), (4, 1), (5, None)], "pos int, depth int"))
def f23_demote_headings(spark, sf_dir):
    return seq.demote_thin_headings(values(spark, HEADINGS, "doc_id int, pos int, text string, depth int, signal string")).select("pos", "depth")


# sections and structure


@query(f"WITH {LINES_SQL}, s AS (SELECT *, sum((length(text) < 60)::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM lines) SELECT doc_id, pos, section::BIGINT AS section, CASE WHEN section > 0 THEN first(text) OVER (PARTITION BY doc_id, section ORDER BY pos) END AS section_heading FROM s")
def t4_headed_sections(spark, sf_dir):
    return structure.headed_sections(lines(spark, sf_dir), F.length("text") < 60).select("doc_id", "pos", "section", "section_heading")


BODY = [
    (1, 0, "Introduction", None, 0.0), (1, 1, "First para", "1.", 0.0), (1, 2, "sub a", "(a)", 0.5), (1, 3, "sub i", "(i)", 1.0), (1, 4, "sub b", "(b)", 0.5), (1, 5, "“quoted text", None, 1.0),
    (1, 6, "Discussion", None, 0.0), (1, 7, "Second para", "2.", 0.0), (1, 8, "Annex 1", None, 0.0), (1, 9, "annex text.", None, 0.0),
]
BODY_OUT = [
    ("1", 0, None, "crossHeading", None), ("1", 1, 0, "paragraph", "1."), ("1", 2, 1, "subparagraph", "(a)"), ("1", 3, 2, "subparagraph", "(i)"), ("1", 4, 1, "subparagraph", "(b)"), ("1", 5, 4, "quotedStructure", None), ("1", 6, 5, "paragraph", None),
    ("1", 7, None, "crossHeading", None), ("1", 8, 7, "paragraph", "2."), ("1", 9, None, "annex", "Annex 1"), ("1", 10, 9, "paragraph", None),
]


@query("SELECT * FROM " + values_sql(BODY_OUT, "doc_id string, node_id int, parent_id int, name string, number string"))
def t1_to_t7_divisions(spark, sf_dir):
    return structure.build(values(spark, BODY, "doc_id int, pos int, text string, number string, indent double")).select("doc_id", "node_id", "parent_id", "name", "number")


@query("WITH s AS (SELECT doc_id, text, lag(length(text)) OVER (PARTITION BY doc_id ORDER BY pos) AS x, pos FROM (SELECT conv_id AS doc_id, turn AS pos, text FROM conversations)) SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id")
def t1_documents_to_divisions(spark, sf_dir):
    """All turns of conversations as blocks of a body: each becomes one division."""
    b = turns(spark, sf_dir).withColumn("number", F.concat((F.col("pos") + 1).cast("string"), F.lit("."))).withColumn("indent", F.lit(0.0))
    return structure.build(b).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))


@query(None)
def t1_conversation_divisions(spark, sf_dir):
    """The division rows of all conversations, with whole texts: turns of the user are numbered, all others are not."""
    b = turns(spark, sf_dir).withColumn("number", F.when(F.col("role") == "user", F.concat((F.col("pos") + 1).cast("string"), F.lit(".")))).withColumn("indent", F.lit(0.0))
    return structure.build(b)


BILL = [
    (1, 0, None, "PART 1"), (1, 1, None, "Preliminary"), (1, 2, "1", "Overview"), (1, 3, "(1)", "This Act—"), (1, 4, "(a)", "does this,"), (1, 5, "(b)", "does that."), (1, 6, "(2)", "More."), (1, 7, "2", "Change of law"),
    (1, 8, None, "“2A"), (1, 9, None, "New text”"), (1, 10, None, "PART 2"), (1, 11, "3", "End"), (1, 12, None, "SCHEDULE 1"), (1, 13, "1", "Para"), (1, 14, None, "EXPLANATORY NOTE"), (1, 15, None, "It explains."),
]
BILL_OUT = [
    (0, None, "part", "PART 1"), (1, 0, "section", "1"), (2, 1, "subsection", "(1)"), (3, 2, "para1", "(a)"), (4, 2, "para1", "(b)"), (5, 1, "subsection", "(2)"), (6, 0, "section", "2"), (7, 6, "quotedStructure", None), (8, 7, "unnumbered", None), (9, 7, "unnumbered", None),
    (10, None, "part", "PART 2"), (11, 10, "section", "3"), (12, None, "schedule", "SCHEDULE 1"), (13, 12, "schProv1", "1"), (14, None, "explanatoryNote", None),
]


@query("SELECT * FROM " + values_sql(BILL_OUT, "node_id int, parent_id int, name string, number string"))
def t11_bill(spark, sf_dir):
    from . import bills

    return bills.parse(values(spark, BILL, "doc_id int, pos int, number string, text string")).select("node_id", "parent_id", "name", "number")


INDENTS = [(0.0, 0.0, 0), (0.5, -0.5, 1), (0.0, 0.0, 2), (1.0, -0.25, 0), (None, None, 1)]


@query("SELECT * FROM " + values_sql([(0.0, 0.0, 0, 0.0), (0.5, -0.5, 1, 0.5), (0.0, 0.0, 2, 1.0), (1.0, -0.25, 0, 0.75), (None, None, 1, 0.5)], "left_in double, first_in double, tabs int, indent double"))
def f11_indents(spark, sf_dir):
    v = values(spark, INDENTS, "left_in double, first_in double, tabs int")
    return v.withColumn("indent", structure.effective_indent(F.col("left_in"), F.col("first_in"), F.col("tabs")))


STYLES = [("a", "b", None), ("b", "c", None), ("c", None, "bold"), ("d", None, None), ("e", "a", "own")]


@query("WITH RECURSIVE s AS (SELECT * FROM " + values_sql(STYLES, "style string, based_on string, prop string") + "), r AS (SELECT style, based_on, prop FROM s UNION ALL SELECT r.style, s.based_on, s.prop FROM r JOIN s ON r.based_on = s.style WHERE r.prop IS NULL) SELECT style, max(prop) AS prop FROM r GROUP BY style")
def j10_inherited_style(spark, sf_dir):
    return structure.inherited(values(spark, STYLES, "style string, based_on string, prop string"), "prop")


@query("SELECT c.c_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, max(o_orderdate) AS last_date, count(o_orderkey) AS n FROM customer c LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def a5_a7_first_and_main(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"), F.max("o_orderdate").alias("last_date"), F.count("*").alias("n"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("WITH c AS (SELECT doc_id, 1 AS attempt, (length(text) > 500)::INTEGER + (contains(text, ','))::INTEGER AS score FROM documents UNION ALL SELECT doc_id, 2, (length(text) > 1000)::INTEGER + 1 FROM documents UNION ALL SELECT doc_id, 3, (lang = 'en')::INTEGER * 2 FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, attempt) AS n FROM c) SELECT doc_id, attempt, score FROM r WHERE n = 1")
def a9_best_candidate(spark, sf_dir):
    """Three attempts at a document, the best kept, the earlier on ties."""
    d = table(spark, sf_dir, "documents")
    i = lambda c: c.cast("int")
    t = F.col("text")
    a = d.select("doc_id", F.lit(1).alias("attempt"), (i(F.length(t) > 500) + i(t.contains(","))).alias("score"))
    b = d.select("doc_id", F.lit(2).alias("attempt"), (i(F.length(t) > 1000) + 1).alias("score"))
    c = d.select("doc_id", F.lit(3).alias("attempt"), (i(F.col("lang") == "en") * 2).alias("score"))
    return reconcile.best_candidate(a.unionAll(b).unionAll(c))


@query("SELECT user_id, count(DISTINCT event_type) FILTER (event_type NOT IN ('click', 'view', 'purchase')) > 0 AS conflict FROM events GROUP BY user_id")
def j13_superset(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("t"))
    return e.select("user_id", reconcile.jurisdictions(F.col("t"), F.array(F.lit("click"), F.lit("view"), F.lit("purchase")))["conflict"].alias("conflict"))


@query("SELECT o_orderkey AS doc_id, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'ext' END, o_orderpriority) AS court, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 3 = 0 THEN 'n' || o_orderkey END) AS name FROM orders")
def m2_external_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    docs = o.select(k.alias("doc_id"), F.col("o_orderpriority").alias("court"), F.when(k % 3 == 0, F.concat(F.lit("n"), k.cast("string"))).alias("name"))
    ext = o.select(k.alias("doc_id"), F.when(k % 3 == 0, "ext").alias("court"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("name"))
    return reconcile.reconcile(docs, ext).select("doc_id", "court", "name")


@query("SELECT o_orderkey AS doc_id, o_orderpriority AS court, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 2 = 0 THEN o_orderstatus ELSE coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'n' || o_orderkey END, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) END AS name FROM orders")
def m1_document_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    docs = o.select(k.alias("doc_id"), F.col("o_orderpriority").alias("court"), F.when(k % 3 == 0, F.concat(F.lit("n"), k.cast("string"))).alias("name"))
    ext = o.select(k.alias("doc_id"), F.when(k % 3 == 0, "ext").alias("court"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("name"), (k % 5 == 0).alias("uri_trumps"))
    return reconcile.reconcile(docs, ext, external_first=False).select("doc_id", "court", "name")


# parties, roles and lookups

ROLE_LINES = [("Appellant", "Appellant"), ("1st Respondents", "Respondent"), ("Part 20 Claimant", "Claimant"), ("Third Party", "ThirdParty"), ("Respondent/Appellant", "Appellant"), ("Claimant and Defendant", "Claimant"), ("Defendant and Applicant", "Applicant"), ("(Interested Parties)", "InterestedParty"), ("Claimant/Petitioner", None), ("/ Appellant", "Appellant"), ("nobody", None), ("Requesting State", "RequestingState")]


@query("SELECT * FROM " + values_sql(ROLE_LINES, "line string, role string"))
def e9_roles(spark, sf_dir):
    return values(spark, ROLE_LINES, "line string, role string").select("line", enrich.role(F.col("line")).alias("role"))


PARTY_LINES = [(1, 0, "BETWEEN:"), (1, 1, "THE KING (on the application of)"), (1, 2, "JOHN SMITH"), (1, 3, "Claimant"), (1, 4, "- v -"), (1, 5, "HOME OFFICE"), (1, 6, "Defendant"), (2, 0, "(1) ACME LTD"), (2, 1, "Appellant"), (2, 2, "and"), (2, 3, "HMRC"), (2, 4, "Respondents")]


@query("SELECT * FROM " + values_sql([(1, "JOHN SMITH", "Claimant"), (1, "HOME OFFICE", "Defendant"), (2, "ACME LTD", "Appellant"), (2, "HMRC", "Respondent")], "doc_id int, name string, role string"))
def e8_parties(spark, sf_dir):
    return enrich.parties(values(spark, PARTY_LINES, "doc_id int, pos int, text string")).select("doc_id", "name", "role")


PARTIES = [(1, 0, "THE KING (on the application of)", "Claimant"), (1, 1, "Smith", "Claimant"), (1, 2, "Home Office", "Defendant"), (2, 0, "A", "Appellant"), (2, 1, "B", "Appellant"), (2, 2, "C", "Respondent"), (3, 0, "THE QUEEN", "Claimant"), (3, 1, "(on the application of JONES)", "Claimant"), (3, 2, "X", "Defendant")]


@query("SELECT * FROM " + values_sql([(1, "Smith (R on the application of) v Home Office"), (2, "A v C"), (3, "JONES (R on the application of) v X")], "doc_id int, case_name string"))
def e16_case_name(spark, sf_dir):
    return enrich.case_name(values(spark, PARTIES, "doc_id int, pos int, name string, role string"))


JLINES = [("(Charity)", "Charity"), ("Freedom of Information Act", "InformationRights"), ("Animal welfare", "WelfareOfAnimals"), ("transport", "Transport"), ("Tax", None)]


@query("SELECT * FROM " + values_sql(JLINES, "line string, j string"))
def e5_jurisdictions(spark, sf_dir):
    return values(spark, JLINES, "line string, j string").select("line", enrich.jurisdiction(F.col("line")).alias("j"))


COURT_BLOCKS = [(1, 0, "x"), (1, 1, "IN THE HIGH COURT OF  JUSTICE"), (1, 2, "King’s Bench Division"), (1, 3, "Administrative Court"), (2, 0, "IN THE HIGH COURT OF JUSTICE"), (2, 1, "QUEEN'S BENCH DIVISION"), (3, 0, "none")]


@query("SELECT * FROM " + values_sql([(1, 1, 3, "EWHC-KBD-Admin"), (2, 0, 2, "EWHC-QBD")], "doc_id int, pos int, n_lines int, code string"))
def e4_court_of_lines(spark, sf_dir):
    return enrich.court_of_lines(values(spark, COURT_BLOCKS, "doc_id int, pos int, text string"), enrich.court_rules(spark)).select("doc_id", "pos", "n_lines", "code")


JUDGES = [("MR JUSTICE SMITH", True), ("Lady Justice Rose:", True), ("Mrs Justice O'Brien", False), ("Mr A.B. Jones", True), ("John Brown QC, Deputy High Court Judge", True), ("The Court", False)]


@query("SELECT * FROM " + values_sql(JUDGES, "line string, is_judge boolean"))
def f10_judge_names(spark, sf_dir):
    return values(spark, JUDGES, "line string, is_judge boolean").select("line", enrich.is_judge_name(F.col("line")).alias("is_judge"))


ANNEX = [("Annex", True), ("ANNEX 12", True), ("- annex -", True), ("Appendix", True), ("Annex A", False), ("the annex", False)]


@query("SELECT * FROM " + values_sql(ANNEX, "line string, is_annex boolean"))
def f12_annex_heading(spark, sf_dir):
    return values(spark, ANNEX, "line string, is_annex boolean").select("line", structure.is_annex(F.col("line")).alias("is_annex"))


HEADS_IN = [(0, "x", None, None), (None, "Heading 3", None, None), (None, "Body", True, 36), (None, "Body", True, 28), (None, "Body", True, 20), (7, "heading2", None, None)]


@query("SELECT * FROM " + values_sql([(0, "x", None, None, 1, "authoritative"), (None, "Heading 3", None, None, 3, "authoritative"), (None, "Body", True, 36, 1, "visual"), (None, "Body", True, 28, 3, "visual"), (None, "Body", True, 20, None, None), (7, "heading2", None, None, 2, "authoritative")], "outline int, style string, bold boolean, size int, depth int, signal string"))
def e17_heading_depth(spark, sf_dir):
    v = values(spark, HEADS_IN, "outline int, style string, bold boolean, size int")
    h = enrich.heading_depth(F.col("outline"), F.col("style"), F.col("bold"), F.col("size"))
    return v.withColumn("h", h).select("outline", "style", "bold", "size", "h.depth", "h.signal")


@query("SELECT * FROM " + values_sql([(k, "http://www.legislation.gov.uk/id/" + v) for k, v in legislation.AUTHORS.items()] + [("x", None)], "class string, author string"))
def j7_work_author(spark, sf_dir):
    return values(spark, [(k,) for k in legislation.AUTHORS] + [("x",)], "class string").select("class", legislation.author(F.col("class")).alias("author"))


@query("SELECT * FROM " + values_sql([(k.lower(), e, p) for k, (e, p) in legislation.DOC_NAMES.items()] + [("zz", None, None)], "name string, enacted string, is_primary boolean"))
def fn_doc_names(spark, sf_dir):
    v = values(spark, [(k.lower(),) for k in legislation.DOC_NAMES] + [("zz",)], "name string")
    d = legislation.doc_name(F.col("name"))
    return v.select("name", d["enacted"].alias("enacted"), d["is_primary"].alias("is_primary"))


MAP_ROWS = [(1, "UKIA_20130012_en.pdf", "t1", "http://www.legislation.gov.uk/id/uksi/2013/5", "Final"), (2, "ukia_20130012_EN.docx", "t2", None, None), (3, "ukia_20140003_en.pdf", "t3", None, "Post Implementation"), (4, "", "t4", None, None)]


@query("SELECT * FROM " + values_sql([(2013, 12, "t1", "uksi/2013/5/impacts/2013/12", "final"), (2014, 3, "t3", "ukia/2014/3", "post-implementation"), (2015, 1, None, "ukia/2015/1", None)], "year int, number int, document_title string, uri string, stage string"))
def j4_j5_mapping(spark, sf_dir):
    raw = values(spark, MAP_ROWS, "line_no int, filename string, document_title string, legislation_uri string, document_stage string")
    for c in legislation.MAPPING:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    docs = values(spark, [(2013, 12), (2014, 3), (2015, 1)], "year int, number int")
    return legislation.by_assessment(docs, legislation.mapping(raw)).select("year", "number", "document_title", "uri", "stage")


@query("SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def j2_dimension_lookup(spark, sf_dir):
    """A lookup of a small dimension; its size decides about a broadcast."""
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("court_name"))
    n = table(spark, sf_dir, "nation").withColumn("court", F.col("n_regionkey").cast("string"))
    return courts.by_code(n, r).select("n_nationkey", "n_name", F.col("court_name").alias("r_name"))


REQUESTS = [
    (1, '{"consignment-reference": "TDR-1", "document-type": "judgment", "metadata": {"uri": "https://caselaw.example.org/id/uksc/2023/1", "cite": "[2023] UKSC 01", "court": "uksc", "date": "2023-01-02", "name": "A v B"}}', "uksc/2023/1", "[2023] UKSC 1", "Judgment", 0),
    (2, '{"document-type": "pressSummary", "metadata": {"uri": "uksc/2023/1"}}', "uksc/2023/1", None, "PressSummary", 1),
    (3, '{"document-type": "judgment", "metadata": {"uri": "x y", "cite": "bad", "court": "none", "date": "1/2/2023"}}', "x y", None, "Judgment", 4),
    (4, '{"metadata": {"uri": ""}}', None, None, None, 1),
    (5, '{"document-type": "judgment", "metadata": {"court": "EWHC-KBD"}}', None, None, "EWHC", 0),
    (6, '{"document-type": "judgment"}', None, None, "Judgment", 0),
]


@query("SELECT * FROM " + values_sql([(i, u, c, h, n) for i, _, u, c, h, n in REQUESTS], "id int, uri string, cite string, hint string, n_errors int"))
def f17_f18_requests(spark, sf_dir):
    raw = values(spark, [(i, v) for i, v, *_ in REQUESTS], "id int, value string")
    return requests.check(requests.from_json(raw)).select("id", "uri", "cite", "hint", F.size("errors").alias("n_errors"))


@query("""SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", files.variant_value(F.replace("props", F.lit('"k"'), F.lit('"value"')), "int").alias("k"))


@query("SELECT doc_id, (length(text) - length(replace(text, ',', '')))::INTEGER AS opens, (length(text) - length(replace(text, '.', '')))::INTEGER AS closes FROM documents")
def a12_quote_counts(spark, sf_dir):
    """Commas and full stops stand in for the quotes, which these texts do not have."""
    q = enrich.quotes(F.translate("text", ",.", "“”"))
    return table(spark, sf_dir, "documents").select("doc_id", q["opens"].alias("opens"), q["closes"].alias("closes"))


@query(r"""SELECT page_id AS doc_id, (i - 1)::INTEGER AS i, l[i] AS text FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))""")
def t19_page_descendants(spark, sf_dir):
    """The links of a page among its inlines, in order."""
    found = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)
    inlines = F.flatten(F.transform(found, lambda x: F.array(F.struct(F.lit("link").alias("kind"), x.alias("text")))))
    blocks = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.lit(0).alias("pos"), inlines.alias("inlines"))
    return structure.descendants(blocks, "link").select("doc_id", "i", "text")


INLINES = [(1, 0, [("text", "a"), ("link", "b")]), (1, 1, [("link", "c")]), (2, 0, [])]


@query("SELECT * FROM " + values_sql([(1, 0, 1, "b"), (1, 1, 0, "c")], "doc_id int, pos int, i int, text string"))
def t19_descendants(spark, sf_dir):
    v = values(spark, INLINES, "doc_id int, pos int, inlines array<struct<kind:string,text:string>>")
    return structure.descendants(v, "link").select("doc_id", "pos", "i", "text")


META = [("1", "uksc/2023/1", "2023-01-02", "judgment", "UKSC", "[2023] UKSC 1", 2023, 1, "A & B v \"C\""), ("2", None, None, None, None, None, None, None, None)]
META_COLUMNS = "doc_id string, uri string, date string, date_name string, court string, cite string, year int, number int, name string"


@query("SELECT doc_id, nullif(uri, '') AS uri, date, court, cite, year, number, name, 0 AS n_errors FROM " + values_sql(META, META_COLUMNS))
def k6_e18_stub_round_trip(spark, sf_dir):
    """Stub XML written from metadata, checked, and read back."""
    from . import akn

    x = akn.check(akn.stub(values(spark, META, META_COLUMNS)))
    return akn.extract_metadata(x).select("doc_id", "uri", "date", "court", "cite", "year", "number", "name", F.size("errors").alias("n_errors"))


@query("SELECT '1' AS doc_id, 0 AS n_errors, 11 AS n_ids")
def t21_akn_build(spark, sf_dir):
    from . import akn

    d = structure.build(values(spark, BODY, "doc_id int, pos int, text string, number string, indent double"))
    x = akn.check(akn.build(d, values(spark, META[:1], META_COLUMNS)))
    return x.select("doc_id", F.size("errors").alias("n_errors"), F.size(F.regexp_extract_all("xml", F.lit(r'\beId="([^"]*)"'), 1)).alias("n_ids"))


SI_LINES = [(1, 0, "Made - - - - 5th March 2021"), (1, 1, "Laid before Parliament 8th March 2021"), (1, 2, "Coming into force ***"), (1, 3, "Gwnaed 1 Ionawr 2020"), (1, 4, "text")]


@query("SELECT pos, kind, date FROM " + values_sql([(0, "made", "2021-03-05"), (1, "laid", "2021-03-08"), (2, "commence", None), (3, "made", "2020-01-01")], "pos int, kind string, date string"))
def t17_instrument_dates(spark, sf_dir):
    return legislation.instrument_dates(values(spark, SI_LINES, "doc_id int, pos int, text string")).select("pos", "kind", F.col("date").cast("string").alias("date"))


REFS = [(1, "varBillTitle", "B", 1), (1, "varAuthor", "X", 1), (1, "varAuthor", "Y", 2), (1, "varHouse", "H", 1), (1, "other", "z", 1)]


@query("SELECT * FROM " + values_sql([(1, "varBillTitle", "B"), (1, "varHouse", "H"), (1, "varAuthor", "X"), (1, "varAuthor2", "Y")], "doc_id int, eid string, show_as string"))
def m10_references(spark, sf_dir):
    return legislation.references(values(spark, REFS, "doc_id int, key string, show_as string, occurrence int")).select("doc_id", "eid", "show_as")


LEG = [(1, 0, "  EXPLANATORY MEMORANDUM TO"), (1, 1, "THE THING ORDER"), (1, 2, "(AMENDED)"), (1, 3, "2013 No. 12"), (1, 4, "1. Text"), (2, 0, "No header")]


@query("SELECT * FROM " + values_sql([(1, 0, "doc_type"), (1, 1, "title"), (1, 2, "title"), (1, 3, "number"), (1, 4, "body"), (2, 0, "body")], "doc_id int, pos int, state string"))
def w5_leg_header(spark, sf_dir):
    return legislation.header_states(values(spark, LEG, "doc_id int, pos int, text string")).select("doc_id", "pos", "state")


PS = [(1, 0, "2 March 2023"), (1, 1, "PRESS SUMMARY"), (1, 2, "Smith (Appellant) v Jones (Respondent)"), (1, 3, "[2023] UKSC 7"), (1, 4, "On appeal from [2021] EWCA Civ 1"), (1, 5, "Justices: Lord A, Lady B")]


@query("SELECT 1 AS doc_id, '2023-03-02' AS date, 'PRESS SUMMARY' AS doc_type, 'Smith (Appellant) v Jones (Respondent)' AS case_name, '[2023] UKSC 7' AS cite, 'On appeal from [2021] EWCA Civ 1' AS on_appeal_from, 'Lord A, Lady B' AS justices")
def e13_press_summary(spark, sf_dir):
    return enrich.press_summary_fields(values(spark, PS, "doc_id int, pos int, text string")).withColumn("date", F.col("date").cast("string"))


# fields

FIELDS = [
    (0, ' HYPERLINK "http://x.org/" \\l "p" ', "handle", "http://x.org/#p", None, None), (1, ' HYPERLINK \\l "b1" ', "handle", "#b1", None, None), (2, " REF _Ref1 \\h ", "handle", "#_Ref1", None, None), (3, " PRIVATE x", "skip", None, None, None),
    (4, " =SUM(ABOVE) ", "contents", None, None, None), (5, " SYMBOL 183 \\f \"Symbol\" \\s 10 \\h ", "handle", None, "·", None), (6, " SYMBOL 150 \\* MERGEFORMAT ", "handle", None, "–", None), (7, " LISTNUM L1 \\s 5", "handle", None, None, 5),
    (8, " LISTNUM L1", "handle", None, None, 6), (9, " AUTONUM ", "handle", None, None, 1), (10, " LINK Excel.Sheet.8 x", "unsupported", None, None, None), (11, " seq Figure", "contents", None, None, None), (12, " WHAT ", "unknown", None, None, None),
]


@query("SELECT * FROM " + values_sql([(i, a, t, s, n) for i, _, a, t, s, n in FIELDS], "pos int, action string, target string, symbol string, n int"))
def d2_d3_fields(spark, sf_dir):
    from ..operators import fields

    f = values(spark, [(1, i, c) for i, c, *_ in FIELDS], "doc_id int, pos int, code string")
    c = F.col("code")
    return fields.numbered(f).select("pos", fields.action(c).alias("action"), fields.link(c).alias("target"), fields.symbol(c).alias("symbol"), "n")


# metadata, links and stores over the order tables


def order_dates(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("name"), F.col("o_orderdate").cast("date").alias("value"))


@query("SELECT o_custkey AS doc_id, o_orderpriority AS name, min(o_orderkey) AS pos, arg_min(o_orderdate::DATE, o_orderkey)::VARCHAR AS value FROM orders GROUP BY ALL")
def a5_unique_dates(spark, sf_dir):
    return reconcile.unique_dates(order_dates(spark, sf_dir), "name").select("doc_id", "name", "pos", F.col("value").cast("string").alias("value"))


@query("SELECT o_custkey AS doc_id, arg_min(o_orderpriority, o_orderkey) AS name, arg_min(o_orderstatus, o_orderkey) AS role, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') AS roles FROM orders GROUP BY o_custkey, o_orderpriority")
def a6_unique_parties(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("role"))
    return reconcile.unique_parties(o).select("doc_id", "name", "role", F.array_join("roles", ",").alias("roles"))


@query("SELECT o_custkey AS doc_id, max(o_orderdate::DATE)::VARCHAR AS date, arg_max(o_orderpriority, (o_orderdate::DATE, -o_orderkey)) AS name FROM orders GROUP BY o_custkey")
def a7_main_date(spark, sf_dir):
    return reconcile.main_date(order_dates(spark, sf_dir)).select("doc_id", F.col("date").cast("string").alias("date"), "name")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'EWHC-KBD' WHEN 1 THEN 'UKSC' WHEN 2 THEN 'UKPC' WHEN 3 THEN 'EWHC' END AS court FROM documents")
def m3_court(spark, sf_dir):
    """Refined by the citation, not contradicted by it, known from it alone, from the tag alone, from neither."""
    i = F.col("doc_id") % 5
    tagged = F.when(i == 0, "EWHC").when(i == 1, "UKSC").when(i == 3, "EWHC")
    cite = F.when(i <= 1, F.concat(F.lit("[2020] EWHC "), F.col("doc_id") + 1, F.lit(" (KB)"))).when(i == 2, F.concat(F.lit("[2019]  UKPC "), F.col("doc_id"))).otherwise("none")
    return table(spark, sf_dir, "documents").select("doc_id", reconcile.court(tagged, cite).alias("court"))


@query("SELECT doc_id, 'https://docs.example.org/id/uksc/2020/' || doc_id AS work, 'https://docs.example.org/uksc/2020/' || doc_id AS expression, 'https://docs.example.org/uksc/2020/' || doc_id || '/data.xml' AS manifestation FROM documents")
def m4_uris(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", reconcile.uris(F.concat(F.lit("uksc/2020/"), F.col("doc_id")), "https://docs.example.org/").alias("u")).select("doc_id", "u.*")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1990 + o_orderkey % 30 ELSE year(o_orderdate) END::INTEGER AS year FROM orders")
def m_year_of_path_or_date(spark, sf_dir):
    k = F.col("o_orderkey")
    path = F.when(k % 2 == 0, F.concat(F.lit("uksc/"), k % 30 + 1990, F.lit("/"), k))
    return table(spark, sf_dir, "orders").select("o_orderkey", reconcile.year(path, F.col("o_orderdate").cast("date")).alias("year"))


#: Lines of orders as references by supplier and part; those sent back are the bookmarks.
MARKS_SQL = "r AS (SELECT l_suppkey AS doc_id, (l_partkey % 20)::VARCHAR AS name, l_orderkey * 10 + l_linenumber AS pos, l_returnflag = 'R' AS marked FROM lineitem), b AS (SELECT doc_id, name, min(pos) AS target FROM r WHERE marked GROUP BY ALL)"


def references(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc_id"), (F.col("l_partkey") % 20).cast("string").alias("name"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), (F.col("l_returnflag") == "R").alias("marked"))


@query(f"WITH {MARKS_SQL} SELECT doc_id, name, target AS node_id FROM (SELECT DISTINCT doc_id, name FROM r) LEFT JOIN b USING (doc_id, name)")
def j8_link_targets(spark, sf_dir):
    r = references(spark, sf_dir)
    marks = r.where("marked").select("doc_id", "name", F.col("pos").alias("node_id"), F.col("pos").alias("ord"))
    return structure.link_targets(r.select("doc_id", "name").distinct(), marks)


@query(f"WITH {MARKS_SQL} SELECT doc_id, name, pos, CASE WHEN target < pos THEN 'above' WHEN target > pos THEN 'below' END AS direction FROM r LEFT JOIN b USING (doc_id, name)")
def j9_reference_direction(spark, sf_dir):
    r = references(spark, sf_dir)
    return structure.reference_direction(r.drop("marked"), r.where("marked").drop("marked")).select("doc_id", "name", "pos", "direction")


@query("SELECT event_id::VARCHAR AS document_uri, 'T' || user_id AS fake_tre_uuid, CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS published, 'R' || event_id AS aws_request_id FROM events WHERE event_type = 'click' AND event_id % 3 = 0")
def s16_query_store(spark, sf_dir):
    """Documents of one collection and run; `published` is there only where it is true."""
    i = F.col("event_id")
    props = F.to_json(F.struct(F.concat(F.lit("run"), i % 3).alias("parser_run_id"), F.concat(F.lit("T"), F.col("user_id")).alias("tre_uuid"), F.when(i % 2 == 0, "true").alias("published"), F.concat(F.lit("R"), i).alias("aws_request_id")))
    docs = table(spark, sf_dir, "events").select(i.cast("string").alias("uri"), F.array(F.lit("all"), F.col("event_type")).alias("collections"), props.alias("properties"))
    return files.query_store(docs, "click", "run0")


@query(f"WITH {LINES_SQL}, d AS (SELECT *, CASE WHEN length(text) % 3 = 0 THEN 'n' || pos END AS number FROM lines), k AS (SELECT *, NOT (number IS NULL AND coalesce(lag(number IS NULL) OVER (PARTITION BY doc_id ORDER BY pos), false)) AS begins FROM d), g AS (SELECT *, sum(begins::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM k) SELECT doc_id, min(pos) AS pos, max(number) AS number, string_agg(text, chr(10) ORDER BY pos) AS text, count(*) AS n_merged FROM g GROUP BY doc_id, run")
def w22_consolidate_unnumbered(spark, sf_dir):
    d = lines(spark, sf_dir).select("doc_id", "pos", F.when(F.length("text") % 3 == 0, F.concat(F.lit("n"), F.col("pos"))).alias("number"), F.lit(None).cast("string").alias("heading"), "text")
    return structure.consolidate_unnumbered(d, order=("pos",)).select("doc_id", "pos", "number", "text", "n_merged")
