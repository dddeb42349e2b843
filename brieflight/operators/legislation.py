"""Associated documents of legislation: their mapping table, kinds, authors, headers and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import citations as c
from ..functions import dates as d
from ..functions import text as t

MAPPING = ["document_type", "document_uri", "filename", "document_title", "document_date", "document_year", "document_number", "department", "publisher", "modified_date", "legislation_uri", "legislation_class", "legislation_year", "legislation_number", "legislation_title", "document_stage", "pdf_date"]

# Authors of works by class of legislation.
AUTHORS = {
    "EnglandAct": "legislature/EnglishParliament", "GreatBritainAct": "legislature/ParliamentOfGreatBritain", "IrelandAct": "legislature/OldIrishParliament",
    "NorthernIrelandAct": "legislature/NorthernIrelandAssembly", "NorthernIrelandAssemblyMeasure": "legislature/NorthernIrelandAssembly", "NorthernIrelandParliamentAct": "legislature/NorthernIrelandParliament",
    "NorthernIrelandOrderInCouncil": "government/uk", "NorthernIrelandDraftOrderInCouncil": "government/uk", "NorthernIrelandStatutoryRule": "government/northern-ireland",
    "NorthernIrelandDraftStatutoryRule": "government/northern-ireland", "ScottishAct": "legislature/ScottishParliament", "ScottishOldAct": "legislature/OldScottishParliament",
    "ScottishStatutoryInstrument": "government/scotland", "ScottishDraftStatutoryInstrument": "government/scotland", "UnitedKingdomChurchInstrument": "legislature/GeneralSynod",
    "UnitedKingdomChurchMeasure": "legislature/GeneralSynod", "UnitedKingdomPrivateAct": "legislature/UnitedKingdomParliament", "UnitedKingdomPublicGeneralAct": "legislature/UnitedKingdomParliament",
    "UnitedKingdomLocalAct": "legislature/UnitedKingdomParliament", "UnitedKingdomMinisterialOrder": "government/uk", "UnitedKingdomStatutoryInstrument": "government/uk",
    "UnitedKingdomDraftStatutoryInstrument": "government/uk", "WelshAssemblyMeasure": "legislature/NationalAssemblyForWales", "WelshParliamentAct": "legislature/SeneddCymru",
    "WelshNationalAssemblyAct": "legislature/NationalAssemblyForWales", "WelshStatutoryInstrument": "government/wales", "WelshDraftStatutoryInstrument": "government/wales",
    "UnitedKingdomMinisterialDirection": "government/uk", "UnitedKingdomStatutoryRuleOrOrder": "government/uk", "NorthernIrelandStatutoryRuleOrOrder": "government/northern-ireland",
    "UnitedKingdomImpactAssessment": "government/uk",
}

# Types of bills and instruments with the type they have once enacted, and whether that is primary.
DOC_NAMES = {
    "NIA": ("NIA", True), "NIPUBB": ("NIA", True), "NISI": ("NISI", False), "NIDSI": ("NISI", False), "NISR": ("NISR", False), "NIDSR": ("NISR", False),
    "UKPGA": ("UKPGA", True), "UKPUBB": ("UKPGA", True), "UKPRIB": ("UKPGA", True), "UKHYBB": ("UKPGA", True), "UKCM": ("UKCM", True), "UKDCM": ("UKCM", True),
    "UKSI": ("UKSI", False), "UKDSI": ("UKSI", False), "ASP": ("ASP", True), "SPPUBB": ("ASP", True), "SPPRIB": ("ASP", True), "SPHYBB": ("ASP", True),
    "ASC": ("ASC", True), "SCPUBB": ("ASC", True), "SCPRIB": ("ASC", True), "SCHYBB": ("ASC", True), "SSI": ("SSI", False), "SDSI": ("SSI", False), "WSI": ("WSI", False), "WDSI": ("WSI", False),
}


def author(legislation_class: Column) -> Column:
    return F.concat(F.lit("http://www.legislation.gov.uk/id/"), F.element_at(F.create_map(*(F.lit(x) for kv in AUTHORS.items() for x in kv)), legislation_class))


def doc_name(name: Column) -> Column:
    """struct(name, enacted, primary) of a document type, null for one that is not known."""
    table = F.create_map(*(x for k, (e, p) in DOC_NAMES.items() for x in (F.lit(k), F.struct(F.lit(k).alias("name"), F.lit(e).alias("enacted"), F.lit(p).alias("is_primary")))))
    return F.element_at(table, F.upper(F.trim(name)))


def mapping(raw: DataFrame) -> DataFrame:
    """Rows of the mapping table (columns in the order of MAPPING, plus line_no): names without extension, numbers through
    doubles, the first row of a name wins."""
    whole = lambda n: F.coalesce(F.col(n).try_cast("double").cast("long").cast("string"), F.col(n))
    rows = raw.withColumn("key", F.lower(t.file_stem(F.trim("filename")))).where("coalesce(key, '') <> ''")
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy("key").orderBy("line_no"))).where("__n = 1").drop("__n")
    return first.withColumns({"document_year": F.col("document_year").try_cast("double").cast("int"), "legislation_year": F.col("legislation_year").try_cast("double").cast("int"), "document_number": whole("document_number"), "legislation_number": whole("legislation_number")})


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*MAPPING[: len(raw.columns)]).withColumn("line_no", F.monotonically_increasing_id())
    return mapping(raw)


def by_file(docs: DataFrame, table: DataFrame, column: str = "filename") -> DataFrame:
    """docs with the mapping row of their file. Without a broadcast hint: how large the table is, Spark sees."""
    return docs.withColumn("key", F.lower(t.file_stem(F.col(column)))).join(table.drop("filename", "line_no"), "key", "left")


def by_assessment(docs: DataFrame, table: DataFrame) -> DataFrame:
    """The same by year and number of an impact assessment."""
    return docs.withColumn("key", c.assessment_key(F.col("year"), F.col("number"))).join(table.select("key", "legislation_uri", "document_stage", "document_title"), "key", "left").withColumn("uri", c.assessment_path(F.col("year"), F.col("number"), F.col("legislation_uri"))).withColumn("stage", c.assessment_stage(F.col("document_stage")))


SEGMENTS = [("memorandum", "memorandum"), ("executive note", "executive-note"), ("policy note", "policy-note")]


def segment(kind: Column) -> Column:
    k = F.lower(kind)
    return F.coalesce(*(F.when(k.contains(a), b) for a, b in SEGMENTS))


def file_version(name: Column) -> Column:
    """The version at the end of a file name like `uksiem_20130001_en_002`, else 1."""
    return F.coalesce(F.regexp_extract(t.file_stem(name), r"_en_(\d+)$", 1).try_cast("int"), F.lit(1))


def memorandum_uri(legislation: Column, kind: Column, version: Column) -> Column:
    g = lambda n: F.regexp_extract(legislation, c.LEGISLATION, n)
    return F.when(legislation.rlike(c.LEGISLATION) & segment(kind).isNotNull(), F.concat_ws("/", g(1), g(2), g(3), segment(kind), version.cast("string")))


def header_states(blocks: DataFrame, title: str = r"(?i)^explanatory memorandum(?: to)?") -> DataFrame:
    """state of the first blocks: doc_type, title, number, else body. A header runs from a title line to the first line
    that is a regulation number; without one there is no header. A second title with a number may follow at once."""
    w = Window.partitionBy("doc_id")
    s = t.clean_whitespace(F.col("text"))
    rows = blocks.withColumn("__t", F.min(F.when(s.rlike(title) & (F.col("pos") < 20), F.col("pos"))).over(w))
    rows = rows.withColumn("__n", F.min(F.when(c.is_regulation(s) & (F.col("pos") > F.col("__t")) & (F.col("pos") < F.col("__t") + 20), F.col("pos"))).over(w))
    return rows.withColumn("state", F.when(F.col("__n").isNull() | (F.col("pos") > F.col("__n")), "body").when(F.col("pos") == F.col("__n"), "number").when(F.col("pos") == F.col("__t"), "doc_type").when(F.col("pos") < F.col("__t"), "before").otherwise("title")).drop("__t", "__n")


def metadata(docs: DataFrame, table: DataFrame, header: DataFrame) -> DataFrame:
    """docs(doc_id, filename) with mapping and header(doc_id, title, number_text, date_text): what the mapping lacks comes
    from the header."""
    j = by_file(docs, table).join(header, "doc_id", "left")
    return j.select("doc_id", "filename", F.coalesce("document_title", "title").alias("title"), F.coalesce("legislation_uri", F.concat(F.lit("http://www.legislation.gov.uk/id/"), c.regulation_path(F.col("number_text")))).alias("legislation_uri"), F.coalesce(d.parse(F.col("document_date")), d.parse_header(F.col("date_text"))).alias("date"), author(F.col("legislation_class")).alias("author"), file_version(F.col("filename")).alias("version"), "department", "publisher")


#: Names of references in the order in which they are written: bills, then instruments only.
REFERENCES = "DocSubType BillTitle House StageVersion ProjectId Work WorkUri CHOiid Expression ExpressionUri VDOiid Manifestation ManifestationUri ActYear ActTitle IntroDate ConsidDate FurthConsidDate BillNoComp BillNo SessionNo BillYear Session AssentDate ActNoComp ActNo DocType System Author Jurisdiction Ontologies Sovereign SITitle ProcedureType SIYear MadeDate LaidDate CommenceDate OtherDate SINoComp SINo SISubsidiaryNos ISBN MinistryAgency".split()


def references(values: DataFrame) -> DataFrame:
    """values(doc_id, key, show_as, occurrence) in writing order, with ids: the second of a key is key2."""
    order = F.array_position(F.array(*(F.lit("var" + x) for x in REFERENCES)), F.col("key"))
    n = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("occurrence"))
    rows = values.withColumn("ord", order).where("ord > 0").withColumn("n", n)
    return rows.withColumn("eid", F.when(F.col("n") > 1, F.concat("key", F.col("n").cast("string"))).otherwise(F.col("key"))).select("doc_id", "ord", "eid", "show_as")


def instrument_dates(blocks: DataFrame) -> DataFrame:
    """doc_id, kind (made, laid, commence, other), date: label and date on one line between tabs or spaces."""
    s = t.clean_whitespace(F.col("text"))
    label = r"(?i)^(Made|Laid before .*?|Coming into (?:force|operation)|Approved by .*?|Gwnaed|Gosodwyd gerbron .*?|Yn dod i rym)\s*[-–. ]*\s*(?:at .*? on )?(\d{1,2}(?:st|nd|rd|th)? [A-Za-z]+ \d{4}|\d{4}|\*\*\*)$"
    kind = F.lower(F.regexp_extract(s, label, 1))
    rows = blocks.where(s.rlike(label)).select("doc_id", "pos", kind.alias("k"), d.parse_bilingual(F.regexp_replace(F.regexp_extract(s, label, 2), r"(?i)(\d)(?:st|nd|rd|th)\b", "$1")).alias("date"))
    return rows.select("doc_id", "pos", F.when(F.col("k").rlike("^(made|gwnaed)"), "made").when(F.col("k").rlike("^(laid|gosodwyd)"), "laid").when(F.col("k").rlike("^(coming|yn dod)"), "commence").otherwise("other").alias("kind"), "date")


# assessments: passes over divisions


def drop_empty(divisions: DataFrame) -> DataFrame:
    """Without leaves that have neither number, heading nor text."""
    parents = divisions.select("doc_id", F.col("parent_id").alias("node_id")).where("node_id is not null").distinct().withColumn("has", F.lit(1))
    bare = t.is_blank(F.col("text")) & F.col("number").isNull() & F.col("heading").isNull()
    return divisions.join(parents, ["doc_id", "node_id"], "left").where(~bare | F.col("has").isNotNull()).drop("has")


def promote_only_children(divisions: DataFrame, name: str = "paragraphs") -> DataFrame:
    """Children of a wrapper that is its parent's only child move up to that parent, and the wrapper goes."""
    alone = divisions.groupBy("doc_id", "parent_id").agg(F.count("*").alias("n")).where("n = 1").select("doc_id", "parent_id")
    wrappers = divisions.where((F.col("name") == name) & F.col("number").isNull() & F.col("heading").isNull())
    gone = wrappers.join(alone, (wrappers.doc_id == alone.doc_id) & wrappers.parent_id.eqNullSafe(alone.parent_id), "left_semi").select("doc_id", F.col("node_id").alias("w"), F.col("parent_id").alias("up"), F.lit(1).alias("gone"))
    up = divisions.join(gone, (divisions.doc_id == gone.doc_id) & (divisions.parent_id == gone.w), "left").select(divisions["*"], "up", F.col("gone").alias("moved"))
    up = up.withColumn("parent_id", F.when(F.col("moved").isNotNull(), F.col("up")).otherwise(F.col("parent_id"))).withColumn("depth", F.col("depth") - F.coalesce("moved", F.lit(0))).drop("up", "moved")
    return up.join(gone.select("doc_id", F.col("w").alias("node_id")), ["doc_id", "node_id"], "left_anti")


def renumber(divisions: DataFrame) -> DataFrame:
    """ord anew, without gaps, in the order of the divisions below one parent."""
    return divisions.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id", "parent_id").orderBy("ord", "node_id")) - 1)


def header_values(blocks: DataFrame, labels: tuple[str, ...] = ("Title", "Stage", "Date", "IA No", "RPC Reference No", "Lead department or agency", "Other departments or agencies", "Type of measure", "Source of intervention", "Contact for enquiries")) -> DataFrame:
    """doc_id, label, value of an assessment's first page: a label with its value on the same line or the lines after it."""
    line = t.clean_whitespace(F.col("text"))
    pattern = "(?i)^(" + "|".join(labels) + ")\\s*:"
    head = blocks.where(F.col("pos") < 60).withColumn("text", line)
    from . import sequence as seq

    rows = seq.continuations(head, F.col("text").rlike(pattern), F.length("text") < 120)
    return rows.select("doc_id", F.lower(F.regexp_extract("text", pattern, 1)).alias("label"), F.trim(F.regexp_replace("text", pattern, "")).alias("value"))
