"""Metadata of a document against metadata supplied with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import citations as c
from ..functions import dates as d
from ..functions.text import DOMAIN

FIELDS = ["court", "year", "number", "cite", "uri", "date", "name"]


def reconcile(docs: DataFrame, external: DataFrame, key: str = "doc_id", external_first: bool = True, uri_trumps: str | None = "uri_trumps") -> DataFrame:
    """docs left-joined with external; for each field the first side that has it, external first (the default) or document
    first. Document first still takes an address and name that were supplied, if `uri_trumps` says so. Columns missing on
    one side are null."""
    get = lambda side, df, f: F.col(f"{side}.{f}") if f in df.columns else F.lit(None)
    j = docs.alias("d").join(external.alias("e"), key, "left")
    trumps = F.coalesce(F.col(f"e.{uri_trumps}"), F.lit(False)) if uri_trumps and uri_trumps in external.columns else F.lit(False)
    out = []
    for f in FIELDS:
        doc, ext = get("d", docs, f), get("e", external, f)
        if external_first:
            v = F.coalesce(ext, doc)
        elif f in ("uri", "name"):
            v = F.when(trumps, ext).otherwise(F.coalesce(doc, ext)) if f == "uri" else F.when(trumps & ext.isNotNull(), ext).otherwise(F.coalesce(doc, ext))
        else:
            v = F.coalesce(doc, ext)
        out.append(v.alias(f))
    cases = F.when(F.size(get("e", external, "case_numbers")) > 0, get("e", external, "case_numbers")).otherwise(get("d", docs, "case_numbers")) if "case_numbers" in external.columns and "case_numbers" in docs.columns else None
    done = j.select(key, *out, *([cases.alias("case_numbers")] if cases is not None else []))
    return done.withColumn("date_name", F.when(F.col("date").isNotNull(), d.date_name(F.col("court"))))


def jurisdictions(document: Column, external: Column) -> Column:
    """struct(conflict, names): supplied names must hold all of the document's; their order is kept. None supplied: the
    document's."""
    given = F.size(F.coalesce(external, F.array().cast("array<string>"))) > 0
    lacking = F.size(F.array_except(F.coalesce(document, F.array().cast("array<string>")), F.coalesce(external, F.array().cast("array<string>")))) > 0
    return F.struct((given & lacking).alias("conflict"), F.when(given & ~lacking, external).when(~given, document).alias("names"))


def overridden(document: Column, external: Column) -> Column:
    """For each supplied name whether the document lacks it."""
    return F.transform(external, lambda x: F.struct(x.alias("name"), (~F.coalesce(F.array_contains(document, x), F.lit(False))).alias("overridden")))


def court(tagged: Column, citation: Column) -> Column:
    """The code of the citation if it refines the tagged one, else the tagged one, else that of the citation."""
    from .courts import code_of_citation

    of = code_of_citation(citation)
    return F.when(of.startswith(F.concat(tagged, F.lit("-"))), of).otherwise(F.coalesce(tagged, of))


def citation(header: Column, cover: Column) -> Column:
    return F.coalesce(c.normalize_citation(header), c.normalize_citation(cover))


def uris(short: Column, base: str = DOMAIN) -> Column:
    """struct(work, expression, manifestation) of a short path."""
    return F.struct(F.concat(F.lit(base + "id/"), short).alias("work"), F.concat(F.lit(base), short).alias("expression"), F.concat(F.lit(base), short, F.lit("/data.xml")).alias("manifestation"))


def year(path: Column, decision_date: Column) -> Column:
    """The year of the citation's path, else of the decision, unless that is the date that stands for none."""
    return F.when(path.isNotNull(), c.year_of_path(path)).when(decision_date != F.lit(d.NO_DATE).cast("date"), F.year(decision_date))


def stub_metadata(rows: DataFrame) -> DataFrame:
    """Metadata of a document of which only the manifest row is known."""
    path = c.citation_path(F.col("ncn"))
    day = F.to_date("decision_ts")
    dummy = day == F.lit(d.NO_DATE).cast("date")
    return rows.select("uuid", F.lit("decision").alias("type"), "court", F.col("ncn").alias("cite"), path.alias("uri"), year(F.when(F.col("ncn").isNotNull(), path), day).alias("year"), c.number_of_path(path).alias("number"), day.cast("string").alias("date"), F.when(dummy, "dummy").otherwise("decision").alias("date_name"), F.concat(F.col("parties")[0]["name"], F.lit(" v "), F.col("parties")[1]["name"]).alias("name"), "case_no", "jurisdictions", "parties", "categories", F.col("mime_type").alias("source_format"), F.col("web_archiving"))


def unique_dates(dates: DataFrame, by: str = "value") -> DataFrame:
    """dates(doc_id, pos, name, value): the first per value or name."""
    return dates.groupBy("doc_id", by).agg(F.min_by(F.struct("pos", *(x for x in ("name", "value") if x != by)), "pos").alias("s")).select("doc_id", by, "s.*")


def unique_parties(parties: DataFrame) -> DataFrame:
    """parties(doc_id, pos, name, role) by id, the first wins; roles of all."""
    from ..functions.text import party_id

    return parties.withColumn("party_id", party_id(F.col("name"))).groupBy("doc_id", "party_id").agg(F.min_by("name", "pos").alias("name"), F.min_by("role", "pos").alias("role"), F.sort_array(F.collect_set("role")).alias("roles"))


def main_date(dates: DataFrame) -> DataFrame:
    return dates.groupBy("doc_id").agg(F.max("value").alias("date"), F.max_by("name", F.struct("value", -F.col("pos"))).alias("name"))


def score(*present: Column) -> Column:
    """How many fields a parse found."""
    return sum((p.isNotNull().cast("int") for p in present), F.lit(0))


def best_candidate(candidates: DataFrame, key: str = "doc_id") -> DataFrame:
    """candidates(key, attempt, score, ...): the highest score, of equal ones the earliest attempt."""
    rest = [x for x in candidates.columns if x != key]
    return candidates.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("score", -F.col("attempt"))).alias("s")).select(key, "s.*")
