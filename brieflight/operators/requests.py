"""Requests: JSON in, checked and completed columns out. Errors are rows of text, not exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import citations as c
from ..functions import text as t
from .courts import COURTS

SCHEMA = "`consignment-reference` string, `s3-bucket` string, `document-url` string, `attachment-urls` array<string>, `s3-output-prefix` string, `s3-input-bucket` string, `s3-input-key` string, `document-type` string, metadata struct<uri:string,cite:string,court:string,date:string,name:string>"


def from_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Columns of a request with names in snake case."""
    r = df.withColumn("r", F.from_json(column, SCHEMA))
    names = ["consignment-reference", "s3-bucket", "document-url", "attachment-urls", "s3-output-prefix", "s3-input-bucket", "s3-input-key", "document-type"]
    keep = [x for x in df.columns if x != column]
    return r.select(*keep, *(F.col(f"r.`{n}`").alias(n.replace("-", "_")) for n in names), F.col("r.metadata").alias("metadata"))


def hint(document_type: Column, court: Column) -> Column:
    """Which parser is tried; null without a type."""
    kind = document_type
    return (
        F.when(t.is_blank(kind), None)
        .when(kind == "pressSummary", "PressSummary")
        .when(kind != "judgment", None)
        .when(court.isin("UKSC", "UKPC"), "UKSC")
        .when(court.startswith("EWCA"), "EWCA")
        .when(court.startswith("EWHC"), "EWHC")
        .when(court.rlike("^(?:UKUT|UKFTT|FTT)"), "UKUT")
        .otherwise("Judgment")
    )


def check(requests: DataFrame) -> DataFrame:
    """uri, cite, court, date and name in normal form (null where blank), the hint, and errors and warnings."""
    m = lambda f: F.when(~t.is_blank(F.col(f"metadata.{f}")), F.col(f"metadata.{f}"))
    uri, cite = t.short_uri(m("uri")), c.normalize_citation(m("cite"))
    press, kind = F.col("document_type") == "pressSummary", F.col("document_type")
    old, new = c.is_path(uri), uri.rlike(r"^d-[0-9a-f-]{36}$")
    known = F.lower(m("court")).isin([x[0].lower() for x in COURTS])
    error = lambda bad, message: F.when(F.coalesce(bad, F.lit(False)), F.lit(message))
    errors = [
        error(F.col("metadata").isNotNull() & t.is_blank(kind), "metadata is present but document type is null"),
        error(~t.is_blank(kind) & ~kind.isin("judgment", "pressSummary"), "unrecognized document type"),
        error(uri.isNotNull() & old & (press != uri.contains("press-summary")), "document type and URI do not match"),
        error(uri.isNotNull() & ~old & ~new, "input URI is not supported"),
        error(m("cite").isNotNull() & cite.isNull(), "input cite is not supported"),
        error(m("court").isNotNull() & ~known, "input court is not recognized"),
        error(m("date").isNotNull() & ~m("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), "input date is not valid"),
    ]
    warning = error(uri.isNotNull() & cite.isNotNull() & ~uri.startswith(c.citation_path(cite)), "cite and URI do not match")
    keep = [x for x in requests.columns if x != "metadata"]
    return requests.select(*keep, uri.alias("uri"), cite.alias("cite"), m("court").alias("court"), m("date").alias("date"), m("name").alias("name"), hint(kind, F.coalesce(m("court"), F.lit(""))).alias("hint"), F.array_compact(F.array(*errors)).alias("errors"), F.array_compact(F.array(warning)).alias("warnings"))
