"""The court dimension and its lookups. The table is small and part of the program, so it is broadcast."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import add_anchors, clean_whitespace

# Own table: code, name, pattern of neutral citations. (The published list is not part of this repository; `from_json`
# reads it where it is at hand.)
COURTS = [
    ("UKSC", "United Kingdom Supreme Court", r"\[\d{4}\] UKSC \d+"),
    ("UKPC", "Judicial Committee of the Privy Council", r"\[\d{4}\] UKPC \d+"),
    ("EWCA-Civil", "Court of Appeal (Civil Division)", r"\[\d{4}\] EWCA Civ \d+"),
    ("EWCA-Criminal", "Court of Appeal (Criminal Division)", r"\[\d{4}\] EWCA Crim \d+"),
    ("EWHC-KBD", "High Court, King's Bench Division", r"\[\d{4}\] EWHC \d+ \((KB|QB)\)"),
    ("EWHC-QBD", "High Court, Queen's Bench Division", r"\[\d{4}\] EWHC \d+ \(QB\)"),
    ("EWHC-KBD-Admin", "High Court, Administrative Court", r"\[\d{4}\] EWHC \d+ \(Admin\)"),
    ("EWHC-QBD-Admin", "High Court, Administrative Court", r"\[\d{4}\] EWHC \d+ \(Admin\)"),
    ("EWHC-Chancery", "High Court, Chancery Division", r"\[\d{4}\] EWHC \d+ \(Ch\)"),
    ("EWHC-Family", "High Court, Family Division", r"\[\d{4}\] EWHC \d+ \(Fam\)"),
    ("EWFC", "Family Court", r"\[\d{4}\] EWFC \d+"),
    ("EWFC-B", "Family Court (B)", r"\[\d{4}\] EWFC \d+ \(B\)"),
    ("EWCOP", "Court of Protection", r"\[\d{4}\] EWCOP \d+"),
    ("UKUT-AAC", "Upper Tribunal (Administrative Appeals Chamber)", r"\[\d{4}\] UKUT \d+ \(AAC\)"),
    ("UKUT-IAC", "Upper Tribunal (Immigration and Asylum Chamber)", r"\[\d{4}\] UKUT \d+ \(IAC\)"),
    ("UKUT-LC", "Upper Tribunal (Lands Chamber)", r"\[\d{4}\] UKUT \d+ \(LC\)"),
    ("UKUT-TCC", "Upper Tribunal (Tax and Chancery Chamber)", r"\[\d{4}\] UKUT \d+ \(TCC\)"),
    ("UKFTT-GRC", "First-tier Tribunal (General Regulatory Chamber)", r"\[\d{4}\] UKFTT \d+ \(GRC\)"),
    ("UKFTT-TC", "First-tier Tribunal (Tax Chamber)", r"\[\d{4}\] UKFTT \d+ \(TC\)"),
    ("EAT", "Employment Appeal Tribunal", r"\[\d{4}\] EAT \d+"),
    ("UKIPT", "Investigatory Powers Tribunal", r"\[\d{4}\] UKIPTrib \d+"),
]


def table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COURTS, "code string, court_name string, ncn_pattern string")


def from_json(df: DataFrame, column: str = "value", internal: str = "") -> DataFrame:
    """A JSON array of top-level courts with nested courts to one row per court; codes that begin with
    `internal`, if given, are left out."""
    court = "struct<code:string,name:string,long_name:string,ncn_pattern:string,identifier_iri:string,start_year:int,end_year:int>"
    top = F.from_json(column, f"array<struct<name:string,courts:array<{court}>>>")
    rows = df.select(F.explode(top).alias("t")).select(F.explode("t.courts").alias("c")).select("c.*")
    if internal:
        rows = rows.where(~F.lower("code").startswith(internal.lower()))
    return rows.withColumn("court_name", F.coalesce("long_name", "name"))


def by_code(df: DataFrame, courts: DataFrame, column: str = "court") -> DataFrame:
    """court_code and court_name by code, whatever its case; null where there is none."""
    c = courts.select(F.lower("code").alias("__code"), F.col("code").alias("court_code"), "court_name")
    return df.join(c, F.lower(column) == F.col("__code"), "left").drop("__code")


def by_code_strict(df: DataFrame, courts: DataFrame, column: str = "court") -> DataFrame:
    """As `by_code`, but a code that is missing fails the query."""
    out = by_code(df, courts, column)
    return out.withColumn("court_code", F.coalesce("court_code", F.raise_error(F.concat(F.lit("Couldn't find court with code "), F.coalesce(column, F.lit("null"))))))


def code_of_citation(citation: Column, courts=COURTS) -> Column:
    """The smallest code whose whole pattern fits. The table is small, so it is spelled out: literal patterns are compiled
    once, and no rows are multiplied."""
    c = clean_whitespace(citation)
    out = F.lit(None).cast("string")
    for code, _, pattern in sorted(courts, reverse=True):
        p = pattern if pattern.startswith("^") else "^" + pattern
        out = F.when(c.rlike(p if p.endswith("$") else p + "$"), code).otherwise(out)
    return out


def by_citation(df: DataFrame, courts: DataFrame, key: list[str], column: str = "citation") -> DataFrame:
    """The same with patterns from a table: a broadcast regex join, then the smallest code of each key."""
    c = courts.where("ncn_pattern is not null").select("code", add_anchors(F.col("ncn_pattern")).alias("__p"))
    hits = df.join(c, F.expr(f"regexp_replace({column}, r'(?U)\\s+', ' ') rlike __p"))
    return df.join(hits.groupBy(*key).agg(F.min("code").alias("court_code")), key, "left")


def parse_patterns() -> None:
    """Every pattern of the table compiles."""
    for _, _, p in COURTS:
        re.compile(p)
