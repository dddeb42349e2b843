"""The bulk manifest: reading, validation and typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t

REQUIRED = ["id", "court", "filepath", "extension", "respondent", "uuid"]
OPTIONAL = ["decisiondatetime", "caseno", "jurisdictions", "claimants", "appellants", "maincategory", "mainsubcategory", "seccategory", "secsubcategory", "ncn", "headnotesummary", "webarchiving", "skip"]
UUID = r"(?i)^\{?[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}\}?$"


def canonical_header(name: str) -> str:
    return name.strip().lstrip("﻿").lower().replace("_", "")


def from_raw(raw: DataFrame) -> DataFrame:
    """Columns renamed to canonical names, cells trimmed, empty ones null, missing columns added, the raw row kept."""
    names = {canonical_header(c): c for c in raw.columns}
    cell = lambda c: F.nullif(t.clean_whitespace_ends(F.col(f"`{names[c]}`")), F.lit("")) if c in names else F.lit(None).cast("string")
    pairs = [x for c in raw.columns if c not in ("line_no", "csv_name", "csv_hash") for x in (F.lit(c.strip()), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))]
    keep = [c for c in ("line_no", "csv_name", "csv_hash") if c in raw.columns]
    return raw.select(*keep, *(cell(c).alias(c) for c in REQUIRED + OPTIONAL), F.create_map(*pairs).alias("full_line"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """A manifest file, with its name, the SHA-256 of its bytes and line numbers (the header is line 1). The file is a
    catalogue that people edit; it is read as one piece, as quoted cells may hold line ends."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", True).csv(path)
    source = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("csv_name"), F.sha2("content", 256).alias("csv_hash"))
    raw = raw.withColumn("__at", F.monotonically_increasing_id())
    raw = raw.withColumn("line_no", (F.row_number().over(Window.orderBy("__at")) + 1).cast("int")).drop("__at")
    return from_raw(raw.crossJoin(F.broadcast(source)))  # one row


def errors() -> Column:
    """Messages for a row, in a fixed order; empty for a valid one."""
    has = lambda c: ~t.is_blank(F.col(c))
    message = lambda bad, *parts: F.when(bad, F.concat(*(F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts)))
    of = [message(~has(c), f"The {c} field is required.") for c in REQUIRED]
    date = F.col("decisiondatetime")
    of += [
        message(has("uuid") & ~F.col("uuid").rlike(UUID), "uuid is not valid: ", F.col("uuid")),
        message(~has("decisiondatetime"), "Decision date must be provided"),
        message(has("decisiondatetime") & ~date.rlike(r"^\d\d\d\d"), "Unsupported decision date. Ensure dates are in yyyy-MM-dd format"),
        message(has("decisiondatetime") & date.rlike(r"^\d\d\d\d") & decision_time().isNull(), "Could not convert decisiondatetime: ", date),
        message(has("claimants") & has("appellants"), "Id ", F.col("id"), " - Cannot have both claimants and appellants. Please provide only one."),
        message(~has("claimants") & ~has("appellants"), "Id ", F.col("id"), " - Must have either claimants or appellants. At least one is required."),
        message(has("mainsubcategory") & ~has("maincategory"), "Id ", F.col("id"), " - main_subcategory '", F.col("mainsubcategory"), "' cannot exist without main_category being defined"),
        message(has("secsubcategory") & ~has("seccategory"), "Id ", F.col("id"), " - sec_subcategory '", F.col("secsubcategory"), "' cannot exist without sec_category being defined"),
    ]
    return F.array_compact(F.array(*of))


def decision_time() -> Column:
    d = F.col("decisiondatetime")
    return F.coalesce(*(F.try_to_timestamp(d, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "yyyy-M-d")))


def validate(manifest: DataFrame) -> DataFrame:
    """The rows with `skipped`, `errors` and `status` (skipped, failed, valid). Skipped rows are not checked."""
    rows = manifest.withColumn("skipped", t.is_skipped(F.col("skip")))
    rows = rows.withColumn("errors", F.when(F.col("skipped"), F.array().cast("array<string>")).otherwise(errors()))
    return rows.withColumn("status", F.when(F.col("skipped"), "skipped").when(F.size("errors") > 0, "failed").otherwise("valid"))


def typed(validated: DataFrame) -> DataFrame:
    """Valid rows with typed columns: parties, categories, citation without zeros, media type and file name."""
    v = validated.where("status = 'valid'")
    first = F.when(F.col("claimants").isNotNull(), F.struct(F.col("claimants").alias("name"), F.lit("Claimant").alias("role"))).otherwise(F.struct(F.col("appellants").alias("name"), F.lit("Appellant").alias("role")))
    category = lambda n, p: F.when(n.isNotNull(), F.struct(n.alias("name"), p.alias("parent")))
    none = F.lit(None).cast("string")
    c = F.array_compact(F.array(category(F.col("maincategory"), none), F.when(F.col("maincategory").isNotNull(), category(F.col("mainsubcategory"), F.col("maincategory"))), category(F.col("seccategory"), none), F.when(F.col("seccategory").isNotNull(), category(F.col("secsubcategory"), F.col("seccategory")))))
    return v.select(
        *[x for x in ("line_no", "csv_name", "csv_hash") if x in v.columns],
        "id", "court", "filepath", "extension", F.lower(F.regexp_replace("uuid", "[{}]", "")).alias("uuid"), decision_time().alias("decision_ts"),
        t.delimited(F.col("caseno")).alias("case_no"), t.delimited(F.col("jurisdictions")).alias("jurisdictions"),
        F.array(first, F.struct(F.col("respondent").alias("name"), F.lit("Respondent").alias("role"))).alias("parties"), c.alias("categories"),
        t.strip_citation_zeros(F.col("ncn")).alias("ncn"), F.col("headnotesummary").alias("headnote_summary"), F.col("webarchiving").alias("web_archiving"),
        t.mime_type(F.lower("extension")).alias("mime_type"), t.file_name(F.col("filepath")).alias("file_name"), "full_line",
    )


def only_id(manifest: DataFrame, id_: str | None) -> DataFrame:
    return manifest if id_ is None else manifest.where(F.col("id") == id_)


def metadata_fields(rows: DataFrame, now: Column) -> DataFrame:
    """One row per metadata field of a typed row: id, name, value (JSON), source, timestamp. Ids are hashes of what they
    name, so that a rerun gives the same ones."""
    one = lambda name, value: F.when(value.isNotNull(), F.array(F.struct(F.lit(name).alias("name"), F.to_json(F.struct(value.alias("value"))).alias("value"))))
    each = lambda name, values: F.transform(values, lambda x: F.struct(F.lit(name).alias("name"), F.to_json(F.struct(x.alias("value"))).alias("value")))
    parts = [
        each("case_number", F.col("case_no")), each("category", F.col("categories")), one("court", F.col("court")), one("date", F.date_format("decision_ts", "yyyy-MM-dd")),
        each("jurisdiction", F.col("jurisdictions")), each("party", F.col("parties")), one("ncn", F.col("ncn")), one("headnote_summary", F.col("headnote_summary")), one("web_archiving_link", F.col("web_archiving")),
    ]
    kind = "array<struct<name:string,value:string>>"
    fields = F.concat(*(F.coalesce(p.cast(kind), F.array().cast(kind)) for p in parts))
    out = rows.select("uuid", F.posexplode(fields).alias("ord", "field"))
    return out.select(F.substring(F.sha2(F.concat_ws("|", "uuid", F.col("ord").cast("string"), "field.name", "field.value"), 256), 1, 32).alias("field_id"), "uuid", "ord", "field.name", "field.value", F.lit("external").alias("source"), now.alias("timestamp"))


def file_of_uuid(rows: DataFrame, files: DataFrame) -> DataFrame:
    """files(path) joined by the uuid at the beginning of their names: one is right, none and several are errors. One
    listing serves all rows."""
    found = files.select("path", F.lower(F.regexp_extract(t.file_name(F.col("path")), r"(?i)^([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", 1)).alias("uuid")).where("uuid <> ''")
    found = found.groupBy("uuid").agg(F.count("*").alias("n_files"), F.min("path").alias("path"))
    out = rows.join(found, "uuid", "left").withColumn("n_files", F.coalesce("n_files", F.lit(0)))
    return out.withColumn("file_error", F.when(F.col("n_files") == 0, F.concat(F.lit("Couldn't find file with UUID "), "uuid")).when(F.col("n_files") > 1, F.concat(F.lit("More than one file with UUID "), "uuid")))
