"""Listings, archives and plain tables."""

from __future__ import annotations

import io
import tarfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_name


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, extension, length, modified of all files below a folder; their contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    name = file_name(F.col("path"))
    return rows.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("extension"), "length", F.col("modificationTime").alias("modified"))


def buckets(files: DataFrame, marker: str = "court_documents") -> DataFrame:
    """Files below a folder of that name, with the folder above it as their bucket."""
    p = rf"^(.*?)/{marker}/"
    return files.where(F.col("path").rlike(p)).withColumn("bucket", F.regexp_extract("path", p, 1))


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of UUID, file_name, file_type."""
    raw = spark.read.option("header", True).csv(path)
    names = {c.lower().replace("_", ""): c for c in raw.columns}
    return raw.select(*(F.trim(F.col(f"`{names[k]}`")).alias(v) for k, v in (("uuid", "uuid"), ("filename", "file_name"), ("filetype", "file_type"))))


def by_extension(files: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Files written into a folder for each extension, `Other` for none; a dry run only says where they would go."""
    rows = files.withColumn("ext", F.when(F.coalesce("extension", F.lit("")) == "", "Other").otherwise(F.regexp_replace("extension", r"^\.", "")))
    if not dry_run:
        rows.write.mode("overwrite").partitionBy("ext").parquet(path)
    return rows.select("path", F.concat(F.lit(path), F.lit("/ext="), "ext").alias("target"))


def bundles(documents: DataFrame, kind: str = "tar.gz") -> DataFrame:
    """reference, archive of documents(reference, source_name, source, xml, metadata, images array<struct<name,content>>):
    {reference}/source, xml, metadata and images. One document is one archive; times are zero, so equal input gives equal
    bytes."""
    import gzip

    import pandas as pd

    def entries(ref, source_name, source, xml, meta, images):
        yield f"{ref}/{source_name}", source
        yield f"{ref}/{ref}.xml", None if xml is None else xml.encode("utf-8")
        yield f"{ref}/TRE-{ref}-metadata.json", None if meta is None else meta.encode("utf-8")
        for i in images if images is not None else []:
            yield f"{ref}/{i['name']}", i["content"]

    def pack(rows):
        out = io.BytesIO()
        if kind == "zip":
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for name, data in rows:
                    if data is not None:
                        z.writestr(zipfile.ZipInfo(name), bytes(data))
            return out.getvalue()
        with gzip.GzipFile(fileobj=out, mode="wb", mtime=0) as g, tarfile.open(fileobj=g, mode="w") as t:
            for name, data in rows:
                if data is not None:
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(bytes(data)))
        return out.getvalue()

    def run(batches):
        for b in batches:
            made = [pack(entries(*r)) for r in b[["reference", "source_name", "source", "xml", "metadata", "images"]].itertuples(index=False)]
            yield pd.DataFrame({"reference": b["reference"], "archive": made})

    return documents.mapInPandas(run, "reference string, archive binary")


def log(messages: DataFrame, path: str) -> None:
    """Diagnostics appended as JSON lines: ts, source, level, message."""
    messages.select("ts", "source", "level", "message").write.mode("append").json(path)


def query_store(documents: DataFrame, collection: str, run_id: str) -> DataFrame:
    """document_uri, fake_tre_uuid, published of documents(uri, collections, properties JSON) of one parser run."""
    get = lambda p: F.get_json_object("properties", p)
    rows = documents.where(F.array_contains("collections", collection) & (get("$.parser_run_id") == run_id))
    return rows.select(F.col("uri").alias("document_uri"), get("$.tre_uuid").alias("fake_tre_uuid"), F.coalesce(get("$.published"), F.lit("false")).alias("published"), get("$.aws_request_id").alias("aws_request_id"))


def variant_value(column: Column, kind: str) -> Column:
    """A typed value of a metadata field whose type depends on its name."""
    return F.try_variant_get(F.parse_json(column), "$.value", kind)
