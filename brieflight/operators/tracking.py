"""Run history: events of parser runs, what was already sent, the final report, and the join with ingester logs.

Events are only appended: (source_uuid, parser_run_id, status, last_updated, ...). The state of a document in a run is its
latest event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

STARTED, PARSED, FAILED, SENT, INGEST_FAILED = "Started", "Parsed", "ParserFailed", "SentToIngester", "IngesterFailed"
ORDER = [STARTED, PARSED, FAILED, SENT, INGEST_FAILED]
KEY = ["source_uuid", "parser_run_id"]


def plain_uuid(uuid: Column) -> Column:
    """The one form in which uuids are compared: lower case, without the braces that validation allows."""
    return F.lower(F.regexp_replace(F.trim(uuid), r"^\{(.*)\}$", "$1"))


def latest(events: DataFrame) -> DataFrame:
    """One row per document and run. Fields that the latest event lacks come from the last event that has them; of events with
    equal time and status the one with the greatest fields counts, so the result does not depend on the order of rows."""
    rest = [c for c in events.columns if c not in (*KEY, "status", "last_updated")]
    comparable = [c for c in rest if not isinstance(events.schema[c].dataType, MapType)]
    order = F.struct("last_updated", F.array_position(F.array(*(F.lit(s) for s in ORDER)), F.col("status")), *comparable)
    return events.groupBy(*KEY).agg(F.max_by("status", order).alias("status"), F.max("last_updated").alias("last_updated"), *(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest))


def event(rows: DataFrame, run_id: str, status: str, now: Column, **columns: Column) -> DataFrame:
    """Events of one step for rows(uuid, ...), to be appended."""
    return rows.select(F.col("uuid").alias("source_uuid"), F.lit(run_id).alias("parser_run_id"), F.lit(status).alias("status"), now.alias("last_updated"), *(v.alias(k) for k, v in columns.items()))


def not_yet_sent(rows: DataFrame, states: DataFrame, run_id: str) -> DataFrame:
    """Rows whose document was not sent in another run."""
    done = states.where((F.col("status") == SENT) & (F.col("parser_run_id") != run_id)).select(plain_uuid(F.col("source_uuid")).alias("__done")).distinct()
    return rows.join(done, plain_uuid(F.col("uuid")) == F.col("__done"), "left_anti")


# Messages that are reported as one, as (how they are found, text, name).
ERRORS = [
    ("starts", "Could not find file", "Could not find file"),
    ("starts", "Couldn't find file with UUID", "Couldn't find file with UUID"),
    ("ends", "was not recognized as a valid DateTime.", "String was not recognized as a valid DateTime"),
]


def error_group(message: Column) -> Column:
    out = message
    for how, part, name in reversed(ERRORS):
        out = F.when(message.startswith(part) if how == "starts" else message.endswith(part), name).otherwise(out)
    return out


def first_five(ids: Column) -> Column:
    """Up to five in order, with dots if there are more. Only six are kept while grouping is merged."""
    sorted_ = F.sort_array(ids)
    return F.concat(F.array_join(F.slice(sorted_, 1, 5), ", "), F.when(F.size(sorted_) > 5, "...").otherwise(""))


def failures(states: DataFrame, run_id: str) -> DataFrame:
    """error, n, ids: failed documents of a run by error. A window keeps six ids of each error before they are listed, so
    an error that all documents share gathers no more than these."""
    from pyspark.sql.window import Window

    own = states.where((F.col("parser_run_id") == run_id) & (F.col("status") == FAILED)).withColumn("error", F.coalesce(error_group(F.col("error_message")), F.lit("")))
    n = own.groupBy("error").agg(F.count("*").alias("n"))
    few = own.withColumn("__n", F.row_number().over(Window.partitionBy("error").orderBy("source_uuid"))).where("__n <= 6")
    return few.groupBy("error").agg(first_five(F.collect_list("source_uuid")).alias("ids")).join(n, "error").select("error", "n", "ids")


def by_extension(states: DataFrame, run_id: str, status: str = SENT) -> DataFrame:
    return states.where((F.col("parser_run_id") == run_id) & (F.col("status") == status)).groupBy("file_extension").agg(F.count("*").alias("n"))


def totals(validated: DataFrame, states: DataFrame, run_id: str) -> DataFrame:
    """One row: lines, skipped, unreadable, already done (of this manifest only), new, failed."""
    done = states.where((F.col("status") == SENT) & (F.col("parser_run_id") != run_id)).select(plain_uuid(F.col("source_uuid")).alias("uuid")).distinct().withColumn("done", F.lit(1))
    own = states.where(F.col("parser_run_id") == run_id).select(plain_uuid(F.col("source_uuid")).alias("uuid"), F.col("status").alias("state"))
    rows = validated.withColumn("uuid", plain_uuid(F.col("uuid"))).join(done, "uuid", "left").join(own, "uuid", "left")
    n = lambda c: F.count(F.when(c, 1))
    valid = F.col("status") == "valid"
    return rows.agg(F.count("*").alias("n_lines"), n(F.col("status") == "skipped").alias("n_skipped"), n(F.col("status") == "failed").alias("n_unreadable"), n(valid & F.col("done").isNotNull()).alias("n_already_done"), n(valid & (F.col("state") == SENT)).alias("n_new"), n(valid & (F.col("state") == FAILED)).alias("n_failed"))


def files_by_extension(expected: DataFrame, copied: DataFrame) -> DataFrame:
    """extension, expected, copied, failed from expected(uuid, extension) and copied(uuid)."""
    rows = expected.withColumn("extension", F.coalesce(F.nullif(F.lower("extension"), F.lit("")), F.lit("Other"))).join(copied.select("uuid").distinct().withColumn("ok", F.lit(1)), "uuid", "left")
    return rows.groupBy("extension").agg(F.count("*").alias("expected"), F.count("ok").alias("copied"), (F.count("*") - F.count("ok")).alias("failed"))


# ingester logs

# The forms of addresses, file names, citations and lines in the logs.
URI = r"(d-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"
REFERENCE = r"([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})\.tar\.gz"
CITATION = r"(\[\d{4}\]\s+[A-Z]+\s+\d+(\s+\([A-Z0-9]+\))?)"
LINE = r"^\[(.*?)\]\s+([^ ]+?)\s+[-0-9a-f]*\s+(.*?)$"


def log_rollup(logs: DataFrame) -> DataFrame:
    """logs(request_id, ts, message) to one row per request: first addresses, last message of each severity, latest line."""
    m = F.col("message")
    part = lambda p, g=1: F.nullif(F.regexp_extract(m, p, g), F.lit(""))
    said = F.concat(part(LINE, 2), F.lit(" | "), part(LINE, 3))
    of = lambda s: F.max(F.when(part(LINE, 1) == s, said))
    return logs.where("request_id is not null").groupBy("request_id").agg(
        F.min(part(URI)).alias("document_uri"), F.min(part(REFERENCE)).alias("reference"), F.min(part(CITATION)).alias("ncn"),
        of("INFO").alias("last_info"), of("WARNING").alias("last_warning"), of("ERROR").alias("last_error"), F.max_by("message", F.struct("ts", "message")).alias("report"),
    )


def run_summaries(raw: DataFrame) -> DataFrame:
    """Imported log summaries: empty cells are null, rows without a request go."""
    n = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    rest = [n(c) for c in raw.columns if c not in ("request_id", "lambda_report")]
    return raw.where("coalesce(request_id, '') <> ''").select("request_id", *rest, F.coalesce("lambda_report", F.lit("")).alias("lambda_report"))


def document_statuses(raw: DataFrame) -> DataFrame:
    yes = F.lower(F.coalesce("published", F.lit(""))).isin("true", "1", "yes")
    return raw.where("coalesce(fake_tre_uuid, '') <> ''").select("fake_tre_uuid", F.coalesce("document_uri", F.lit("")).alias("document_uri"), yes.alias("published"), F.coalesce("aws_request_id", F.lit("")).alias("aws_request_id"))


def consolidate(states: DataFrame, summaries: DataFrame, statuses: DataFrame) -> DataFrame:
    """The history of each sent document: its state, the ingester's summary by reference, and the store's status by request."""
    s = summaries.select("tre_reference", "request_id", "last_error")
    d = statuses.where("aws_request_id <> ''").select(F.col("aws_request_id").alias("request_id"), "document_uri", "published")
    return states.join(s, "tre_reference", "left").join(d, "request_id", "left")
