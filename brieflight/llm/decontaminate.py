"""Benchmark decontamination by a prefix-filtered set join.

The windows of an item are its runs of SIZE consecutive words (one run of all its words if it has fewer). A document word
is hit if it lies in an occurrence of a window. A window's tokens are its shingles of SHINGLE words (of all its words, if it has
fewer). They are ordered by how rare they are in the documents; as a whole window must be contained, the necessary prefix is
the rarest shingle alone, and only places where a document holds it are candidates.

One pass over the texts keeps the stretches of words whose every shingle may be one of the benchmark's (a bitmap of a bounded
size; what it lets through by chance is found out later) and that are as long as the shortest window (the bound on length).
From here on all is a join of tables: shingles of stretches are counted, each window takes its rarest one, stretches meet
windows there (hot shingles are dealt out over several tasks), the position in the stretch must leave room for the window
(the bound on position), and the words are compared one by one. Neither documents nor the benchmark are held in one place.

Defined results: a null or wordless text has no words and is never contaminated; a null or wordless item has no windows; an
item without an id hits words but is not listed or counted; equal windows of several items count for each of them, items
that share an id count once; item ids may be of any type and are given as strings; repeated rows, whatever their ids, are
judged each; of equally rare shingles the one with the smaller hash is taken, which changes no result; very long texts are
read whole, their stretches are a row each; an empty table gives no rows; only doc_id, item_id and text are read, other
columns pass through `drop_contaminated` untouched.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, pieces, renamed, saved

SIZE, SHINGLE = 10, 5
#: Bits of the bitmap of shingles: LOAD for each shingle, but not over 2^MOST (16 MB).
LOAD, LEAST, MOST = 64, 16, 27
#: A shingle that more than this many places hold is dealt out; at most HOT such shingles are known to the tasks.
CELL, HOT = 20_000, 4096

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of a-z, 0-9 and all that isn't ASCII, A-Z lower-cased."""
    return text.translate(_KEEP).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(of_words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words."""
    n = len(of_words) - k + 1
    out = np.full(max(0, n), k, dtype=np.uint64)
    for j in range(k if n > 0 else 0):
        out = (out ^ of_words[j : n + j]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def windows_of(benchmark: DataFrame, size: int, shingle: int) -> DataFrame:
    """item, window (its words), n, k, hashes of its shingles: one row per window of each item."""

    def run(batches):
        for b in pieces(batches, 50):
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                if not words:
                    continue
                n = min(size, len(words))
                k, of_words = min(shingle, n), word_hashes(words)
                hashes = shingle_hashes(of_words, k).view(np.int64)
                for s in range(0, len(words) - n + 1, 5000):
                    at = range(s, min(s + 5000, len(words) - n + 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(at), pa.string()), pa.array([words[i : i + n] for i in at], pa.list_(pa.binary())), pa.array([n] * len(at), pa.int32()), pa.array([k] * len(at), pa.int32()), pa.array([hashes[i : i + n - k + 1] for i in at], pa.list_(pa.int64()))],
                        ["item", "window", "n", "k", "hashes"],
                    )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "item string, window array<binary>, n int, k int, hashes array<long>")


class Bitmap:
    """Which shingle hashes the benchmark may have: a bit for the top bits of each."""

    def __init__(self, bits: int, parts: list[tuple[int, bytes]]):
        self.shift = np.uint64(64 - bits)
        self.bytes = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for bucket, part in parts:
            part = np.frombuffer(part, dtype=np.uint8)
            at = bucket << 12
            self.bytes[at : at + len(part)] = part[: len(self.bytes) - at]

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def bitmap(windows: DataFrame) -> Bitmap:
    """At most 2^MOST bits come to the driver, in parts of 4 KB."""
    hashes = windows.select(F.explode("hashes").alias("h"))
    some = hashes.agg(F.approx_count_distinct("h")).first()[0] or 0
    bits = min(MOST, max(LEAST, int(some * LOAD).bit_length()))
    at = hashes.select(F.shiftrightunsigned("h", 64 - bits).alias("at"))
    parts = at.groupBy(F.shiftright("at", 15).alias("bucket")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(32767)).alias("part"))
    return Bitmap(bits, [(r.bucket, bytes(r.part)) for r in parts.collect()])


def stretches(docs: DataFrame, found: Bitmap, kinds: list[tuple[int, int]]) -> DataFrame:
    """row, doc_id, n_words, key (of texts with stretches), stretches (k, start, words, hashes): one row per document.

    kinds: for each size k of shingles, the words of the shortest window that has such."""
    sent = docs.sparkSession.sparkContext.broadcast(found)
    kind = pa.list_(pa.struct([("k", pa.int32()), ("start", pa.int64()), ("words", pa.list_(pa.binary())), ("hashes", pa.list_(pa.int64()))]))

    def of_text(words, seen):
        if not words:
            return []
        of_words, out = word_hashes(words), []
        for k, least in kinds:
            hashes = shingle_hashes(of_words, k)
            if len(hashes) + k - 1 < least:
                continue
            inside = seen.holds(hashes)
            if not inside.any():
                continue
            edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
            for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                if e - s + k - 1 >= least:
                    out.append({"k": k, "start": s, "words": words[s : e + k - 1], "hashes": hashes[s:e].view(np.int64)})
        return out

    def run(batches):
        from pyspark import TaskContext

        seen = sent.value
        number = itertools.count(TaskContext.get().partitionId() << 40)
        for b in pieces(batches):
            texts = b.column(1).to_pylist()
            words = [words_of(t) for t in texts]
            held = [of_text(w, seen) for w in words]
            keys = [hashlib.sha256(t).digest() if h else None for t, h in zip(texts, held)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(number) for _ in texts], pa.int64()), b.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(keys, pa.binary()), pa.array(held, kind)], ["row", "doc_id", "n_words", "key", "stretches"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, n_words long, key binary, stretches array<struct<k:int,start:long,words:array<binary>,hashes:array<long>>>")


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (one per document), hits (row, start, n, window) of them, and windows with their items."""
    windows = saved(windows_of(benchmark, size, shingle), "benchmark-windows")
    kinds = sorted((r.k, r.n) for r in windows.groupBy("k").agg(F.min("n").alias("n")).collect())
    rows = saved(stretches(docs, bitmap(windows), kinds), "document-stretches")
    parts = rows.where(F.size("stretches") > 0).select("row", F.explode("stretches").alias("s")).select("row", "s.*")
    counts = saved(parts.select(F.explode("hashes").alias("h")).groupBy("h").agg(F.count("*").alias("places")), "shingle-counts")
    # the necessary prefix of each window: its rarest shingle; a window with a shingle that no document has occurs nowhere
    distinct = windows.select("window", "n", "k", "hashes").dropDuplicates(["window"])
    tokens = distinct.select("window", "n", "k", F.size("hashes").alias("size"), F.posexplode("hashes").alias("offset", "h")).join(counts, "h")
    rarest = tokens.groupBy("window", "n", "k", "size").agg(F.min(F.struct("places", "h", "offset")).alias("least"), F.count("*").alias("found")).where("found = size")
    prefixes = saved(rarest.select("window", "n", "k", F.col("least.h").alias("h"), F.col("least.offset").alias("offset"), F.col("least.places").alias("places")), "window-prefixes")
    most = max(CELL, (prefixes.agg(F.max("places")).first()[0] or 0) // 1024)
    hot = prefixes.where(F.col("places") > most).select("h", F.ceil(F.col("places") / most).cast("int").alias("cells")).distinct().orderBy(F.desc("cells"), "h").limit(HOT)
    hot = F.broadcast(hot)  # at most HOT rows
    cells = F.coalesce("cells", F.lit(1))
    given = prefixes.join(hot, "h", "left").withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1))).select("h", "cell", "window", "n", F.col("k").alias("w_k"), "offset")
    # around a place: so many words that any window that holds it fits
    place = F.posexplode("hashes").alias("at", "h")
    places = parts.select("row", "k", "start", "words", place).withColumn("from", F.greatest(F.lit(0), F.col("at") - size + 1))
    places = places.select("row", "k", "h", F.col("start"), "at", "from", F.size("words").alias("whole"), F.expr(f"slice(words, from + 1, {2 * size})").alias("around"))
    places = places.join(hot, "h", "left").withColumn("cell", F.pmod(F.xxhash64("row", "start", "at"), cells).cast("int")).drop("cells")
    met = places.join(given, ["h", "cell"]).where("k = w_k and at >= offset and at - offset + n <= whole")
    hits = met.where("slice(around, cast(at - offset - from + 1 as int), n) = window").select("row", (F.col("start") + F.col("at") - F.col("offset")).alias("start"), "n", "window")
    return rows, saved(hits, "window-hits"), windows.select("window", "item")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, spans (start, end of hit intervals in words), item_ids: one row per document."""
    rows, hits, windows = occurrences(docs, benchmark, size, shingle)
    # intervals in order, each counted from where those before it end
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    covered = """aggregate(spans, named_struct('last', 0L, 'n', 0L),
        (a, s) -> named_struct('last', greatest(a.last, s.end), 'n', a.n + greatest(0L, s.end - greatest(s.start, a.last))), a -> a.n)"""
    of_row = hits.groupBy("row").agg(spans.alias("spans")).withColumn("n_hit", F.expr(covered))
    pairs = hits.select("row", "window").distinct().join(windows.where("item is not null").distinct(), "window")
    items = pairs.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    out = rows.select("row", "doc_id", "n_words").join(of_row, "row", "left").join(items, "row", "left")
    none = "cast(array() as array<struct<start:long,end:long>>)"
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("spans", F.expr(none)).alias("spans"), F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """The documents without a hit, with all their columns. Equal texts have equal hits, so they are told by a hash of the text."""
    rows, hits, _ = occurrences(docs, benchmark, size, shingle)
    bad = saved(rows.select("row", "key").join(hits.select("row").distinct(), "row", "left_semi").select(F.col("key").alias("bad")).distinct(), "contaminated")
    forget(hits)
    flat, text = renamed(docs), f"c{docs.columns.index('text')}"
    return flat.join(bad, F.unhex(F.sha2(F.col(text).cast("binary"), 256)) == F.col("bad"), "left_anti").toDF(*docs.columns)


def op10(spark, sf_dir) -> DataFrame:
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    items = F.concat_ws(",", "item_ids")
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
