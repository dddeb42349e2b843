"""What the operators of this package share: the shared folder, written tables, words, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a batch that Python takes at a time; Spark bounds the bytes of a batch (spark.sql.execution.arrow.maxBytesPerBatch).
ROWS = 1000
#: Bits of a sieve at most (8 MB), and those of each id while there is room.
SIEVE, SPARSE = 1 << 26, 16
#: Edges of which the driver finds the components itself; more are joined in rounds.
FEW = 1 << 16

_own_dirs: dict[str, str] = {}
_written: dict[str, set[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where it is unset, a temporary one on a local master (tests
    and single machines) and an error on a cluster, where a machine's own folder would lose rows."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_dirs.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="brieflight-"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: it cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/brieflight/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables that saved() wrote and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(spark, path)
            _written.get(spark.sparkContext.applicationId, set()).discard(path.removeprefix("file:"))


def clean(spark: SparkSession) -> None:
    """Delete every table that is still there. Results read them lazily, so call it when their rows have been used."""
    for path in _written.pop(spark.sparkContext.applicationId, set()):
        _delete(spark, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are no longer held; worth it after a stage that moved much. A full
    collection also gives back what the driver's heap has taken for planning, which it otherwise keeps."""
    spark.sparkContext._jvm.System.gc()


def pieces(batches, rows: int = ROWS):
    """Arrow batches in slices of a few rows, so that what Python makes of them stays small."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


def renamed(df: DataFrame) -> DataFrame:
    """df with columns c0, c1, ...: columns of one's own can then be added without a clash of names."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def tasks_for(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def lower_ascii(column: str):
    return F.translate(F.col(column), UPPER, LOWER)


def sieve(ids: DataFrame) -> Callable[[str], Column]:
    """A test for long columns: true for all of ids (a table of one column), seldom true for others, never null.

    Rows that pass still need an exact join, unless more of them do no harm; those that do not pass need not move for it. The
    test has at most SIEVE bits at any number of ids: with more ids than bits it lets more through, but loses none. The bits
    are the value of a scalar subquery, so that Spark tests rows itself: a function in Python would take a second Python
    worker for each task that also runs mapInArrow, and workers stay for the stages after.
    """
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(SIEVE))
    set_ = ids.select(place(ids.columns[0]).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b")).toArrow()
    bits = np.zeros(SIEVE // 64, dtype=np.int64)
    bits[np.asarray(set_["w"])] = np.asarray(set_["b"])
    least = max(1 << 10, SPARSE * int(np.bitwise_count(bits.view(np.uint64)).sum()))
    while 32 * len(bits) >= least:  # folded to what its ids need
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    row = pa.table({"bits": pa.ListArray.from_arrays(pa.array([0, len(bits)], pa.int32()), pa.array(bits))})
    held, last = ids.sparkSession.createDataFrame(row).scalar(), len(bits) - 1

    def test(k: str) -> Column:
        p = place(k)
        word = F.get(held, F.shiftright(p, 6).bitwiseAND(last).cast("int"))
        return F.call_function("shiftright", word, (p % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1

    return test


def _of_few(rows: list) -> pa.Table:
    """(node, component) of (u, v) edges with u > v."""
    nodes, ends = np.unique(np.array(rows, dtype=np.int64), return_inverse=True)
    ends, label = ends.reshape(-1, 2), np.arange(len(nodes))
    i, j = ends[:, 0], ends[:, 1]
    while len(i):
        x, y = label[i], label[j]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label = up
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return pa.table({"node": nodes, "component": nodes[label]})


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) long edges to (node, component): the smallest node that can be reached. Only nodes with edges are returned.

    Alternating large-star and small-star steps; each step is two keyed aggregations and a join whose edge side can be
    split, so a node with very many neighbours is never gathered in one place. Each round is written to the shared
    folder, and what it was made from is deleted. It ends when every node leads to one other that leads nowhere. At most
    FEW edges are joined on the driver instead, as rounds of so little cost the driver more plans and threads than memory.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    few = now.limit(FEW + 1).collect() if FEW else []
    if 0 < len(few) <= FEW:
        forget(now)
        return edges.sparkSession.createDataFrame(_of_few(few), "node long, component long")
    while not now.isEmpty():
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large.where("u <> v"), name)
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        moved = large.join(least, large.u == least.k).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, saved(moved.unionAll(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct(), name)
        forget(before, large)
        # settled: every node hangs on one other, and no node that others hang on hangs on another itself
        twice = now.groupBy("u").agg(F.min("v").alias("p"), F.max("v").alias("q")).where("p <> q").select("u")
        if twice.unionAll(now.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")).isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
