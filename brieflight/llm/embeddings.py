"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised in double precision; equal vectors are one class. In each of several tables a class is put into the
bucket of PROJECTIONS(n) quantised random projections floor((a.v + b) / WIDTH). In a bucket larger than BLOCK every class is
first compared with the smallest id alone; if that does not join the bucket into one component, it is dealt out as pairs of
blocks, so no task gathers more than two. Most classes that share a bucket meet by chance: there only short sketches (SKETCH
signs of random projections) are compared, and only classes with a sketch near their own in the bucket stay. Of these each is
compared by exact cosine with the first one near it, which joins most; in buckets that still hold several components the
vectors themselves are sent and compared by exact cosine. What a bucket returns is not its pairs but one row for each class
that it joins to another. From these rows come the components; within each component, again in pairs of blocks, exact cosines
count the links of every class. No link is ever taken from a sketch.

The number of projections and tables follows the number of classes, as p-stable hashing has it: so many projections that
vectors at a right angle meet in a table about once a class, and so many tables that a pair at the threshold meets in
none with probability MISS at most. A sketch of a pair at the threshold is beyond the margin with a probability of 4e-6. (Pairs
in one component are counted even where they met in no table.)

Defined results: a vector that is null, empty or zero, or holds null or non-finite components, has no links and is its own
component; vectors of different lengths are never linked; a null vec_id is linked with nothing and kept; rows that repeat
a vec_id are counted as vectors of their own, each with the links of its vector, and share one component; equal vectors are
linked and count each; a cosine of exactly the threshold is a link; vectors of any length are taken whole; an empty table
gives no rows; only vec_id and embedding are read, so other columns may have any name.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, forget, pieces, saved, tasks_for

COSINE, WIDTH, MISS, BLOCK = 0.9, 2.0, 0.02, 512
#: Bits of a sketch, and the standard deviations of margin.
SKETCH, SIGMAS = 128, 4.5
#: Rows of a cell up to which cells are compared many at once.
SMALL = 24
#: Classes of a component that are counted in one block.
COUNTED = 4096
MIX = np.uint64(0x9E3779B97F4A7C15)


def meets(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees for vectors at this distance."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(classes: int, cosine: float = COSINE) -> tuple[int, int]:
    """Projections in a table, and tables."""
    near, far = meets(math.sqrt(2 - 2 * cosine)), meets(math.sqrt(2))
    k = max(6, round(math.log(max(classes, 2)) / -math.log(far)))
    return k, math.ceil(math.log(MISS) / math.log(1 - near**k))


def normal(vector) -> np.ndarray | None:
    """A unit vector in double precision, or None."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.asarray(vector, dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top
    return v / math.sqrt(float((v * v).sum()))


def _units(vectors: DataFrame) -> DataFrame:
    """id, unit: a binary unit vector, or null."""

    def run(batches):
        for b in pieces(batches):
            units = [normal(v) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())], ["id", "unit"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, unit binary")


def _keys(classes: DataFrame, k: int, tables: int) -> DataFrame:
    """key, id: the bucket of each class in each table."""

    def run(batches):
        made = {}
        for b in pieces(batches):
            units = [np.frombuffer(u, dtype=np.float64) for u in b.column(1).to_pylist()]
            ids = np.asarray(b.column(0).to_pylist(), dtype=np.int64)
            sizes = np.array([len(u) for u in units])
            for d in np.unique(sizes).tolist():
                if d not in made:
                    rng = np.random.default_rng([7, d])
                    made[d] = rng.standard_normal((d, tables * k)), rng.uniform(0, WIDTH, tables * k), rng.integers(0, 2**63, k, dtype=np.uint64) | np.uint64(1)
                a, shift, odd = made[d]
                at = np.flatnonzero(sizes == d)
                cells = np.floor((np.stack([units[i] for i in at]) @ a + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(at), tables, k)
                keys = (cells * odd).sum(axis=2, dtype=np.uint64) + np.arange(tables, dtype=np.uint64) * MIX + np.uint64(d)
                keys = (keys ^ (keys >> np.uint64(31))) * MIX
                keys = (keys ^ (keys >> np.uint64(29))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids[at], tables))], ["key", "id"])

    return classes.select("id", "unit").mapInArrow(run, "key long, id long")


def _sketched(classes: DataFrame) -> DataFrame:
    """classes with SKETCH signs of random projections of each unit vector."""

    def run(batches):
        planes = {}
        for b in pieces(batches):
            out = []
            for u in b.column(0).to_pylist():
                v = np.frombuffer(u, dtype=np.float64)
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([11, len(v)]).standard_normal((len(v), SKETCH))
                out.append(np.packbits(v @ planes[len(v)] >= 0).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "sketch"])

    return classes.mapInArrow(run, "unit binary, first long, weight long, id long, sketch binary")


def _near(rows: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """key, id, lead: rows of blocks with another class's sketch near their own, and the smallest id among these and itself."""
    share = math.acos(cosine) / math.pi
    most = SKETCH * share + SIGMAS * math.sqrt(SKETCH * share * (1 - share))

    def pairs(bits, ids, side, alone):
        """Of one cell: which rows have one near, and their leads."""
        a, b = (np.arange(len(ids)),) * 2 if alone else (np.flatnonzero(~side), np.flatnonzero(side))
        lead, some, top = ids.copy(), np.zeros(len(ids), dtype=bool), np.iinfo(np.int64).max
        for s in range(0, len(a), 64):
            part = a[s : s + 64]
            near = np.bitwise_count(bits[part][:, None, :] ^ bits[b][None, :, :]).sum(axis=2, dtype=np.int32) <= most
            if alone:
                near[np.arange(len(part)), s + np.arange(len(part))] = False
            some[part] |= near.any(axis=1)
            some[b] |= near.any(axis=0)
            lead[part] = np.minimum(lead[part], np.where(near, ids[b][None, :], top).min(axis=1, initial=top))
            lead[b] = np.minimum(lead[b], np.where(near, ids[part][:, None], top).min(axis=0, initial=top))
        return some, lead

    def run(batches):
        last = None
        for b in itertools.chain(batches, [None]):
            if b is None and last is None:
                return
            if b is not None and not b.num_rows:
                continue
            table = pa.Table.from_batches([x for x in (last, b) if x is not None]).combine_chunks()
            k, p, q, side, ids = (table.column(i).to_numpy() for i in range(5))
            new = np.flatnonzero((k[1:] != k[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
            starts = np.concatenate([[0], new])
            end = len(k) if b is None else int(starts[-1])  # the last cell may go on in the next batch
            last = None if b is None else pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.slice(end).columns], schema=table.schema)
            starts = starts[starts < end]
            if not end:
                continue
            k, p, q, side, ids = k[:end], p[:end], q[:end], side[:end], ids[:end]
            bits = np.frombuffer(b"".join(table.column(6).slice(0, end).to_pylist()), dtype=np.uint64).reshape(end, -1)
            sizes = np.diff(np.concatenate([starts, [end]]))
            some, lead = np.zeros(end, dtype=bool), ids.copy()
            # small cells, which are most, all at once: each row with the d-th one after it
            cell = np.repeat(np.arange(len(starts)), sizes)
            small = (sizes <= SMALL)[cell] & (p == q)
            for d in range(1, min(SMALL, end)):
                at = np.flatnonzero(small[:-d] & (cell[:-d] == cell[d:]))
                if not len(at):
                    break
                at = at[np.bitwise_count(bits[at] ^ bits[at + d]).sum(axis=1, dtype=np.int32) <= most]
                some[at] = some[at + d] = True
                lead[at] = np.minimum(lead[at], ids[at + d])
                lead[at + d] = np.minimum(lead[at + d], ids[at])
            for s, n in zip(starts.tolist(), sizes.tolist()):
                if not small[s] and n > 1:
                    some[s : s + n], lead[s : s + n] = pairs(bits[s : s + n], ids[s : s + n], side[s : s + n], p[s] == q[s])
            yield pa.RecordBatch.from_arrays([pa.array(k[some]), pa.array(ids[some]), pa.array(lead[some])], ["key", "id", "lead"])

    sketches = classes.select("id", "sketch")
    rows = rows.join(sketches, "id").select("key", "p", "q", "side", "id", F.lit(1).cast("long").alias("weight"), "sketch")
    rows = rows.repartition(tasks_for(classes.sparkSession), "key", "p", "q").sortWithinPartitions("key", "p", "q")
    return rows.mapInArrow(run, "key long, id long, lead long")


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """key, id to key, p, q, side, id: groups in pairs (p, q) of blocks; side: whether the row is of block q."""
    size = saved(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "vector-groups")
    rows = members.join(size, "key").select("key", "id", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).alias("side"), "id")


def _groups(batches):
    """(side, id, weight, units) of each (key, p, q), from rows sorted by these."""
    held, mark = [], None

    def out():
        return np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]), sum((h[3] for h in held), [])

    for b in batches:
        if not b.num_rows:
            continue
        k, p, q, side, ids, w = (np.asarray(b.column(i)) for i in range(6))
        units = b.column(6).to_pylist()
        cuts = np.flatnonzero((k[1:] != k[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k)]):
            now = (k[s], p[s], q[s])
            if held and now != mark:
                yield (*out(), mark)
                held = []
            mark = now
            held.append((side[s:e], ids[s:e], w[s:e], units[s:e]))
    if held:
        yield (*out(), mark)


def _linked(units: list[bytes], cosine: float) -> np.ndarray:
    u = np.stack([np.frombuffer(x, dtype=np.float64) for x in units])
    return u @ u.T >= cosine


def _counted(u: np.ndarray, weight: np.ndarray, side: np.ndarray, alone: bool, cosine: float) -> np.ndarray:
    """Links of each vector, by weight: within a block that meets itself, else between the two sides; in strips."""
    n = np.zeros(len(u), dtype=np.int64)
    a, b = (np.arange(len(u)),) * 2 if alone else (np.flatnonzero(~side), np.flatnonzero(side))
    for s in range(0, len(a), 256):
        part = a[s : s + 256]
        linked = u[part] @ u[b].T >= cosine
        if alone:
            linked[np.arange(len(part)), s + np.arange(len(part))] = False
        n[part] += linked @ weight[b]
        if not alone:
            n[b] += linked.T @ weight[part]
    return n


def _joined(linked: np.ndarray) -> np.ndarray:
    """The smallest index in each one's component."""
    labels = np.arange(len(linked))
    while True:
        new = np.minimum(labels, np.where(linked, labels[None, :], len(labels)).min(axis=1))
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _compared(rows: DataFrame, classes: DataFrame, cosine: float, count: bool) -> DataFrame:
    """Rows of blocks with their vectors, compared in each pair of blocks: edges (a, b), or counts (a: id, b: links)."""

    def run(batches):
        for side, ids, weight, units, (_, p, q) in _groups(batches):
            if len({len(u) for u in units}) > 1:  # two lengths met in one key
                groups = [np.flatnonzero(np.array([len(u) for u in units]) == n) for n in {len(u) for u in units}]
            else:
                groups = [np.arange(len(ids))]
            for g in groups:
                if len(g) < 2:
                    continue
                if count:
                    n = _counted(np.stack([np.frombuffer(units[i], dtype=np.float64) for i in g]), weight[g], side[g], p == q, cosine)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[g]), pa.array(n)], ["a", "b"])
                else:
                    linked = _linked([units[i] for i in g], cosine)
                    np.fill_diagonal(linked, True)
                    to = _joined(linked)
                    at = np.flatnonzero(to != np.arange(len(g)))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[g][at]), pa.array(ids[g][to[at]])], ["a", "b"])

    n = tasks_for(classes.sparkSession)
    rows = rows.join(classes, "id").select("key", "p", "q", "side", "id", "weight", "unit").repartition(n, "key", "p", "q").sortWithinPartitions("key", "p", "q")
    return rows.mapInArrow(run, "a long, b long")


def _to_first(members: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Edges (a, b) between a class and the smallest id of a bucket of more than BLOCK, where they are linked."""
    first = members.groupBy("key").agg(F.min("id").alias("b"), F.count("*").alias("n")).where(F.col("n") > BLOCK).select("key", "b")
    return _exact(members.join(saved(first, "vector-firsts"), "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct(), classes, cosine)


def _exact(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Of pairs (a, b) those that are linked."""

    def run(batches):
        for b in pieces(batches):
            x, y = (b.column(i).to_pylist() for i in (2, 3))
            keep = [len(u) == len(v) and float(np.frombuffer(u, dtype=np.float64) @ np.frombuffer(v, dtype=np.float64)) >= cosine for u, v in zip(x, y)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    unit = lambda k, n: classes.select(F.col("id").alias(k), F.col("unit").alias(n))
    return pairs.join(unit("a", "x"), "a").join(unit("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _unsettled(members: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """key, id: without buckets of more than `least` that lie within one component already."""
    large = saved(members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > least).select("key"), "vector-large")
    placed = members.join(large, "key").join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id"))
    done = saved(placed.groupBy("key").agg(F.min("c").alias("p"), F.max("c").alias("q")).where("p = q").select("key"), "vector-settled")
    return members.join(done, "key", "left_anti").select("key", "id")


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    spark = vectors.sparkSession
    rows = saved(_units(vectors), "vectors")
    real = rows.where("unit is not null and id is not null")
    # each vector is a class with a number of its own; classes under one vec_id are tied, so that it has one component
    of_unit = real.groupBy("unit").agg(F.min("id").alias("first"), F.count("*").alias("weight")).withColumn("id", F.monotonically_increasing_id())
    classes = saved(_sketched(of_unit), "vector-classes")
    several = real.groupBy("id").agg(F.min("unit").alias("low"), F.max("unit").alias("high")).where("low <> high").select(F.col("id").alias("vec"))
    ties = real.join(several, real.id == several.vec, "left_semi").select(F.col("id").alias("vec"), "unit").distinct().join(classes, "unit").select("vec", F.col("id").alias("a"))
    ties = saved(ties.join(ties.groupBy("vec").agg(F.min("a").alias("b")), "vec").where("a <> b").select("a", "b"), "vector-ties")
    keys = saved(_keys(classes, *plan(classes.count(), cosine)), "vector-keys")
    shared = saved(keys.groupBy("key").agg(F.min("id").alias("p"), F.max("id").alias("q")).where("p <> q").select("key"), "vector-shared")
    members = saved(keys.join(shared, "key"), "vector-members")
    forget(keys, shared)
    stars = saved(_to_first(members, classes, cosine), "vector-stars")
    left = members if stars.isEmpty() else saved(_unsettled(members, connected_components(stars), BLOCK), "vector-left")
    near = saved(_near(_in_blocks(left, BLOCK), classes, cosine), "vector-near")
    firsts = near.where("lead < id").groupBy("id").agg(F.min("lead").alias("b")).select(F.col("id").alias("a"), "b")
    stars = saved(_exact(firsts, classes, cosine).unionAll(stars), "vector-stars")
    # what the first ones did not join is compared whole
    rest = saved(_unsettled(near.select("key", "id").distinct(), connected_components(stars), 1), "vector-rest")
    edges = saved(_compared(_in_blocks(rest, BLOCK), classes, cosine, False).unionAll(stars).unionAll(ties).distinct(), "vector-edges")
    found = saved(connected_components(edges), "vector-components")
    inside = found.select(F.col("component").alias("key"), F.col("node").alias("id"))
    counts = _compared(_in_blocks(inside, COUNTED), classes, cosine, True).groupBy("a").agg(F.sum("b").alias("others")).withColumnRenamed("a", "id")
    placed = classes.join(found.withColumnRenamed("node", "id"), "id", "left")
    least = placed.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    of_class = placed.join(counts, "id", "left").join(least, "component", "left")
    of_class = of_class.select("unit", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "first").alias("component"))
    out = rows.withColumn("known", F.when(F.col("id").isNotNull(), F.col("unit"))).join(of_class.withColumnRenamed("unit", "known"), "known", "left")
    out = out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op7(spark, sf_dir) -> DataFrame:
    return links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
