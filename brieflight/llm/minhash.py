"""MinHash near-dedup with b-bit signatures.

Each text becomes its set of word shingles. Equal sets are one class. HASHES minima of a class give BANDS band keys, from
which candidates come; of each minimum only the low BITS bits are kept, packed into longs, and the share of equal lanes,
corrected for chance collisions, estimates the similarity of a candidate pair by bit counts. What passes, with a margin,
is confirmed on the full sets.

A bucket of candidates is not expanded into pairs. In three rounds every class is compared with one other: the first
of its buckets, then one of another component; these links already join copies of one text. After each round only the new
links are joined, between the components that were there, and only buckets that still hold several components are kept. In
these, last, the classes outside the bucket's largest component are held against those of other components by a longer
signature of one bit each, as many such pairs lie just below the threshold. What is alike there falls into clusters; the
full sets are sent once for each class to its cluster (a large one is dealt out in pairs of blocks) and pairs alike in it are
confirmed there, unless they are connected by then. No pair becomes a row: a task gives each class one other that it is
joined with. A pair that shares a bucket is thus compared or already connected, so no connection between candidates is lost.
Buckets of the same classes count once. Whatever many classes are compared with (the first of a large group) is sent in
copies, one for each CELL of them, so no group meets in one task.

Defined results: a text with fewer words than a shingle is one shingle; a null, empty or blank text has none and is linked
with nothing; a null doc_id is linked with nothing and kept; classes are told apart by their sets, so rows that repeat a
doc_id with other texts lose no link, and all rows of one doc_id count as one node with one component; the smallest doc_id
stands for a component; equal rows get equal results; very long texts are read whole (their sets are one value each); an empty
table gives no rows; only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, forget, free_shuffles, pieces, renamed, saved, sieve, tasks_for

HASHES, BANDS, BITS = 128, 32, 4
ROWS = HASHES // BANDS
LANES = 64 // BITS
#: Below the threshold by this much, an estimate still goes to the exact check (4.5 standard deviations).
MARGIN = 0.15
WORDS, PERCENT = 5, 80

#: Bits of the long signature that pairs of the last pass are held against, and the margin for it (4.5 standard deviations).
LONG, LONG_MARGIN = 4096, 0.042
#: Rows of a block in the last pass, shingles that a block holds there, and classes that are compared with one other in one task.
BLOCK, HELD, CELL = 1024, 1 << 21, 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_LONG_A = _rng.integers(0, 2**63, LONG, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_LONG_B = _rng.integers(0, 2**63, LONG, dtype=np.uint64)
_BAND = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text: A-Z lower-cased, words between ASCII white space."""
    tokens = text.lower().split() if text else []
    n = len(tokens)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, tokens), dtype=np.uint64, count=n)
    k = min(words, n)
    acc = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        acc = (acc ^ h[j : n - k + 1 + j]) * _MIX
        acc ^= acc >> np.uint64(29)
    return np.unique(acc)


def minima(shingles: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(best, (shingles[i : i + 1024, None] * _A + _B).min(axis=0), out=best)
    return best


def band_keys(best: np.ndarray) -> np.ndarray:
    keys = (best.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _MIX
    keys ^= keys >> np.uint64(31)
    return (keys * _MIX).view(np.int64)


def packed(best: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, LANES to a long."""
    low = (best & np.uint64(2**BITS - 1)).reshape(-1, LANES)
    return (low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def long_signature(shingles: np.ndarray) -> np.ndarray:
    """One bit of each of LONG minima, 64 to a long."""
    best = np.full(LONG, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 64):
        np.minimum(best, (shingles[i : i + 64, None] * _LONG_A + _LONG_B).min(axis=0), out=best)
    bits = ((best * _MIX) >> np.uint64(63)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def estimate(a: str, b: str) -> str:
    """SQL for the similarity of two packed signature columns, corrected for lanes that agree by chance."""
    low = int("0001" * LANES, 2)
    lanes = []
    for i in range(HASHES // LANES):
        x = f"({a}[{i}] ^ {b}[{i}])"
        lanes.append(f"bit_count(({x} | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3)) & {low}L)")
    return f"((1 - ({' + '.join(lanes)}) / {HASHES}D) - {2.0**-BITS}D) / {1 - 2.0**-BITS}D"


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key, bands, signature: one row per document."""

    def run(batches):
        for b in pieces(batches):
            own, n, key, bands, sig = [], [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, words)
                n.append(len(s))
                if not len(s):
                    own.append(None), key.append(None), bands.append(None), sig.append(None)
                    continue
                best = minima(s)
                own.append(hashlib.sha256(text).digest())
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_keys(best))
                sig.append(packed(best))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.binary()), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bands, longs), pa.array(sig, longs)], ["doc_id", "text_key", "n_shingles", "set_key", "bands", "signature"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key binary, n_shingles long, set_key binary, bands array<long>, signature array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """id, shingles (bytes) of the wanted classes (id, first, set_key), from the texts of their first documents."""

    def run(batches):
        for b in pieces(batches):
            made = [shingle_set(t, words).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in made], pa.binary()), pa.array(made, pa.binary())], ["key", "shingles"])

    # the texts are filtered where they are read: what passes without being wanted has no partner in the join on keys
    rows = docs.select(F.col("doc_id").cast("long").alias("first"), F.col("text").cast("binary").alias("text"))
    made = rows.where(sieve(wanted.select("first"))("first")).select("text").mapInArrow(run, "key binary, shingles binary")
    return saved(made.join(wanted.select("id", F.col("set_key").alias("key")), "key").dropDuplicates(["key"]).select("id", "shingles"), "minhash-sets")


def _long(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """id, long signature of the given classes, and of a few more."""

    def run(batches):
        for b in pieces(batches):
            made = [long_signature(np.frombuffer(x, dtype=np.uint64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.list_(pa.int64()))], ["id", "long"])

    return saved(sets.where(sieve(ids)("id")).select("id", "shingles").mapInArrow(run, "id long, long array<long>"), "minhash-long")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    # those of the shorter that are found in the longer
    short, long = (x, y) if len(x) < len(y) else (y, x)
    found = np.searchsorted(long, short)
    same = int((long[np.minimum(found, len(long) - 1)] == short).sum())
    return 100 * same >= percent * (len(x) + len(y) - same)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those with enough in common: 100 * intersection >= percent * union.

    Of a pair the one that is in more pairs is the hub. A hub's set is sent once for each CELL of its pairs, the other sets once
    a pair; they meet sorted, so that a task holds one hub's set and goes through the others."""

    def run(batches):
        hub = None
        for b in pieces(batches, 200):
            a_out, b_out = [], []
            for k, _, at, a, x in zip(*(b.column(i).to_pylist() for i in range(5))):
                x = np.frombuffer(x, dtype=np.uint64)
                if at == 0:
                    hub = x
                    continue
                if _alike(x, hub, percent):
                    a_out.append(a), b_out.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    degrees = saved(ends, "minhash-degrees")
    one, two = (degrees.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}")) for k in "ab")
    turned = F.struct("n_a", "a") > F.struct("n_b", "b")
    both = pairs.join(one, "a").join(two, "b").select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"), F.greatest("n_a", "n_b").alias("n"))
    both = saved(both.withColumn("p", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / CELL)).cast("int")), "minhash-turned")
    hubs = both.select("b", "p").distinct().join(sets.withColumnRenamed("id", "b"), "b").select("b", "p", F.lit(0).alias("at"), F.col("b").alias("a"), "shingles")
    rest = both.join(sets.withColumnRenamed("id", "a"), "a").select("b", "p", F.lit(1).alias("at"), "a", "shingles")
    rows = hubs.unionAll(rest).repartition(tasks_for(pairs.sparkSession), "b", "p").sortWithinPartitions("b", "p", "at")
    out = saved(rows.mapInArrow(run, "a long, b long"), "minhash-links")
    forget(both, degrees)
    return out


def _dealt(placed: DataFrame, own: DataFrame, held: int | None) -> DataFrame:
    """placed(key, id, component) in cells of two blocks, sorted, with the columns of own: key, p, q, side, id, component, ...

    A key is dealt out in blocks of at most about BLOCK rows and, if given, `held` shingles; blocks outside its largest component
    meet all blocks.
    """
    if held:
        placed = placed.join(own.select("id", "n"), "id")
    shares = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    major = saved(shares.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top")).select("key", F.col("top.component").alias("major")), "minhash-major")
    left = placed.join(major, "key")
    few = F.col("component") != F.col("major")

    def blocks(which):
        count = F.ceil(F.count(F.when(which, 1)) / BLOCK)
        return (F.greatest(count, F.ceil(F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)) / held)) if held else count).cast("int")

    size = left.groupBy("key").agg(blocks(few).alias("few_blocks"), blocks(~few).alias("more_blocks"))
    size = saved(size, "minhash-blocks")  # written, so that the join below may split a hot key
    rows = left.join(size, "key").withColumn("hash", F.xxhash64("id", "key"))
    rows = rows.withColumn("own", F.when(few, F.pmod("hash", "few_blocks")).otherwise(F.col("few_blocks") + F.pmod("hash", "more_blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(few, F.col("few_blocks") + F.col("more_blocks")).otherwise(F.col("few_blocks")) - 1)))
    rows = rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).alias("side"), "id", "component")
    return rows.join(own, "id").select("key", "p", "q", "side", "id", "component", *own.columns[1:]).repartition(tasks_for(placed.sparkSession), "key", "p", "q").sortWithinPartitions("key", "p", "q")


def _cells(batches):
    """(side, ids, components, sizes, long signatures, sets if there are any) of each (key, p, q), from rows sorted by these."""
    mark, held = None, []

    def out():
        side, ids, comp, n, long = (np.concatenate(x) for x in list(zip(*held))[:5])
        return side, ids, comp, n, long.reshape(len(ids), LONG // 64), [np.frombuffer(x, dtype=np.uint64) for h in held for x in h[5]]

    for b in batches:
        if not b.num_rows:
            continue
        k, p, q = (np.asarray(b.column(i)) for i in range(3))
        side, ids, comp, n = (np.asarray(b.column(i)) for i in range(3, 7))
        long = np.asarray(b.column(7).flatten()).view(np.uint64)  # bits are counted, so there is no sign
        sets = b.column(8).to_pylist() if b.num_columns > 8 else []
        cuts = np.flatnonzero((k[1:] != k[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k)]):
            now = (k[s], p[s], q[s])
            if held and now != mark:
                yield out()
                held = []
            mark = now
            held.append((side[s:e], ids[s:e], comp[s:e], n[s:e], long[s * (LONG // 64) : e * (LONG // 64)], sets[s:e]))
    if held:
        yield out()


def _near(side, ids, comp, n, long, percent: int):
    """Pairs of rows (i, j) of a cell, each once: of different components and alike by their sizes and long signatures; by strips."""
    a, b = (np.flatnonzero(~side), np.flatnonzero(side)) if side.any() else (np.arange(len(ids)),) * 2
    for s in range(0, len(a), 32):
        part = a[s : s + 32]
        differ = np.bitwise_count(long[part][:, None, :] ^ long[b][None, :, :]).sum(axis=2, dtype=np.int32)
        near = 1 - 2 * differ / LONG >= percent / 100 - LONG_MARGIN
        near &= comp[part][:, None] != comp[b][None, :]
        near &= percent * np.maximum(n[part][:, None], n[b][None, :]) <= 100 * np.minimum(n[part][:, None], n[b][None, :])
        if a is b:
            near &= ids[part][:, None] > ids[b][None, :]
        i, j = np.nonzero(near)
        yield part[i], b[j]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the rows i with the rows j; label leads each row to the least one that it is joined with."""
    while len(i):
        x, y = label[i], label[j]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label[:] = up
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]


def _leads(ids: np.ndarray, label: np.ndarray, rows: np.ndarray):
    """Edges from the given rows to those that they are joined with."""
    rows = rows[label[rows] != rows]
    return pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(ids[label[rows]])], ["a", "b"])


def _clusters(placed: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """key, id: clusters of classes that are alike by their long signatures with one of another component in a bucket.

    placed(key, id, component) are the buckets; own(id, n, long).
    """

    def run(batches):
        for side, ids, comp, n, long, _ in _cells(batches):
            label = np.arange(len(ids))
            for i, j in _near(side, ids, comp, n, long, percent):
                _merge(label, i, j)
            yield _leads(ids, label, np.arange(len(ids)))

    edges = saved(_dealt(placed, own, None).mapInArrow(run, "a long, b long"), "minhash-near")
    return saved(connected_components(edges).select(F.col("component").alias("key"), F.col("node").alias("id")), "minhash-clusters")


def _within(placed: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that join the components of the clusters placed(key, id, component); own(id, n, long, shingles)."""

    def run(batches):
        for side, ids, comp, n, long, sets in _cells(batches):
            _, first, of = np.unique(comp, return_index=True, return_inverse=True)
            label = first[of]
            for i, j in _near(side, ids, comp, n, long, percent):
                for x, y in zip(i.tolist(), j.tolist()):
                    p, q = label[x], label[y]
                    if p != q and _alike(sets[x], sets[y], percent):
                        label[label == max(p, q)] = min(p, q)
            yield _leads(ids, label, first)

    return _dealt(placed, own, HELD).mapInArrow(run, "a long, b long")


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """key, id, component of each entry; found(id, component) has every candidate."""
    return members.select("key", "id").join(found, "id")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """found(id, component) after links: only their components are joined, not all classes anew."""
    of = lambda k: found.select(F.col("id").alias(k), F.col("component").alias(f"c_{k}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    more = connected_components(edges).select(F.col("node").alias("component"), F.col("component").alias("to"))
    out = saved(found.join(more, "component", "left").select("id", F.coalesce("to", "component").alias("component")), "minhash-found")
    forget(found, links)
    return out


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of the buckets that hold several components, with one class of the smallest and one of the largest."""
    placed = saved(_placed(members, found), "minhash-placed")
    ends = placed.groupBy("key").agg(F.min(F.struct("component", "id")).alias("low"), F.max(F.struct("component", "id")).alias("high")).where("low.component <> high.component")
    out = saved(placed.join(saved(ends, "minhash-ends"), "key"), "minhash-open")
    forget(placed)
    return out


def _linked_classes(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """classes (set_key, id, first) and found (id, component): those with candidates."""
    least = percent / 100 - MARGIN
    real = rows.where("set_key is not null and doc_id is not null")
    of_set = real.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "signature")).alias("s"))
    of_set = of_set.select("set_key", F.col("s.doc_id").alias("first"), F.col("s.n_shingles").alias("n"), F.col("s.bands").alias("bands"), F.col("s.signature").alias("signature"))
    classes = saved(of_set.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")
    entries = classes.select(F.explode("bands").alias("key"), "id")
    # near copies share many bands: of buckets with the same classes one is kept
    same = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"x{k}") for k in range(2)]
    held = entries.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("c"), *same).where("low <> high")
    shared = saved(held.groupBy("low", "high", "c", "x0", "x1").agg(F.min("key").alias("key")).select("key", "low"), "minhash-shared")
    members = saved(entries.join(shared, "key"), "minhash-buckets")
    forget(shared)
    ids = members.select("id").distinct()
    sig = saved(classes.join(ids, "id", "left_semi").select("id", "n", "signature", "first", "set_key"), "minhash-signatures")
    sets = _sets(docs, sig.select("id", "first", "set_key"), words)
    free_shuffles(docs.sparkSession)
    found = saved(sig.select("id", F.col("id").alias("component")), "minhash-found")
    x, y = (sig.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("signature").alias(f"sig_{k}")) for k in "ab")
    alike = f"{percent} * greatest(n_a, n_b) <= 100 * least(n_a, n_b) and {estimate('sig_a', 'sig_b')} >= {least}D"
    # each round compares a class with one other of its buckets: the first one, then one of another component
    other = lambda end: F.when(F.col("component") != F.col(f"{end}.component"), F.col(f"{end}.id"))
    for lead in (F.min(F.when(F.col("id") != F.col("low"), F.col("low"))), F.min(other("low")), F.max(other("high"))):
        chosen = members.groupBy("id").agg(lead.alias("b")).where("b is not null").withColumnRenamed("id", "a")
        pairs = saved(chosen.join(x, "a").join(y, "b").where(alike).select("a", "b"), "minhash-pairs")
        first, new = "component" not in members.columns, not pairs.isEmpty()
        if new:
            found = _joined(found, _confirmed(pairs, sets, percent))
        if new or first:
            before, members = members, _open(members, found)
            forget(before)
        forget(pairs)
        free_shuffles(docs.sparkSession)  # after each round, so that neither files nor the driver's heap grow over all of them
        if members.isEmpty():
            break
    if not members.isEmpty():
        own = sig.select("id", "n").join(_long(sets, members.select("id").distinct()), "id")
        near = _clusters(members.select("key", "id", "component"), own, percent)
        free_shuffles(docs.sparkSession)
        found = _joined(found, saved(_within(_placed(near, found), own.join(sets, "id"), percent), "minhash-links"))
        forget(near)
    forget(members, sets, sig)
    free_shuffles(docs.sparkSession)
    return classes, found


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    rows = saved(signatures(docs, words), "minhash-rows")
    classes, found = _linked_classes(docs, rows, words, percent)
    placed = classes.select("set_key", "id", "first").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    # rows of one doc_id are one node: their classes are tied
    again = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("n > 1")
    again = saved(again.select("doc_id", (F.col("low") != F.col("high")).alias("several")), "minhash-again")
    several = again.where("several").select("doc_id")
    if not several.isEmpty():
        ties = rows.join(several, "doc_id", "left_semi").where("set_key is not null").join(placed, "set_key").select("doc_id", F.col("component").alias("a"))
        ties = ties.join(ties.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b")
        more = connected_components(ties).select(F.col("node").alias("component"), F.col("component").alias("to"))
        placed = placed.join(more, "component", "left").withColumn("component", F.coalesce("to", "component")).drop("to")
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = placed.join(smallest, "component").select(F.col("set_key").alias("own_key"), "component_id")
    own = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("own_key"))
    out = own.join(of_class, "own_key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    if not again.isEmpty():  # a row without words follows the other rows of its doc_id
        whole = out.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("whole"))
        out = out.join(whole, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("whole", "component_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all columns: the one with the smallest doc_id, of equal rows one. Here groups are of
    texts alone, so a text whose doc_id is also that of a copy stays; texts without words and rows without a doc_id all stay."""
    rows = saved(signatures(docs, words), "minhash-rows")
    classes, found = _linked_classes(docs, rows, words, percent)
    placed = classes.select("set_key", "id").join(found, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    real = rows.where("set_key is not null and doc_id is not null").select("doc_id", "text_key", "set_key").join(placed, "set_key")
    real = saved(real.select("component", "doc_id", "text_key"), "minhash-real")
    first = saved(real.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first")).select("component", "first.*"), "minhash-first")
    forget(rows, classes, found)
    stay = first.select("component", F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    gone = real.join(stay, "component").where("doc_id <> d or text_key <> t").select(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).distinct()
    gone = saved(gone, "minhash-gone")
    again = saved(real.groupBy("component", "doc_id", "text_key").count().where("count > 1").join(first, ["component", "doc_id", "text_key"]).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t")), "minhash-repeated")
    flat, i, text = renamed(docs), f"c{docs.columns.index('doc_id')}", f"c{docs.columns.index('text')}"
    flat = flat.withColumn("own_id", F.col(i).cast("long"))
    # only rows whose doc_id may be of a text that goes or repeats are moved for the joins
    touched = sieve(gone.select("d").unionAll(again.select("d")))
    out = flat.where(touched("own_id")).withColumn("own_key", F.unhex(F.sha2(F.col(text).cast("binary"), 256)))
    same = (F.col("own_id") == F.col("d")) & (F.col("own_key") == F.col("t"))
    out = out.join(gone, same, "left_anti")
    if not again.isEmpty():
        out = out.join(again, same, "left_anti").unionAll(out.join(again, same, "left_semi").dropDuplicates(["own_id", "own_key"]))
    out = flat.where(~touched("own_id")).drop("own_id").unionAll(out.drop("own_id", "own_key"))
    return out.toDF(*docs.columns)


def op6(spark, sf_dir) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)
