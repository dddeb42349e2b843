"""LM scoring by a hidden Markov language model.

Words are counted over all training documents, and every counted word has emissions of its own in each state. A word's
emission in a state is that of its class times its share of the class there. The most frequent OWN words, with the end mark,
are classes of one word; all others are in FORMS classes by their form (a hash of their first two and last three bytes).
Classes only smooth: a word's share of its class in a state is (c + WITHIN * s) / (C + WITHIN), where c and C are the
expected counts of the word and its class in the state and s is the word's smoothed share of the class over all states. Words
that were never counted have what s leaves for them. So the emissions grow with the vocabulary and sum to one in each state.

Training is Baum-Welch: documents are packed into blocks of about BLOCK tokens, with a vocabulary for each block. Tasks run
forward and backward over segments of SEGMENT tokens of all training documents and return expected counts of words. The
first emissions are those of STATES - 1 documents that differ most among SEEDS hashed ones, mixed with the whole corpus; this
only breaks the symmetry, all counts then come from all training documents.

Counts of words above a count that at most HEAD words have go by the driver, which broadcasts their emissions. All others,
however many, stay in the cluster: each block sends its counts of them by PART of the vocabulary (a hash of the word), where
they are summed and sent back to the blocks that hold the word. Such words occur seldom, so no part is hot, and the number of
parts follows the tokens. What travels is a byte for each state, a word's share of its count there in 255ths.

Defined results: a null text is an empty one, which is one end mark; a null doc_id counts as the empty text for the
split; equal rows get equal scores; words with equal counts are ordered by their bytes; a very long text is read whole and
scored by one recursion over all its tokens; without training documents the model is uniform over classes; an empty table gives no
rows; only doc_id and text are read.
"""

from __future__ import annotations

import itertools
import math
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, free_shuffles, pieces, saved, shared_dir, tasks_for

STATES, OWN, FORMS, HEAD = 8, 8192, 16384, 1 << 18
ITERATIONS, SEGMENT, LANES, SEEDS = 3, 128, 2048, 512
#: Smoothing: of a word within its class (and in the base), of each state's emissions by tokens of the whole corpus, of
#: state changes.
ALPHA, EMIT, MOVE = 0.1, 500.0, 1.0
#: Tokens of its class in a state that a word's share over all states counts for.
WITHIN = 5.0
#: Tokens in a block of documents, and tokens of words outside the head in a part of the vocabulary.
BLOCK, PART = 1 << 19, 200_000
CLASSES = OWN + FORMS
#: Numbers of words and classes that are summed up in one place.
SLICE = 4096
#: Tokens that a task scores at a time.
HOLD = 3_000_000
#: Distinct words that a task counts before it hands them on.
FLUSH = 400_000
END = b""


def form(word: bytes, own: int | None = None) -> int:
    return (OWN if own is None else own) + zlib.crc32(word[:2] + word[-3:]) % FORMS


def form_sql(word: str) -> str:
    return f"({OWN} + crc32(concat(substring({word}, 1, 2), substring({word}, greatest(1, length({word}) - 2)))) % {FORMS})"


def _tokens(text: bytes | None) -> list[bytes]:
    """Words, A-Z lower-cased, and the end mark."""
    words = text.lower().split() if text else []
    words.append(END)
    return words


def _split(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, text as bytes."""
    i = F.col("doc_id").cast("long")
    return docs.select(i.alias("doc_id"), (F.crc32(F.coalesce(i.cast("string"), F.lit(""))) % 10 == 0).alias("held_out"), F.col("text").cast("binary").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over training documents. Each task sums what it meets before the shuffle."""

    def run(batches):
        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        seen: Counter = Counter()
        for b in pieces(batches):
            for text in b.column(0).to_pylist():
                seen.update(_tokens(text))
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return _split(docs).where("not held_out").select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """What tasks need of the counts: the words of the head with their counts, and sizes of the shared classes."""

    def __init__(self, words: list[bytes], counts: list[int], tokens: int, distinct: int, class_tokens: np.ndarray, class_words: np.ndarray):
        self.words, self.counts, self.tokens, self.distinct = words, np.array(counts, dtype=np.int64), tokens, distinct
        self.class_tokens, self.class_words, self.own = class_tokens, class_words, OWN

    def prepare(self) -> None:
        """A number, class, and log10 share for each head word."""
        self.number = {w: i for i, w in enumerate(self.words)}
        self.classes = np.array([i if i < self.own else form(w, self.own) for i, w in enumerate(self.words)], dtype=np.int32)
        self.base = np.log10((self.counts + ALPHA) / self.whole)

    @property
    def whole(self) -> float:
        return self.tokens + ALPHA * (self.distinct + 1)

    def class_size(self, classes):
        return self.class_tokens[classes] + ALPHA * (self.class_words[classes] + 1)


def _lexicon(sent) -> Lexicon:
    """Once for each Python worker."""
    found = sent.value
    if not hasattr(found, "number"):
        found.prepare()
    return found


def lexicon(counts: DataFrame) -> Lexicon:
    """At most HEAD words come to the driver."""
    whole = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    # how many words have each count, from the largest: HEAD words are reached after HEAD counts at the latest
    by_count = [(r.n, r["count"]) for r in counts.groupBy("n").count().orderBy(F.desc("n")).limit(HEAD + 1).collect()]
    least, held = (by_count[0][0] + 1 if by_count else 1), 0
    for n, words in by_count:
        if held + words > HEAD:
            break
        least, held = n, held + words
    top = counts.where((F.col("n") >= least) | (F.length("word") == 0)).toArrow()
    order = sorted(zip(top.column("n").to_pylist(), top.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
    end = [x for x in order if x[1] == END]
    order = end + [x for x in order if x[1] != END]  # the end mark always has a class of its own
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    own = [w for _, w in order[:OWN]]
    shared = counts.withColumn("c", F.expr(form_sql("word")).cast("int"))
    for r in shared.groupBy("c").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        tokens[r.c], words[r.c] = r.n, r.k
    for n, w in order[:OWN]:
        tokens[form(w)] -= n
        words[form(w)] -= 1
    for i, (n, _) in enumerate(order[:OWN]):
        tokens[i], words[i] = n, 1
    if not own or own[0] != END:
        order.insert(0, (0, END))
    return Lexicon([w for _, w in order], [n for n, _ in order], int(whole.tokens or 0), int(whole.words or 0), tokens, words)


def pack(codes: np.ndarray) -> bytes:
    """uint32 numbers as zstd of their lowest bytes, then their second ones, and so on: the upper bytes are mostly zero. Written
    or shuffled, they take this much and no more, whatever codec Spark has there."""
    return pa.compress(np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd"), dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _packed(docs: DataFrame, sent, parts: int) -> DataFrame:
    """Blocks of documents: their ids, held_out and sizes, tokens as places in the block's vocabulary (words of the head, by
    number, then the others, by part), and the other words with their parts and counts in training documents."""

    def run(batches):
        from pyspark import TaskContext

        number = _lexicon(sent).number.get
        at = itertools.count(TaskContext.get().partitionId() << 36)
        ids, held, codes, words, size = [], [], [], {}, 0

        def out():
            of = np.array([zlib.crc32(w) % parts for w in words], dtype=np.int64)
            order = np.argsort(of, kind="stable")
            rank = np.empty(len(of), dtype=np.int64)
            rank[order] = np.arange(len(of))
            flat = np.concatenate(codes)
            head, place = np.unique(flat[flat >= 0], return_inverse=True)
            local = np.empty(len(flat), dtype=np.uint32)
            local[flat >= 0] = place
            local[flat < 0] = len(head) + rank[-1 - flat[flat < 0]]
            sizes = np.array([len(c) for c in codes])
            n = np.bincount(local[np.repeat(~np.array(held, dtype=bool), sizes)], minlength=len(head) + len(of))[len(head) :]
            listed = list(words)
            row = [next(at), ids, held, sizes.tolist(), pack(local), head.astype(np.int32).tobytes(), [listed[i] for i in order.tolist()], of[order].tolist(), n.tolist()]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["block", "ids", "held", "sizes", "codes", "head", "words", "parts", "n"])

        for b in pieces(batches):
            for i, out_of, text in zip(*(b.column(k).to_pylist() for k in range(3))):
                tokens = _tokens(text)
                found = np.fromiter(map(number, tokens, itertools.repeat(-1)), dtype=np.int64, count=len(tokens))
                for k in np.flatnonzero(found < 0).tolist():
                    found[k] = -1 - words.setdefault(tokens[k], len(words))
                ids.append(i), held.append(out_of), codes.append(found)
                size += len(found)
                if size >= BLOCK:
                    yield out()
                    ids, held, codes, words, size = [], [], [], {}, 0
        if ids:
            yield out()

    return _split(docs).mapInArrow(run, "block long, ids array<long>, held array<boolean>, sizes array<int>, codes binary, head binary, words array<binary>, parts array<int>, n array<long>")


def _by_part(rows: DataFrame, work, schema: str) -> DataFrame:
    """work(columns of the rows of one part) for each part; the first column is the part."""

    def run(batches):
        held, mark = [], None
        for b in batches:
            if not b.num_rows:
                continue
            part = np.asarray(b.column(0))
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
                if held and part[s] != mark:
                    yield work(pa.Table.from_batches(held))
                    held = []
                mark = part[s]
                held.append(b.slice(s, e - s))
        if held:
            yield work(pa.Table.from_batches(held))

    return rows.repartition(tasks_for(rows.sparkSession), "part").sortWithinPartitions("part").mapInArrow(run, schema)


def _slices(parts: list[int]):
    """(part, start, end) in a sorted list of parts."""
    p = np.asarray(parts, dtype=np.int64)
    cuts = np.flatnonzero(p[1:] != p[:-1]) + 1
    return [(int(p[s]), s, e) for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(p)])] if len(p) else []


def _numbered(blocks: DataFrame) -> DataFrame:
    """block, part, number (of each word in its part), n (its count in all training documents)."""

    def cut(batches):
        for b in batches:
            for block, words, parts, n in zip(*(b.column(k).to_pylist() for k in range(4))):
                found = _slices(parts)
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in found], pa.int32()), pa.array([block] * len(found), pa.int64()), pa.array([words[s:e] for _, s, e in found], pa.list_(pa.binary())), pa.array([n[s:e] for _, s, e in found], pa.list_(pa.int64()))], ["part", "block", "words", "n"])

    def work(t):
        words, n = t.column("words").combine_chunks(), t.column("n").combine_chunks()
        sizes = pc.list_value_length(words).to_numpy()
        number = pc.dictionary_encode(words.flatten()).indices.to_numpy()
        whole = np.bincount(number, n.flatten().to_numpy()).astype(np.int64)[number]
        ends = np.cumsum(sizes)[:-1]
        cells = lambda x: pa.array([y.tobytes() for y in np.split(x, ends)], pa.binary())
        return pa.RecordBatch.from_arrays([t.column("block").combine_chunks(), t.column("part").combine_chunks(), cells(number.astype(np.int32)), cells(whole)], ["block", "part", "number", "n"])

    rows = blocks.select("block", "words", "parts", "n").mapInArrow(cut, "part int, block long, words array<binary>, n array<long>")
    return _by_part(rows, work, "block long, part int, number binary, n binary")


def _gathered(rows: DataFrame, *columns: str) -> DataFrame:
    """block, found: what the parts sent back to each block, in the order of parts."""
    return rows.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", *columns))).alias("found"))


def encoded(docs: DataFrame, sent, parts: int) -> DataFrame:
    """Blocks, with numbers and whole counts of their words outside the head, kept by block so that no round moves them. The
    numbers are written first, so that the words' shuffle is gone when the blocks are moved."""
    spark = docs.sparkSession
    blocks = saved(_packed(docs, sent, parts), "packed")
    numbers = saved(_numbered(blocks), "numbers")
    free_shuffles(spark)
    got = _gathered(numbers, "number", "n").withColumnRenamed("found", "tail")
    buckets = max(1, min(tasks_for(spark), blocks.count() // 3))
    out = blocks.withColumn("forms", F.expr(f"transform(words, w -> cast({form_sql('w')} as int))")).drop("words", "n").join(got, "block", "left").repartition(buckets, "block")
    name = "hmm_" + uuid.uuid4().hex
    out.write.option("compression", "zstd").option("path", f"{shared_dir(spark)}/brieflight/{name}").bucketBy(buckets, "block").saveAsTable(name)
    forget(blocks, numbers)
    return spark.table(name)


class Hmm:
    """first (state), move (from, to), emit (class, state): probabilities."""

    def __init__(self, first: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.first, self.move, self.emit = first, move, emit

    @staticmethod
    def of_counts(first, move, emit, corpus) -> Hmm:
        first = first + MOVE
        move = move + MOVE
        emit = emit + EMIT * corpus[:, None]
        return Hmm(first / first.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of each class sequence, by the scaled forward recursion over all of them at once."""
        sizes = np.array([len(s) for s in sequences])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        flat = np.concatenate([sequences[i] for i in order]).astype(np.int64) if len(order) else np.zeros(0, dtype=np.int64)
        total = np.zeros(len(order))
        active = len(order)
        ahead = np.tile(self.first, (active, 1))
        ones = np.ones(STATES)
        product, steps = np.ones(active), 0
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[active - 1] <= t:
                active -= 1
            if len(ahead) > active:
                total[: len(product)] += np.log10(product)
                ahead, product = ahead[:active], np.ones(active)
            now = ahead * self.emit.take(flat.take(starts[:active] + t), axis=0)
            scale = now @ ones
            now /= scale[:, None]
            product *= scale
            steps += 1
            if steps % 8 == 0:  # before the product can underflow
                total[:active] += np.log10(product)
                product = np.ones(active)
            ahead = now @ self.move
        total[: len(product)] += np.log10(product)
        out = np.zeros(len(order))
        out[order] = total
        return out

    def expected(self, codes: np.ndarray, lengths: np.ndarray, begins: np.ndarray):
        """Expected counts (first, move, emit) of segments (lane, time), the shortest lane first; lanes that begin a document
        start from `first`. States come before lanes in all arrays, and a step touches only lanes that still run."""
        lanes, size = codes.shape
        live = np.searchsorted(lengths, np.arange(size), side="right")  # the first lane that runs at each time
        emit = np.ascontiguousarray(self.emit.take(np.ascontiguousarray(codes.T), axis=0).transpose(0, 2, 1))  # time, state, lane
        ahead, scale = np.empty_like(emit), np.empty((size, lanes), dtype=emit.dtype)
        forth, back = np.ascontiguousarray(self.move.T), np.ascontiguousarray(self.move)
        for t in range(size):
            at = live[t]
            now = np.where(begins, self.first[:, None], self.still[:, None]).astype(emit.dtype) if t == 0 else forth @ ahead[t - 1, :, at:]
            now *= emit[t, :, at:]
            scale[t, at:] = 1 / now.sum(axis=0)
            np.multiply(now, scale[t, at:], out=ahead[t, :, at:])
        move = np.zeros((STATES, STATES))
        behind = np.ones((STATES, lanes), dtype=emit.dtype)
        for t in range(size - 1, 0, -1):
            at = live[t]
            moved = emit[t, :, at:]
            moved *= behind[:, at:]
            moved *= scale[t, at:]
            move += ahead[t - 1, :, at:] @ moved.T
            ahead[t, :, at:] *= behind[:, at:]
            behind[:, at:] = back @ moved
        ahead[0] *= behind
        mask = np.arange(size)[:, None] < lengths[None, :]
        flat = codes.T[mask]
        counts = np.empty((len(self.emit), STATES))
        for k in range(STATES):
            counts[:, k] = np.bincount(flat, ahead[:, k][mask], minlength=len(self.emit))
        return ahead[0][:, begins].sum(axis=1), move * self.move, counts

    @property
    def still(self) -> np.ndarray:
        """The long-run shares of states, for segments inside a document."""
        p = np.full(STATES, 1 / STATES)
        for _ in range(64):
            p = p @ self.move
        return p / p.sum()


class Trained:
    """A model over classes with expected counts of classes (class, state) and emissions of head words (word, state)."""

    def __init__(self, model: Hmm, x: Lexicon, counts: np.ndarray, head: np.ndarray):
        """counts: of classes; head: of head words."""
        self.model, self.counts, self.sizes = model, counts, x.class_size(np.arange(CLASSES))
        own = x.classes < OWN
        emit = self.emission(x.classes, x.counts, head)
        emit[own] = model.emit[x.classes[own]]
        self.head = emit.astype(np.float32)

    def emission(self, classes: np.ndarray, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Emissions (word, state) of words of shared classes with n tokens and these expected counts."""
        share = (n + ALPHA) / self.sizes[classes]
        return self.model.emit[classes] * (counts + WITHIN * share[:, None]) / (self.counts[classes] + WITHIN)


class Block:
    """A block as a task reads it, with emissions of its vocabulary."""

    columns = ("block", "ids", "held", "sizes", "codes", "head", "forms", "tail", "found")

    def __init__(self, row: dict, m: Trained, kind):
        """kind: of the emissions' numbers."""
        self.block, self.ids, self.held = row["block"], row["ids"], row["held"]
        self.head = np.frombuffer(row["head"], dtype=np.int32)
        tail = row["tail"] or []
        self.parts = [(t["part"], t["number"]) for t in tail]
        self.n = np.concatenate([np.frombuffer(t["n"], dtype=np.int64) for t in tail]) if tail else np.zeros(0, dtype=np.int64)
        if row["found"]:
            counts = _counts(np.concatenate([np.frombuffer(t["v"], dtype=np.uint8) for t in row["found"]]), self.n)
        else:
            counts = np.zeros((len(self.n), STATES))
        self.forms = np.array(row["forms"], dtype=np.int64)
        self.emit = np.concatenate([m.head[self.head].astype(kind), m.emission(self.forms, self.n, counts).astype(kind)])
        self.texts = np.split(unpack(row["codes"], sum(row["sizes"])), np.cumsum(row["sizes"])[:-1])


def _shares(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (word, state) as each word's whole count and its states' shares in 255ths."""
    n = counts.sum(axis=1)
    return np.rint(counts * (255 / np.maximum(n, 1e-9))[:, None]).astype(np.uint8), n


def _counts(shares: np.ndarray, n: np.ndarray) -> np.ndarray:
    return shares.reshape(-1, STATES) * (n / 255.0)[:, None]


def _blocks(batches, m: Trained, kind):
    for b in batches:
        for row in b.to_pylist():
            yield Block(row, m, kind)


def _with_counts(blocks: DataFrame, sums: DataFrame | None) -> DataFrame:
    if sums is None:
        return blocks.withColumn("found", F.lit(None).cast("array<struct<part:int,v:binary>>")).select(*Block.columns)
    return blocks.join(_gathered(sums, "v"), "block", "left").select(*Block.columns)


def _e_step(blocks: DataFrame, sums: DataFrame | None, model: Trained):
    """Expected counts over all training documents: first, move, words of the head, classes of the others, and a table of the
    counts of the others for each block and part. sums, that of the round before, is deleted when it has been read."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(model)
    heads = len(model.head)
    named, kinds = ["key", "part", "block", "number", "v"], [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    batch = lambda *columns: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], named)

    def run(batches):
        from pyspark import TaskContext

        m = sent.value
        first, move = np.zeros(STATES), np.zeros((STATES, STATES))
        head, forms = np.zeros((heads, STATES)), np.zeros((CLASSES, STATES))
        for x in _blocks(batches, m, np.float32):
            local = Hmm(m.model.first.astype(np.float32), m.model.move.astype(np.float32), x.emit)
            counts = np.zeros(x.emit.shape)
            parts = [(len(t[s : s + SEGMENT]), s == 0, t[s : s + SEGMENT]) for t, out in zip(x.texts, x.held) if not out for s in range(0, len(t), SEGMENT)]
            parts.sort(key=lambda p: p[0])
            for s in range(0, len(parts), LANES):
                some = parts[s : s + LANES]
                lengths = np.array([p[0] for p in some])
                codes = np.zeros((len(some), int(lengths.max())), dtype=np.int64)
                codes[np.arange(codes.shape[1])[None, :] < lengths[:, None]] = np.concatenate([p[2] for p in some])
                a, b, c = local.expected(codes, lengths, np.array([p[1] for p in some]))
                first, move = first + a, move + b
                counts += c
            head[x.head] += counts[: len(x.head)]
            tail = counts[len(x.head) :]
            for k in range(STATES):
                forms[:, k] += np.bincount(x.forms, tail[:, k], minlength=CLASSES)
            (shares, whole), at = _shares(tail), 0
            whole = np.rint(whole).astype(np.uint32)
            rows = []
            for _, number in x.parts:
                n = len(number) // 4
                rows.append(shares[at : at + n].tobytes() + whole[at : at + n].tobytes())
                at += n
            k = len(rows)
            yield batch([None] * k, [p for p, _ in x.parts], [x.block] * k, [i for _, i in x.parts], rows)
        # words of the head, classes of the others, then the state changes and the first states under numbers of their own
        whole = np.concatenate([head, forms, move, first[None, :]])
        at = np.flatnonzero(whole.any(axis=1)).astype(np.int32)
        # in slices of SLICE numbers, each one row for the shuffle
        slices = _slices(at // SLICE)
        k = len(slices)
        yield batch([s for s, _, _ in slices], [None] * k, [TaskContext.get().partitionId()] * k, [at[a:b].tobytes() for _, a, b in slices], [whole[at[a:b]].astype(np.float32).tobytes() for _, a, b in slices])

    def work(t):
        number = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in t.column("number").to_pylist()])
        cut = lambda x: len(x) // (STATES + 4) * STATES  # shares of each word, then the counts
        v = t.column("v").to_pylist()
        counts = _counts(np.concatenate([np.frombuffer(x, dtype=np.uint8, count=cut(x)) for x in v]), np.concatenate([np.frombuffer(x, dtype=np.uint32, offset=cut(x)) for x in v]))
        sums = _shares(np.stack([np.bincount(number, counts[:, k]) for k in range(STATES)], axis=1))[0][number]
        ends = np.cumsum([len(x) // 4 for x in t.column("number").to_pylist()])[:-1]
        return pa.RecordBatch.from_arrays([t.column("block").combine_chunks(), t.column("part").combine_chunks(), pa.array([y.tobytes() for y in np.split(sums, ends)], pa.binary())], ["block", "part", "v"])

    def added(fan, kind):
        """The sums of one slice in one of `fan` groups of tasks, all its numbers in one row."""

        def work(t):
            key = t.column("part")[0].as_py() // fan
            whole = np.zeros((SLICE, STATES))
            for at, v in zip(t.column("number").to_pylist(), t.column("v").to_pylist()):
                whole[np.frombuffer(at, dtype=np.int32) - key * SLICE] += np.frombuffer(v, dtype=kind).reshape(-1, STATES)
            at = np.flatnonzero(whole.any(axis=1))
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([(at + key * SLICE).astype(np.int32).tobytes()], pa.binary()), pa.array([whole[at].tobytes()], pa.binary())], ["part", "number", "v"])

        return work

    out = saved(_with_counts(blocks, sums).mapInArrow(run, "key int, part int, block long, number binary, v binary"), "e-step")
    if sums is not None:
        forget(sums)
        free_shuffles(spark)  # what is summed below takes the place of what was read above
    # every task has a row for a slice, so rows are summed by groups of tasks, then over the groups: no task takes more rows of
    # a slice than the root of the number of tasks
    fan = math.ceil(math.sqrt(tasks_for(spark)))
    schema = "part int, number binary, v binary"
    grouped = out.where("key is not null").select((F.col("key") * fan + F.col("block") % fan).cast("int").alias("part"), "number", "v")
    whole = np.zeros((heads + CLASSES + STATES + 1, STATES))
    for r in _by_part(_by_part(grouped, added(fan, np.float32), schema), added(1, np.float64), schema).collect():
        whole[np.frombuffer(r.number, dtype=np.int32)] = np.frombuffer(r.v).reshape(-1, STATES)
    sums = saved(_by_part(out.where("part is not null").select("part", "block", "number", "v"), work, "block long, part int, v binary"), "e-sums")
    forget(out)
    return whole[-1], whole[heads + CLASSES : -1], whole[:heads], whole[heads : heads + CLASSES], sums


def _seeded(docs: DataFrame, sent, corpus: np.ndarray) -> Hmm:
    """A first model: states lean to documents that differ most from one another, found among SEEDS of them."""
    rows = _split(docs).where("not held_out").withColumn("at", F.xxhash64("doc_id", "text"))
    chosen = [r.at for r in rows.select("at").distinct().orderBy("at").limit(SEEDS).collect()]

    def run(batches):
        lexicon = _lexicon(sent)
        for b in pieces(batches):
            made = []
            for text in b.column(1).to_pylist():
                codes = [lexicon.classes[i] if (i := lexicon.number.get(t, -1)) >= 0 else form(t, lexicon.own) for t in _tokens(text)]
                made.append(np.unique(codes, return_counts=True))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.astype(np.int32) for c, _ in made], pa.list_(pa.int32())), pa.array([n for _, n in made], pa.list_(pa.int64()))], ["at", "classes", "n"])

    # only the counts of classes come to the driver, however long the texts are
    found = rows.where(F.col("at").isin(chosen)).select("at", "text").mapInArrow(run, "at long, classes array<int>, n array<long>") if chosen else None
    shares, seen = [], set()
    for r in sorted(found.collect(), key=lambda r: r.at) if found is not None else []:
        if r.at not in seen:
            seen.add(r.at)
            c = np.zeros(CLASSES, dtype=np.float32)
            c[r.classes] = r.n
            shares.append(c / c.sum())
    emit = np.tile(corpus[:, None], (1, STATES))
    if shares:
        roots = np.sqrt(np.stack(shares))
        chosen, far = [], np.full(len(roots), np.inf)
        at = int(np.argmin(roots @ np.sqrt(corpus)))
        for k in range(1, STATES):
            chosen.append(at)
            far = np.minimum(far, 1 - roots @ roots[at])
            # the mean of the nearest documents, so that one odd document does not make a state
            near = np.argsort(-(roots @ roots[at]), kind="stable")[: max(1, len(roots) // 32)]
            emit[:, k] = 0.5 * np.stack([shares[i] for i in near]).mean(axis=0) + 0.5 * corpus
            at = int(np.argsort(far, kind="stable")[int(len(far) * 0.9)])
    move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
    np.fill_diagonal(move, 0.9)
    return Hmm(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


def train(docs: DataFrame, blocks: DataFrame, x: Lexicon, sent, iterations: int = ITERATIONS) -> tuple[Trained, DataFrame | None]:
    """The model, and the counts of words outside the head by block and part."""
    corpus = x.class_tokens + ALPHA / CLASSES
    corpus = corpus / corpus.sum()
    model = Trained(_seeded(docs, sent, corpus), x, np.zeros((CLASSES, STATES)), np.zeros((len(x.words), STATES)))
    sums = None
    for _ in range(iterations):
        first, move, head, classes, sums = _e_step(blocks, sums, model)
        for k in range(STATES):
            classes[:, k] += np.bincount(x.classes, head[:, k], minlength=CLASSES)
        model = Trained(Hmm.of_counts(first, move, classes, corpus), x, classes, head)
        free_shuffles(docs.sparkSession)  # of the round before: the disk holds one round at a time
    return model, sums


def _scored(blocks: DataFrame, sums: DataFrame | None, model: Trained, lexicon_sent) -> DataFrame:
    sent = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, x = sent.value, _lexicon(lexicon_sent)
        held, size = [], 0

        def out():
            at = np.cumsum([0, *(len(h.emit) for h in held)])
            whole = Hmm(m.model.first, m.model.move, np.concatenate([h.emit for h in held]))
            n = np.concatenate([np.concatenate([x.counts[h.head], h.n]) for h in held])
            base = np.log10((n + ALPHA) / x.whole)
            texts = [t + np.int64(a) for a, h in zip(at, held) for t in h.texts]
            score = whole.log10(texts)
            ids, flags = [i for h in held for i in h.ids], [o for h in held for o in h.held]
            columns = [pa.array(ids, pa.int64()), pa.array(flags, pa.bool_()), pa.array([len(t) for t in texts], pa.int64()), pa.array([int((n[t] > 0).sum()) for t in texts], pa.int64()), pa.array([float(base[t].sum()) for t in texts], pa.float64()), pa.array(score, pa.float64())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        for h in _blocks(batches, m, float):
            held.append(h)
            size += sum(len(t) for t in h.texts)
            if size > HOLD:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return _with_counts(blocks, sums).mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    spark = docs.sparkSession
    counts = saved(word_counts(docs), "word-counts")
    x = lexicon(counts)
    forget(counts)
    free_shuffles(spark)
    sent = spark.sparkContext.broadcast(x)
    x.prepare()
    blocks = encoded(docs, sent, 1 + int(x.tokens - x.counts.sum()) // PART)
    free_shuffles(spark)
    model, sums = train(docs, blocks, x, sent, iterations)
    out = _scored(blocks, sums, model, sent)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(x.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op1(spark, sf_dir) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
