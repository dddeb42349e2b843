"""Chat formatting: transcripts parsed by a hidden Markov model over speaker-marker and line features.

The states are the roles. A line emits its speaker marker, its length and its ending; a role changes by one table where
a row of the transcript begins, freely at a marker inside a row, and hardly ever at another line. The tables are
counts over all rows with a known role, plus prior counts that make a marker speak for its role. Viterbi recovers the role
of each line without looking at the role column; runs of lines of one role become turns in one canonical form.

A conversation is cut into chunks of CHUNK turns. Each chunk is first reduced to the best scores between its entry and
exit roles (a small matrix), the matrices of a conversation are chained, and each chunk is then traced back between its
known entry and exit roles. That gives the same path as one pass over the conversation, in tasks of bounded size. A chunk of
very many rows, which share turns or have none, is cut further: by turn, by ranges of the hash of the text, and copies of one
text, which may stand in any order, into shares.

A body cannot forge a turn: in `<|`, with any backslashes between, one backslash more is put before the bar.

Defined results: a null text is one empty line; a null conv_id is a conversation of its own for each row; a null turn comes
first; rows that share conv_id and turn have an order that only depends on their texts (by the texts' hash), and repeated rows
are parsed each; unknown or null roles teach nothing; ties go to the role that is first in ROLES; without any known role only
the priors decide; a very long text is parsed whole, line by line; an empty table gives no rows; only conv_id, turn, role
and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, saved, tasks_for

ROLES = ["system", "user", "assistant", "tool"]
CHUNK = 128
# Names that mark a speaker.
MARKERS = {
    "system": "system|instructions?|context",
    "user": "user|human|customer|client|question|q|you",
    "assistant": "assistant|ai|bot|model|agent|answer|a",
    "tool": "tool|function|observation|result",
}
_MARKER = re.compile(r"\s*(?:#{1,6}\s*|<\|?|\*\*|\[)?(?:" + "|".join(f"(?P<{r}>{p})" for r, p in MARKERS.items()) + r")(?:\|?>|\*\*:|:\*\*|\]:?|\s*:)\s*", re.IGNORECASE)
LENGTHS = [0, 20, 40, 80, 160, 320, 640, 1280]
ENDINGS = ["?", ".!", ":,;"]
#: Prior counts: of a marker for its own role and for others; of staying and changing inside a row; of all else.
OWN, OTHER, STAY, CHANGE, ELSE = 50.0, 0.001, 1000.0, 1.0, 1.0
#: How a line follows the one before: a row begins, no marker, a marker inside a row.
BEGINS, GOES_ON, MARKED = 0, 1, 2
K = len(ROLES)
SIZES = (K + 1, len(LENGTHS), len(ENDINGS) + 2)


def line_features(line: str) -> tuple[int, int, int]:
    """Marker (0: none), length and ending of a line."""
    m = _MARKER.match(line)
    rest = line[m.end() :] if m else line
    end = rest.rstrip()[-1:]
    return (
        1 + ROLES.index(m.lastgroup) if m else 0,
        sum(len(rest) > n for n in LENGTHS) - 1 if rest else 0,
        next((i for i, e in enumerate(ENDINGS) if end and end in e), len(ENDINGS) + (not end)),
    )


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


class ChatModel:
    """Log tables: start and inside change of role, first role, and emission of each feature."""

    def __init__(self, first, start, features):
        log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
        self.first, self.start = log(first + ELSE), log(start + ELSE)
        # inside a row a role goes on until a marker, which leaves every change open
        self.change = [self.start, log(np.full((K, K), CHANGE) + np.eye(K) * STAY), log(np.full((K, K), CHANGE))]
        prior = np.full((K, K + 1), OTHER)
        prior[:, 0] = ELSE
        prior[np.arange(K), 1 + np.arange(K)] = OWN
        # a marker must speak for its role also where the rows have none at all: prior shares weigh at least as the counts
        marker = features[0] / np.maximum(1, features[0].sum(axis=1, keepdims=True)) * 10 + prior
        self.emit = [log(marker), log(features[1] + ELSE), log(features[2] + ELSE)]

    def line_scores(self, text: str | None) -> list[tuple[np.ndarray, int]]:
        """For each line, the score of each role and how it follows the line before."""
        out = []
        for i, line in enumerate(lines_of(text)):
            found = line_features(line)
            out.append((sum(e[:, x] for e, x in zip(self.emit, found)), BEGINS if i == 0 else MARKED if found[0] else GOES_ON))
        return out

    def step(self, into: np.ndarray, line: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores into a line from rows of `into` (entry, role), and where from."""
        reach = into[..., :, None] + self.change[kind]
        return reach.max(axis=-2) + line, reach.argmax(axis=-2)

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        """Best score from each role before the texts to each role at their end."""
        into = np.where(np.eye(K, dtype=bool), 0.0, -1e300)
        for text in texts:
            for line, kind in self.line_scores(text):
                into, _ = self.step(into, line, kind)
        return into

    def path(self, texts: list[str | None], entry: int | None, leave: int) -> list[list[int]]:
        """The roles of the lines of each text, given the role before (None: the conversation begins) and at the end."""
        scores, back, counts = None, [], []
        for text in texts:
            rows = self.line_scores(text)
            counts.append(len(rows))
            for line, kind in rows:
                if scores is None and entry is None:
                    scores, come = self.first + line, np.zeros(K, dtype=int)
                elif scores is None:
                    scores, come = self.start[entry] + line, np.full(K, entry)
                else:
                    scores, come = self.step(scores, line, kind)
                back.append(come)
        role, flat = leave, []
        for come in reversed(back):
            flat.append(role)
            role = int(come[role])
        flat.reverse()
        out, at = [], 0
        for n in counts:
            out.append(flat[at : at + n])
            at += n
        return out


def render(role: str, lines: list[str]) -> str:
    """One canonical turn; the marker of its first line goes."""
    m = _MARKER.match(lines[0])
    body = "\n".join([lines[0][m.end() :] if m else lines[0], *lines[1:]]).strip()
    return f"<|{role}|>\n{escaped(body)}\n<|end|>\n"


def escaped(body: str) -> str:
    """The body with no mark of a turn in it: taking one backslash off before each such bar gives it back."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", body)


def _rows(conversations: DataFrame) -> DataFrame:
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.lower(F.trim("role")).alias("given"), "text")
    return c.withColumn("chunk", F.floor(F.col("turn") / CHUNK).cast("long"))


#: What is parsed in one go, in order: a chunk of a conversation or, of a large chunk, one turn, range of hashes, text, share.
CELL = ["conv", "chunk", "part", "range", "copy", "share"]


def _cells(rows: DataFrame) -> DataFrame:
    """rows with CELL. They are written, as numbers given to rows here must stay the same."""
    row = F.monotonically_increasing_id()
    rows = rows.select(F.when(F.col("conv_id").isNull(), F.concat(F.lit("n"), row)).otherwise(F.concat(F.lit("c"), F.col("conv_id"))).alias("conv"), "chunk", "turn", F.xxhash64("text").alias("hash"), "text", "conv_id", row.alias("row"))
    rows = saved(rows, "chat-rows")
    none = F.lit(None).cast("long")
    large = saved(rows.groupBy("conv", "chunk").agg(F.count("*").alias("n")).where(F.col("n") > 4 * CHUNK), "chat-large")
    if large.isEmpty():
        return rows.select("*", none.alias("part"), none.alias("range"), none.alias("copy"), none.alias("share"))
    on = lambda a, b, *names: [a[x].eqNullSafe(b[x]) for x in names]
    big = rows.join(large, on(rows, large, "conv", "chunk"), "left_semi").groupBy("conv", "chunk", "turn", "hash").agg(F.count("*").alias("times")).where(F.col("times") > CHUNK)
    big = saved(big, "chat-copies")
    out = rows.join(large, on(rows, large, "conv", "chunk"), "left").select(rows["*"], "n")
    out = out.join(big, on(out, big, "conv", "chunk", "turn", "hash"), "left").select(out["*"], "times")
    # of large chunks so many ranges of hashes that each holds about CHUNK rows
    step = F.floor(F.lit(2.0**64) / F.ceil(F.col("n") / CHUNK))
    inside = F.col("n").isNotNull()
    return out.select(
        *rows.columns, F.when(inside, F.col("turn")).otherwise(none).alias("part"), F.when(inside, F.floor(F.col("hash") / step)).otherwise(none).cast("long").alias("range"),
        F.when(F.col("times").isNotNull(), F.col("hash")).otherwise(none).alias("copy"), F.when(F.col("times").isNotNull(), F.pmod("row", F.ceil(F.col("times") / CHUNK))).otherwise(none).cast("long").alias("share"),
    )


def fit(conversations: DataFrame) -> ChatModel:
    """Counts over all rows whose role is known; what comes to the driver is one row for each role and feature value."""
    rows = _rows(conversations)

    def run(batches):
        for b in pieces(batches):
            seen: dict[tuple, int] = {}
            for role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = ROLES.index(role)
                for line in lines_of(text):
                    for f, x in enumerate(line_features(line)):
                        seen[k, f, x] = seen.get((k, f, x), 0) + 1
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32()) for c in zip(*seen)] + [pa.array(list(seen.values()), pa.int64())], ["role", "feature", "value", "n"])

    known = rows.where(F.col("given").isin(ROLES))
    features = [np.zeros((K, n)) for n in SIZES]
    for r in known.select("given", "text").mapInArrow(run, "role int, feature int, value int, n long").groupBy("role", "feature", "value").agg(F.sum("n").alias("n")).collect():
        features[r.feature][r.role, r.value] += r.n
    turns = known.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("given").alias("given"))
    after = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("given").alias("before"))
    first, start = np.zeros(K), np.zeros((K, K))
    for r in turns.join(after, ["conv_id", "turn"], "left").groupBy("before", "given").count().collect():
        if r.before is None:
            first[ROLES.index(r.given)] += r["count"]
        else:
            start[ROLES.index(r.before), ROLES.index(r.given)] += r["count"]
    return ChatModel(first, start, features)


def _runs(batches, n_keys: int):
    """Row groups of equal leading columns, from sorted rows: (key, columns as lists)."""
    key, held = None, []
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        for row in zip(*columns):
            if held and row[:n_keys] != key:
                yield key, list(zip(*held))
                held = []
            key = row[:n_keys]
            held.append(row)
    if held:
        yield key, list(zip(*held))


def parse(conversations: DataFrame, model: ChatModel | None = None) -> DataFrame:
    """conv_id, turn, role, n_lines, n_segments, continues, rendered: one row per row of the table; role is that of its first line,
    continues whether the line before, in the row before, has it too."""
    spark = conversations.sparkSession
    sent = spark.sparkContext.broadcast(model or fit(conversations))
    n, longs = tasks_for(spark), pa.int64()
    rows = _cells(_rows(conversations))
    order = [F.asc_nulls_first(c) for c in (*CELL, "turn", "hash", "text")]
    rows = rows.select(*CELL, "turn", "hash", "text", "conv_id")
    dealt = rows.repartition(n, *CELL).sortWithinPartitions(*order)

    k, kinds = len(CELL), [pa.string(), longs, longs, longs, longs, longs]

    def matrices(batches):
        m = sent.value
        for cell, columns in _runs(batches, k):
            texts = columns[k + 2]
            whole = m.matrix(texts)
            begin = None
            for text in texts:
                for line, kind in m.line_scores(text):
                    begin = m.first + line if begin is None else m.step(begin, line, kind)[0]
            yield pa.RecordBatch.from_arrays([*(pa.array([x], t) for x, t in zip(cell, kinds)), pa.array([whole.ravel().tolist()]), pa.array([begin.tolist()])], [*CELL, "matrix", "begin"])

    def chained(batches):
        for _, columns in _runs(batches, 1):
            scores, back = np.array(columns[k + 1][0]), []
            for flat in columns[k][1:]:
                reach = scores[:, None] + np.array(flat).reshape(K, K)
                back.append(reach.argmax(axis=0))
                scores = reach.max(axis=0)
            leave = [int(scores.argmax())]
            for come in reversed(back):
                leave.append(int(come[leave[-1]]))
            leave.reverse()
            entry = [None, *leave[:-1]]
            yield pa.RecordBatch.from_arrays([*(pa.array(list(c), t) for c, t in zip(columns, kinds)), pa.array(entry, pa.int32()), pa.array(leave, pa.int32())], [*CELL, "entry", "leave"])

    def traced(batches):
        m = sent.value
        for _, columns in _runs(batches, k):
            turns, texts, ids, before = columns[k], columns[k + 2], columns[k + 3], columns[k + 4][0]
            out = []
            for text, roles, turn, conv_id in zip(texts, m.path(texts, before, columns[k + 5][0]), turns, ids):
                lines, parts, at = lines_of(text), [], 0
                for i in range(1, len(lines) + 1):
                    if i == len(lines) or roles[i] != roles[at]:
                        parts.append(render(ROLES[roles[at]], lines[at:i]))
                        at = i
                out.append((conv_id, turn, ROLES[roles[0]], len(lines), len(parts), roles[0] == before, "".join(parts)))
                before = roles[-1]
            types = [longs, longs, pa.string(), longs, longs, pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], ["conv_id", "turn", "role", "n_lines", "n_segments", "continues", "rendered"])

    keys = "conv string, chunk long, part long, range long, copy long, share long"
    chunks = dealt.mapInArrow(matrices, f"{keys}, matrix array<double>, begin array<double>")
    ends = saved(chunks.repartition(n, "conv").sortWithinPartitions(*order[:k]).mapInArrow(chained, f"{keys}, entry int, leave int"), "chat-ends")
    same = [rows[c].eqNullSafe(ends[c]) for c in CELL]
    placed = rows.join(ends, same).select(*(rows[c] for c in CELL), "turn", "hash", "text", "conv_id", "entry", "leave")
    placed = placed.repartition(n, *CELL).sortWithinPartitions(*order)
    return placed.mapInArrow(traced, "conv_id long, turn long, role string, n_lines long, n_segments long, continues boolean, rendered string")


def op5(spark, sf_dir) -> DataFrame:
    return parse(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
