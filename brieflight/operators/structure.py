"""Structure: blocks to divisions(doc_id, node_id, parent_id, ord, depth, name, number, heading, text), an adjacency list.

Flat splits are islands. Trees by indent are built in one pass per document, since each row depends on the open ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text
from . import sequence as seq
from .enrich import is_judge_name

MARGIN = 0.099

DIVISIONS = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("node_id", T.IntegerType()), T.StructField("parent_id", T.IntegerType()), T.StructField("ord", T.IntegerType()),
    T.StructField("depth", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("number", T.StringType()), T.StructField("heading", T.StringType()), T.StructField("text", T.StringType()),
])


def lines(docs: DataFrame, id_: str = "doc_id", column: str = "text") -> DataFrame:
    """Documents to blocks(doc_id, pos, text): one per line that is not blank, positions without gaps left by blanks."""
    rows = docs.select(F.col(id_).alias("doc_id"), F.posexplode(F.split(column, "\r?\n")).alias("pos", "text"))
    return rows.where(~text.is_blank(F.col("text")))


def is_annex(c: Column) -> Column:
    return F.lower(text.clean_whitespace(c)).rlike(r"^(?:annex|- annex -|annex \d+|appendix)$")


def is_leg_annex(c: Column) -> Column:
    """The variant of associated documents: short lines that begin with the word."""
    s = text.clean_whitespace(c)
    return (F.length(s) <= 120) & s.rlike(r"(?i)^(?:annex|appendix)\b(?:\s+[A-Z0-9]+)?\s*(?:[-–:.].*)?$")


def decisions(blocks: DataFrame) -> DataFrame:
    """decision: 0 before the first judge's line, then one more at each."""
    judge = is_judge_name(F.col("text"))
    return blocks.withColumn("decision", seq.island(judge))


def annexes(blocks: DataFrame) -> DataFrame:
    """annex: null before the first, else its number; judges' lines end an annex."""
    a = is_annex(F.col("text"))
    rows = blocks.withColumn("__n", seq.island(a)).withColumn("__end", seq.island(is_judge_name(F.col("text"))))
    first = F.first("__end").over(Window.partitionBy("doc_id", "__n").orderBy("pos"))
    return rows.withColumn("annex", F.when((F.col("__n") > 0) & (F.col("__end") == first), F.col("__n"))).drop("__n", "__end")


def headed_sections(blocks: DataFrame, heading: Column, least: int = 1) -> DataFrame:
    """section (0: before the first) and its heading. With fewer than `least` headings in a document none counts."""
    rows = blocks.withColumn("__h", F.coalesce(heading, F.lit(False)))
    enough = F.sum(F.col("__h").cast("int")).over(Window.partitionBy("doc_id")) >= least
    rows = rows.withColumn("__h", F.col("__h") & enough)
    rows = rows.withColumn("section", seq.island(F.col("__h")))
    return rows.withColumn("section_heading", F.first(F.when(F.col("__h"), F.col("text"))).over(Window.partitionBy("doc_id", "section").orderBy("pos"))).withColumn("is_heading", F.col("__h")).drop("__h")


def nested_sections(blocks: DataFrame, depth: str = "depth", deepest: int | None = None) -> DataFrame:
    """section_1 .. section_n: counters of headings of each depth below the last heading above it."""
    return seq.level_path(blocks.where(F.col(depth).isNotNull()), depth, deepest)


def press_summary_sections(blocks: DataFrame) -> DataFrame:
    """Sections by lines in capitals, or of the usual names."""
    c = text.clean_whitespace(F.col("text"))
    capitals = (F.upper(c) == c) & c.rlike("[A-Z]{3}") & (F.length(c) < 120)
    return headed_sections(blocks, capitals | c.rlike(r"(?i)^(?:background to the appeal|judgment|reasons for the judgment|note)$"))


def consolidate_unnumbered(divisions: DataFrame, by=seq.BY, order=("ord",)) -> DataFrame:
    """Neighbouring divisions without number and heading as one, their texts on lines of their own."""
    rows = divisions.withColumn("__dummy", F.col("number").isNull() & F.col("heading").isNull())
    begins = ~(F.col("__dummy") & F.coalesce(F.lag("__dummy").over(seq.window(by, list(order))), F.lit(False)))
    rows = rows.withColumn("__run", seq.island(begins, by, list(order)))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.coalesce("text", F.lit("")).alias("__t")))), lambda x: x["__t"])
    return rows.groupBy(*by, "__run").agg(F.min(order[0]).alias(order[0]), F.first("number").alias("number"), F.first("heading").alias("heading"), F.array_join(parts, "\n").alias("text"), F.count("*").alias("n_merged")).drop("__run")


def effective_indent(left: Column, first: Column, tabs: Column, default: float = 0.5) -> Column:
    """Where a line's text begins, with leading tabs at default stops."""
    start = F.coalesce(left, F.lit(0.0)) + F.coalesce(first, F.lit(0.0))
    stop = lambda x: (F.floor(x / default + 1e-9) + 1) * default
    hang = F.coalesce(left, F.lit(0.0))
    return F.aggregate(F.when(tabs > 0, F.sequence(F.lit(1), tabs)).otherwise(F.array().cast("array<int>")), start.cast("double"), lambda x, _: F.when((x < hang) & (stop(x) > hang), hang.cast("double")).otherwise(stop(x)))


def is_flush_left(align: Column, indent: Column) -> Column:
    return ~F.coalesce(align, F.lit("left")).isin("right", "center") & (indent <= 0)


def is_hanging(indent: Column, left: Column) -> Column:
    return indent < F.coalesce(left, F.lit(0.0)) - MARGIN


BIG_LEVELS = [r"^[A-Z]\.$", r"^\([A-Z]\)$", r"^\(\d+\)$", r"^\([a-z]\)$", r"^\([ivx]+\)$"]

FORMATS = [re.compile(p) for p in BIG_LEVELS]
ANNEX = re.compile(r"(?i)annex|- annex -|annex \d+|appendix")
PROPER = re.compile(r"\d+\.?")


def big_level(number: Column) -> Column:
    """Which of the numbering formats of big levels, from 0; null for none."""
    return F.coalesce(*(F.when(number.rlike(p), i) for i, p in enumerate(BIG_LEVELS)))


@dataclass
class Node:
    name: str
    number: str | None = None
    heading: str | None = None
    text: list = field(default_factory=list)
    children: list = field(default_factory=list)


@dataclass
class Line:
    text: str
    number: str | None
    indent: float
    left: float
    style: str | None
    align: str | None

    @property
    def hanging(self) -> bool:
        return self.indent < self.left - MARGIN

    @property
    def flush(self) -> bool:
        return self.align not in ("right", "center") and self.indent <= 0

    def opens_quote(self, indent: float) -> bool:
        return (self.style == "Quote" or self.text.startswith("“")) and self.indent - MARGIN > indent


class TreeBuilder:
    """Paragraphs, subparagraphs by deeper indent, quoted structures, big levels, cross headings and annexes of one body.

    What opens a division is decided for each line alone and written down first: annex lines, the formats of big numbers that a
    line has, and headings. Divisions are then ranges of lines between such marks; only paragraphs are read line by line."""

    def __init__(self, lines: list[Line]):
        self.lines, self.at, self.end = lines, 0, len(lines)
        self.annexes = [line.number is None and bool(ANNEX.fullmatch(line.text.strip())) for line in lines]
        self.formats = [frozenset(k for k, f in enumerate(FORMATS) if line.number and line.flush and f.match(line.number)) for line in lines]
        self.headings = [line.number is None and line.flush and len(line.text) < 200 and not line.text.rstrip().endswith((".", ";", ":", ",")) for line in lines]

    def body(self) -> list[Node]:
        """What comes before the first annex, then the annexes."""
        marks = [i for i, a in enumerate(self.annexes) if a]
        ends = [*marks[1:], len(self.lines)]
        out = self.divided(0, marks[0] if marks else len(self.lines))
        return out + [Node("annex", self.lines[s].text, None, [], self.paragraphs(s + 1, e)) for s, e in zip(marks, ends)]

    def divided(self, s: int, e: int) -> list[Node]:
        out, no_heading_before = [], s
        while s < e:
            found, to = self.levels(s, e, frozenset())
            if not found and s >= no_heading_before:
                found, to = self.headed(s, e)
                no_heading_before = e if not found else to
            if not found:
                self.at, self.end = s, e
                found = [self.paragraph()]
                to = self.at
            out += found
            s = to
        return out

    def ranges(self, opens: list[int], e: int) -> tuple[list[tuple[int, int]], int]:
        """Lines that open a division, with the ends of their ranges, up to the first that has nothing below it; where that is."""
        out = list(zip(opens, [*opens[1:], e]))
        empty = next((k for k, (a, b) in enumerate(out) if b == a + 1), len(out))
        return out[:empty], out[empty][0] if empty < len(out) else e

    def levels(self, s: int, e: int, above: frozenset[int]) -> tuple[list[Node], int]:
        """Levels from s on, numbered in one format that is not in use above: of the formats of the first line that number at
        least two ranges, the earliest in BIG_LEVELS. A number of a format in use above ends them."""
        for k in sorted(self.formats[s] - above) if s < e else []:
            stop = next((i for i in range(s + 1, e) if self.formats[i] & above), e)
            found, to = self.ranges([i for i in range(s, stop) if k in self.formats[i]], stop)
            if len(found) < 2:
                continue
            out = []
            for a, b in found:
                inner, rest = self.levels(a + 1, b, above | {k})
                out.append(Node("level", self.lines[a].number, self.lines[a].text, [], inner + self.paragraphs(rest if inner else a + 1, b)))
            return out, to
        return [], s

    def headed(self, s: int, e: int) -> tuple[list[Node], int]:
        """Two or more headings with what is below them, after what comes before the first."""
        opens = [i for i in range(s, e) if self.headings[i]]
        found, to = self.ranges(opens, e)
        if len(found) < 2:
            return [], s
        intro = [Node("paragraphs", children=self.paragraphs(s, opens[0]))] if opens[0] > s else []
        return intro + [Node("crossHeading", None, self.lines[a].text, [], self.paragraphs(a + 1, b)) for a, b in found], to

    def paragraphs(self, s: int, e: int) -> list[Node]:
        self.at, self.end, out = s, e, []
        while self.more():
            out.append(self.paragraph())
        return out

    def more(self) -> bool:
        return self.at < self.end

    def paragraph(self, sub: bool = False, quote: bool = False) -> Node:
        """A line and what is deeper than it. Nested lines are read with a stack of open paragraphs, not by recursion, so a
        long run of ever deeper lines does no harm."""
        first = self.lines[self.at]
        self.at += 1
        root = Node("subparagraph" if sub else "paragraph", first.number, None, [first.text])
        open_ = [(first, root)]
        while self.more():
            line = self.lines[self.at]
            while len(open_) > 1 and line.indent - MARGIN <= open_[-1][0].indent:
                open_.pop()
            above, node = open_[-1]
            if line.indent - MARGIN <= above.indent:
                break
            if not quote and not node.children and line.opens_quote(above.indent):
                node.children.append(self.quoted())
                continue
            if len(open_) == 1 and not sub and not proper(root.number) and proper(line.number):
                break
            self.at += 1
            child = Node("subparagraph", line.number, None, [line.text])
            node.children.append(child)
            open_.append((line, child))
        return root

    def quoted(self) -> Node:
        start, out = self.lines[self.at].indent, Node("quotedStructure")
        while self.more() and abs(self.lines[self.at].indent - start) <= MARGIN:
            line = self.lines[self.at]
            if out.children and line.number is None and out.children[-1].children and not line.text.startswith("“"):
                out.children[-1].text.append(line.text)  # what wraps up a quoted paragraph
                self.at += 1
                continue
            out.children.append(self.paragraph(quote=True))
        return out


def proper(number: str | None) -> bool:
    return number is not None and bool(PROPER.fullmatch(number.strip()))


def flatten(doc_id: str, nodes: list[Node]) -> list[tuple]:
    """Rows of DIVISIONS in document order."""
    out, stack = [], [(n, None, 0, i) for i, n in reversed(list(enumerate(nodes)))]
    while stack:
        n, parent, depth, i = stack.pop()
        me = len(out)
        out.append((doc_id, me, parent, i, depth, n.name, n.number, n.heading, "\n".join(n.text)))
        stack.extend((c, me, depth + 1, k) for k, c in reversed(list(enumerate(n.children))))
    return out


def build(blocks: DataFrame) -> DataFrame:
    """blocks(doc_id, pos, text, number, indent, left_in, style, align) to divisions. A task goes through the documents of its
    part in order and holds the lines of one at a time."""
    import pyarrow as pa

    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]

    def run(batches):
        mark, held, done = None, [], []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done), kinds)], DIVISIONS.fieldNames())

        for b in batches:
            for doc, _, t, number, indent, left, style, align in zip(*(c.to_pylist() for c in b.columns)):
                if held and doc != mark:
                    done += flatten(mark, TreeBuilder(held).body())
                    held = []
                    if len(done) > 10_000:
                        yield rows()
                        done = []
                mark = doc
                held.append(Line(t or "", number, indent or 0.0, left or 0.0, style, align))
        if held:
            done += flatten(mark, TreeBuilder(held).body())
        if done:
            yield rows()

    need = {"number": "string", "indent": "double", "left_in": "double", "style": "string", "align": "string"}
    blocks = blocks.withColumns({k: F.lit(None).cast(v) for k, v in need.items() if k not in blocks.columns})
    rows = blocks.select(F.col("doc_id").cast("string").alias("doc_id"), "pos", "text", *(F.col(k).cast(v).alias(k) for k, v in need.items()))
    return rows.repartition("doc_id").sortWithinPartitions("doc_id", "pos").mapInArrow(run, DIVISIONS)


def consumed_all(blocks: DataFrame, divisions: DataFrame) -> DataFrame:
    """doc_id, ok: whether the texts of the divisions hold as many lines as the blocks."""
    a = blocks.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.count("*").alias("n"))
    b = divisions.groupBy("doc_id").agg(F.sum(F.when(F.col("text") != "", F.size(F.split("text", "\n"))).otherwise(0) + F.when(F.col("heading").isNotNull(), 1).otherwise(0) + F.when(F.col("name") == "annex", 1).otherwise(0)).alias("m"))
    return a.join(b, "doc_id", "left").select("doc_id", (F.col("n") == F.coalesce("m", F.lit(0))).alias("ok"))


def statistics(divisions: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Paragraphs in the body, in annexes, in all; images."""
    inside = F.col("name").isin("paragraph", "subparagraph")
    # rows of a document are in document order, so an annex holds what comes after it
    rows = divisions.withColumn("__annex", seq.island(F.col("name") == "annex", ["doc_id"], ["node_id"]) > 0)
    n = lambda c: F.count(F.when(c, 1))
    out = rows.groupBy("doc_id").agg(n(inside & ~F.col("__annex")).alias("body_paragraphs"), n(inside & F.col("__annex")).alias("annex_paragraphs"), n(inside).alias("total_paragraphs"))
    if images is None:
        return out.withColumn("images", F.lit(0).cast("long"))
    return out.join(images.groupBy("doc_id").agg(F.count("*").alias("images")), "doc_id", "left").withColumn("images", F.coalesce("images", F.lit(0)))


def descendants(blocks: DataFrame, kind: str) -> DataFrame:
    """All inlines of a kind, flattened."""
    return blocks.select("doc_id", "pos", F.posexplode("inlines").alias("i", "inline")).where(F.col("inline.kind") == kind).select("doc_id", "pos", "i", "inline.*")


def link_targets(links: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """links(doc_id, name) with the first division that holds the bookmark."""
    first = bookmarks.groupBy("doc_id", "name").agg(F.min_by("node_id", "ord").alias("node_id"))
    return links.join(first, ["doc_id", "name"], "left")


def reference_direction(references: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """above or below for references(doc_id, name, pos) to bookmarks(doc_id, name, pos)."""
    b = bookmarks.groupBy("doc_id", "name").agg(F.min("pos").alias("target"))
    return references.join(b, ["doc_id", "name"], "left").withColumn("direction", F.when(F.col("target") < F.col("pos"), "above").when(F.col("target") > F.col("pos"), "below"))


def inherited(styles: DataFrame, prop: str) -> DataFrame:
    """styles(style, based_on, prop): the first value going up the chain. Each round looks twice as far up, until no chain of so
    many styles can be longer; styles that are based on one another in a circle without a value get none."""
    rounds = styles.count()
    now = styles.select("style", F.col("based_on").alias("up"), F.col(prop).alias("v"))
    for _ in range(max(1, rounds.bit_length())):
        above = now.select(F.col("style").alias("s"), F.col("up").alias("up2"), F.col("v").alias("v2"))
        now = now.join(above, now.up == above.s, "left").select("style", F.when(F.col("v").isNull(), F.col("up2")).alias("up"), F.coalesce("v", "v2").alias("v"))
    return now.select("style", F.col("v").alias(prop))
