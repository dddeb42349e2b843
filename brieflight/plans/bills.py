"""Bills and instruments: a grammar of nested provisions, parsed with memory and going back, per document.

A rule reads lines at a place and returns a node with the place after it, or nothing; results are remembered by
(rule, place, quote depth), so trying again costs nothing. Provisions are told by the form of their number, and the next
provision of a level must follow the one before it.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import follows, follows_letters
from ..operators.structure import DIVISIONS, Node, flatten

#: Own forms of headings of grouping provisions in English and Welsh, outermost first.
GROUPS = [
    ("groupOfParts", r"^(?:FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|SEVENTH|EIGHTH|NINTH|TENTH) GROUP OF PARTS$"),
    ("part", r"(?i)^(?:PART|RHAN) ([A-Z]*\d+[A-Z]*|[IVXL]+)$"),
    ("chapter", r"(?i)^(?:CHAPTER|PENNOD) ([A-Z]*\d+[A-Z]*|[IVXL]+)$"),
]
SCHEDULE = r"(?i)^(?:THE )?(?:SCHEDULE|ATODLEN)(?: ([A-Z]*\d+[A-Z]*))?$"
SCHEDULES = r"(?i)^(?:SCHEDULES|ATODLENNI)$"
NOTE = r"(?i)^(?:EXPLANATORY NOTE|NODYN ESBONIADOL)$"
#: Provisions by the form of their number, outermost first, in bodies and in schedules.
LEVELS = [("section", r"^([A-Z]*\d+(?:[A-Z]+\d+)*[A-Z]*)\.?$"), ("subsection", r"^\(([A-Z]*\d+(?:[A-Z]+\d+)*[A-Z]*)\)$"), ("para1", r"^\((z*[a-z]{1,3})\)$"), ("para2", r"^\((z*[ivxl]+[a-z]{0,2})\)$"), ("para3", r"^\((Z*[A-Z]{1,3})\)$")]
IN_SCHEDULE = {"section": "schProv1", "subsection": "schProv2"}


@lru_cache(4096)
def roman(s: str) -> int | None:
    values = dict(i=1, v=5, x=10, l=50)
    if not s or any(c not in values for c in s):
        return None
    n = [values[c] for c in s]
    return sum(-a if a < b else a for a, b in zip(n, [*n[1:], 0]))


def next_in_level(level: str, low: str | None, high: str) -> bool:
    """Whether a provision may follow the last of its level; the first may have any number."""
    if low is None:
        return True
    if level == "para2" and roman(low) is not None and roman(high) is not None:
        return roman(high) == roman(low) + 1
    if level.startswith("para"):
        return follows_letters(low, high) or (high.strip("zZ").lower() == "a" and high != low)
    return follows(low, high)


class Parser:
    """One document's lines: (number or None, text)."""

    def __init__(self, lines: list[tuple[str | None, str]]):
        self.lines, self.memo = lines, {}

    def remembered(self, rule, at: int, *state):
        key = (rule.__name__, at, *state)
        if key not in self.memo:
            self.memo[key] = None  # a rule that comes back to itself at one place fails
            self.memo[key] = rule(at, *state)
        return self.memo[key]

    def number(self, at: int) -> str | None:
        return self.lines[at][0] if at < len(self.lines) else None

    def text(self, at: int) -> str:
        return self.lines[at][1].strip() if at < len(self.lines) else ""

    def group_of(self, at: int) -> int | None:
        if at < len(self.lines) and self.number(at) is None:
            for i, (_, p) in enumerate(GROUPS):
                if re.match(p, self.text(at)):
                    return i
        return None

    def ends(self, at: int) -> bool:
        """Schedules and notes end what is open."""
        return at >= len(self.lines) or (self.number(at) is None and any(re.match(p, self.text(at)) for p in (SCHEDULE, SCHEDULES, NOTE)))

    def level_of(self, at: int) -> list[int]:
        n = self.number(at)
        return [i for i, (_, p) in enumerate(LEVELS) if n and re.match(p, n)]

    def group(self, at: int, depth: int, schedule: bool):
        i = self.group_of(at)
        if i is None or i < depth:
            return None
        node, here = Node(GROUPS[i][0], self.text(at)), at + 1
        if here < len(self.lines) and self.number(here) is None and self.group_of(here) is None and not self.ends(here):
            node.heading, here = self.text(here), here + 1
        while not self.ends(here):
            g = self.group_of(here)
            if g is not None and g <= i:
                break
            made = self.remembered(self.group, here, i + 1, schedule) or self.remembered(self.item, here, schedule)
            if made is None:
                break
            node.children.append(made[0])
            here = made[1]
        return (node, here) if node.children else None

    def item(self, at: int, schedule: bool):
        """A provision, a cross heading with its provisions, or a line of text."""
        if self.ends(at):
            return None
        if self.number(at) is None and at + 1 < len(self.lines) and 0 in self.level_of(at + 1) and self.group_of(at) is None and not self.text(at).endswith((".", ";", ",", "—", ":")):
            node, here = Node("crossHeading", None, self.text(at)), at + 1
            while not self.ends(here) and 0 in self.level_of(here):
                made = self.remembered(self.provision, here, 0, 0, schedule)
                if made is None:
                    break
                node.children.append(made[0])
                here = made[1]
            if node.children:
                return node, here
        for level in self.level_of(at):
            made = self.remembered(self.provision, at, level, 0, schedule)
            if made is not None:
                return made
        return Node("unnumbered", None, None, [self.text(at)]), at + 1

    def quoted(self, at: int, quotes: int, schedule: bool):
        """Lines from one that opens a quotation to the one that closes it."""
        if at >= len(self.lines) or not (self.lines[at][1].lstrip().startswith("“") or (self.number(at) or "").startswith("“")):
            return None
        depth, here = 0, at
        while here < len(self.lines):
            line = (self.number(here) or "") + self.lines[here][1]
            depth += line.count("“") - line.count("”")
            here += 1
            if depth <= 0:
                break
        else:
            return None
        strip = lambda s: None if s is None else s.strip().lstrip("“").strip()
        inner = [(strip(n) or None, strip(x) if k == 0 else x) for k, (n, x) in enumerate(self.lines[at:here])]
        return Node("quotedStructure", children=Parser(inner).all()), here

    def provision(self, at: int, level: int, quotes: int, schedule: bool):
        if level not in self.level_of(at):
            return None
        name = LEVELS[level][0]
        node, here = Node(IN_SCHEDULE.get(name, name) if schedule else name, self.number(at), None, [self.text(at)] if self.text(at) else []), at + 1
        last: dict[int, str] = {}
        while not self.ends(here) and self.group_of(here) is None:
            quote = self.remembered(self.quoted, here, quotes, schedule)
            if quote is not None:
                node.children.append(quote[0])
                here = quote[1]
                continue
            deeper = [i for i in self.level_of(here) if i > level]
            # (i) may be a letter or a Roman number: the one that follows what came before it at its level
            deeper.sort(key=lambda i: (not (i in last and next_in_level(LEVELS[i][0], last[i], self.bare(here, i))), not (i not in last and self.bare(here, i).strip("zZ").lower() in ("a", "i", "1")), i))
            if deeper and not (level + 1 > 0 and any(i <= level for i in self.level_of(here)) and not any(i in last for i in deeper) and self.bare(here, deeper[0]).lower() not in ("a", "i", "1")):
                made = self.remembered(self.provision, here, deeper[0], quotes, schedule)
                if made is None:
                    break
                last[deeper[0]] = self.bare(here, deeper[0])
                node.children.append(made[0])
                here = made[1]
                continue
            if self.number(here) is None and node.children and level > 0 or self.number(here) is not None:
                break
            if self.number(here) is None and here + 1 < len(self.lines) and 0 in self.level_of(here + 1) and not self.text(here).endswith((".", ";", ",", "—", ":")):
                break  # a cross heading
            if self.number(here) is None:
                (node.children.append(Node("wrapUp", None, None, [self.text(here)])) if node.children else node.text.append(self.text(here)))
                here += 1
        return node, here

    def bare(self, at: int, level: int) -> str:
        return re.match(LEVELS[level][1], self.number(at))[1]

    def schedule(self, at: int):
        if at >= len(self.lines) or not re.match(SCHEDULE, self.text(at)) or self.number(at) is not None:
            return None
        node, here = Node("schedule", self.text(at)), at + 1
        if here < len(self.lines) and self.number(here) is None and not self.ends(here) and self.group_of(here) is None:
            node.heading, here = self.text(here), here + 1
        while not self.ends(here):
            made = self.remembered(self.group, here, 0, True) or self.remembered(self.item, here, True)
            if made is None:
                break
            node.children.append(made[0])
            here = made[1]
        return node, here

    def all(self) -> list[Node]:
        out, here = [], 0
        while here < len(self.lines):
            if self.number(here) is None and re.match(SCHEDULES, self.text(here)):
                node, here = Node("schedules", self.text(here)), here + 1
                while (made := self.remembered(self.schedule, here)) is not None:
                    node.children.append(made[0])
                    here = made[1]
                out.append(node)
                continue
            if self.number(here) is None and re.match(NOTE, self.text(here)):
                node, here = Node("explanatoryNote", None, self.text(here)), here + 1
                while here < len(self.lines):
                    node.text.append(self.text(here))
                    here += 1
                out.append(node)
                continue
            made = self.remembered(self.schedule, here) or self.remembered(self.group, here, 0, False) or self.remembered(self.item, here, False)
            out.append(made[0])
            here = made[1]
        return out


def parse(blocks: DataFrame) -> DataFrame:
    """blocks(doc_id, pos, number, text) to divisions."""
    import pandas as pd

    columns = [f.name for f in DIVISIONS]

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("pos")
        lines = [(None if pd.isna(n) else n, t or "") for n, t in zip(p["number"], p["text"])]
        out = pd.DataFrame(flatten(str(p["doc_id"].iloc[0]), Parser(lines).all()), columns=columns)
        out["parent_id"] = out["parent_id"].astype("Int32")
        return out

    return blocks.select(F.col("doc_id").cast("string").alias("doc_id"), "pos", "number", "text").groupBy("doc_id").applyInPandas(run, DIVISIONS)


def provision_ids(divisions: DataFrame) -> DataFrame:
    """Ids of provisions from the names and numbers on their way, like sec_1__subsec_2, level by level."""
    short = F.element_at(F.create_map(*(F.lit(x) for kv in {"section": "sec", "subsection": "subsec", "part": "part", "chapter": "chp", "schedule": "sched", "schProv1": "para", "schProv2": "subpara"}.items() for x in kv)), F.col("name"))
    own = F.concat_ws("_", F.coalesce(short, F.lower("name")), F.nullif(F.regexp_replace(F.coalesce("number", (F.col("ord") + 1).cast("string")), r"(?i)^(?:part|chapter|schedule|the schedule)\s*|[().]", ""), F.lit("")))
    rows = divisions.withColumn("own", own)
    now = rows.where("parent_id is null").select("doc_id", "node_id", F.col("own").alias("eid"))
    out, depth = now, 0
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    while depth < deepest:
        depth += 1
        now = rows.where(F.col("depth") == depth).select("doc_id", F.col("parent_id").alias("p"), F.col("node_id").alias("n"), "own").join(now.select("doc_id", F.col("node_id").alias("p"), "eid"), ["doc_id", "p"]).select("doc_id", F.col("n").alias("node_id"), F.concat_ws("__", "eid", "own").alias("eid"))
        out = out.unionAll(now)
    return divisions.join(out, ["doc_id", "node_id"], "left")


#: Own patterns of what stands before the provisions, in English and Welsh.
HEADER = [
    ("longTitle", r"(?i)^(?:A Bill to|An Act (?:to|of the)|Bil i|Deddf (?:i|gan))\b"),
    ("preamble", r"(?i)^(?:Whereas\b|The (?:Secretary of State|Scottish Ministers|Welsh Ministers|Treasury|Department)\b.* (?:make|makes) the following|Mae Gweinidogion Cymru yn gwneud)"),
    ("enacting", r"(?i)^(?:Be it (?:therefore )?enacted|Be it enacted by being passed|Having been passed by|Gan ei fod wedi ei basio)"),
]


def header(blocks: DataFrame) -> DataFrame:
    """part of each block: cover, then longTitle, preamble, enacting from the lines that begin them, and body from the first
    number or grouping heading on."""
    from pyspark.sql.window import Window

    from ..operators import sequence as seq

    c = F.trim("text")
    first = F.min(F.when(F.col("number").isNotNull() | c.rlike(GROUPS[1][1]) | c.rlike(SCHEDULE), F.col("pos"))).over(Window.partitionBy("doc_id"))
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(HEADER):
        kind = F.when(c.rlike(pattern), name).otherwise(kind)
    rows = blocks.withColumn("__first", first).withColumn("__kind", kind)
    last = F.last("__kind", ignorenulls=True).over(seq.up_to_here())
    return rows.withColumn("part", F.when(F.col("pos") >= F.col("__first"), "body").otherwise(F.coalesce(last, F.lit("cover")))).drop("__first", "__kind")


def block_lists(blocks: DataFrame) -> DataFrame:
    """list (number of the list a block is in, null outside) and item: runs of numbered or bulleted blocks whose number
    follows the one before; a deeper block without number goes with its item."""
    from ..operators import sequence as seq

    mark = F.col("number").isNotNull() | F.col("text").rlike(r"^\s*[•–-]\s")
    inside = mark | (F.coalesce("left_in", F.lit(0.0)) > 0)
    rows = blocks.withColumn("__in", inside).withColumn("__mark", mark)
    begins = F.col("__in") & F.col("__mark") & ~F.coalesce(F.lag("__in").over(seq.window()), F.lit(False))
    rows = rows.withColumn("__list", seq.island(begins))
    open_ = F.col("__in") & (F.col("__list") > 0)
    rows = rows.withColumn("list", F.when(open_, F.col("__list")))
    return rows.withColumn("item", F.when(open_, F.sum(F.when(F.col("__mark"), 1).otherwise(0)).over(seq.up_to_here(["doc_id", "__list"])))).drop("__in", "__mark", "__list")
