"""Operators over ordered rows: blocks(doc_id, pos, ...) to the same rows with more columns, or fewer rows.

All of them work within `by` (usually doc_id) in the order of `order` (usually pos). Window stages over the same `by`
share one exchange. One document is one task's work; documents are independent.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BY, ORDER = ["doc_id"], ["pos"]


def window(by=BY, order=ORDER):
    return Window.partitionBy(*by).orderBy(*order)


def up_to_here(by=BY, order=ORDER):
    return window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def from_here(by=BY, order=ORDER):
    return window(by, order).rowsBetween(Window.currentRow, Window.unboundedFollowing)


def island(begins: Column, by=BY, order=ORDER) -> Column:
    """Number of the run that a row is in: runs begin where `begins` is true (null is false)."""
    return F.sum(F.when(begins, 1).otherwise(0)).over(up_to_here(by, order))


def changed(*columns: str, by=BY, order=ORDER) -> Column:
    """Whether a row differs from the one before in any of the columns; true for the first."""
    w, out = window(by, order), F.row_number().over(window(by, order)) == 1
    for c in columns:
        out = out | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    return out


def merge_runs(df: DataFrame, same: list[str], text: str = "text", separator: str = "", by=BY, order=ORDER, barrier: Column | None = None) -> DataFrame:
    """Neighbours with equal `same` columns become one row with their texts joined; a barrier row stays alone."""
    begins = changed(*same, by=by, order=order)
    if barrier is not None:
        begins = begins | barrier | F.coalesce(F.lag(F.when(barrier, 1)).over(window(by, order)) == 1, F.lit(False))
    runs = df.withColumn("__run", island(begins, by, order))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__t")))), lambda x: x["__t"])
    return runs.groupBy(*by, "__run", *[c for c in same if c not in by]).agg(*(F.min(o).alias(o) for o in order), F.array_join(parts, separator).alias(text), F.count("*").alias("n_merged")).drop("__run")


def merge_flagged(df: DataFrame, flag: str = "merged_with_next", text: str = "text", separator: str = "", by=BY, order=ORDER) -> DataFrame:
    """Rows joined with the next one as long as the flag is set."""
    begins = ~F.coalesce(F.lag(flag).over(window(by, order)), F.lit(False))
    runs = df.withColumn("__run", island(begins, by, order))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__t")))), lambda x: x["__t"])
    return runs.groupBy(*by, "__run").agg(*(F.min(o).alias(o) for o in order), F.array_join(parts, separator).alias(text), F.count("*").alias("n_merged")).drop("__run")


def carry_to_next_kept(df: DataFrame, kept: Column, value: Column, name: str, by=BY, order=ORDER) -> DataFrame:
    """What dropped rows hold goes to the next kept row (true if any of them, or it, holds it); dropped rows go."""
    runs = df.withColumn("__kept", kept).withColumn("__value", value)
    # the run of a kept row: itself and the dropped rows just before it
    runs = runs.withColumn("__run", F.sum(F.when(F.col("__kept"), 1).otherwise(0)).over(up_to_here(by, order)) - F.when(F.col("__kept"), 1).otherwise(0))
    return runs.withColumn(name, F.max(F.coalesce("__value", F.lit(False))).over(Window.partitionBy(*by, "__run"))).where("__kept").drop("__kept", "__run", "__value")


def carry_list_to_next_kept(df: DataFrame, kept: Column, values: str, by=BY, order=ORDER) -> DataFrame:
    """The same for arrays, which are joined in order."""
    runs = df.withColumn("__kept", kept)
    runs = runs.withColumn("__run", F.sum(F.when(F.col("__kept"), 1).otherwise(0)).over(up_to_here(by, order)) - F.when(F.col("__kept"), 1).otherwise(0))
    all_ = F.collect_list(F.coalesce(values, F.array().cast("array<string>"))).over(Window.partitionBy(*by, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return runs.withColumn(values, F.flatten(all_)).where("__kept").drop("__kept", "__run")


def cut_before_first(df: DataFrame, *rules: Column, by=BY, order=ORDER, name: str = "cut") -> DataFrame:
    """Position of the cut: the first row for the first rule in order that fits anywhere, else null."""
    whole = Window.partitionBy(*by)
    return df.withColumn(name, F.coalesce(*(F.min(F.when(r, F.col(order[0]))).over(whole) for r in rules)))


def header_split(blocks: DataFrame, *, title: Column, ends: Column, second: Column, third: Column, numbered: Column, by=BY, order=ORDER) -> DataFrame:
    """Header or body by four attempts in order: after the title, before the first row that ends a header; before an
    introduction; before a break or after a copyright line; before the first numbered row. No attempt fits: all is body."""
    o = order[0]
    w = Window.partitionBy(*by)
    at = F.min(F.when(title, F.col(o))).over(w)
    rows = blocks.withColumn("__title", at)
    one = F.min(F.when(ends & (F.col(o) > F.col("__title")), F.col(o))).over(w)
    two = F.min(F.when(second, F.col(o))).over(w)
    three = F.min(F.when(third, F.col(o))).over(w)
    four = F.min(F.when(numbered, F.col(o))).over(w)
    cut = F.coalesce(one, two, three, four)
    return rows.withColumn("cut", cut).withColumn("part", F.when(F.col(o) < F.col("cut"), "header").otherwise("body")).drop("__title")


def tribunal_split(blocks: DataFrame, *, title: Column, table_title: Column, introduction: Column, copyright: Column, ignored: int = 10, by=BY, order=ORDER) -> DataFrame:
    """Header through a title line, else through a table that ends with one, else before an introduction, else through a
    copyright line that is not among the last `ignored` rows. No attempt fits: all is body."""
    o, whole = order[0], Window.partitionBy(*by)
    rows = blocks.withColumn("__left", F.count("*").over(from_here(by, order)))
    at = lambda c: F.min(F.when(c, F.col(o))).over(whole)
    cut = F.coalesce(at(title) + 1, at(table_title) + 1, at(introduction), at(copyright & (F.col("__left") > ignored)) + 1)
    return rows.withColumn("cut", cut).withColumn("part", F.when(F.col(o) < F.col("cut"), "header").otherwise("body")).drop("__left")


def stages(df: DataFrame, steps: list[tuple[str, Column]], name: str = "stage", optional: tuple[str, ...] = (), by=BY, order=ORDER) -> DataFrame:
    """A state machine that only goes forward: each step begins at the first row after the step before where its condition
    holds. A required step that never comes fails the whole: `stage` is then null in all rows of the document. Rows carry
    the last step begun."""
    o, whole = order[0], Window.partitionBy(*by)
    rows, last, ok, begun = df, F.lit(None), F.lit(True), []
    for i, (step, condition) in enumerate(steps):
        after = condition if i == 0 else condition & (F.col(o) > F.col("__last"))
        rows = rows.withColumn(f"__at{i}", F.min(F.when(after, F.col(o))).over(whole))
        rows = rows.withColumn("__last", F.coalesce(f"__at{i}", F.col("__last") if i else F.lit(-1)))
        if step not in optional:
            ok = ok & F.col(f"__at{i}").isNotNull()
        begun.append((i, step))
    for i, step in begun:
        last = F.when(F.col(o) >= F.col(f"__at{i}"), step).otherwise(last)
    return rows.withColumn(name, F.when(ok, last)).drop("__last", *(f"__at{i}" for i, _ in begun))


def second_break_split(blocks: DataFrame, breaks: Column, speech: Column, by=BY, order=ORDER) -> DataFrame:
    """Header up to the second break, or up to a first break that a speech follows."""
    n = blocks.withColumn("__breaks", F.sum(F.when(breaks, 1).otherwise(0)).over(up_to_here(by, order)))
    begins = (breaks & (F.col("__breaks") == 2)) | (breaks & (F.col("__breaks") == 1) & speech)
    n = cut_before_first(n, begins, by=by, order=order)
    return n.withColumn("part", F.when(F.col(order[0]) < F.col("cut"), "header").otherwise("body")).drop("__breaks")


def balance(opens: Column, closes: Column, by=BY, order=ORDER) -> Column:
    """Open minus closed so far, this row included."""
    return F.sum(F.when(opens, 1).otherwise(0) - F.when(closes, 1).otherwise(0)).over(up_to_here(by, order))


def spans(df: DataFrame, opens: Column, closes: Column, name: str = "in_span", abandon: Column | None = None, by=BY, order=ORDER) -> DataFrame:
    """Marks rows from an opening to the row that closes it; a span that holds an abandoning row is not marked."""
    b = df.withColumn("__after", balance(opens, closes, by, order))
    b = b.withColumn("__before", F.coalesce(F.lag("__after").over(window(by, order)), F.lit(0)))
    inside = (F.col("__after") > 0) | (F.col("__before") > 0)
    b = b.withColumn("__in", inside).withColumn("__span", island((F.col("__before") <= 0) & (F.col("__after") > 0), by, order))
    if abandon is not None:
        bad = F.max(F.when(F.col("__in") & abandon, 1).otherwise(0)).over(Window.partitionBy(*by, "__span")) == 1
        return b.withColumn(name, F.col("__in") & ~bad).drop("__after", "__before", "__in", "__span")
    return b.withColumnRenamed("__in", name).drop("__after", "__before", "__span")


def first_match(df: DataFrame, hit: Column, limit: int | None = None, by=BY, order=ORDER) -> DataFrame:
    """The first row that fits, of the first `limit` positions if given. The filter comes before the window."""
    rows = df if limit is None else df.where(F.col(order[0]) < limit)
    return rows.where(hit).withColumn("__n", F.row_number().over(window(by, order))).where("__n = 1").drop("__n")


def last_match(df: DataFrame, hit: Column, by=BY, order=ORDER) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*(F.col(o).desc() for o in order))
    return df.where(hit).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def kgram_match(df: DataFrame, rules: DataFrame, text: str = "text", longest: int = 6, starts: int = 10, by=BY, order=ORDER) -> DataFrame:
    """rules(rule, code, lines array<string>): the first place among the first starts where consecutive lines equal a
    rule's, the longest rule there, then the first rule. One row per document with a match. The rules are broadcast
    (a few thousand rows of a program's own table)."""
    w = window(by, order)
    head = df.where(F.col(order[0]) < starts + longest)
    lines = F.array(*(F.lead(text, i).over(w) if i else F.col(text) for i in range(longest)))
    grams = head.withColumn("__lines", lines).where(F.col(order[0]) < starts)
    grams = grams.withColumn("__k", F.explode(F.sequence(F.lit(longest), F.lit(1)))).withColumn("__gram", F.slice("__lines", F.lit(1), F.col("__k")))
    hits = grams.join(rules, F.col("__gram") == F.col("lines"))
    best = Window.partitionBy(*by).orderBy(F.col(order[0]), F.col("__k").desc(), "rule")
    return hits.withColumn("__n", F.row_number().over(best)).where("__n = 1").select(*by, *order, F.col("__k").alias("n_lines"), "rule", "code")


def until_marker(df: DataFrame, begins: Column, ends: Column, most: int = 6, name: str = "marked", by=BY, order=ORDER) -> DataFrame:
    """Marks up to `most` rows after the first beginning, until a row that ends it."""
    rows = df.withColumn("__n", F.row_number().over(window(by, order)))
    rows = rows.withColumn("__from", F.min(F.when(begins, F.col("__n"))).over(Window.partitionBy(*by)))
    rows = rows.withColumn("__to", F.min(F.when(ends & (F.col("__n") > F.col("__from")), F.col("__n"))).over(Window.partitionBy(*by)))
    inside = (F.col("__n") > F.col("__from")) & (F.col("__n") <= F.col("__from") + most) & (F.col("__to").isNull() | (F.col("__n") < F.col("__to")))
    return rows.withColumn(name, F.coalesce(inside, F.lit(False))).drop("__n", "__from", "__to")


def continuations(df: DataFrame, label: Column, goes_on: Column, text: str = "text", separator: str = " ", by=BY, order=ORDER) -> DataFrame:
    """A label row with the continuing rows after it as one row; other rows are dropped."""
    rows = df.withColumn("__label", label).withColumn("__on", goes_on)
    rows = rows.withColumn("__run", island(F.col("__label") | ~F.col("__on"), by, order))
    rows = rows.withColumn("__has", F.max(F.col("__label")).over(Window.partitionBy(*by, "__run")))
    rows = rows.where("__has")
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__t")))), lambda x: x["__t"])
    return rows.groupBy(*by, "__run").agg(*(F.min(o).alias(o) for o in order), F.array_join(parts, separator).alias(text)).drop("__run")


def trim_blank_ends(df: DataFrame, blank: Column, by=BY, order=ORDER) -> DataFrame:
    """Without blank rows at the beginning and the end."""
    o = order[0]
    w = Window.partitionBy(*by)
    rows = df.withColumn("__a", F.min(F.when(~blank, F.col(o))).over(w)).withColumn("__b", F.max(F.when(~blank, F.col(o))).over(w))
    return rows.where(F.col(o).between(F.col("__a"), F.col("__b"))).drop("__a", "__b")


# numbers at the beginning of lines

# Forms of numbers that stand as plain text before a line, in order.
NUMBER_FORMS = [
    r"\d+\.", r"\(?\d+\)",
    r"[A-Z]\.", r"\(?Z*[A-Z]{1,3}\)",
    r"[a-z]\.", r"\(?z*[a-z]{1,3}\)",
    r"[ivx]+\.", r"\(?z*[ivx]+[a-z]{0,3}\)",
    r"[1-9]\d*\.\d+\.?", r"\(?[1-9]\d*\.\d+\)",
    r"[1-9]\d*\.\d+\.\d+\.?", r"\(?[1-9]\d*\.\d+\.\d+\)",
    r"[A-Z]*\d+(?:[A-Z]+\d+)*[A-Z]*\.", r"\(?[A-Z]*\d+(?:[A-Z]+\d+)*[A-Z]*\)", r"\(?[ivx]+[a-z]\)",
]
QUOTE_START = r'(?:(?:\{.*?\}\s*)?[“"])?'


def hard_number(df: DataFrame, text: str = "text") -> DataFrame:
    """number and rest of a line whose number is plain text; number is null where there is none. A number before a tab
    may be bare; before an em dash the form of sections is taken."""
    c = F.regexp_replace(F.regexp_replace(F.col(text), "⁠", ""), r"(?U)^[\t\r\n\s]+", "")
    forms = [rf"^({QUOTE_START}{f})(?:[\s ]|$)" for f in NUMBER_FORMS] + [rf"^({QUOTE_START}[A-Z]*\d+(?:[A-Z]+\d+)*[A-Z]*\.)—"]
    bare = F.nullif(F.regexp_extract(c, r'^\s*([“"]?\d+)\s*\t', 1), F.lit(""))
    number = F.coalesce(bare, *(F.nullif(F.regexp_extract(c, f, 1), F.lit("")) for f in forms))
    df = df.withColumn("number", number)
    after = F.substring(c, F.instr(c, F.col("number")) + F.length("number"), F.length(c))
    return df.withColumn("rest", F.when(F.col("number").isNull(), F.col(text)).otherwise(F.regexp_replace(after, r"(?U)^\s+", "")))


def letters_in_order(numbers: Iterable[tuple[int, str | None]]) -> list[bool]:
    """For each (indent, number): whether a capital letter with a point is kept. A letter is kept if it begins a list
    with A or follows the last kept one of its indent; a lone A that is then contradicted is taken back."""
    kept, stacks = [], {}
    for i, (indent, number) in enumerate(numbers):
        text = (number or "").lstrip('“"')
        if len(text) != 2 or not ("A" <= text[0] <= "Z") or text[1] != ".":
            kept.append(True)
            continue
        n, stack = ord(text[0]) - 64, stacks.setdefault(indent, [])
        kept.append(True)
        if stack and stack[-1][1] == 1 and n != 2:
            kept[stack.pop()[0]] = False  # a lone A
        last = stack[-1][1] if stack else None
        if n == 1 or (last is not None and n == last + 1):
            stack.append((i, n))
        else:
            kept[i] = False
    return kept


def revert_letters(df: DataFrame, by=BY, order=ORDER) -> DataFrame:
    """number becomes null where `letters_in_order` takes it back. One document's numbers in one pass (a stack)."""
    import pandas as pd

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order).reset_index(drop=True)
        indents = (p["left_in"].fillna(0.0) / 8).round().astype(int)
        keep = letters_in_order(zip(indents, p["number"]))
        p["number"] = [n if k else None for n, k in zip(p["number"], keep)]
        return p

    return df.groupBy(*by).applyInPandas(run, df.schema)


def list_counters(df: DataFrame, by=BY, order=ORDER) -> DataFrame:
    """n for each (list_id, level) row: counters go up at their level and begin anew below it; `start` is the first value
    of a level, `restart` (nullable) a new first value that counts once per list. One pass per document."""
    import pandas as pd
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField("n", T.IntegerType())])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order).reset_index(drop=True)
        counters: dict = {}
        used: set = set()
        out = []
        for list_id, level, start, restart in zip(p["list_id"], p["level"], p["start"], p["restart"]):
            if pd.isna(list_id):
                out.append(None)
                continue
            own = counters.setdefault(list_id, {})
            if not pd.isna(restart) and (list_id, level) not in used:
                used.add((list_id, level))
                own[level] = int(restart)
            elif level in own:
                own[level] += 1
            else:
                own[level] = int(start) if not pd.isna(start) else 1
            for deeper in [k for k in own if k > level]:
                del own[deeper]
            out.append(own[level])
        p["n"] = pd.array(out, dtype="Int32")
        return p

    return df.groupBy(*by).applyInPandas(run, schema)


def simple_list_number(parent: Column, by=BY, order=ORDER) -> Column:
    """The same without overrides, as a row number below the parent's row."""
    return F.row_number().over(Window.partitionBy(*by, parent).orderBy(*order))


def preceding_count(hit: Column, by=BY, order=ORDER) -> Column:
    """How many rows up to here fit."""
    return F.count(F.when(hit, 1)).over(up_to_here(by, order))


def attachment_number(kind: str = "type", by=BY, order=ORDER) -> Column:
    return F.row_number().over(Window.partitionBy(*by, kind).orderBy(*order))


def paragraph_ids(df: DataFrame, by=BY, order=ORDER) -> DataFrame:
    """para_<number> at the first use of a plain number in a document, else lvl_<position>."""
    clean = F.regexp_replace("number", r"[.()\[\]]", "")
    rows = df.withColumn("__clean", F.when(clean.rlike(r"^\d+$"), clean))
    first = F.row_number().over(Window.partitionBy(*by, "__clean").orderBy(*order)) == 1
    at = F.row_number().over(window(by, order))
    return rows.withColumn("eid", F.when(F.col("__clean").isNotNull() & first, F.concat(F.lit("para_"), F.col("__clean"))).otherwise(F.concat(F.lit("lvl_"), at.cast("string")))).drop("__clean")


def level_path(df: DataFrame, depth: str = "depth", deepest: int | None = None, by=BY, order=ORDER) -> DataFrame:
    """path like 2_1_3: at each depth, how many rows of that depth came since the last row above it. Without `deepest` the greatest
    depth of the rows is looked up first, so no level is left out."""
    parts = []
    rows = df
    if deepest is None:
        deepest = int(df.agg(F.max(depth)).first()[0] or 0)
    for d in range(1, deepest + 1):
        rows = rows.withColumn(f"__up{d}", island(F.col(depth) < d, by, order))
    for d in range(1, deepest + 1):
        w = Window.partitionBy(*by, f"__up{d}").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts.append(F.when(F.col(depth) >= d, F.sum(F.when(F.col(depth) == d, 1).otherwise(0)).over(w).cast("string")))
    return rows.withColumn("path", F.concat_ws("_", *parts)).drop(*(f"__up{d}" for d in range(1, deepest + 1)))


def toc(df: DataFrame, accepted: Column, by=BY, order=ORDER) -> DataFrame:
    """Numbered entries of accepted headings after an entry for the whole document."""
    w = window(by, order)
    entries = df.where(accepted).select(*by, F.row_number().over(w).alias("entry"), *order, F.trim("text").alias("heading"))
    whole = df.select(*by).distinct().select(*by, F.lit(0).alias("entry"), F.lit(-1).cast(df.schema[order[0]].dataType).alias(order[0]), F.lit("Whole document").alias("heading"))
    return whole.unionByName(entries)


def table_grid(cells: DataFrame) -> DataFrame:
    """cells(doc_id, tbl, row, cell, colspan, vmerge): grid column and row span; continued cells go. A cell of vmerge
    'restart' spans the 'continue' cells below it in its grid column."""
    w = Window.partitionBy("doc_id", "tbl", "row").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    span = F.coalesce("colspan", F.lit(1))
    grid = cells.withColumn("grid_col", (F.sum(span).over(w) - span).cast("int"))
    down = Window.partitionBy("doc_id", "tbl", "grid_col").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = grid.withColumn("__run", F.sum(F.when(F.coalesce(F.col("vmerge") == "continue", F.lit(False)), 0).otherwise(1)).over(down))
    runs = runs.withColumn("rowspan", F.count("*").over(Window.partitionBy("doc_id", "tbl", "grid_col", "__run")).cast("int"))
    return runs.where("vmerge is null or vmerge <> 'continue'").drop("__run")


def column_sums(cells: DataFrame) -> DataFrame:
    """sum_above: the sum of the numbers above a cell in its column."""
    w = Window.partitionBy("doc_id", "tbl", "col").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    value = F.regexp_replace("text", r"[£$€,%\s]", "").try_cast("decimal(28,6)")
    return cells.withColumn("sum_above", F.sum(value).over(w).cast("double"))


def demote_thin_headings(df: DataFrame, least: int = 40, by=BY, order=ORDER) -> DataFrame:
    """Visual headings whose text up to the next heading of the same or a higher level is shorter than `least` characters
    lose their depth. Text before a row is a running sum, and the end of each heading's part is found depth by depth."""
    w = up_to_here(by, order)
    rows = df.withColumn("__sum", F.sum(F.when(F.col("depth").isNull(), F.length("text")).otherwise(0)).over(w))
    later = window(by, order).rowsBetween(1, Window.unboundedFollowing)
    total = F.max("__sum").over(Window.partitionBy(*by))
    ends = F.lit(None).cast("bigint")
    for d in range(1, 7):
        ends = F.when(F.col("depth") == d, F.coalesce(F.min(F.when(F.col("depth") <= d, F.col("__sum"))).over(later), total)).otherwise(ends)
    thin = (F.col("signal") == "visual") & ((ends - F.col("__sum")) < least)
    return rows.withColumn("depth", F.when(F.coalesce(thin, F.lit(False)), None).otherwise(F.col("depth"))).drop("__sum")
