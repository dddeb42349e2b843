"""Numbers of paragraphs: Roman, letters, formats and what follows what."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_ROMAN = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]


def roman_to_int(c: Column) -> Column:
    """Value of a lower-case Roman number; null if it holds other characters or nothing."""
    value = lambda x: F.element_at(F.create_map(*(F.lit(v) for k in "ivxlcdm" for v in (k, dict(i=1, v=5, x=10, l=50, c=100, d=500, m=1000)[k]))), x)
    values = F.transform(F.split(F.lower(c), ""), value)
    # each value counts negative before a larger one
    folded = F.aggregate(F.reverse(values), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), lambda a, v: F.struct((a["sum"] + F.when(v < a["last"], -v).otherwise(v)).alias("sum"), v.alias("last")), lambda a: a["sum"])
    return F.when(F.lower(c).rlike("^[ivxlcdm]+$"), folded)


def int_to_roman(c: Column) -> Column:
    """Lower-case Roman number of 1 to 3999, else null."""
    steps = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(s).alias("s")) for n, s in _ROMAN))
    out = F.aggregate(
        steps,
        F.struct(c.cast("int").alias("left"), F.lit("").alias("out")),
        lambda a, x: F.struct((a["left"] % x["n"]).alias("left"), F.concat(a["out"], F.repeat(x["s"], F.floor(a["left"] / x["n"]).cast("int"))).alias("out")),
        lambda a: a["out"],
    )
    return F.when(c.between(1, 3999), out)


def int_to_letters(c: Column) -> Column:
    """a to z, then aa, bb and so on, as word processors number; null below 1."""
    return F.when(c >= 1, F.repeat(F.char(F.lit(97) + (c - 1) % 26), (F.floor((c - 1) / 26) + 1).cast("int")))


def format_number(n: Column, kind: Column, text: Column) -> Column:
    """A list number by format kind and level text (`%1`, `%1.`, `(%1)`, `%1)`); null for an unknown kind or text."""
    body = (
        F.when(kind == "decimal", n.cast("string"))
        .when(kind == "lowerLetter", int_to_letters(n))
        .when(kind == "upperLetter", F.upper(int_to_letters(n)))
        .when(kind == "lowerRoman", int_to_roman(n))
        .when(kind == "upperRoman", F.upper(int_to_roman(n)))
        .when(kind == "decimalZero", F.format_string("%02d", n))
        .when(kind == "none", "")
    )
    return F.when(text.rlike(r"^\(?%\d[.)]?$") & ~text.rlike(r"^\(%\d\.?$"), F.concat(F.when(text.startswith("("), "(").otherwise(""), body, F.regexp_extract(text, r"%\d(.?)$", 1)))


def next_number(s: str) -> str:
    """The number after this one: 1 to 2, A9 to A10, 1A to 1B, N to P, Z to Z1."""
    if re.fullmatch(r"[+-]?\d+", s):
        return str(int(s) + 1)
    m = re.search(r"\d+$", s)
    if m:
        return s[: m.start()] + str(int(m[0]) + 1)
    return s + "1" if s[-1] == "Z" else s[:-1] + ("P" if s[-1] == "N" else chr(ord(s[-1]) + 1))


def inserted_before(s: str) -> str:
    """The number of what is put before this one: 1 to A1, 1A to 1ZA."""
    return "A" + s if re.fullmatch(r"\d+", s) else s[:-1] + "Z" + s[-1:]


def follows(low: str | None, high: str | None) -> bool:
    """Whether a provision numbered high may come directly after one numbered low."""
    if not low or not high:
        return False
    low, high = (x.replace(".", " ").strip() for x in (low, high))
    if not low or not high:
        return False
    if next_number(low) == high or inserted_before(high) == low:
        return True
    if len(high) > len(low):
        return high.startswith(low) and bool(re.fullmatch("Z*A", high[len(low) :]))
    if len(high) < len(low):
        if low[:-1] and next_number(low[:-1]) == high:
            return True
        head = re.sub(r"Z\d+$", "", low)
        if head and next_number(head) == high:
            return True
        return bool(head) and high.startswith(head) and high[len(head) :] in ("A", "1")
    return False


def follows_letters(low: str, high: str) -> bool:
    """The same for letters: A to B, AD to B, D to DA."""
    low, high = low.strip("()"), high.strip("()")
    if not low or not high:
        return False
    if len(low) == len(high):
        return ord(high[-1].upper()) - ord(low[-1].upper()) == 1
    if len(low) == len(high) + 1:
        return follows_letters(low[:-1], high)
    return len(high) == len(low) + 1 and high[-1].upper() == "A"


def follows_column(low: Column, high: Column) -> Column:
    """`follows` over Arrow batches."""

    @F.pandas_udf("boolean")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([follows(x, y) for x, y in zip(a, b)])

    return run(low, high)
