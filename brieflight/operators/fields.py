"""Fields of Word documents: what a field code asks for, as columns.

A code is told by its first word. Rules in order: codes that are left out, codes whose present contents stand, codes that
cannot be handled, and those with a handler; unknown codes keep their contents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sequence as seq

# First words of field codes by what is done with them.
LEFT_OUT = ["PRIVATE"]
CONTENTS = ["=", "ADDIN", "ASK", "FILENAME", "FILLIN", "FORMTEXT", "KEYWORDS", "MACROBUTTON", "MERGEFIELD", "NUMPAGES", "NUMWORDS", "QUOTE", "SEQ", "SUBJECT", "TOC"]
HANDLED = ["AUTONUM", "DATE", "FORMDROPDOWN", "HYPERLINK", "INCLUDEPICTURE", "LISTNUM", "NOTEREF", "PAGE", "REF", "SYMBOL", "TIME"]


def first_word(code: Column) -> Column:
    c = F.trim(code)
    return F.when(c.startswith("="), "=").otherwise(F.upper(F.substring_index(c, " ", 1)))


def action(code: Column) -> Column:
    """skip, contents, unsupported, handle or unknown."""
    word, c = first_word(code), F.trim(code)
    return (
        F.when(word.isin(LEFT_OUT), "skip")
        .when(word.isin(CONTENTS) | c.rlike(r"^ADVANCE \\d4$"), "contents")
        .when(c.rlike(r"^LINK Excel\.Sheet"), "unsupported")
        .when(word.isin(HANDLED), "handle")
        .otherwise("unknown")
    )


def argument(code: Column, switch: str | None = None) -> Column:
    """The first argument of a code, quoted or not, or that of a switch like `l`; null without one."""
    c = F.trim(code)
    if switch is None:
        p = r'^\S+\s+(?:"([^"]*)"|([^\s"\\]\S*))'
    else:
        p = rf'\\{switch}\s+(?:"([^"]*)"|([^\s"\\]\S*))'
    return F.coalesce(F.nullif(F.regexp_extract(c, p, 1), F.lit("")), F.nullif(F.regexp_extract(c, p, 2), F.lit("")))


def link(code: Column) -> Column:
    """Target of a HYPERLINK: address, with the place in it, or a place in the document; of a REF or NOTEREF its bookmark."""
    word, at, place = first_word(code), argument(code), argument(code, "l")
    full = F.when(at.isNotNull() & place.isNotNull(), F.concat(at, F.lit("#"), place)).otherwise(F.coalesce(at, F.concat(F.lit("#"), place)))
    return F.when(word == "HYPERLINK", full).when(word.isin("REF", "NOTEREF"), F.concat(F.lit("#"), at)).when(word == "INCLUDEPICTURE", at)


#: Windows code page 1252 where it differs from Unicode, from 128 on; unused places are themselves.
_ANSI = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def symbol(code: Column) -> Column:
    """The character of a SYMBOL: its number in the Windows code page, or in Unicode where a font is named."""
    n = argument(code).try_cast("int")
    ansi = F.element_at(F.array(*(F.lit(c) for c in _ANSI)), (n - 127).cast("int"))
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
    return F.when(first_word(code) == "SYMBOL", F.when(F.trim(code).rlike(r"\\f") | ~n.between(128, 159), F.when(n.between(1, 65535), plain)).otherwise(ansi))


def numbered(fields: DataFrame) -> DataFrame:
    """n of AUTONUM and LISTNUM fields(doc_id, pos, code): how many of the same code came up to there; a LISTNUM's \\s
    begins anew."""
    rows = fields.withColumn("__word", first_word(F.col("code"))).withColumn("__list", F.coalesce(argument(F.col("code")), F.lit("")))
    start = argument(F.col("code"), "s").try_cast("int")
    by = ["doc_id", "__word", "__list"]
    rows = rows.withColumn("__run", seq.island(start.isNotNull(), by))
    n = F.row_number().over(seq.window([*by, "__run"]))
    first = F.first(start).over(seq.up_to_here([*by, "__run"]))
    return rows.withColumn("n", F.when(F.col("__word").isin("AUTONUM", "LISTNUM"), n - 1 + F.coalesce(first, F.lit(1)))).drop("__word", "__list", "__run")
