"""Text functions as Column -> Column. All run on the JVM; a null gives a null unless a docstring says otherwise."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, the no-break space included.
SPACE = r"(?U)\s+"

# Media types by extension.
MIME = {
    ".doc": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".pdf": "application/pdf",
}
# Skip flags that mean no.
NOT_SKIPPED = ["", "n", "no", "f", "false", "0"]
#: Where documents are published: a setting of whoever runs the engine, passed as `domain` where another one holds.
DOMAIN = "https://caselaw.example.org/"


def clean_whitespace(c: Column) -> Column:
    """Single spaces for any white space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def first_match(c: Column, patterns: list[str], group: int = 0) -> Column:
    """The group of the first pattern in order that matches, else null. An empty group counts as no match."""
    return F.coalesce(*(F.nullif(F.regexp_extract(c, p, group), F.lit("")) for p in patterns))


def add_anchors(pattern: Column) -> Column:
    """The pattern with ^ and $ where it lacks them."""
    head = F.when(pattern.startswith("^"), pattern).otherwise(F.concat(F.lit("^"), pattern))
    return F.when(head.endswith("$"), head).otherwise(F.concat(head, F.lit("$")))


def strip_citation_zeros(c: Column) -> Column:
    return F.regexp_replace(c, " 0+", " ")


def file_name(path: Column) -> Column:
    """The last part of a path with / or, if it has none, with backslashes."""
    return F.when(path.contains("/"), F.substring_index(path, "/", -1)).otherwise(F.substring_index(path, "\\", -1))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def mime_type(extension: Column) -> Column:
    """The media type, null for an unknown extension; `mime_type_strict` fails the query instead."""
    out = F.lit(None).cast("string")
    for k, v in MIME.items():
        out = F.when(extension == k, v).otherwise(out)
    return out


def mime_type_strict(extension: Column) -> Column:
    return F.coalesce(mime_type(extension), F.raise_error(F.concat(F.lit("Unexpected extension "), extension)))


def party_id(name: Column) -> Column:
    """White space to hyphens, some punctuation dropped, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"(?U)\s", "-"), r"[.()“”‘’,]+", ""))


def camel_to(name: Column, separator: str) -> Column:
    """InterestedParty to Interested<separator>Party."""
    return F.regexp_replace(name, r"(?<=.)([A-Z])", separator + "$1")


def role_id(role: Column) -> Column:
    return F.lower(camel_to(role, "-"))


def role_label(role: Column) -> Column:
    return camel_to(role, " ")


def short_uri(uri: Column, domain: str = DOMAIN) -> Column:
    """The path of a document address, without id/ and data suffixes; null if nothing is left."""
    u = F.when(uri.startswith(domain), F.substring(uri, F.lit(len(domain) + 1), F.length(uri))).otherwise(uri)
    u = F.regexp_replace(u, r"^id/", "")
    u = F.regexp_replace(u, r"/data\.xml$", "")
    u = F.regexp_replace(u, r"/data\.akn$", "")
    return F.when(clean_whitespace(u) != "", u)


def delimited(c: Column) -> Column:
    """Parts between , or ;, trimmed, without blanks. A null gives an empty array."""
    return F.coalesce(F.filter(F.transform(F.split(c, "[,;]"), clean_whitespace_ends), lambda x: x != ""), F.array().cast("array<string>"))


def clean_whitespace_ends(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_skipped(flag: Column) -> Column:
    """True unless the flag is missing or says no; never null."""
    return ~F.lower(clean_whitespace_ends(F.coalesce(flag, F.lit("")))).isin(NOT_SKIPPED)


def is_blank(c: Column) -> Column:
    """True for null, empty and white space."""
    return F.coalesce(clean_whitespace_ends(c) == "", F.lit(True))


def title_case(c: Column) -> Column:
    return F.initcap(c)


def tab_part(c: Column, n: int) -> Column:
    """The n-th part between tabs, from 1; empty beyond the end."""
    return F.split_part(c, F.lit("\t"), F.lit(n))


def content_hash(c: Column) -> Column:
    """SHA-256 of the text without white space. Texts that may not be in NFC go through `content_hash_nfc`."""
    return F.sha2(F.regexp_replace(c, r"(?U)\s+", ""), 256)


def content_hash_nfc(c: Column) -> Column:
    """As `content_hash`, of the NFC form; Spark has no normalisation of its own, so this one is a pandas UDF."""

    @F.pandas_udf("string")
    def nfc(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFC")

    return content_hash(nfc(c))


def xml_text(xml: Column) -> Column:
    """Text of an XML string without its meta element, tags dropped and the five entities resolved."""
    body = F.regexp_replace(xml, r"(?s)<(?:\w+:)?meta\b.*?</(?:\w+:)?meta>", "")
    out = F.regexp_replace(F.regexp_replace(body, r"(?s)<[!?].*?>", ""), r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def css_map(style: Column) -> Column:
    """`a: b; c: d` to a map."""
    parts = F.filter(F.split(style, ";"), lambda x: x.contains(":"))
    return F.map_from_entries(F.transform(parts, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value"))))


def css_text(props: Column) -> Column:
    """A map to `a:b;c:d`, keys in order."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(props)), lambda k: F.concat(k, F.lit(":"), F.element_at(props, k))), ";")


def image_name(index: Column, extension: Column) -> Column:
    return F.format_string("image%d%s", index, extension)


def twips_to_inches(c: Column) -> Column:
    return F.try_divide(c.cast("double"), F.lit(1440.0))
