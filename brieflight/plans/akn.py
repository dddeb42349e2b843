"""XML: divisions and metadata to one document per row, stub documents, and metadata read back from XML."""

from __future__ import annotations

import re
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DOMAIN

NS = "http://docs.oasis-open.org/legaldocml/ns/akn/3.0"
UK = "urn:brieflight:metadata"
#: Elements inside which no white space is added.
BLOCK = {"p", "num", "heading", "block", "docTitle", "td", "th"}


def xml_escape(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def meta_xml(prefix: str = "") -> Column:
    """The meta element from columns uri, date, date_name, court, cite, year, number, name; parts that are null are left out."""
    col = lambda n: F.col(prefix + n)
    part = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"<uk:{name}>"), xml_escape(c.cast("string")), F.lit(f"</uk:{name}>"))).otherwise("")
    attr = lambda name, c: F.concat(F.lit(f' {name}="'), xml_escape(c), F.lit('"'))
    work = F.concat(F.lit("<FRBRWork><FRBRthis"), attr("value", F.concat(F.lit(DOMAIN + "id/"), F.coalesce(col("uri"), F.lit("")))), F.lit("/><FRBRdate"), attr("date", F.coalesce(col("date").cast("string"), F.lit("1000-01-01"))), attr("name", F.coalesce(col("date_name"), F.lit("dummy"))), F.lit("/>"), F.when(col("name").isNotNull(), F.concat(F.lit("<FRBRname"), attr("value", col("name")), F.lit("/>"))).otherwise(""), F.lit("</FRBRWork>"))
    own = F.concat(F.lit("<proprietary>"), part("court", col("court")), part("year", col("year")), part("number", col("number")), part("cite", col("cite")), F.lit("</proprietary>"))
    return F.concat(F.lit("<meta><identification>"), work, F.lit("</identification>"), own, F.lit("</meta>"))


def stub(meta: DataFrame) -> DataFrame:
    """doc_id, xml: a document of which only metadata is known; its header and body are empty."""
    open_ = F.lit(f'<akomaNtoso xmlns="{NS}" xmlns:uk="{UK}"><judgment name="decision">')
    return meta.select("doc_id", F.concat(open_, meta_xml(), F.lit("<header/><judgmentBody><decision><p/></decision></judgmentBody></judgment></akomaNtoso>")).alias("xml"))


def html_table(rows: list[list[tuple[str, int, int]]]) -> str:
    """Rows of (text, colspan, rowspan)."""
    span = lambda n, v: f' {n}="{v}"' if v > 1 else ""
    return "<table>" + "".join("<tr>" + "".join(f"<td{span('colspan', c)}{span('rowspan', r)}><p>{escape(t)}</p></td>" for t, c, r in row) + "</tr>" for row in rows) + "</table>"


def style_elements(text: str, bold: bool | None, italic: bool | None, underline: str | None, css: str | None = None) -> str:
    """Text in b, i and u for what a style says, other properties in a span."""
    out = escape(text)
    if css:
        out = f"<span style={quoteattr(css)}>{out}</span>"
    for on, tag in ((underline not in (None, "none"), "u"), (italic, "i"), (bold, "b")):
        if on:
            out = f"<{tag}>{out}</{tag}>"
    return out


def serialize(rows: list[tuple]) -> str:
    """Divisions (node_id, parent_id, name, number, heading, text) of a body in document order to indented XML."""
    out, open_ = [], []
    ids: dict[str, int] = {}
    for node, parent, name, number, heading, text in rows:
        while open_ and open_[-1][0] != parent:
            out.append("  " * (len(open_) + 1) + f"</{open_.pop()[1]}>")
        tag = "embeddedStructure" if name == "quotedStructure" else {"crossHeading": "hcontainer", "paragraphs": "hcontainer", "annex": "attachment"}.get(name, name)
        clean = (number or "").strip("().[] ")
        ids[clean] = ids.get(clean, 0) + 1
        eid = f"para_{clean}" if clean.isdigit() and ids[clean] == 1 else f"lvl_{node + 1}"
        pad = "  " * (len(open_) + 2)
        out.append(pad + f"<{tag} eId={quoteattr(eid)}>")
        open_.append((node, tag))
        if number:
            out.append(pad + f"  <num>{escape(number)}</num>")
        if heading:
            out.append(pad + f"  <heading>{escape(heading)}</heading>")
        if text:
            out.append(pad + "  <content>" + "".join(f"<p>{escape(x)}</p>" for x in text.split("\n")) + "</content>")
    while open_:
        out.append("  " * (len(open_) + 1) + f"</{open_.pop()[1]}>")
    return "\n".join(out)


def build(divisions: DataFrame, meta: DataFrame) -> DataFrame:
    """doc_id, xml from divisions and meta(doc_id, uri, date, date_name, court, cite, year, number, name)."""
    import pandas as pd

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("node_id")
        own = lambda x: None if pd.isna(x) else x
        body = serialize([(int(n), own(a), b, own(c), own(d), own(e)) for n, a, b, c, d, e in zip(p["node_id"], p["parent_id"], p["name"], p["number"], p["heading"], p["text"])])
        return pd.DataFrame({"doc_id": [p["doc_id"].iloc[0]], "body": [body]})

    bodies = divisions.groupBy("doc_id").applyInPandas(run, "doc_id string, body string")
    m = meta.withColumn("doc_id", F.col("doc_id").cast("string"))
    open_ = F.lit(f'<akomaNtoso xmlns="{NS}" xmlns:uk="{UK}">\n<judgment name="judgment">\n')
    return m.join(bodies, "doc_id").select("doc_id", F.concat(open_, meta_xml(), F.lit("\n<judgmentBody>\n"), "body", F.lit("\n</judgmentBody>\n</judgment>\n</akomaNtoso>")).alias("xml"))


def extract_metadata(df: DataFrame, column: str = "xml") -> DataFrame:
    """uri, date, court, cite, year, number, name read from XML; the date that stands for none is null. Prefixes are taken
    off first, as XPath in SQL knows no namespaces."""
    plain = F.regexp_replace(F.regexp_replace(F.col(column), r"(</?)\w+:", "$1"), r'\sxmlns(?::\w+)?="[^"]*"', "")
    get = lambda p: F.nullif(F.xpath_string(plain, F.lit(p)), F.lit(""))
    own = "/akomaNtoso/*/meta/proprietary/"
    uri = F.regexp_replace(get("/akomaNtoso/*/meta/identification/FRBRWork/FRBRthis/@value"), "^" + re.escape(DOMAIN) + "(?:id/)?", "")
    keep = [c for c in df.columns if c != column]
    uri = F.nullif(uri, F.lit(""))
    return df.select(*keep, uri.alias("uri"), F.nullif(get("/akomaNtoso/*/meta/identification/FRBRWork/FRBRdate/@date"), F.lit("1000-01-01")).alias("date"), get(own + "court").alias("court"), get(own + "cite").alias("cite"), get(own + "year").try_cast("int").alias("year"), get(own + "number").try_cast("int").alias("number"), get("/akomaNtoso/*/meta/identification/FRBRWork/FRBRname/@value").alias("name"))


#: Checks of a document as rules: name and XPath that must give a node.
RULES = [("has meta", "/akomaNtoso/*/meta"), ("has work", "/akomaNtoso/*/meta/identification/FRBRWork/FRBRthis"), ("has date", "/akomaNtoso/*/meta/identification/FRBRWork/FRBRdate/@date"), ("has body", "/akomaNtoso/*/judgmentBody|/akomaNtoso/*/mainBody|/akomaNtoso/*/body")]


def check(df: DataFrame, column: str = "xml") -> DataFrame:
    """errors: names of the rules that a document breaks, and `ids are unique`."""
    plain = F.regexp_replace(F.regexp_replace(F.col(column), r"(</?)\w+:", "$1"), r'\sxmlns(?::\w+)?="[^"]*"', "")
    ids = F.regexp_extract_all(plain, F.lit(r'\beId="([^"]*)"'), 1)
    broken = [F.when(~F.xpath_boolean(plain, F.lit(p)), n) for n, p in RULES] + [F.when(F.size(ids) > F.size(F.array_distinct(ids)), "ids are unique")]
    return df.withColumn("errors", F.array_compact(F.array(*broken)))


def metadata_json(columns: list[str]) -> Column:
    """camelCase JSON of columns."""
    camel = lambda s: s.split("_")[0] + "".join(x.title() for x in s.split("_")[1:])
    return F.to_json(F.struct(*(F.col(c).alias(camel(c)) for c in columns)))
