"""Word documents: binaryFile rows to blocks, cells, styles, images and properties, with zipfile and ElementTree.

Reading an archive is not a relational operation, so each file is read in one pass inside mapInPandas; what comes out are
plain tables. A file that cannot be read gives one row with an error and no blocks.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/package/2006/relationships}"

INLINE = "struct<kind:string,text:string,style:string,bold:boolean,italic:boolean,underline:string,color:string,size_pt:double,href:string>"
BLOCKS = f"doc_id string, part string, pos int, kind string, style string, align string, left_in double, first_line_in double, list_id int, level int, outline int, number string, text string, line_break_before boolean, merged_with_next boolean, bookmarks array<string>, fields array<string>, inlines array<{INLINE}>, error string"
CELLS = "doc_id string, tbl int, row int, cell int, colspan int, vmerge string, is_header boolean, text string"


def files(spark: SparkSession, path: str, pattern: str = "*.docx") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select(F.col("path").alias("doc_id"), "content")


def _val(el, tag: str, attr: str = "val"):
    x = el.find(W + tag) if el is not None else None
    return None if x is None else x.get(W + attr)


def _on(props, tag: str) -> bool | None:
    x = props.find(W + tag) if props is not None else None
    return None if x is None else x.get(W + "val") not in ("0", "false", "none", "off")


def _inches(v: str | None) -> float | None:
    try:
        return None if v is None else float(v) / 1440
    except ValueError:
        return None


def relationships(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    folder, _, name = part.rpartition("/")
    try:
        root = ET.fromstring(z.read(f"{folder}/_rels/{name}.rels"))
    except KeyError:
        return {}
    return {r.get("Id"): r.get("Target") for r in root.iter(P + "Relationship")}


def styles(z: zipfile.ZipFile) -> dict[str, dict]:
    """Properties of each paragraph style, inherited ones included."""
    try:
        root = ET.fromstring(z.read("word/styles.xml"))
    except KeyError:
        return {}
    own = {}
    for s in root.iter(W + "style"):
        p, r = s.find(W + "pPr"), s.find(W + "rPr")
        ind = p.find(W + "ind") if p is not None else None
        size = _val(r, "sz")
        outline = _val(p, "outlineLvl")
        own[s.get(W + "styleId")] = {
            "based_on": _val(s, "basedOn"), "align": _val(p, "jc"), "left_in": _inches(ind.get(W + "left")) if ind is not None else None,
            "first_line_in": _first(ind), "outline": int(outline) if outline and outline.isdigit() else None, "bold": _on(r, "b"), "size_pt": float(size) / 2 if size and size.isdigit() else None,
            "list_id": _val(p.find(W + "numPr") if p is not None else None, "numId"), "level": _val(p.find(W + "numPr") if p is not None else None, "ilvl"),
        }
    out = {}
    for name in own:
        made, at, seen = {}, name, set()
        while at in own and at not in seen:
            seen.add(at)
            for k, v in own[at].items():
                if made.get(k) is None:
                    made[k] = v
            at = own[at]["based_on"]
        out[name] = made
    return out


def _first(ind) -> float | None:
    if ind is None:
        return None
    hang = _inches(ind.get(W + "hanging"))
    return -hang if hang is not None else _inches(ind.get(W + "firstLine"))


class Numbering:
    """Levels of lists with overrides, and their running numbers."""

    def __init__(self, z: zipfile.ZipFile):
        self.levels: dict[str, dict] = {}
        self.abstract_of: dict[str, str] = {}
        self.starts: dict[tuple, int] = {}
        self.counters: dict[str, dict[int, int]] = {}
        self.used: set = set()
        try:
            root = ET.fromstring(z.read("word/numbering.xml"))
        except KeyError:
            return
        for a in root.iter(W + "abstractNum"):
            self.levels[a.get(W + "abstractNumId")] = {int(x.get(W + "ilvl")): (_val(x, "numFmt") or "decimal", _val(x, "lvlText") or "", int(_val(x, "start") or 1)) for x in a.iter(W + "lvl")}
        for n in root.iter(W + "num"):
            i = n.get(W + "numId")
            self.abstract_of[i] = _val(n, "abstractNumId")
            for o in n.iter(W + "lvlOverride"):
                start = _val(o, "startOverride")
                if start is not None:
                    self.starts[i, int(o.get(W + "ilvl"))] = int(start)

    def next(self, list_id: str, level: int) -> str | None:
        abstract = self.abstract_of.get(list_id)
        levels = self.levels.get(abstract, {})
        if level not in levels:
            return None
        own = self.counters.setdefault(abstract, {})
        if (list_id, level) in self.starts and (list_id, level) not in self.used:
            own[level] = self.starts[list_id, level]
        else:
            own[level] = own.get(level, levels[level][2] - 1) + 1
        self.used.add((list_id, level))
        for deeper in [k for k in own if k > level]:
            del own[deeper]
        return re.sub(r"%(\d)", lambda m: shown(own.get(int(m[1]) - 1, levels.get(int(m[1]) - 1, ("", "", 1))[2]), levels.get(int(m[1]) - 1, ("decimal",))[0]), levels[level][1])


def shown(n: int, kind: str) -> str:
    """A number in a list's format."""
    letters = lambda: chr(97 + (n - 1) % 26) * ((n - 1) // 26 + 1) if n > 0 else ""

    def roman() -> str:
        out, left = "", n
        for v, s in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            out, left = out + s * (left // v), left % v
        return out

    return {"lowerLetter": letters, "upperLetter": lambda: letters().upper(), "lowerRoman": roman, "upperRoman": lambda: roman().upper(), "decimalZero": lambda: f"{n:02d}", "none": str, "bullet": lambda: "•"}.get(kind, lambda: str(n))()


def _runs(p, rels: dict, state: dict):
    """Inlines of a paragraph: text, tabs, breaks, links, images, footnotes; deleted text is left out."""
    out, fields, bookmarks, breaks = [], [], [], False

    def props(r):
        x = r.find(W + "rPr")
        size = _val(x, "sz")
        return {"style": _val(x, "rStyle"), "bold": _on(x, "b"), "italic": _on(x, "i"), "underline": _val(x, "u"), "color": _val(x, "color"), "size_pt": float(size) / 2 if size and size.isdigit() else None}

    def walk(el, href):
        nonlocal breaks
        for c in el:
            tag = c.tag.rpartition("}")[2]
            if tag in ("del", "moveFrom", "pPr", "rPr"):
                continue
            if tag == "bookmarkStart":
                bookmarks.append(c.get(W + "name"))
            elif tag == "hyperlink":
                walk(c, rels.get(c.get(R + "id")) or ("#" + c.get(W + "anchor") if c.get(W + "anchor") else None))
            elif tag == "r":
                own = props(c)
                for x in c:
                    t = x.tag.rpartition("}")[2]
                    put = lambda kind, text: out.append({"kind": kind, "text": text, "href": href, **own})
                    if t == "fldChar":
                        kind = x.get(W + "fldCharType")
                        state["depth"] = state.get("depth", 0) + (1 if kind == "begin" else -1 if kind == "end" else 0)
                        state["code"] = kind == "begin"
                        fields.append({"begin": "{", "separate": "|", "end": "}"}[kind])
                    elif t == "instrText":
                        fields.append((x.text or "").strip())
                    elif t == "t":
                        put("text", x.text or "")
                    elif t == "tab":
                        put("tab", "\t")
                    elif t in ("br", "cr"):
                        if x.get(W + "type") == "page":
                            breaks = True
                        else:
                            put("break", "\n")
                    elif t == "lastRenderedPageBreak":
                        continue
                    elif t in ("noBreakHyphen", "softHyphen"):
                        put("text", "-" if t == "noBreakHyphen" else "")
                    elif t == "sym":
                        put("symbol", chr(int(x.get(W + "char") or "20", 16) & 0xFF) if (x.get(W + "char") or "").upper().startswith("F0") else chr(int(x.get(W + "char") or "20", 16)))
                    elif t in ("footnoteReference", "endnoteReference"):
                        put("footnote", x.get(W + "id"))
                    elif t in ("drawing", "pict", "object"):
                        for b in x.iter(A + "blip"):
                            put("image", rels.get(b.get(R + "embed")))
            elif tag == "fldSimple":
                fields.extend(["{", (c.get(W + "instr") or "").strip(), "|"])
                walk(c, href)
                fields.append("}")
            elif tag in ("ins", "smartTag", "sdt", "sdtContent", "moveTo", "AlternateContent", "Choice"):
                walk(c, href)
            elif tag == "Fallback":
                continue

    walk(p, None)
    return out, fields, bookmarks, breaks


def _text_boxes(p) -> list:
    """Contents of text boxes in a paragraph; the fallback copy of a box is left out."""
    out, todo = [], [p]
    while todo:
        el = todo.pop()
        for c in reversed(list(el)):
            tag = c.tag.rpartition("}")[2]
            if tag == "txbxContent":
                out.append(c)
            elif tag != "Fallback":
                todo.append(c)
    return out


def read(content: bytes, doc_id: str) -> tuple[list[dict], list[dict]]:
    """Blocks and table cells of one file."""
    z = zipfile.ZipFile(io.BytesIO(content))
    rels, known, numbering = relationships(z, "word/document.xml"), styles(z), Numbering(z)
    blocks: list[dict] = []
    cells: list[dict] = []
    state: dict = {}
    n_tables = 0

    def paragraph(p, part, pos, break_):
        pp = p.find(W + "pPr")
        style = _val(pp, "pStyle")
        s = known.get(style, {})
        ind = pp.find(W + "ind") if pp is not None else None
        num = pp.find(W + "numPr") if pp is not None else None
        list_id, level = _val(num, "numId") or s.get("list_id"), _val(num, "ilvl") or s.get("level") or "0"
        inlines, fields, bookmarks, breaks = _runs(p, rels, state)
        left = _inches(ind.get(W + "left") or ind.get(W + "start")) if ind is not None else None
        outline = _val(pp, "outlineLvl")
        mark = pp.find(f"{W}rPr") if pp is not None else None
        return {
            "doc_id": doc_id, "part": part, "pos": pos, "kind": "line", "style": style, "align": _val(pp, "jc") or s.get("align"),
            "left_in": left if left is not None else s.get("left_in"), "first_line_in": _first(ind) if _first(ind) is not None else s.get("first_line_in"),
            "list_id": int(list_id) if list_id and list_id.isdigit() else None, "level": int(level) if level.isdigit() else None, "outline": int(outline) if outline and outline.isdigit() else s.get("outline"),
            "number": numbering.next(list_id, int(level)) if list_id and list_id != "0" and level.isdigit() else None,
            "text": "".join(i["text"] or "" for i in inlines if i["kind"] not in ("image", "footnote")), "line_break_before": break_ or breaks or bool(_on(pp, "pageBreakBefore")),
            "merged_with_next": mark is not None and mark.find(W + "del") is not None, "bookmarks": bookmarks, "fields": fields, "inlines": inlines, "error": None,
        }

    def body(el, part, start):
        nonlocal n_tables
        pos, break_ = start, False
        for c in el:
            tag = c.tag.rpartition("}")[2]
            if tag == "p":
                b = paragraph(c, part, pos, break_)
                break_ = c.find(f"{W}pPr/{W}sectPr") is not None
                blocks.append(b)
                pos += 1
                for box in _text_boxes(c):  # their lines come after the line that holds them
                    for inner in box.findall(W + "p"):
                        blocks.append(paragraph(inner, part, pos, False))
                        pos += 1
            elif tag == "tbl":
                for i, tr in enumerate(c.iter(W + "tr")):
                    for k, tc in enumerate(tr.findall(W + "tc")):
                        tp = tc.find(W + "tcPr")
                        merge = tp.find(W + "vMerge") if tp is not None else None
                        texts = ["".join(x["text"] or "" for x in _runs(p, rels, state)[0] if x["kind"] not in ("image", "footnote")) for p in tc.findall(W + "p")]
                        cells.append({"doc_id": doc_id, "tbl": n_tables, "row": i, "cell": k, "colspan": int(_val(tp, "gridSpan") or 1), "vmerge": None if merge is None else (merge.get(W + "val") or "continue"), "is_header": tr.find(f"{W}trPr/{W}tblHeader") is not None, "text": "\n".join(texts)})
                blocks.append({"doc_id": doc_id, "part": part, "pos": pos, "kind": "table", "level": n_tables, "line_break_before": break_, "merged_with_next": False, "bookmarks": [], "fields": [], "inlines": []})
                n_tables, break_ = n_tables + 1, False
                pos += 1
            elif tag == "sdt":
                inner = c.find(W + "sdtContent")
                if inner is not None:
                    pos = body(inner, part, pos)
        return pos

    for target in rels.values():
        if re.search(r"header\d*\.xml$", target or ""):
            root = ET.fromstring(z.read("word/" + target.removeprefix("/word/")))
            body(root, "cover", 0)
            blocks[:] = [b for b in blocks if (b.get("text") or "").strip()]
            break
    root = ET.fromstring(z.read("word/document.xml"))
    body(root.find(W + "body"), "body", 0)
    return blocks, cells




def _columns(schema: str) -> list[str]:
    return re.findall(r"(?:^|, )(\w+) (?:string|int|double|boolean|array|binary)", schema)


def blocks(docs: DataFrame) -> DataFrame:
    """Rows of BLOCKS."""
    import pandas as pd

    names = _columns(BLOCKS)

    def run(batches):
        for b in batches:
            out = []
            for doc_id, content in zip(b["doc_id"], b["content"]):
                try:
                    out += read(content, doc_id)[0]
                except (zipfile.BadZipFile, KeyError, ET.ParseError, AttributeError) as e:
                    out.append({"doc_id": doc_id, "pos": -1, "kind": "error", "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame([[r.get(n) for n in names] for r in out], columns=names, dtype=object)

    return docs.select("doc_id", "content").mapInPandas(run, BLOCKS)


def cells(docs: DataFrame) -> DataFrame:
    """Rows of CELLS; unreadable files have none."""
    import pandas as pd

    names = _columns(CELLS)

    def run(batches):
        for b in batches:
            out = []
            for doc_id, content in zip(b["doc_id"], b["content"]):
                try:
                    out += read(content, doc_id)[1]
                except (zipfile.BadZipFile, KeyError, ET.ParseError, AttributeError):
                    continue
            yield pd.DataFrame([[r.get(n) for n in names] for r in out], columns=names, dtype=object)

    return docs.select("doc_id", "content").mapInPandas(run, CELLS)


def images(docs: DataFrame) -> DataFrame:
    """doc_id, name, type, content of all images."""
    import pandas as pd

    def run(batches):
        for b in batches:
            out = []
            for doc_id, content in zip(b["doc_id"], b["content"]):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                out += [(doc_id, n.rpartition("/")[2], n.rpartition(".")[2].lower(), z.read(n)) for n in sorted(z.namelist()) if n.startswith("word/media/")]
            yield pd.DataFrame(out, columns=["doc_id", "name", "type", "content"])

    return docs.select("doc_id", "content").mapInPandas(run, "doc_id string, name string, type string, content binary")


def properties(docs: DataFrame) -> DataFrame:
    """doc_id, title, creator, modified from the core properties; modified falls back on the newest entry's time."""
    import pandas as pd

    def run(batches):
        for b in batches:
            out = []
            for doc_id, content in zip(b["doc_id"], b["content"]):
                title = creator = modified = None
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                    if "docProps/core.xml" in z.namelist():
                        found = {x.tag.rpartition("}")[2]: x.text for x in ET.fromstring(z.read("docProps/core.xml"))}
                        title, creator, modified = found.get("title"), found.get("creator"), found.get("modified")
                    modified = modified or "{:04d}-{:02d}-{:02d}T{:02d}:{:02d}:{:02d}Z".format(*max(i.date_time for i in z.infolist()))
                except (zipfile.BadZipFile, ET.ParseError, ValueError):
                    pass
                out.append((doc_id, title, creator, modified))
            yield pd.DataFrame(out, columns=["doc_id", "title", "creator", "modified"], dtype=object)

    return docs.select("doc_id", "content").mapInPandas(run, "doc_id string, title string, creator string, modified string")


def skippable(blocks_: DataFrame) -> DataFrame:
    """Without blocks that hold nothing: blank lines without number or image. Their breaks and bookmarks go to the next
    block that stays."""
    from ..operators import sequence as seq

    shown_ = (F.col("kind") != "line") | F.col("number").isNotNull() | (F.trim(F.coalesce("text", F.lit(""))) != "") | F.exists(F.coalesce("inlines", F.array().cast(f"array<{INLINE}>")), lambda i: i["kind"] == "image")
    by = ["doc_id", "part"]
    rows = blocks_.withColumn("__shown", shown_)
    marks = seq.carry_list_to_next_kept(rows, F.col("__shown"), "bookmarks", by=by).select(*by, "pos", "bookmarks")
    kept = seq.carry_to_next_kept(rows.drop("bookmarks"), F.col("__shown"), F.col("line_break_before"), "line_break_before", by=by)
    return kept.join(marks, [*by, "pos"]).drop("__shown")
