"""Word files, trees, bills, XML, archives and streams, on small documents made here."""

import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from brieflight.functions import numbers, text
from brieflight.operators import courts, enrich, manifest, reconcile, structure, tracking
from brieflight.operators import sequence as seq
from brieflight.plans import akn, bills
from brieflight.sources import docx, files
from brieflight.streaming import tracker

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'


def word_file(body, styles="", numbering="", header=None, core=None, image=None):
    out = io.BytesIO()
    rels = '<Relationship Id="l1" Target="http://x.org/"/><Relationship Id="i1" Target="media/image1.png"/>' + ('<Relationship Id="h1" Target="header1.xml"/>' if header else "")
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        z.writestr("word/styles.xml", f"<w:styles {W}>{styles}</w:styles>")
        z.writestr("word/numbering.xml", f"<w:numbering {W}>{numbering}</w:numbering>")
        if header:
            z.writestr("word/header1.xml", f"<w:hdr {W}>{header}</w:hdr>")
        if core:
            z.writestr("docProps/core.xml", core)
        if image:
            z.writestr("word/media/image1.png", image)
    return out.getvalue()


def p(t, props="", runs=""):
    return f"<w:p><w:pPr>{props}</w:pPr>{runs or f'<w:r><w:t>{t}</w:t></w:r>'}</w:p>"


NUM = '<w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl><w:lvl w:ilvl="1"><w:start w:val="1"/><w:numFmt w:val="lowerRoman"/><w:lvlText w:val="(%1.%2)"/></w:lvl></w:abstractNum><w:num w:numId="5"><w:abstractNumId w:val="0"/></w:num><w:num w:numId="6"><w:abstractNumId w:val="0"/><w:lvlOverride w:ilvl="0"><w:startOverride w:val="9"/></w:lvlOverride></w:num>'
n = lambda i, l: f'<w:numPr><w:ilvl w:val="{l}"/><w:numId w:val="{i}"/></w:numPr>'


@pytest.fixture(scope="module")
def word(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("docx")
    body = (
        p("Title", '<w:pStyle w:val="H2"/>') + p("one", n(5, 0)) + p("sub", n(5, 1)) + p("two", n(5, 0)) + p("restarted", n(6, 0))
        + '<w:p><w:bookmarkStart w:name="b1"/></w:p>'
        + p("", '<w:ind w:left="720" w:hanging="360"/>', '<w:r><w:rPr><w:b/><w:color w:val="FF0000"/></w:rPr><w:t>bold</w:t><w:tab/></w:r><w:del><w:r><w:t>gone</w:t></w:r></w:del><w:hyperlink r:id="l1"><w:r><w:t>link</w:t></w:r></w:hyperlink><w:r><w:drawing><a:blip r:embed="i1"/></w:drawing></w:r>')
        + p("", "", '<w:r><w:br w:type="page"/><w:t>after break</w:t></w:r><w:r><w:fldChar w:fldCharType="begin"/></w:r><w:r><w:instrText>PAGE</w:instrText></w:r><w:r><w:fldChar w:fldCharType="separate"/></w:r><w:r><w:t>7</w:t></w:r><w:r><w:fldChar w:fldCharType="end"/></w:r>')
        + '<w:p><w:r><w:t>box:</w:t></w:r><w:r><w:drawing><w:txbxContent><w:p><w:r><w:t>inside</w:t></w:r></w:p></w:txbxContent></w:drawing></w:r></w:p>'
        + '<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr><w:p><w:r><w:t>wide</w:t></w:r></w:p></w:tc></w:tr><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:tcPr><w:vMerge/></w:tcPr><w:p/></w:tc></w:tr></w:tbl>'
    )
    styles = '<w:style w:styleId="H1"><w:pPr><w:outlineLvl w:val="1"/><w:jc w:val="center"/></w:pPr></w:style><w:style w:styleId="H2"><w:basedOn w:val="H1"/></w:style>'
    core = '<c xmlns:dc="d" xmlns:t="t"><dc:title>T</dc:title><t:modified>2020-01-02T00:00:00Z</t:modified></c>'
    (d / "0b0b0b0b-0000-4000-8000-000000000001 a.docx").write_bytes(word_file(body, styles, NUM, p("Header line"), core, b"png"))
    (d / "bad.docx").write_bytes(b"not a zip")
    return str(d)


def test_word_blocks(spark, word):
    rows = docx.blocks(docx.files(spark, word)).orderBy("part", "pos").collect()
    assert [r.error for r in rows if r.kind == "error"][0].startswith("BadZipFile")
    good = [r for r in rows if r.kind != "error"]
    assert [(r.part, r.text) for r in good if r.part == "cover"] == [("cover", "Header line")]
    body = [r for r in good if r.part == "body"]
    assert [r.text for r in body[:5]] == ["Title", "one", "sub", "two", "restarted"]
    assert [r.number for r in body[:5]] == [None, "1.", "(1.i)", "2.", "9."]
    assert (body[0].outline, body[0].align) == (1, "center")
    assert body[5].bookmarks == ["b1"]
    assert body[6].text == "bold\tlink" and body[6].left_in == 0.5 and body[6].first_line_in == -0.25
    assert [(i.kind, i.bold, i.href) for i in body[6].inlines] == [("text", True, None), ("tab", True, None), ("text", None, "http://x.org/"), ("image", None, None)]
    assert body[7].line_break_before and body[7].fields == ["{", "PAGE", "|", "}"]
    assert [b.text for b in body[8:10]] == ["box:", "inside"]
    assert body[10].kind == "table"


def test_word_parts(spark, word):
    d = docx.files(spark, word)
    cells = docx.cells(d).orderBy("row", "cell").collect()
    assert [(c.row, c.cell, c.colspan, c.vmerge, c.text) for c in cells] == [(0, 0, 2, None, "wide"), (1, 0, 1, None, "a"), (1, 1, 1, "continue", "")]
    assert [(i.name, i.type, bytes(i.content)) for i in docx.images(d).collect()] == [("image1.png", "png", b"png")]
    assert {(x.title, x.modified) for x in docx.properties(d).collect()} == {("T", "2020-01-02T00:00:00Z"), (None, None)}
    kept = docx.skippable(docx.blocks(d).where("error is null")).where("part = 'body'").orderBy("pos").collect()
    assert "b1" in [k for k in kept if k.text == "bold\tlink"][0].bookmarks


def test_files(spark, word, tmp_path):
    rows = files.listing(spark, word)
    assert {r.extension for r in rows.collect()} == {".docx"}
    found = manifest.file_of_uuid(spark.createDataFrame([("0b0b0b0b-0000-4000-8000-000000000001",), ("x",)], "uuid string"), rows).collect()
    assert {(f.n_files, f.file_error is None) for f in found} == {(1, True), (0, False)}
    target = files.by_extension(rows, f"{tmp_path}/out", dry_run=True).collect()
    assert all(t.target.endswith("ext=docx") for t in target)
    files.by_extension(rows, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_bundles(spark):
    rows = spark.createDataFrame([("R", "s.docx", bytearray(b"src"), "<x/>", "{}", [("i.png", bytearray(b"p"))])], "reference string, source_name string, source binary, xml string, metadata string, images array<struct<name:string,content:binary>>")
    a, b = (bytes(files.bundles(rows).first().archive) for _ in range(2))
    assert a == b
    with tarfile.open(fileobj=io.BytesIO(a)) as t:
        assert t.getnames() == ["R/s.docx", "R/R.xml", "R/TRE-R-metadata.json", "R/i.png"]
    with zipfile.ZipFile(io.BytesIO(bytes(files.bundles(rows, "zip").first().archive))) as z:
        assert z.read("R/R.xml") == b"<x/>"


def test_manifest_file(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿ID,Court,file_path,Extension,decision_datetime,claimants,respondent,UUID,Skip\n1,EAT,\"a, b.docx\",.docx,2020-01-02,A,\"B\nC\",0b0b0b0b-0000-4000-8000-000000000001,\n2,,,,,,,,yes\n", encoding="utf-8")
    m = manifest.read(spark, f"{tmp_path}/m.csv")
    v = {r.line_no: r for r in manifest.validate(m).collect()}
    assert v[2].status == "valid" and v[3].status == "skipped" and v[2].csv_name == "m.csv" and len(v[2].csv_hash) == 64
    assert v[2].full_line["file_path"] == "a, b.docx"
    assert manifest.only_id(m, "2").count() == 1 and manifest.only_id(m, None).count() == 2


# trees


def tree(spark, lines):
    rows = [(1, i, t, num, ind) for i, (t, num, ind) in enumerate(lines)]
    d = structure.build(spark.createDataFrame(rows, "doc_id int, pos int, text string, number string, indent double"))
    return [(r.node_id, r.parent_id, r.name, r.number) for r in d.orderBy("node_id").collect()]


def test_big_levels_need_two(spark):
    assert [x[2] for x in tree(spark, [("Head", "A.", 0.0), ("p", "1.", 0.0), ("Head", "B.", 0.0), ("q", "2.", 0.0)])] == ["level", "paragraph", "level", "paragraph"]
    assert [x[2] for x in tree(spark, [("Head", "A.", 0.0), ("p", "1.", 0.0)])] == ["paragraph", "paragraph"]


def test_deep_indents_do_no_harm(spark):
    got = tree(spark, [("x", None, i * 0.5) for i in range(1500)])
    assert len(got) == 1500 and got[-1][1] == 1498


def test_every_line_is_used(spark):
    rows = spark.createDataFrame([(d, i, f"line {i}.", None if i % 3 else f"{i + 1}.", float(i % 4) / 2) for d in (1, 2) for i in range(30)], "doc_id int, pos int, text string, number string, indent double")
    assert all(r.ok for r in structure.consumed_all(rows, structure.build(rows)).collect())


def test_statistics(spark):
    d = structure.build(spark.createDataFrame([(1, 0, "a", "1.", 0.0), (1, 1, "Annex", None, 0.0), (1, 2, "b.", None, 0.0)], "doc_id int, pos int, text string, number string, indent double"))
    s = structure.statistics(d).first()
    assert (s.body_paragraphs, s.annex_paragraphs, s.total_paragraphs, s.images) == (1, 1, 2, 0)


def test_bill_numbering_and_ids(spark):
    lines = [("1", "Title"), ("(1)", "x"), ("(a)", "y"), ("(i)", "z"), ("(ii)", "w"), ("(b)", "v"), (None, "wrap"), ("(2)", "u"), ("1A", "next"), (None, "SCHEDULES"), (None, "SCHEDULE 1"), ("1", "p")]
    d = bills.parse(spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate(lines)], "doc_id int, pos int, number string, text string"))
    got = {(r.number, r.name): r for r in bills.provision_ids(d).collect()}
    assert got[("(ii)", "para2")].eid == "sec_1__subsec_1__para1_a__para2_ii"
    assert got[("1", "schProv1")].eid.endswith("sched_1__para_1")
    assert ("1A", "section") in got


def test_akn_round_trip(spark):
    d = structure.build(spark.createDataFrame([(1, 0, "a < b", "1.", 0.0), (1, 1, "sub", "(a)", 0.5)], "doc_id int, pos int, text string, number string, indent double"))
    meta = spark.createDataFrame([("1", "eat/2020/1", "2020-01-02", "decision", "EAT", "[2020] EAT 1", 2020, 1, "A & B")], "doc_id string, uri string, date string, date_name string, court string, cite string, year int, number int, name string")
    x = akn.build(d, meta)
    from xml.etree import ElementTree

    root = ElementTree.fromstring(x.first().xml)
    assert [e.text for e in root.iter("{%s}p" % akn.NS)] == ["a < b", "sub"]
    m = akn.extract_metadata(x).first()
    assert (m.uri, m.date, m.court, m.cite, m.year, m.number, m.name) == ("eat/2020/1", "2020-01-02", "EAT", "[2020] EAT 1", 2020, 1, "A & B")
    assert akn.check(x).first().errors == []
    assert json.loads(meta.select(akn.metadata_json(["date_name", "court"]).alias("j")).first().j) == {"dateName": "decision", "court": "EAT"}
    assert akn.style_elements("x", True, False, "single") == "<b><u>x</u></b>"


def test_golden_metadata(spark, tmp_path):
    """What reads our XML also reads namespaced XML with prefixes."""
    xml = f'<akn:akomaNtoso xmlns:akn="{akn.NS}" xmlns:uk="u"><akn:judgment><akn:meta><akn:proprietary><uk:court>UKSC</uk:court></akn:proprietary></akn:meta></akn:judgment></akn:akomaNtoso>'
    assert akn.extract_metadata(spark.createDataFrame([(xml,)], "xml string")).first().court == "UKSC"


# columns


def test_reconcile_twice_is_reconcile_once(spark):
    docs = spark.createDataFrame([(1, "EAT", 2020, None, None, "2020-01-01", "n"), (2, None, None, None, None, None, None)], "doc_id int, court string, year int, cite string, uri string, date string, name string")
    ext = spark.createDataFrame([(1, None, 2021, "[2021] EAT 1", "u", None, None), (2, "UKSC", None, None, None, None, "m")], "doc_id int, court string, year int, cite string, uri string, date string, name string")
    for first in (True, False):
        once = reconcile.reconcile(docs, ext, external_first=first)
        assert sorted(map(tuple, reconcile.reconcile(once, ext, external_first=first).collect())) == sorted(map(tuple, once.collect()))


def test_small_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("v")).first().v
    assert get(text.css_text(text.css_map(F.lit("b: 1; a:x:y")))) == "a:x:y;b:1"
    assert get(text.content_hash_nfc(F.lit("é x"))) == get(text.content_hash(F.lit("éx")))
    assert get(text.xml_text(F.lit("<a><meta>no</meta><p>x &amp; y</p></a>"))) == "x & y"
    assert get(text.add_anchors(F.lit("a$"))) == "^a$"
    assert get(text.first_match(F.lit("b1"), [r"a(\d)", r"b(\d)"], 1)) == "1"
    assert get(numbers.format_number(F.lit(28), F.lit("lowerLetter"), F.lit("(%1)"))) == "(bb)"
    assert get(numbers.format_number(F.lit(4), F.lit("upperRoman"), F.lit("%1."))) == "IV."
    assert get(courts.code_of_citation(F.lit("[2020] EWHC 1 (QB)"))) == "EWHC-KBD"
    assert get(enrich.case_numbers(F.lit("Case No: HQ16X01238 and HQ16X01239"))) == ["HQ16X01238", "HQ16X01239"]
    assert get(enrich.quotes(F.lit("“a” “b"))).opens == 2
    assert get(enrich.defined_terms(F.lit("“Act” means x; “other” y"))) == ["Act"]
    assert get(reconcile.uris(F.lit("eat/2020/1")))["manifestation"].endswith("/eat/2020/1/data.xml")
    with pytest.raises(Exception, match="Unexpected extension"):
        get(text.mime_type_strict(F.lit(".xyz")))


def test_court_table_and_join(spark):
    courts.parse_patterns()
    c = courts.from_json(spark.createDataFrame([('[{"name":"t","courts":[{"code":"EAT","name":"E"},{"code":"own-x","name":"n"}]}]',)], "value string"), internal="OWN-")
    assert [r.code for r in c.collect()] == ["EAT"]
    rows = spark.createDataFrame([(1, "[2020] EWHC 7 (QB)"), (2, "none")], "id int, citation string")
    assert {(r.id, r.court_code) for r in courts.by_citation(rows, courts.table(spark), ["id"]).collect()} == {(1, "EWHC-KBD"), (2, None)}


def test_merge_runs_with_barriers(spark):
    rows = spark.createDataFrame([(1, 0, "a", True, "text"), (1, 1, "b", True, "text"), (1, 2, "L", True, "link"), (1, 3, "c", True, "text"), (1, 4, "d", None, "text")], "doc_id int, pos int, text string, bold boolean, kind string")
    got = seq.merge_runs(rows, ["bold"], barrier=F.col("kind") == "link").orderBy("pos").collect()
    assert [(r.pos, r.text) for r in got] == [(0, "ab"), (2, "L"), (3, "c"), (4, "d")]


def test_header_split(spark):
    lines = [(1, i, t) for i, t in enumerate(["Court", "Judgment", "Lord A", "Lord Justice Smith: I agree", "text"])] + [(2, 0, "x"), (2, 1, "Introduction"), (3, 0, "only")]
    b = spark.createDataFrame(lines, "doc_id int, pos int, text string")
    t = F.col("text")
    got = seq.header_split(b, title=t == "Judgment", ends=enrich.begins_speech(t), second=t == "Introduction", third=t.startswith("©"), numbered=t.rlike(r"^\d+\."))
    assert [(r.doc_id, r.pos) for r in got.where("part = 'header'").orderBy("doc_id", "pos").collect()] == [(1, 0), (1, 1), (1, 2), (2, 0)]


def test_tribunal_split_and_stages(spark):
    lines = [(1, 0, "Court"), (1, 1, "DECISION"), (1, 2, "x"), (2, 0, "a"), (2, 1, "Introduction"), (3, 0, "© Crown"), (3, 1, "z")]
    b, t = spark.createDataFrame(lines, "doc_id int, pos int, text string"), F.col("text")
    got = seq.tribunal_split(b, title=t == "DECISION", table_title=F.lit(False), introduction=t == "Introduction", copyright=t.startswith("©"))
    assert [(r.doc_id, r.pos) for r in got.where("part = 'header'").orderBy("doc_id", "pos").collect()] == [(1, 0), (1, 1), (2, 0)]
    ps = spark.createDataFrame([(1, i, x) for i, x in enumerate(["2 May 2020", "PRESS SUMMARY", "A v B [2020] UKSC 1", "JUSTICES: Lord A", "BACKGROUND TO THE APPEAL", "text"])] + [(2, 0, "nothing")], "doc_id int, pos int, text string")
    assert [r.stage for r in enrich.press_summary_header(ps).orderBy("doc_id", "pos").collect()] == ["date", "type", "cite", "justices", "body", "body", None]


def test_bill_header_and_lists(spark):
    lines = [(None, "Thing Bill"), (None, "A Bill to do"), (None, "things."), (None, "Be it enacted by"), ("1", "Section"), (None, "after")]
    b = spark.createDataFrame([(1, i, n, t, 0.0) for i, (n, t) in enumerate(lines)], "doc_id int, pos int, number string, text string, left_in double")
    assert [r.part for r in bills.header(b).orderBy("pos").collect()] == ["cover", "longTitle", "longTitle", "enacting", "body", "body"]
    l = spark.createDataFrame([(1, 0, None, "x", 0.0), (1, 1, "(a)", "y", 0.5), (1, 2, None, "more", 0.5), (1, 3, None, "• z", 0.0), (1, 4, None, "end", 0.0)], "doc_id int, pos int, number string, text string, left_in double")
    assert [(r.list, r.item) for r in bills.block_lists(l).orderBy("pos").collect()] == [(None, None), (1, 1), (1, 1), (1, 2), (None, None)]


def test_assessment_passes(spark):
    d = spark.createDataFrame([("1", 0, None, 0, 0, "section", "1", None, ""), ("1", 1, 0, 0, 1, "paragraphs", None, None, ""), ("1", 2, 1, 0, 2, "paragraph", None, None, "x"), ("1", 3, 1, 5, 2, "paragraph", None, None, " ")], structure.DIVISIONS)
    from brieflight.operators import legislation

    out = legislation.renumber(legislation.promote_only_children(legislation.drop_empty(d))).orderBy("node_id").collect()
    assert [(r.node_id, r.parent_id, r.depth) for r in out] == [(0, None, 0), (2, 0, 1)]
    head = spark.createDataFrame([(1, 0, "Title: The"), (1, 1, "plan"), (1, 2, "Stage: Final"), (1, 3, "y" * 200)], "doc_id int, pos int, text string")
    assert {(r.label, r.value) for r in legislation.header_values(head).collect()} == {("title", "The plan"), ("stage", "Final")}


def test_plan_has_one_exchange(spark):
    b = spark.range(100).repartition(3).select(F.col("id").alias("doc_id"), F.col("id").alias("pos"), F.lit("x").alias("text"))
    d = seq.cut_before_first(b.withColumn("g", seq.island(F.col("text") == "x")), F.col("text") == "x")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_stream_keeps_the_latest_state(spark, tmp_path):
    events = tmp_path / "in"
    events.mkdir()
    line = lambda s, t: json.dumps({"source_uuid": "u", "parser_run_id": "r", "status": s, "last_updated": t})
    (events / "a.json").write_text(line("Started", "2024-01-01T00:00:00Z"))
    tracker.keep_latest(tracker.read(spark, str(events)), f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    (events / "b.json").write_text(line("Parsed", "2024-01-01T01:00:00Z"))
    tracker.keep_latest(tracker.read(spark, str(events)), f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert [r.status for r in spark.read.parquet(f"{tmp_path}/t/batch=1").collect()] == ["Parsed"]
    counts = tracker.counts_by_hour(tracker.read(spark, str(events)))
    assert counts.isStreaming
    assert tracking.latest(spark.read.schema(tracker.EVENTS).json(str(events))).first().status == "Parsed"


def test_divisions_of_conversations_hold_whole_texts(spark, tmp_path):
    from brieflight.plans.queries import QUERIES

    rows = [(1, 0, "user", "first words"), (1, 1, "assistant", "An answer."), (1, 2, "assistant", "Annex"), (1, 3, "assistant", "annex text."), (2, 0, "user", "other " * 2000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["t1_conversation_divisions"](spark, str(tmp_path)).collect()
    assert [(x.doc_id, x.name, x.number, x.heading, x.text) for x in sorted(got, key=lambda x: (x.doc_id, x.node_id))] == [
        ("1", "paragraph", "1.", None, "first words"), ("1", "paragraph", None, None, "An answer."), ("1", "annex", "Annex", None, ""), ("1", "paragraph", None, None, "annex text."), ("2", "paragraph", "1.", None, "other " * 2000),
    ]
    assert {x.doc_id: x.n for x in QUERIES["t1_documents_to_divisions"](spark, str(tmp_path)).collect()} == {1: 4, 2: 1}


def test_nothing_is_cut_at_a_length_or_depth(spark):
    """2 million characters, chains of 40 styles, 12 levels."""
    long = "x" * 2_000_000
    rest = seq.hard_number(spark.createDataFrame([(f"1. {long}",)], "text string")).first().rest
    assert rest == long
    chain = spark.createDataFrame([(f"s{i}", f"s{i + 1}" if i < 39 else None, "v" if i == 39 else None) for i in range(40)] + [("a", "b", None), ("b", "a", None)], "style string, based_on string, prop string")
    got = {r.style: r.prop for r in structure.inherited(chain, "prop").collect()}
    assert all(got[f"s{i}"] == "v" for i in range(40)) and got["a"] is None
    deep = spark.createDataFrame([(1, i, i + 1) for i in range(12)], "doc_id int, pos int, depth int")
    assert seq.level_path(deep).orderBy("pos").collect()[-1].path == "_".join(["1"] * 12)


def test_uuids_are_compared_in_one_form(spark):
    states = spark.createDataFrame([("aaaa-1", "r0", "SentToIngester"), ("{BBBB-2}", "r0", "SentToIngester")], "source_uuid string, parser_run_id string, status string")
    rows = spark.createDataFrame([("{AAAA-1}", "valid"), ("bbbb-2", "valid"), ("cccc-3", "valid")], "uuid string, status string")
    assert [r.uuid for r in tracking.not_yet_sent(rows, states, "r1").collect()] == ["cccc-3"]
    assert tracking.totals(rows, states, "r1").first().n_already_done == 2


def test_latest_does_not_depend_on_the_order_of_rows(spark):
    rows = [("u", "r", "Parsed", 1, "a", 5), ("u", "r", "Parsed", 1, "b", None)]
    for some in (rows, rows[::-1]):
        got = tracking.latest(spark.createDataFrame(some, "source_uuid string, parser_run_id string, status string, last_updated long, x string, y long")).first()
        assert (got.x, got.y) == ("b", 5)
