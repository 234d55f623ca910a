"""Sources from literal texts and from files made here."""

import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assaylake.sources import discovery, markers, ooxml, tables
from assaylake.streaming import leases

PAPER = """TITLE|A title
DOI|10.1234/abc
YEAR|2021
MATERIAL|FA-01|material_type=fly ash|specific_surface=3500|specific_surface_unit=cm2/g|D50_um=12.5
MATERIAL|SL-01|material_type=slag|specific_surface=420|specific_surface_unit=m2/kg
XRF|FA-01|SiO2=55.1|Al2O3=22
MIX|MIX-A|specimen_type=mortar|mat_refs=FA-01,SL-01|masses_g=FA-01:300,SL-01:100
CURING|MIX-A|method=steam|temperature_C=60|humidity_percent=95|duration_d=1
PERFORMANCE|MIX-A|name=compressive_strength|value=41.2|unit=MPa|age_d=28|specimen=cube
AMBIGUITY|MIX-A|field=performance.flow|reason=two values
some other line"""


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_markers(spark):
    marked = markers.lines(spark.createDataFrame([("p", PAPER)], "paper string, text string"))
    assert rows_of(markers.papers(marked)) == [{"paper": "p", "title": "A title", "doi": "10.1234/abc", "year": 2021}]
    assert [(r["mat_key"], r["specific_surface_m2_kg"]) for r in rows_of(markers.materials(marked).orderBy("mat_key"))] == [("mat-FA-01", 350.0), ("mat-SL-01", 420.0)]
    assert {r["component"]: r["value"] for r in rows_of(markers.oxides(marked))} == {"SiO2": 55.1, "Al2O3": 22.0}
    (mix,) = rows_of(markers.mixes(marked))
    assert mix["mat_keys"] == ["mat-FA-01", "mat-SL-01"] and mix["masses_g"] == {"FA-01": 300.0, "SL-01": 100.0}
    assert rows_of(markers.curing(marked))[0]["duration_seconds"] == 86400.0 and rows_of(markers.performance(marked))[0]["age_seconds"] == 28 * 86400.0
    assert rows_of(markers.ambiguities(marked))[0]["reason"] == "two values"


def test_discovery(spark):
    page = '{"message": {"items": [{"DOI": "10.1234/X", "title": ["T"], "author": [{"given": "A", "family": "B"}], "issued": {"date-parts": [[2020, 5]]}, "link": [{"URL": "u.pdf", "content-type": "application/pdf"}], "license": [{"URL": "https://creativecommons.org/licenses/by/4.0/", "content-version": "vor", "start": {"date-parts": [[2020]]}}]}, {"DOI": "10.1234/Y", "link": [{"URL": "v.pdf", "content-type": "application/pdf"}], "license": [{"URL": "https://creativecommons.org/licenses/by/4.0/", "content-version": "vor", "start": {"date-parts": [[2999]]}}]}]}}'
    pages = spark.createDataFrame([(page,), ("nonsense",)], "payload string")
    good, bad = discovery.split_envelopes(pages, "payload", discovery.CROSSREF, "message.items")
    found = rows_of(discovery.crossref(good, F.lit("2024-01-01").cast("date")).drop("payload").orderBy("doi"))
    assert [(r["doi"], r["year"], r["fulltext_url"], r["access_status"]) for r in found] == [("10.1234/x", 2020, "u.pdf", "OPEN_FULLTEXT_CANDIDATE"), ("10.1234/y", None, None, "UNRESOLVED")]
    assert found[0]["authors"] == ["A B"] and bad.count() == 1
    alex = '{"meta": {"count": 1}, "results": [{"id": "W1", "doi": "https://doi.org/10.1234/z", "title": "T", "publication_year": 2019, "authorships": [{"author": {"display_name": "N"}}], "locations": [{"is_oa": false, "pdf_url": "a"}, {"is_oa": true, "pdf_url": "b"}]}]}'
    good, _ = discovery.split_envelopes(spark.createDataFrame([(alex,)], "payload string"), "payload", discovery.OPENALEX, "results")
    assert [(r["doi"], r["fulltext_url"]) for r in rows_of(discovery.openalex(good))] == [("10.1234/z", "b")]
    ids = spark.createDataFrame([("10.1/a", None, None, "t", ["b", "a"], None), (None, None, None, "t", ["b", "a"], None), (None, None, None, "", None, None)], "d string, p string, s string, t string, a array<string>, o string")
    assert [r[0] for r in ids.select(discovery.identity(*[F.col(c) for c in "dpstao"])).collect()] == ["doi:10.1/a", "title:t|a|b", None]


def word_file(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{ooxml.WORD[1:-1]}"><w:body>{body}</w:body></w:document>')
    return bytearray(out.getvalue())


def cell(text, props=""):
    return f"<w:tc><w:tcPr>{props}</w:tcPr><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:tc>"


def test_docx(spark):
    good = f'<w:p><w:r><w:t>Intro</w:t></w:r></w:p><w:tbl><w:tblGrid><w:gridCol/><w:gridCol/></w:tblGrid><w:tr>{cell("H", chr(60) + "w:gridSpan w:val=" + chr(34) + "2" + chr(34) + "/>")}</w:tr><w:tr>{cell("a", "<w:vMerge w:val=" + chr(34) + "restart" + chr(34) + "/>")}{cell("1")}</w:tr><w:tr>{cell("", "<w:vMerge/>")}{cell("2")}</w:tr><w:tr>{cell("x")}</w:tr></w:tbl>'
    bad = f'<w:tbl><w:tr>{cell("a")}</w:tr><w:tr>{cell("b", "<w:vMerge/>")}</w:tr></w:tbl>'
    files = spark.createDataFrame([("good", word_file(good)), ("bad", word_file(bad)), ("broken", bytearray(b"x"))], "path string, content binary")
    found = rows_of(ooxml.docx_cells(files))
    places = {(r["row"], r["column"]): r["text"] for r in found if r["path"] == "good" and r["issue"] is None}
    assert places == {(0, 0): "H", (0, 1): "H", (1, 0): "a", (1, 1): "1", (2, 0): "a", (2, 1): "2", (3, 0): "x"}
    assert {(r["path"], r["issue"]) for r in found if r["issue"]} == {("good", "GRID_WIDTH_MISMATCH"), ("bad", "INVALID_VERTICAL_MERGE"), ("broken", "UNREADABLE:BadZipFile")}
    assert [(r["kind"], r["text"]) for r in rows_of(ooxml.docx_blocks(files.where("path = 'good'")))][0] == ("text", "Intro")


def sheet_file(path=None):
    out = io.BytesIO()
    main, rel = ooxml.SHEET[1:-1], "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>name</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1"><v>2.5</v></c></row></sheetData></worksheet>')
    return bytearray(out.getvalue())


def test_xlsx(spark, tmp_path):
    files = spark.createDataFrame([("f", sheet_file()), ("g", bytearray(b"no"))], "path string, content binary")
    assert sorted((r["path"], r["reference"] or "", r["value"] or "") for r in rows_of(ooxml.xlsx_cells(files))) == [("f", "A1", "name"), ("f", "B1", "2.5"), ("g", "", "")]
    (tmp_path / "f.xlsx").write_bytes(bytes(sheet_file()))
    spark.dataSource.register(ooxml.WorkbookSource)
    got = spark.read.format("workbook").load(str(tmp_path / "f.xlsx"))
    assert sorted((r["reference"], r["value"]) for r in rows_of(got)) == [("A1", "name"), ("B1", "2.5")]


def test_archives(spark):
    def archive(*names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for n in names:
                z.writestr(n, "0" * (1 << 20) if n == "bomb" else "x")
        return bytearray(out.getvalue())

    files = spark.createDataFrame([("safe", archive("a", "b/c")), ("up", archive("../a")), ("twice", archive("A", "a")), ("bomb", archive("bomb")), ("none", bytearray(b"x"))], "path string, content binary")
    assert {r["path"]: r["defects"] for r in rows_of(ooxml.archive_safety(files))} == {"safe": "", "up": "PATH_TRAVERSAL", "twice": "DUPLICATE_MEMBER", "bomb": "COMPRESSION_RATIO", "none": "NOT_AN_ARCHIVE"}


def test_curves(spark, tmp_path):
    (tmp_path / "c1.csv").write_text("x,y,pixel_x,pixel_y,gap_before\n1,10,100,200,0\n2,20,110,190,1\n")
    found = rows_of(tables.curve_points(spark, str(tmp_path)).orderBy("ordinal"))
    assert [(r["curve_key"], r["ordinal"], r["x"], r["gap_before"]) for r in found] == [("c1", 0, 1.0, 0), ("c1", 1, 2.0, 1)]


def test_ledger(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"event_id": "1", "fault_id": "f", "event": "OBSERVED"}\n{"event_id": "1", "fault_id": "f", "event": "OBSERVED"}\n{"event_id": "2", "fault_id": "f", "event": "RESOLVED"}\n')
    old = tables.fault_ledger(spark, str(tmp_path))
    assert old.count() == 2
    new = spark.createDataFrame([("2", "x"), ("3", "y"), ("3", "y")], "event_id string, summary string")
    assert tables.append_faults(new, old).count() == 1
    (tmp_path / "m.jsonl").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.fault_ledger(spark, str(tmp_path)).count()


def test_usage(spark):
    lines = [("f", '{"type": "session_meta", "timestamp": "2024-01-01T00:00:00Z", "payload": {"cwd": "/w"}}'), ("f", '{"type": "event", "timestamp": "2024-01-01T01:00:00Z", "payload": {"type": "token_count", "task_id": "t", "info": {"last_token_usage": {"input_tokens": 10, "cached_input_tokens": 4, "output_tokens": 2}}}}'), ("f", '{"type": "event", "timestamp": "2024-01-02T00:00:00Z", "payload": {"type": "token_count", "task_id": "t"}}'), ("g", '{"type": "event", "timestamp": "2024-01-01T01:00:00Z", "payload": {"type": "token_count", "task_id": "u"}}')]
    rows = spark.createDataFrame(lines, "file string, line string").select("file", F.from_json("line", tables.ROLLOUT_SCHEMA).alias("r")).select("file", "r.*")
    found = rows_of(tables.token_usage(rows, "file", "2024-01-01 00:00:00", "2024-01-02 00:00:00", "/w"))
    assert [(r["task_id"], r["input_tokens"], r["cached_input_tokens"]) for r in found] == [("t", 10, 4)]


def test_markdown_round_trip(spark):
    blocks = [("d", 1, 0, "Hello"), ("d", 1, 1, "## Page 9\nx"), ("d", 2, 0, "\\## Page 3"), ("e", 1, 0, "")]
    rows = spark.createDataFrame(blocks, "document string, page int, ordinal int, text string")
    back = tables.from_markdown(tables.to_markdown(rows))
    assert sorted((r["document"], r["page"], r["text"]) for r in rows_of(back)) == [("d", 1, "Hello\n\n## Page 9\nx"), ("d", 2, "\\## Page 3"), ("e", 1, "")]


def test_exchange_and_snapshot(spark, tmp_path):
    mats, mixes = spark.createDataFrame([(1,)], "m int"), spark.createDataFrame([(5, 1)], "x int, m int")
    found = tables.write_exchange({"mats": mats, "mixes": mixes}, [("mixes", "mats", "m", "m")], str(tmp_path / "a"))
    assert found.first()["n_orphans"] == 0 and spark.read.parquet(str(tmp_path / "a/mixes")).count() == 1
    with pytest.raises(ValueError):
        tables.write_exchange({"mats": mats, "mixes": spark.createDataFrame([(5, 2)], "x int, m int")}, [("mixes", "mats", "m", "m")], str(tmp_path / "b"))
    tables.freeze(mats, str(tmp_path / "s"))
    with pytest.raises(Exception, match="(?i)exist"):
        tables.freeze(mats, str(tmp_path / "s"))


def run_stream(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return rows_of(spark.table(name))


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    rows = [(1, "LEASE", 0.0, "a", "2024-01-01 00:00:00"), (1, "COMPLETE", 5.0, "a", "2024-01-01 00:10:00"), (2, "LEASE", 0.0, "b", "2024-01-01 02:00:00"), (2, "COMPLETE", 99.0, "b", "2024-01-01 02:10:00")]
    schema = "key int, event string, at double, owner string, ts string"
    for i, half in enumerate((rows[:2] + rows[2:3], rows[3:])):
        spark.createDataFrame(half, schema).coalesce(1).write.mode("append").json(str(source))
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    found = run_stream(spark, leases.lease_stream(events, "key", "event", "at", "owner"), "leases", "update")
    assert {(r["key"], r["status"]) for r in found} >= {(1, "succeeded")}
    timed = events.withColumns({"t": F.col("ts").cast("timestamp"), "value": F.lit(1.0)})
    counts = run_stream(spark, leases.windowed_counts(timed, "t", "event", late="0 seconds"), "counts", "append")
    assert {(r["window_start"], r["event"], r["n"]) for r in counts} >= {(datetime(2024, 1, 1), "LEASE", 1)}
    once = run_stream(spark, leases.ledger_stream(timed.withColumn("id", F.lit(1)), "id", "t", "1 day"), "once", "append")
    assert len(once) == 1
