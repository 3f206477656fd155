"""Workbooks: dates, odd cells, sheets without data, damaged archives."""

import zipfile

from tabforge.plans.harmonize_folder import HarmonizeConfig, harmonize_folder

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
STYLES = f"""<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="[Red]0.00&quot;days&quot;"/>
<numFmt numFmtId="166" formatCode="[h]:mm:ss"/></numFmts><cellXfs>{"".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 22, 164, 165, 166, 20))}</cellXfs></styleSheet>"""


def book(path, rows, props=""):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}">{props}<sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/styles.xml", STYLES)
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(f"<row>{r}</row>" for r in rows)}</sheetData></worksheet>')


def head(*names):
    return "".join(f'<c t="inlineStr"><is><t>{n}</t></is></c>' for n in names)


def test_workbooks(spark, tmp_path):
    cells = [head("A", "B", "C", "D", "E", "F"),
             '<c s="1"><v>45366</v></c><c s="2"><v>45366.75</v></c><c s="3"><v>59</v></c><c s="4"><v>45366</v></c><c s="5"><v>0.5</v></c><c s="6"><v>0.25</v></c>',
             '<c r="A3" s="3"><v>61</v></c><c r="C3"><v>7</v></c><c><v>8</v></c>']
    book(tmp_path / "dates.xlsx", cells)
    book(tmp_path / "mac.xlsx", [head("A"), '<c s="1"><v>0.5</v></c>', '<c s="1"><v>43904</v></c>'], '<workbookPr date1904="1"/>')
    book(tmp_path / "header.xlsx", [head("A", "Z")])
    book(tmp_path / "damaged.xlsx", cells * 400)
    raw = bytearray((tmp_path / "damaged.xlsx").read_bytes())
    at = raw.find(b"xl/worksheets/s.xml") + 60
    raw[at:at + 40] = b"\xff" * 40
    (tmp_path / "damaged.xlsx").write_bytes(raw)
    res = harmonize_folder(spark, str(tmp_path), HarmonizeConfig(types=["xlsx"], index_mode="local", split_names=False))
    assert {(r.source_file, r.status, r.rows) for r in res.file_status.collect()} == {
        ("dates.xlsx", "ok", 2), ("mac.xlsx", "ok", 2), ("header.xlsx", "ok", 0), ("damaged.xlsx", "failed", 0)}
    got = {(r.source_file, r.row_index): tuple(str(x) if x is not None else None for x in (r.a, r.b, r.c, r.d, r.e, r.f)) for r in res.data.collect()}
    assert got["dates.xlsx", 0] == ("2024-03-15", "2024-03-15 18:00:00", "1900-02-28", "45366", "12:00:00", "06:00:00")
    assert got["dates.xlsx", 1] == ("1900-03-01", None, "7", "8", None, None)
    assert got["mac.xlsx", 0][0] == "12:00:00" and got["mac.xlsx", 1][0] == "2024-03-15" and len(got) == 4
    assert "z" in res.data.columns


def test_sheets_of_one_workbook_are_spread_over_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    from tabforge.sources.excel import read_excel_folder
    n = 8
    with zipfile.ZipFile(tmp_path / "many.xlsx", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>' + "".join(f'<sheet name="S{i}" sheetId="{i + 1}" r:id="r{i}"/>' for i in range(n)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="/xl/worksheets/s{i}.xml"/>' for i in range(n)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>text {i}</t></si>" for i in range(20_000)) + "</sst>")
        for i in range(n):
            rows = "".join(f'<row><c t="s"><v>{(k * 7 + i) % 20_000}</v></c><c><v>{k}</v></c></row>' for k in range(12_000))
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData><row>{head("A", "B")}</row>{rows}</sheetData></worksheet>', zipfile.ZIP_STORED if i % 2 else zipfile.ZIP_DEFLATED)
    rows = read_excel_folder(spark, str(tmp_path), None)
    got = rows.withColumn("task", F.spark_partition_id()).groupBy("sheet_pos", "sheet_name").agg(F.count("cells").alias("n"), F.count_distinct("task").alias("tasks"),
                                                      F.min(F.expr("cells[0] = concat('text ', (row_number * 7 + sheet_pos) % 20000) AND cells[1] = row_number")).alias("right")).collect()
    assert {(r.sheet_pos, r.sheet_name, r.n, r.tasks, r.right) for r in got} == {(i, f"S{i}", 12_000, 1, True) for i in range(n)}
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    assert [r.sheet_name for r in read_excel_folder(spark, str(tmp_path), ["S3"]).select("sheet_name").distinct().collect()] == ["S3"]


def test_a_bad_sheet_fails_its_workbook_alone(spark, tmp_path):
    from tabforge.sources.excel import read_excel_folder
    cells = [head("A"), *["<c><v>1</v></c>"] * 4000]
    for name in ("good", "good one", "sum", "short", "no"):
        book(tmp_path / f"{name}.xlsx", cells)
    for name, change in (("sum", lambda raw, at: raw.__setitem__(slice(at, at + 4), b"abcd")), ("no", lambda raw, at: raw.__delitem__(slice(100, len(raw))))):
        raw = bytearray((tmp_path / f"{name}.xlsx").read_bytes())
        change(raw, raw.rfind(b"PK\x01\x02") + 16)  # the checksum in the last entry of the directory: the sheet's
        (tmp_path / f"{name}.xlsx").write_bytes(raw)
    with zipfile.ZipFile(tmp_path / "short.xlsx", "a") as z:
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{MAIN}"><sheetData><row>')
    (tmp_path / "empty + one.xlsx").write_bytes(b"")
    got = {(r.path.rsplit("/", 1)[1], r.failed) for r in read_excel_folder(spark, str(tmp_path)).select("path", "failed").distinct().collect()}
    assert {p for p, f in got if f} == {"sum.xlsx", "short.xlsx", "no.xlsx", "empty + one.xlsx"}
    assert {p for p, f in got if not f} >= {"good.xlsx", "good one.xlsx"}


def test_a_pipeline_with_a_pattern_runs_twice():
    from tabforge.plans import spec
    k = {"pattern": r"(?P<a>\d+)"}
    step = spec.BUILTIN["extractor"]["regex"]([], k)
    step(None)
    step(None)
    assert k == {"pattern": r"(?P<a>\d+)"}
