"""S1, S4, S10, S12, H11, K1 on small hand-made folders."""

import os
import zipfile

from pyspark.sql import functions as F

from tabforge.plans.harmonize_folder import HarmonizeConfig, check_inputs, harmonize_folder
from tabforge.sources.catalog import file_catalog
from tabforge.sources.excel import read_excel_folder
from tabforge.sources.oplog import parse_log_lines

SHEET = ('<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
         '<sheetData>{rows}</sheetData></worksheet>')


def _xlsx(path, sheets):
    """Minimal workbook writer for fixtures: sheets = {name: [[cells]]} (inline strings / numbers)."""
    def cell(r, c, v):
        ref = chr(65 + c) + str(r + 1)
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    with zipfile.ZipFile(path, "w") as z:
        wb = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   f"<sheets>{wb}</sheets></workbook>")
        rels = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships '
                   f'xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, rows in enumerate(sheets.values()):
            body = "".join(f'<row r="{r + 1}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>"
                           for r, row in enumerate(rows))
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", SHEET.format(rows=body))


def test_excel_all_sheets(spark, tmpdir_path):
    _xlsx(os.path.join(tmpdir_path, "book.xlsx"), {
        "Customers": [["Full Name", "Age"], ["Ann Lee", 31], ["Bo Chen", 40]],
        "Orders": [["Order ID", "Amount"], [1, 9.5]],
    })
    rows = {(r.sheet_name, r.row_number): dict(zip(r.header, r.cells)) for r in read_excel_folder(spark, tmpdir_path, sheets=None).collect()}
    assert rows[("Customers", 0)]["Full Name"] == "Ann Lee"
    assert rows[("Customers", 1)]["Age"] == "40"
    assert rows[("Orders", 0)]["Amount"] == "9.5"
    first_only = read_excel_folder(spark, tmpdir_path).select("sheet_name").distinct().collect()
    assert [r.sheet_name for r in first_only] == ["Customers"]


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_mixed_folder_bad_and_short_rows(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "a.csv"), "Name,Age,City\nJohn Doe,30,NYC\nJane,25\n")
    _write(os.path.join(tmpdir_path, "b.CSV"), "Full Name,Years,Location\nBob Ray,41,LA\n")
    _write(os.path.join(tmpdir_path, "bad.csv"), "Name,Age,City\nX Y,1,Z,extra\n")
    _write(os.path.join(tmpdir_path, "data.json"), '[{"name": "Eve Moss", "age": 22, "contact": {"city": "SF"}}]')
    os.makedirs(os.path.join(tmpdir_path, "sub"))
    _write(os.path.join(tmpdir_path, "sub", "c.csv"), "ID,Value\n1,2.5\n")
    cfg = HarmonizeConfig(schema_map={"name": ["Full Name"], "age": ["Years"], "city": ["Location"]})
    res = harmonize_folder(spark, tmpdir_path, cfg)
    rows = res.data.orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(len(rows)))
    firsts = sorted((r.first_name or "") for r in rows)
    assert firsts == ["", "Bob", "Eve", "Jane", "John"]  # bad.csv dropped whole; short row kept
    jane = [r for r in rows if r.first_name == "Jane"][0]
    assert jane.city is None and jane.age == 25
    assert res.types["age"] == "int64" and res.types["value"] == "float64"
    status = {r.source_file: r.status for r in res.file_status.collect()}
    assert status["bad.csv"] == "failed" and status["a.csv"] == "ok"


def test_catalog_and_checks(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "x.CSV"), "a\n1\n")
    _write(os.path.join(tmpdir_path, "y.txt"), "hello")
    cat = file_catalog(spark, tmpdir_path, types=["csv"])
    r = cat.first()
    assert cat.count() == 1 and r.file_name == "x.CSV" and r.extension == ".CSV" and r.base_name == "x"
    msgs = check_inputs(spark, file_catalog(spark, tmpdir_path),
                        HarmonizeConfig(types=["json"], columns=["a", "a"], column_types={"a": "decimal"})).collect()
    sev = sorted((m.severity, m.message.split(" ")[0]) for m in msgs)
    assert ("error", "duplicate") in sev and ("error", "no") in sev and ("warning", "unknown") in sev


def test_operation_log_parse(spark):
    line = ('{"timestamp": "2024-01-02T03:04:05", "level": "ERROR", "logger": "app", "message": "m", "module": "x", '
            '"function": "f", "line": 7, "user_id": 12, "exception": {"type": "E", "message": "boom", "traceback": ["a", "b"]}}')
    df = parse_log_lines(spark.createDataFrame([(line,)], "value STRING"))
    r = df.first()
    assert r.level == "ERROR" and r.line == 7 and r.extra == {"user_id": "12"}
    assert r.exception.type == "E" and r.exception.traceback == ["a", "b"]
    assert df.select(F.year("timestamp")).first()[0] == 2024


def test_photo_content_hash(spark, tmpdir_path):
    from tabforge.functions.naming import a_photos, content_md5
    for n in ("IMG_20240315_101010.jpg", "IMG_20240316_101010.jpg"):
        _write(os.path.join(tmpdir_path, n), "same bytes")
    cat = file_catalog(spark, tmpdir_path)
    cat = cat.join(content_md5(spark, tmpdir_path), "path")
    names = sorted(r[0] for r in cat.select(a_photos(content_hash="md5")).collect())
    import hashlib
    h = hashlib.md5(b"same bytes").hexdigest()[:8]
    assert names == [f"2024-03_20240315_202403_Photo_{h}", f"2024-03_20240316_202403_Photo_{h}"]


def test_documents_lie_flat_one_file_a_bucket(spark, tmpdir_path):
    """A folder for each file would be listed by a task of its own at every reading; renaming goes through subfolders too."""
    from tabforge import inputs
    from tabforge.suite import q_sources
    spark.range(40).select(F.col("id").cast("int").alias("n_nationkey"), F.format_string("N%d", "id").alias("n_name")).where("n_nationkey < 25").write.parquet(f"{tmpdir_path}/nation.parquet")
    cust = spark.range(20_000).select(F.col("id").alias("c_custkey"), F.format_string("C%d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
                                      F.lit(1.5).alias("c_acctbal"), F.lit("AUTO").alias("c_mktsegment"))
    cust.write.parquet(f"{tmpdir_path}/customer.parquet")
    root = q_sources._mixed(spark, tmpdir_path).removeprefix("file:")
    for kind in ("array", "object", "cut"):
        folders = [d for d, _, _ in os.walk(f"{root}/{kind}")]
        files = [f for f in os.listdir(f"{root}/{kind}") if f.endswith(".json") and os.path.getsize(f"{root}/{kind}/{f}")]
        assert folders == [f"{root}/{kind}"] and len(files) == 20, kind
    got = q_sources.harmonize_mixed(spark, tmpdir_path)
    assert {r["kind"]: r["count"] for r in got.groupBy("kind").count().collect()} == {"csv": 6400, "array": 3200, "object": 3200, "book": 25}
    assert got.where("kind = 'array'").agg(F.sum("customer_id")).first()[0] == sum(i for i in range(20_000) if 8 <= i % 25 <= 11)
    os.makedirs(f"{tmpdir_path}/deep/b=1")
    for f in ("part-0.txt", "b=1/part-1.txt", "b=1/other.txt"):
        open(f"{tmpdir_path}/deep/{f}", "w").close()
    inputs.set_extension(spark, f"{tmpdir_path}/deep", ".json")
    assert sorted(f for _, _, fs in os.walk(f"{tmpdir_path}/deep") for f in fs) == ["other.txt", "part-0.json", "part-1.json"]
