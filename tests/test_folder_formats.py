"""Folder harmonisation on hand-made folders: formats, failures, options, layouts."""

import json
import os

import pytest

from tabforge.operators import harmonize as H
from tabforge.plans.harmonize_folder import HarmonizeConfig, harmonize_folder
from tabforge.sources import folder as S
from tabforge.sources.excel import parse_workbook
from tabforge.streaming.ingest import ingest_stream

from test_sources import _write, _xlsx


def rows_of(res, *cols):
    return sorted((tuple(r[c] for c in cols) for r in res.data.collect()), key=str)


def test_every_format_and_failure(spark, tmpdir_path):
    at = lambda n: os.path.join(tmpdir_path, n)
    _write(at("a.csv"), 'ID,Name\n1,"Lee, Ann"\n\n2,Bo\n')
    _xlsx(at("b.xlsx"), {"S1": [["ID", "Name"], [3, "Cy Dee"]], "S2": [["ID"], [99]]})
    _write(at("c.json"), json.dumps([{"id": 4, "name": "Ed", "at": {"city": "X"}}]))
    _write(at("d.json"), json.dumps({"meta": "m", "one": [{"id": 5}], "two": [{"id": 6, "name": "Flo"}], "n": 3}))
    _write(at("cut.json"), '[{"id": 7, "name": "Gu')
    _write(at("long.csv"), "ID,Name\n8,Hal\n9,Ida,extra\n")
    _write(at("junk.xlsx"), "this is no archive")
    res = harmonize_folder(spark, tmpdir_path, HarmonizeConfig(split_names=False))
    assert rows_of(res, "id", "name", "sheet_name") == [(1, "Lee, Ann", None), (2, "Bo", None), (3, "Cy Dee", "S1"), (4, "Ed", None),
                                                        (5, None, "one"), (6, "Flo", "two")]
    status = {r.source_file: (r.status, r.rows) for r in res.file_status.collect()}
    assert status == {"a.csv": ("ok", 2), "b.xlsx": ("ok", 1), "c.json": ("ok", 1), "d.json": ("ok", 2), "cut.json": ("failed", 0),
                      "long.csv": ("failed", 0), "junk.xlsx": ("failed", 0)}
    assert sorted(r.row_index for r in res.data.collect()) == list(range(6))
    with pytest.raises(ValueError):
        harmonize_folder(spark, tmpdir_path, HarmonizeConfig(on_error="fail"))
    every = harmonize_folder(spark, tmpdir_path, HarmonizeConfig(types=["xlsx"], sheets=None, split_names=False))
    assert rows_of(every, "id", "sheet_name") == [(3, "S1"), (99, "S2")]


def test_cells_right_of_the_header_row_are_kept(tmpdir_path):
    path = os.path.join(tmpdir_path, "wide.xlsx")
    _xlsx(path, {"S1": [["ID", "Name"], [1, "Al"], [2, "Bo", "extra", 7]]})
    with open(path, "rb") as f:
        got = list(parse_workbook(f.read()))
    assert [r[3:] for r in got] == [(["ID", "Name", "Unnamed: 2", "Unnamed: 3"], ["1", "Al", None, None]),
                                    (["ID", "Name", "Unnamed: 2", "Unnamed: 3"], ["2", "Bo", "extra", "7"])]


def test_codes_are_no_numbers(spark):
    df = spark.createDataFrame([("12D", "1.5", "7"), ("15F", "2e3", "08")], "code STRING, x STRING, n STRING")
    assert H.profile_types(df) == {"code": "object", "x": "float64", "n": "int64"}
    got = H.align_to_schema(df, {"code": "float64", "x": "float64"}).collect()
    assert [tuple(r) for r in got] == [(None, 1.5), (None, 2000.0)]


def test_reader_options_reach_header_and_long_row_check(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "a.csv"), "# note\n'First;Name';Age\n'x;y';3\n'z';4\n")
    cfg = HarmonizeConfig(read_options={"sep": ";", "quotechar": "'", "comment": "#"}, split_names=False)
    res = harmonize_folder(spark, tmpdir_path, cfg)
    assert rows_of(res, "first;name", "age") == [("x;y", 3), ("z", 4)]
    assert S.parse_header('a,"b,c",,d') == ["a", "b,c", "", "d"]


def test_plans_grow_once_with_the_layouts(spark, tmpdir_path):
    def scans(n):
        root = os.path.join(tmpdir_path, str(n))
        os.makedirs(root)
        for i in range(n):
            _write(os.path.join(root, f"f{i}.csv"), f"id,c{i}\n{i},1\n")
        _write(os.path.join(root, "bad.csv"), "id\n1,2\n")
        df = harmonize_folder(spark, root, HarmonizeConfig(types=["csv"])).data
        assert df.count() == n
        return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    two, four, eight = scans(2), scans(4), scans(8)
    assert eight - four <= 2 * (four - two)


def test_ingest_of_mixed_headers_takes_up_new_files(spark, tmpdir_path):
    root, out, ckpt = (os.path.join(tmpdir_path, n) for n in ("in", "out", "ckpt"))
    os.makedirs(root)
    _write(os.path.join(root, "a.csv"), "id,name\n1,Ann Lee\n")
    _write(os.path.join(root, "b.csv"), "name,id\nq r,2\n")
    _write(os.path.join(root, "bad.csv"), "id,name\n3,x,y\n")
    types = {"id": "int64", "first_name": "object", "last_name": "object"}
    ingest_stream(spark, root, out, ckpt, types)
    _write(os.path.join(root, "c.csv"), "Id\n4\n")
    ingest_stream(spark, root, out, ckpt, types)
    ingest_stream(spark, root, out, ckpt, types)
    got = sorted((r.id, r.first_name, r.last_name, r.source_file) for r in spark.read.parquet(f"{out}/data").collect())
    assert got == [(1, "Ann", "Lee", "a.csv"), (2, "q", "r", "b.csv"), (4, None, None, "c.csv")]
    files = {r.source_file: (r.status, r.rows) for r in spark.read.parquet(f"{out}/files").collect()}
    assert files == {"a.csv": ("ok", 1), "b.csv": ("ok", 1), "bad.csv": ("failed", 0), "c.csv": ("ok", 1)}
