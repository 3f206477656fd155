"""CSV records with line breaks in quoted fields."""

import csv
import io
import random

from tabforge.plans.harmonize_folder import HarmonizeConfig, harmonize_folder


def text_of(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def test_records_over_several_splits(spark, small_splits, tmp_path):
    rng = random.Random(4)
    parts = ["plain", 'say "hi"', "a,b", "two\nlines", "\n", "\n\nx", '"', '",\n"', "#no", "long " * 300, 'end"\n', '\n"start', "5 inch"]
    tables = {}
    for f in range(3):
        rows = [["Id", "No\nte", "Last"]] + [[str(i), "".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))), rng.choice(["z", "y\nz", ""])] for i in range(120)]
        tables[f"f{f}.csv"] = rows[1:]
        (tmp_path / f"f{f}.csv").write_text(text_of(rows))
    (tmp_path / "quotes.csv").write_text('Id,No\nte,Last\n'.replace("No\nte", '"No\nte"') + '1,5" pipe,z\n2,6" pipe,y\n\n3,"x\n\n",w\n')
    tables["quotes.csv"] = [["1", '5" pipe', "z"], ["2", '6" pipe', "y"], ["3", "x\n\n", "w"]]
    (tmp_path / "open.csv").write_text('Id,"No\nte",Last\n1,"never\nends,x\n2,b,c\n')
    cfg = HarmonizeConfig(types=["csv"], index_mode="local", split_names=False, read_options={"escape": '"'}, to_lower=False, spaces_to_underscores=False)
    res = harmonize_folder(spark, str(tmp_path), cfg)
    assert {r.source_file: (r.status, r.rows) for r in res.file_status.collect()} == {
        **{f: ("ok", len(t)) for f, t in tables.items()}, "open.csv": ("failed", 0)}
    got = {}
    for r in res.data.orderBy("source_file", "row_index").collect():
        got.setdefault(r.source_file, []).append((r.row_index, [str(r.Id), r["No\nte"], r.Last or ""]))
    assert {f: [x for _, x in t] for f, t in got.items()} == tables
    assert all([i for i, _ in t] == list(range(len(t))) for t in got.values())


def test_backslash_escapes_and_names_that_differ_in_case(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,id,Note\n1,,"a \\"quoted\\"\nline"\n,2,b\n')
    (tmp_path / "b.csv").write_text("ID,Note\n3,c\n")
    res = harmonize_folder(spark, str(tmp_path), HarmonizeConfig(types=["csv"], index_mode="none", split_names=False))
    assert sorted((r.id, r.note) for r in res.data.collect()) == [(1, 'a "quoted"\nline'), (2, "b"), (3, "c")]
    assert {r.status for r in res.file_status.collect()} == {"ok"}
