"""Ingest of every format: schema and numbers grow from run to run, a replayed batch gives the same."""

import json
import os

from tabforge.plans.harmonize_folder import HarmonizeConfig
from tabforge.streaming.ingest import ingest_folder, read_ingested


def test_runs_widen_the_schema_and_number_on(spark, tmp_path):
    root, sink, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    os.mkdir(root)
    cfg = HarmonizeConfig(split_names=False, index_start=1)

    def put(name, text):
        with open(os.path.join(root, name), "w") as f:
            f.write(text)
    put("a.csv", "ID,Val\n1,10\n2,20\n")
    put("bad.csv", "ID,Val\n1,2,3\n")
    ingest_folder(spark, root, sink, ckpt, cfg)
    first = read_ingested(spark, sink)
    assert dict(first.dtypes)["val"] == "bigint" and sorted((r.row_index, r.id, r.val) for r in first.collect()) == [(1, 1, 10), (2, 2, 20)]
    put("b.json", json.dumps([{"id": 3, "val": "x", "New": 1.5}]))
    put("void.json", "")
    put("c.csv", "id\n4\n")
    ingest_folder(spark, root, sink, ckpt, cfg)

    def rows():
        return sorted((r.row_index, r.source_file, r.id, r.val, r.new) for r in read_ingested(spark, sink).collect())
    want = rows()
    assert want == [(1, "a.csv", 1, "10", None), (2, "a.csv", 2, "20", None), (3, "b.json", 3, "x", 1.5), (4, "c.csv", 4, None, None)]
    status = {(r.source_file, r.status, r.rows) for r in spark.read.parquet(f"{sink}/files").collect()}
    assert {("a.csv", "ok", 2), ("bad.csv", "failed", 0), ("b.json", "ok", 1), ("c.csv", "ok", 1)} <= status
    # the last batch was not committed: it runs again
    commits = sorted((int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit()))
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        os.remove(f"{ckpt}/commits/{name}")
    ingest_folder(spark, root, sink, ckpt, cfg)
    assert rows() == want
    put("d.csv", "id,val\n5,9\n")
    ingest_folder(spark, root, sink, ckpt, cfg)
    assert rows() == [*want, (5, "d.csv", 5, "9", None)]
