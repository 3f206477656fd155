"""JSON documents of every shape, cut by commas over many splits."""

import json
import random

import pytest

from tabforge.plans.harmonize_folder import HarmonizeConfig, harmonize_folder
from tabforge.sources import jsonsrc


def rows_of(doc):
    return [(None, e) for e in doc] if isinstance(doc, list) else [(k, e) for k, v in doc.items() if isinstance(v, list) for e in v]


def flat(e):
    out = {}
    for k, v in sorted(e.items()) if isinstance(e, dict) else [("value", e)]:
        for a, b in sorted(v.items()) if isinstance(v, dict) else [(k, v)]:
            out.pop(a, None)
            out[a] = b
    return out


def norm(t, x):
    return None if t == "VOID" else json.loads(x) if t.startswith(("OBJECT", "ARRAY", "BIGINT", "DECIMAL", "DOUBLE", "BOOLEAN")) else x


def hostile():
    rng = random.Random(6)
    texts = ["plain", 'a "quote"', "back\\slash", "]}[{", ",", "é\u2028", "", "x" * 900, "\\", "tab\t\nline"]
    def value(d=0):
        k = rng.randrange(8 if d < 2 else 6)
        if k == 6:
            return [value(d + 1) for _ in range(rng.randrange(3))]
        if k == 7:
            return {rng.choice(["A", "a", "b,c", 'q"', "]"]): value(d + 1) for _ in range(rng.randrange(3))}
        return [rng.choice(texts), rng.randrange(100), 2.5, None, True, rng.choice(texts)][k]
    docs = {"array": [{k: value() for k in rng.sample(["ID", "id", "Name", "a b", "{x"], 3)} for _ in range(60)],
            "scalars": [1, "two,", None, [3, {"a": 4}], {"a": 5}], "empty": [], "none": {}, "object": {"s": [{"a": 1}, {"A": 2}], "k": "[t", "o": {"in": [1, 2], "z": {}}, "l,[": [[1, 2], [3]], "e": [], "m": 1},
            "scalar_s": {"s": "t"}, "one": [{"a": [1, 2]}]}
    return docs


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_equal_the_parser(spark, small_splits, tmp_path, indent):
    docs = hostile()
    for n, d in docs.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(d, indent=indent, ensure_ascii=False))
    broken = {"cut": '[{"a": 1}, {"a"', "string": '[{"a": "x]', "text": '"str"', "twice": "[1,,2]", "after": "[1] [2]", "comma": "[1,2,]", "mixed": '[{"a": 1]}'}
    for n, t in broken.items():
        (tmp_path / f"{n}.json").write_text(t)
    (tmp_path / "void.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n")
    got, status = jsonsrc.json_elements(spark, str(tmp_path), f"file:{tmp_path}")
    state = {r.source_file: (r.failed, r.rows) for r in status.collect()}
    assert {f for f, (bad, _) in state.items() if bad} == {f"{n}.json" for n in broken}
    assert {f: n for f, (bad, n) in state.items() if not bad} == {"void.json": 0, "blank.json": 0, **{f"{n}.json": len(rows_of(d)) for n, d in docs.items()}}
    seen = {}
    for r in got.orderBy("source_file", "blk", "mid").collect():
        seen.setdefault(r.source_file, []).append((r.sheet_name, {e.k: norm(e.t, e.x) for e in r.flat}))
    for n, d in docs.items():
        assert seen.get(f"{n}.json", []) == [(s, flat(e)) for s, e in rows_of(d)], n


def test_keys_and_types_are_those_of_each_file(spark, tmp_path):
    files = {"a": [{"ID": 1, "Name": "x"}], "b": [{"id": 2, "name": "y", "v": 1.5}], "c": {"s": [{"ID": 3}], "v": [{"V": "w"}]}, "d": {"s": "t"}, "e": []}
    for n, d in files.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(d))
    res = harmonize_folder(spark, str(tmp_path), HarmonizeConfig(types=["json"], split_names=False, index_mode="sequential"))
    got = sorted((r.source_file, r.sheet_name, r.id, r.name, r.v, r.row_index) for r in res.data.collect())
    assert got == [("a.json", None, 1, "x", None, 0), ("b.json", None, 2, "y", "1.5", 1), ("c.json", "s", 3, None, None, 2), ("c.json", "v", None, None, "w", 3)]
    assert {(r.source_file, r.status, r.rows) for r in res.file_status.collect()} == {("a.json", "ok", 1), ("b.json", "ok", 1), ("c.json", "ok", 2), ("d.json", "ok", 0), ("e.json", "ok", 0)}


def test_one_large_array_takes_several_tasks(spark, tmp_path):
    with open(tmp_path / "big.json", "w") as f:
        f.write("[" + ",".join(json.dumps({"id": i, "pad": "p,]" * 40}) for i in range(60_000)) + "]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        got, _ = jsonsrc.json_elements(spark, str(tmp_path), f"file:{tmp_path}")
        assert got.select("blk").distinct().count() >= 8
        ids = got.selectExpr("CAST(flat[0].x AS INT) AS i")
        assert ids.count() == 60_000 and ids.distinct().count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
