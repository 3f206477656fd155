"""P4-P9 collision handling and D1 specs."""

import pytest
from pyspark.sql import functions as F

from tabforge.plans import rename as R
from tabforge.plans.spec import from_dict, register_step
from tabforge.sources.catalog import with_name_parts


def catalog(spark, names, parent="/d"):
    df = spark.createDataFrame([(f"{parent}/{n}", 10, None) for n in names], "path STRING, size BIGINT, modified TIMESTAMP")
    return with_name_parts(df).withColumn("created", F.col("modified"))


def test_collision_set_and_append_number(spark):
    cat = catalog(spark, ["HR_report_1.pdf", "HR_document_1.pdf", "IT_report_1.pdf", "IT_document_1.pdf"])
    spec = from_dict({"pipeline": {"extractor": {"name": "split", "args": ["_", "dept", "type", "num"]},
                                   "template": {"name": "template", "args": ["{dept}_{num}"]}}})
    plan = R.rename_plan(cat, spec)
    assert R.collision_count(plan).first()[0] == 2
    flags = {r.old_name: r.collides for r in R.flag_collisions(plan).collect()}
    assert all(flags.values())
    res = {r.old_name: r.new_name for r in R.resolve_collisions(plan, internal="append_number").collect()}
    assert res == {"HR_document_1.pdf": "HR_1.pdf", "HR_report_1.pdf": "HR_1_1.pdf",
                   "IT_document_1.pdf": "IT_1.pdf", "IT_report_1.pdf": "IT_1_1.pdf"}
    skip = {r.old_name: r.action for r in R.resolve_collisions(plan, internal="skip").collect()}
    assert set(skip.values()) == {"skip"}


def test_existing_file_collision(spark):
    cat = catalog(spark, ["a.txt", "B.txt"])
    spec = from_dict({"pipeline": {"all_in_one": {"name": "uppercase"}}})
    plan = R.rename_plan(cat, spec)
    res = {r.old_name: (r.new_name, r.action) for r in R.resolve_collisions(plan, catalog=cat).collect()}
    assert res == {"a.txt": ("A.txt", "rename")}
    cat2 = catalog(spark, ["b.txt", "B.txt"])
    plan2 = R.rename_plan(cat2, spec)
    res2 = {r.old_name: r.action for r in R.resolve_collisions(plan2, catalog=cat2).collect()}
    assert res2 == {"b.txt": "skip"}


def test_metrics_zero_guards(spark):
    cat = catalog(spark, ["x.txt"])
    spec = from_dict({"pipeline": {"filters": [{"name": "!pattern", "args": ["*.txt"]}]}})
    m = R.plan_metrics(R.rename_plan(cat, spec)).first()
    assert (m.files_found, m.files_filtered_out, m.files_to_rename, m.success_rate, m.filtering_efficiency) == (1, 1, 0, 0.0, 0.0)


def test_spec_errors_and_custom_steps(spark):
    with pytest.raises(ValueError):
        from_dict({"pipeline": {"extractor": {"name": "nope"}}})
    with pytest.raises(ValueError):
        from_dict({"pipeline": {"converters": [{"name": "case", "args": ["a", "upper"]}]}})
    register_step("template", "dash", lambda f, t: F.concat_ws("-", *[f.getField(n) for n in t.fieldNames()]))
    cat = catalog(spark, ["HR_x.pdf"])
    spec = from_dict({"pipeline": {"extractor": {"name": "split", "args": ["_", "a", "b"]}, "template": {"name": "dash"}}})
    assert R.rename_plan(cat, spec).first().new_name == "HR-x.pdf"


def moves(spark, pairs, **kw):
    """{old: (new, action)} of a plan with the given old -> new names over those files and the ones in ``also``."""
    also = kw.pop("also", [])
    cat = catalog(spark, [a for a, _ in pairs] + also)
    names = dict(pairs)
    new = F.col("file_name")
    for a, b in pairs:
        new = F.when(F.col("file_name") == a, F.lit(names[a])).otherwise(new)
    plan = cat.select(F.col("path").alias("old_path"), F.col("file_name").alias("old_name"), "parent", "extension", F.lit(True).alias("kept"),
                      new.alias("new_name"), F.lit(None).cast("string").alias("error"))
    got = {r.old_name: (r.new_name, r.action) for r in R.resolve_collisions(plan, catalog=cat, **kw).collect()}
    final = [b for b, action in got.values() if action == "rename"]
    stays = [r.file_name for r in cat.collect() if got.get(r.file_name, ("", "skip"))[1] != "rename"]
    assert len(set(final) | set(stays)) == len(final) + len(stays)
    return got


def test_numbers_avoid_planned_and_existing_names(spark):
    got = moves(spark, [("a.txt", "X.txt"), ("b.txt", "X.txt"), ("c.txt", "X_1.txt")], internal="append_number")
    assert got == {"a.txt": ("X.txt", "rename"), "b.txt": ("X_2.txt", "rename"), "c.txt": ("X_1.txt", "rename")}
    got = moves(spark, [("q.txt", "Q.txt")], also=["Q.txt", "Q_1.txt", "Q_02.txt", "Q_3.txt"], internal="append_number", existing="append_number")
    assert got == {"q.txt": ("Q_2.txt", "rename")}
    got = moves(spark, [(f"f{i}.txt", "T.txt") for i in range(6)], also=["T_2.txt", "T_3.txt", "T_5.txt"],
                internal="append_number", existing="append_number")
    assert [got[f"f{i}.txt"][0] for i in range(6)] == ["T.txt", "T_1.txt", "T_4.txt", "T_6.txt", "T_7.txt", "T_8.txt"]


def test_skipped_rows_stay_and_block(spark):
    got = moves(spark, [("a.txt", "Z.txt"), ("b.txt", "Z.txt"), ("c.txt", "a.txt")])
    assert {k: v[1] for k, v in got.items()} == {"a.txt": "skip", "b.txt": "skip", "c.txt": "skip"}
    chain = [(f"n{i}.txt", f"n{i + 1}.txt") for i in range(9)]
    assert set(moves(spark, chain, also=["n9.txt"]).values()) == {(b, "skip") for _, b in chain}
    assert {v[1] for v in moves(spark, chain).values()} == {"rename"}
    ring = [("a.txt", "b.txt"), ("b.txt", "c.txt"), ("c.txt", "a.txt")]
    assert {v[1] for v in moves(spark, ring, existing="error").values()} == {"rename"}


def test_pipeline_takes_policies_from_the_spec(spark):
    from tabforge.plans.spec import Pipeline
    spec = {"pipeline": {"all_in_one": {"name": "uppercase"}}, "collision_handling": {"on_existing_collision": "append_number"}}
    cat = catalog(spark, ["b.txt", "B.txt"])
    got = {r.old_name: (r.new_name, r.action) for r in Pipeline.from_dict(spec).run(cat).collect()}
    assert got == {"b.txt": ("B_1.txt", "rename")}
    with pytest.raises(ValueError):
        Pipeline.from_dict({**spec, "collision_handling": {"on_internal_collision": "shrug"}})


def test_names_are_made_once_before_rows_are_chosen_by_them(spark, monkeypatch):
    """A filter on the new name, moved below it, would make the name again for each place that reads it, in each job."""
    written = {}

    def write(df, name, real=R.write_and_read):
        written.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(R, "write_and_read", write)
    cat = catalog(spark, ["a.txt", "b.txt", "B.txt", "c.TXT"])
    plan = R.rename_plan(cat, from_dict({"pipeline": {"all_in_one": {"name": "uppercase"}}}))
    got = {r.old_name: r.new_name for r in R.resolve_collisions(plan, internal="append_number", existing="append_number", catalog=cat).collect()}
    assert got == {"a.txt": "A.txt", "b.txt": "B_1.txt", "c.TXT": "C.TXT"}
    assert "upper(" in written["plan"] and "upper(" not in written["collisions"] and "upper(" not in written["policies"]
    written.clear()
    assert R.flag_collisions(plan).where("collides").count() == 0 and "upper(" not in written["collisions"]


def test_rows_at_the_end_of_a_chain_are_not_joined(spark, monkeypatch):
    """They wait for nothing: joined by a null they would all meet in one task."""
    plans = []

    def write(df, name, real=R.write_and_read):
        if name == "chains":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(R, "write_and_read", write)
    ch = spark.createDataFrame([(f"/d/{i}", f"/d/{i + 1}", "rename") for i in range(9)] + [("/r/a", "/r/b", "rename"), ("/r/b", "/r/a", "rename")],
                               "old_path string, new_path string, action string")
    stays = spark.createDataFrame([("/d/9",)], "__p string")
    assert {r.old_path for r in R._blocked_chains(ch, stays).collect()} == {f"/d/{i}" for i in range(9)}
    assert len(plans) > 1 and all("LeftOuter" in p and "Union" in p and "isnotnull(next" in p for p in plans[1:])
