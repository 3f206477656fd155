"""D1 call strings and step names, U2 checks of types, C4 fields that only some rows have."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.plans import rename as R
from tabforge.plans import steps as S
from tabforge.plans.spec import Pipeline, from_dict, register_step
from tabforge.sources.catalog import with_name_parts


def catalog(spark, names):
    df = spark.createDataFrame([(f"/d/{n}", 10, None) for n in names], "path STRING, size BIGINT, modified TIMESTAMP")
    return with_name_parts(df).withColumn("created", F.col("modified"))


@pytest.mark.parametrize("call, name, args, kwargs", [
    ("split,_,dept,type", "split", ["_", "dept", "type"], {}),
    ("lowercase", "lowercase", [], {}),
    ("!pattern,*backup*", "!pattern", ["*backup*"], {}),
    (" case , field=type,  case = x ", "case", ["case = x"], {"field": "type"}),
    ("split,' ',a", "split", [" ", "a"], {}),
    ("split,\",\",a", "split", [",", "a"], {}),
    ("replace,'a=b',\"it's\"", "replace", ["a=b", "it's"], {}),
    ("replace,'it''s',", "replace", ["it's", ""], {}),
    ("template,pre='a, b' ", "template", [], {"pre": "a, b"}),
    ("position,0-3:year,4-5:month", "position", ["0-3:year", "4-5:month"], {}),
    ("replace,it's,its", "replace", ["it's", "its"], {}),
    ("regex,^(?P<a>\\d+)=(x y)$", "regex", ["^(?P<a>\\d+)=(x y)$"], {}),
    ("template,{a} - {b}", "template", ["{a} - {b}"], {}),
    ("f,,x", "f", ["", "x"], {}),
])
def test_call_strings(call, name, args, kwargs):
    assert S.parse_call(call) == {"name": name, "args": args, "kwargs": kwargs}


@pytest.mark.parametrize("call", ["", "  ", "!", "a=b", "x,k=1,k=2", ",a"])
def test_calls_that_are_none(call):
    with pytest.raises(ValueError):
        S.parse_call(call)


# the least arguments of each built-in step
ARGS = {"extractor": {"split": ["_", "a", "b"], "regex": [r"(?P<a>\d+)"], "position": ["0-1:a"]},
        "converter": {"pad_numbers": ["dept"], "date_format": ["date"], "case": ["dept"]},
        "template": {"template": ["{dept}"], "section": ["{{;dept}}"], "business": ["2024-01-31"]},
        "filter": {"date-modified": [">", "2024-01-01"]}}


@pytest.mark.parametrize("kind", S.KINDS)
def test_every_step_by_name_has_its_type(spark, kind):
    fields = T.StructType.fromDDL("dept string, type string, date string")
    df = S.empty_catalog(spark, fields)
    for name in S.BUILTIN[kind]:
        kwargs = {"hr": "policy|handbook"} if name == "keywords" else {}
        step = S.resolve(kind, name, ARGS.get(kind, {}).get(name, []), kwargs)
        if kind in ("extractor", "all_in_one"):
            step = step(df)
        elif kind != "filter":
            step = step(F.col("fields"), fields)
        S.check_type(kind, name, step, df)


def test_steps_by_name_give_names(spark):
    cat = catalog(spark, ["HR_policy_20240115.pdf", "Invoice_42_ACME Corp_2024-03-02.pdf"])
    first = lambda p: [r.new_name for r in p.plan(cat).orderBy("old_name").collect()]
    got = first(Pipeline.from_calls("business-doc", ["business"], "join,dept_code,type,year"))
    assert got[0] == "HR_policy_2024.pdf"
    assert first(Pipeline.from_calls("business-doc", ["business"], "template,{formatted_name}"))[0].endswith(".pdf")
    assert first(Pipeline.from_calls("invoice", ["invoice,company_prefix=false"], "template,{number_padded}"))[1] == "000042.pdf"
    assert first(Pipeline.from_calls(all_in_one="clean,-"))[1] == "Invoice_42_ACME-Corp_2024-03-02.pdf"
    assert first(Pipeline.from_calls("keywords,people=policy|HR,money=invoice", template="template,{category}")) == ["people.pdf", "money.pdf"]
    spec = '{"pipeline": {"all_in_one": "uppercase", "filters": ["pattern,HR*"]}}'
    assert [(r.kept, r.new_name) for r in Pipeline.from_json(spec).plan(cat).orderBy("old_name").collect()][0] == (True, "HR_POLICY_20240115.pdf")


@pytest.mark.parametrize("pipe", [
    {"extractor": "nope"}, {"all_in_one": "clean,_,x"}, {"all_in_one": "photos,organize_by_month=maybe"}, {"all_in_one": "media,size=1"},
    {"extractor": "split,_,a", "converters": ["case"]}, {"extractor": "split,_,a", "converters": ["case,a,upper,more"]},
    {"extractor": "split,_,a", "template": "business"}, {"extractor": "split,_,a", "template": "join,a,sep=x"}, {"extractor": "keywords"},
])
def test_wrong_arguments_are_errors(spark, pipe):
    with pytest.raises(ValueError):
        from_dict({"pipeline": pipe})


@pytest.mark.parametrize("kind, fn, error", [
    ("filter", lambda: F.col("size"), TypeError), ("filter", lambda: True, TypeError), ("filter", "no", TypeError),
    ("extractor", lambda df: F.col("file_name"), TypeError), ("extractor", lambda df: F.create_map(F.lit("a"), F.lit(1)), TypeError),
    ("extractor", lambda: F.struct(F.lit("a")), ValueError), ("converter", lambda f: f, ValueError),
    ("converter", lambda f, t: F.lit("x"), TypeError), ("template", lambda f, t: f, TypeError), ("template", lambda f, t: F.size(f), ValueError),
    ("all_in_one", lambda df: F.length("base_name"), TypeError), ("all_in_one", lambda df: F.upper(F.array(F.lit(1))), ValueError),
    ("shape", lambda: F.lit(True), ValueError),
])
def test_steps_of_a_wrong_type_are_not_registered(spark, kind, fn, error):
    with pytest.raises(error):
        register_step(kind, "bad", fn)
    assert "bad" not in S.CUSTOM.get(kind, {})


def test_what_the_empty_frame_lacks_is_left_to_the_plan(spark):
    register_step("filter", "own-column", lambda: F.col("owner") == "me")
    register_step("filter", "over", lambda least: F.col("size") > int(least))
    register_step("template", "third", lambda f, t: F.length(f.getField(t.fieldNames()[2])))
    cat = catalog(spark, ["a_b_c.txt"])
    assert R.rename_plan(cat, from_dict({"pipeline": {"filters": ["over,10"]}})).first().kept is False
    with pytest.raises(ValueError):
        from_dict({"pipeline": {"filters": ["over"]}})
    with pytest.raises(TypeError, match="template step .* gives int"):
        R.rename_plan(cat, from_dict({"pipeline": {"extractor": "split,_,x,y,z", "template": "third"}}))
    with pytest.raises(TypeError):
        register_step("converter", "total", lambda f, t: f.getField("n"), needs=["n"])
    with pytest.raises(TypeError):
        register_step("converter", "total", lambda f, t: f.getField("n") + 1, fields="n int")


def rows(spark):
    data = [("/d/full.x", {"a": "one", "n": "7"}), ("/d/empty.x", {"a": "", "n": ""}), ("/d/null.x", {"a": None, "n": "5"}),
            ("/d/no_n.x", {"a": "two", "z": "q"}), ("/d/no_a.x", {"n": "1"}), ("/d/none.x", None), ("/d/no_fields.x", {})]
    df = spark.createDataFrame(data, "path string, m map<string,string>").withColumn("size", F.lit(1).cast("bigint"))
    return with_name_parts(df)


def test_absent_empty_and_null_fields_differ(spark):
    register_step("extractor", "own-map", lambda df: F.col("m") if "m" in df.columns else F.create_map(F.lit("a"), F.lit("b")))
    pipe = Pipeline.from_calls("own-map", ["case,a,upper", "pad_numbers,n"], "template,{a}-{n}")
    plan = pipe.plan(rows(spark))
    got = {r.old_name: (r.new_name, r.error) for r in plan.collect()}
    assert got == {
        "full.x": ("ONE-007.x", None), "empty.x": ("-.x", None), "null.x": ("None-005.x", None), "none.x": ("none.x", None),
        "no_fields.x": ("no_fields.x", None), "no_a.x": (None, "no field 'a' to convert; the fields are n"),
        "no_n.x": (None, "no field 'n' to convert; the fields are a, z")}
    assert {r.old_name: r.present for r in plan.collect()}["null.x"] == ["a", "n"]
    m = R.plan_metrics(plan).first()
    assert (m.files_found, m.errors) == (7, 2)
    assert "no_a.x" not in {r.old_name for r in R.plan_changes(plan).collect()}


def test_templates_by_row_and_new_fields(spark):
    # without converters: a placeholder that a row lacks stays, and its empty and NULL fields too
    got = {r.old_name: r.new_name for r in Pipeline.from_calls("own-map", template="template,{a}+{n}").plan(rows(spark)).collect()}
    assert got["no_n.x"] == "two+{n}.x" and got["no_a.x"] == "{a}+1.x" and got["null.x"] == "None+5.x" and got["empty.x"] == "+.x"
    register_step("converter", "twice", lambda f, t: f.withField("d", F.concat(f.getField("a"), f.getField("a"))), needs=["a"])
    plan = Pipeline.from_calls("own-map", ["twice", "case,d,upper"], "join,d,n").plan(rows(spark))
    got = {r.old_name: (r.new_name, r.error) for r in plan.collect()}
    assert got["full.x"] == ("ONEONE_7.x", None) and got["no_n.x"] == ("TWOTWO.x", None) and got["null.x"] == ("5.x", None)
    assert got["no_a.x"][1] == "no field 'a' to convert; the fields are n" and got["none.x"] == ("none.x", None)
    spec = {"pipeline": {"extractor": {"name": "own-map", "fields": ["z", "a"]}}}
    assert {r.old_name: r.new_name for r in from_plan(spark, spec).collect()}["no_n.x"] == "q_two.x"
    with pytest.raises(ValueError, match="names of its fields"):
        from_plan(spark, {"pipeline": {"extractor": "own-map"}})


def from_plan(spark, spec):
    return Pipeline.from_dict(spec).plan(rows(spark))
