"""M1-M7 template compiler."""

import pytest
from pyspark.sql import functions as F

from tabforge.functions.template import TemplateError, compile_template, describe, parse


def render(spark, tpl, row, schema, **kw):
    df = spark.createDataFrame([row], schema)
    return df.select(compile_template(tpl, columns=df.columns, **kw).alias("t")).first()[0]


def test_vanishing_sections(spark):
    schema = "name STRING, level INT"
    assert render(spark, "{{User: ;name;}} {{(Level ;level;)}}", ("admin", 5), schema) == "User: admin (Level 5)"
    assert render(spark, "{{User: ;name;}} {{(Level ;level;)}}", ("admin", None), schema) == "User: admin "
    assert render(spark, "{{User: ;name;}} {{(Level ;level;)}}", (None, None), schema) == " "


def test_styles_stripped_and_escape(spark):
    assert render(spark, "{{#red@bold;ERROR: ;message;}} \\{{x}}", ("Failed",), "message STRING") == "ERROR: Failed {{x}}"


def test_conditional_and_multi_param(spark):
    def is_profitable(revenue, costs):
        return revenue.cast("double") > costs.cast("double")
    tpl = "{{Company: ;company;}} {{?is_profitable; Profitable;revenue;}}"
    schema = "company STRING, revenue STRING, costs STRING"
    assert render(spark, tpl, ("T", "150", "100"), schema, functions=[is_profitable]) == "Company: T  Profitable150"
    assert render(spark, tpl, ("T", "50", "100"), schema, functions=[is_profitable]) == "Company: T "


def test_mandatory_flag_and_raise(spark):
    df = spark.createDataFrame([(None,)], "u STRING")
    text, err = compile_template("{{!u}} in", columns=df.columns, on_missing="flag")
    r = df.select(text.alias("t"), err.alias("e")).first()
    assert r.t == " in" and r.e == "missing mandatory field u"
    with pytest.raises(Exception):
        df.select(compile_template("{{!u}}", columns=df.columns)).collect()


def test_positional_and_errors(spark):
    df = spark.createDataFrame([("15", "27", "42")], "a STRING, b STRING, c STRING")
    assert df.select(compile_template("{{}} + {{}} = {{}}", positional=["a", "b", "c"])).first()[0] == "15 + 27 = 42"
    with pytest.raises(TemplateError):
        parse("{{a;b;c;d}}")
    with pytest.raises(TemplateError):
        parse("{{open")
    with pytest.raises(TemplateError):
        compile_template("{{}} {{a}}", positional=["a"])


def test_describe():
    d = describe("{{!user}} {{?f;x;level;}}")
    assert d["mandatory_fields"] == ["user"] and d["optional_fields"] == ["level"] and d["functions"] == ["f"]


def test_section_ends_after_an_inline_token(spark):
    def mark(v):
        return F.lit("*")
    schema = "a STRING"
    assert render(spark, "{{p;{$mark}a}}.", ("x",), schema, functions=[mark]) == "p*."
    assert render(spark, "{{p;a;{$mark}}}.", ("x",), schema, functions=[mark]) == "px*."


def test_header_transform_goes_before_the_first_part(spark):
    def icon(v):
        return F.concat(F.lit("<"), F.upper(v), F.lit(">"))
    assert render(spark, "{{$icon;status}}", ("up",), "status STRING", functions=[icon]) == "<UP>up"
    assert render(spark, "{{$icon;is ;status;!}}", ("up",), "status STRING", functions=[icon]) == "<UP>is up!"
    assert render(spark, "{{$icon;is ;status;!}}", (None,), "status STRING", functions=[icon]) == ""


def test_escapes_inside_sections(spark):
    assert render(spark, r"{{a\;b;x;\}\}}}", ("1",), "x STRING") == "a;b1}}"
    assert render(spark, "a;b}} {c", ("1",), "x STRING") == "a;b}} {c"
    with pytest.raises(TemplateError):
        parse("{{a {#red}b;x}}")
