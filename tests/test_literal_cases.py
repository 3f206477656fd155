"""Expectations written out by hand for the operators that work by tables and patterns (the oracles share those tables)."""

import pytest
from pyspark.sql import functions as F

from tabforge.functions import convert as C
from tabforge.functions import extract as X
from tabforge.functions import logfmt as L
from tabforge.functions import naming as N


def one(spark, col, value="x"):
    return spark.createDataFrame([(value,)], "base_name STRING").select(col.alias("v")).first()[0]


@pytest.mark.parametrize("name,want", [
    ("ACME_HR_policy_draft_20240115", dict(client="Acme", dept="Hr", doc_type="Policy", status="Draft", date="20240115", version=None, description=None)),
    ("globalcorp_legal_contract_v2.1_final", dict(client="Globalcorp", dept="Legal", doc_type="Contract", version="2.1", status="Final", date=None, description=None)),
    ("acme_invoice_march-order_202403", dict(client="Acme", doc_type="Invoice", description="March-Order", date="202403", dept=None, status=None, version=None)),
    ("acme-notes-long_story", dict(client="Acme", doc_type="Notes", description="Long Story", dept=None, status=None, date=None, version=None)),
    ("solo", dict(client="Solo", doc_type="Document", description="General", dept=None, status=None, date=None, version=None)),
])
def test_corporate_names(spark, name, want):
    assert one(spark, X.x_corporate(), name).asDict() == want


@pytest.mark.parametrize("client,tier", [("MegaSoft", "enterprise"), ("Global Tech", "enterprise"), ("techlabs", "startup"), ("acme", "standard")])
def test_client_tiers(spark, client, tier):
    assert one(spark, C.client_tier("base_name"), client) == tier


def test_optional_groups_are_null(spark):
    f = X.x_regex(r"(?P<dept>[A-Z]+)(?:_(?P<num>\d+))?(?P<rest>x*)")
    assert one(spark, f, "HR_12xx").asDict() == {"dept": "HR", "num": "12", "rest": "xx"}
    assert one(spark, f, "HR").asDict() == {"dept": "HR", "num": None, "rest": ""}
    either = X.x_regex(r"^(?:a(\d*)|b([(\d]*))$", field1="a", field2="b")
    assert one(spark, either, "a").asDict() == {"a": "", "b": None} and one(spark, either, "b(1").asDict() == {"a": None, "b": "(1"}
    back = X.x_regex(r"(x)?(\w)\2(?:-(\d))?", field1="x", field2="w", field3="n")
    assert one(spark, back, "..aa").asDict() == {"x": None, "w": "a", "n": None}
    assert one(spark, back, "xbb-7").asDict() == {"x": "x", "w": "b", "n": "7"}


def test_split_and_position_of_the_known_examples(spark):
    assert one(spark, X.x_split("_", "dept", "type", "category", "year", "extra"), "HR_employee_data_2024").asDict() == {
        "dept": "HR", "type": "employee", "category": "data", "year": "2024", "extra": ""}
    assert one(spark, X.x_split("-", "dept", "type"), "nodasheshere").asDict() == {"dept": "nodasheshere", "type": ""}
    assert one(spark, X.x_position("0-3:part1", "10-15:part2"), "short").asDict() == {"part1": "shor", "part2": ""}


def test_padding_dates_and_cases_of_the_known_examples(spark):
    s = F.struct(F.col("base_name").alias("v"))
    pad = lambda x: one(spark, C.c_pad_numbers(s, "v", 3).getField("v"), x)
    assert [pad(x) for x in ("5", "12345", "abc123def", "rev3")] == ["005", "12345", "abc123def", "rev003"]
    date = lambda x: one(spark, C.c_date_format(s, "v", "%Y%m%d", "%m/%d/%Y").getField("v"), x)
    assert [date(x) for x in ("20240115", "invalid-date", "")] == ["01/15/2024", "invalid-date", ""]
    case = lambda k, x: one(spark, C.c_case(s, "v", k).getField("v"), x)
    assert [case("title", "human resources"), case("capitalize", "human resources"), case("lower", "HR"), case("upper", "")] == [
        "Human Resources", "Human resources", "hr", ""]
    with pytest.raises(ValueError):
        C.c_case(s, "v", "sideways")


def test_emptied_and_missing_fields(spark):
    df = spark.createDataFrame([("a", "b", "", "d")], "x STRING, y STRING, z STRING, w STRING")
    df = df.select(F.struct("x", "y", "z", "w").alias("f"))
    df = df.withColumn("g", F.struct(F.lit("").alias("x"), F.col("f.y").alias("y"), F.lit(None).cast("string").alias("z"), F.lit("n").alias("v")))
    kinds = df.schema["f"].dataType, df.schema["g"].dataType
    assert df.select(C.emptied_fields("f", "g", *kinds)).first()[0] == ["x"]
    assert C.check_fields(*kinds) == {"removed": ["w"], "added": ["v"]}


@pytest.mark.parametrize("seconds,want", [(0.0000005, "0μs"), (0.0004, "400μs"), (0.25, "250.0ms"), (2.345, "2.35s"), (61.5, "1m1.5s"), (None, None)])
def test_durations(spark, seconds, want):
    assert spark.createDataFrame([(seconds,)], "d DOUBLE").select(L.format_duration("d")).first()[0] in (want, "1μs" if want == "0μs" else want)


def test_log_line_with_and_without_context(spark):
    df = spark.createDataFrame([("INFO", "2024-01-02 03:04:05", "app", "done", 7, "r1", 6.5, 3, 1, 12), ("WARN", "2024-01-02 03:04:05", "app", "so", *[None] * 6)],
                               "level STRING, t STRING, name STRING, message STRING, u INT, r STRING, d DOUBLE, f INT, e INT, m INT")
    line = L.log_line(time=F.to_timestamp("t"), user_id="u", request_id="r", duration="d", file_count="f", error_count="e", memory_mb="m")
    assert [r[0] for r in df.select(line).collect()] == [
        "[INFO] 2024-01-02 03:04:05 app (User: 7) [Req: r1] done in 6.50s 3 files) - 1 error12MB] ⚠️ SLOW 6.5", "[WARN] 2024-01-02 03:04:05 app so"]
    assert [r[0] for r in df.select(L.log_line(time=F.to_timestamp("t"))).collect()][0] == "[INFO] 2024-01-02 03:04:05 app done"


def test_phases(spark):
    from tabforge.operators.opstats import pair_operations
    rows = [("a", "2024-01-01 00:00:00", "start", 1.0), ("a", "2024-01-01 00:00:05", "end", 4.0), ("b", "2024-01-01 00:00:01", "start", 1.0),
            ("c", "2024-01-01 00:00:01", "end", 1.0), ("d", "2024-01-01 00:00:09", "start", 1.0), ("d", "2024-01-01 00:00:01", "end", 1.0)]
    df = spark.createDataFrame(rows, "op STRING, t STRING, phase STRING, m DOUBLE").withColumn("t", F.to_timestamp("t"))
    got = {r.op: (r.duration, r.memory_delta_mb, r.status) for r in pair_operations(df, "op", "t", memory="m", phase="phase").collect()}
    assert got == {"a": (5.0, 3.0, "completed"), "b": (None, None, "open"), "d": (None, None, "open")}


def test_clean_of_the_known_examples(spark):
    assert one(spark, N.a_clean("_"), "Report (final) v2!") == "Report_final_v2"
