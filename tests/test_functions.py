"""F/X/C/T/A operators: unit cases."""

from pyspark.sql import functions as F

from tabforge.functions import convert as C
from tabforge.functions import extract as X
from tabforge.functions import filters as FL
from tabforge.functions import naming as N
from tabforge.functions.text import glob_to_regex, strptime_to_spark, title_case


def one(spark, col, value="x"):
    return spark.createDataFrame([(value,)], "base_name STRING").select(col.alias("v")).first()[0]


def test_title_case_is_python_title(spark):
    df = spark.createDataFrame([("hr-data o'neil",), ("3rd quarter",), ("ÉCOLE été",)], "s STRING")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == ["hr-data o'neil".title(), "3rd quarter".title(), "ÉCOLE été".title()]


def test_glob_translation():
    import re
    rx = glob_to_regex("*_[!a]?.pdf")
    assert re.match(rx.replace("(?s)", ""), "x_b1.pdf")
    assert not re.match(rx.replace("(?s)", ""), "x_a1.pdf")


def test_strptime_translation():
    assert strptime_to_spark("%Y-%m-%d") == "yyyy-MM-dd"
    assert strptime_to_spark("%d %B %Y at %H") == "dd MMMM yyyy' at 'HH"


def test_split_missing_parts(spark):
    v = one(spark, X.x_split("_", "dept", "type", "year"), "HR_employee")
    assert v.asDict() == {"dept": "HR", "type": "employee", "year": ""}


def test_regex_named_and_no_match(spark):
    f = X.x_regex(r"(?P<dept>[A-Z]+)_(?P<year>\d{4})")
    assert one(spark, f, "HR_2024_x").asDict() == {"dept": "HR", "year": "2024"}
    assert one(spark, f, "nothing") is None


def test_position_spec(spark):
    v = one(spark, X.x_position("0-1:a", "3:b", "50-60:c"), "HR_x")
    assert v.asDict() == {"a": "HR", "b": "x", "c": ""}


def test_pad_numbers(spark):
    s = F.struct(F.col("base_name").alias("v"))
    pad = lambda x: one(spark, C.c_pad_numbers(s, "v", 3).getField("v"), x)
    assert pad("v1") == "v001"
    assert pad("document_v12") == "document_v012"
    assert pad("a1b2") == "a1b2"  # non-contiguous digits: unchanged
    assert pad("12345") == "12345"


def test_date_format_unparsable_kept(spark):
    s = F.struct(F.col("base_name").alias("d"))
    conv = lambda x: one(spark, C.c_date_format(s, "d", "%Y%m%d", "%Y-%m-%d").getField("d"), x)
    assert conv("20240315") == "2024-03-15"
    assert conv("2024-03-15") == "2024-03-15"
    assert conv("garbage") == "garbage"


def test_template_missing_fields_verbatim(spark):
    df = spark.createDataFrame([("x", "HR", "", "2024")], "base_name STRING, dept STRING, type STRING, year STRING")
    df = df.select("base_name", F.struct("dept", "type", "year").alias("fields"))
    ft = df.schema["fields"].dataType
    assert df.select(N.t_template("{dept}_{type}_{year}", fields_type=ft)).first()[0] == "HR__2024"
    assert df.select(N.t_template("{dept}_{type}_{nope}", fields_type=ft)).first()[0] == "HR_{type}_{nope}"


def test_join_skips_empty_and_falls_back(spark):
    df = spark.createDataFrame([("stem", "HR", "", "2024")], "base_name STRING, a STRING, b STRING, c STRING")
    df = df.select("base_name", F.struct("a", "b", "c").alias("fields"))
    ft = df.schema["fields"].dataType
    assert df.select(N.t_join(fields_type=ft)).first()[0] == "HR_2024"
    assert df.select(N.t_join("b", fields_type=ft)).first()[0] == "stem"


def test_clean_and_replace(spark):
    assert one(spark, N.a_clean("_"), "  Hello   World!! (v2).final ") == "Hello_World_v2_final"
    assert one(spark, N.a_clean("_"), "café déjà") == "café_déjà"
    assert one(spark, N.a_clean("_"), "!!!") == "!!!"
    assert one(spark, N.a_replace("a", "b", "bb", "c"), "aab") == "cb"


def test_filters(spark):
    df = spark.createDataFrame([("a.PDF", ".PDF", 2048, "abcde")], "file_name STRING, extension STRING, size BIGINT, base_name STRING")
    assert df.filter(FL.f_file_type("pdf")).count() == 1
    assert df.filter(FL.f_file_size("1KB", "2KB")).count() == 1
    assert df.filter(FL.f_pattern("*.pdf")).count() == 0  # case-sensitive like POSIX fnmatch
    assert df.filter(FL.invert(FL.f_name_length(10))).count() == 1


def test_hash_sequence_matches_md5(spark):
    import hashlib
    name = "report"
    want = f"{name}_{int(hashlib.md5(name.encode()).hexdigest()[:4], 16) % 1000:03d}"
    assert one(spark, N.t_hash_sequence("base_name"), name) == want


def test_quarter_of(spark):
    assert one(spark, C.quarter_of("base_name", "none"), "20240815") == "2024-Q3"
    assert one(spark, C.quarter_of("base_name", "none"), "031524") == "2024-Q1"
    assert one(spark, C.quarter_of("base_name", "none"), "x") == "none"
