"""H1-H8 unit cases."""

from pyspark.sql import functions as F

from tabforge.operators import harmonize as H


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`First Name` INT, `Last Name` INT")
    assert H.normalize_columns(df).columns == ["first_name", "last_name"]
    assert H.normalize_columns(df, to_lower=False).columns == ["First_Name", "Last_Name"]
    assert H.normalize_columns(df, spaces_to_underscores=False).columns == ["first name", "last name"]


def test_schema_map_both_forms_and_coalesce(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "`Full Name` STRING, customer_name STRING")
    m = {"name": ["Full Name", "customer_name"]}
    out = H.apply_schema_map(df, m)
    assert out.columns == ["name"]
    assert [r.name for r in out.collect()] == ["a", "b"]
    typed = {"name": {"type": "object", "aliases": ["Full Name", "customer_name"]}}
    assert H.apply_schema_map(df, typed).columns == ["name"]


def test_split_name_cases(spark):
    rows = [("John Doe",), ("  John   Doe  ",), ("",), (None,), ("Jane",)]
    df = spark.createDataFrame(rows, "name STRING")
    out = [tuple(r) for r in H.split_name(df).collect()]
    assert out == [("John", "Doe"), ("", " John   Doe  "), ("", None), (None, None), ("Jane", None)]


def test_split_name_keeps_existing_first_name(spark):
    df = spark.createDataFrame([("A B", None)], "name STRING, first_name STRING")
    out = H.split_name(df)
    assert sorted(out.columns) == ["first_name", "last_name"]
    r = out.first()
    assert (r.first_name, r.last_name) == (None, "B")
    r = H.split_name(df, fill_gaps=True).first()
    assert (r.first_name, r.last_name) == ("A", "B")


def test_merge_types_lattice():
    assert H.merge_types(None, "int64") == "int64"
    assert H.merge_types("int64", "float64") == "float64"
    assert H.merge_types("int64", "object") == "object"
    assert H.merge_types("bool", "datetime64[ns]") == "bool"
    assert H.merge_types("weird", "int64") == "object"


def test_profile_and_conflicting_types(spark):
    a = spark.createDataFrame([("1", "1.5"), ("2", "2.5")], "id STRING, value STRING")
    b = spark.createDataFrame([("x", "3"), ("y", "4")], "id STRING, value STRING")
    merged = H.merge_schemas([H.profile_types(a), H.profile_types(b)])
    assert merged == {"id": "object", "value": "float64"}


def test_union_with_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id BIGINT, name STRING")
    b = spark.createDataFrame([(2, 3.5)], "id BIGINT, value DOUBLE")
    out = H.union_tables([a, b]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, 3.5)]


def test_union_sheets_tags_sheet_name(spark):
    a = spark.createDataFrame([(1,)], "`Order ID` BIGINT")
    b = spark.createDataFrame([(2,)], "`order id` BIGINT")
    out = H.union_sheets({"Jan": a, "Feb": b}).orderBy("order_id").collect()
    assert [(r.order_id, r.sheet_name) for r in out] == [(1, "Jan"), (2, "Feb")]


def test_align_to_schema_try_cast(spark):
    df = spark.createDataFrame([("12", "abc")], "id STRING, extra STRING")
    out = H.align_to_schema(df, {"id": "int64", "missing": "float64"})
    assert out.columns == ["id", "missing"]
    assert tuple(out.first()) == (12, None)
    bad = spark.createDataFrame([("x",)], "id STRING")
    assert H.align_to_schema(bad, {"id": "int64"}).first()[0] is None
