"""JSON folder scans.

Every file is one JSON document. A document is scanned as pieces between commas, so one large file is read by many
tasks. What a piece does to a reader is a function of whether it begins inside a string, and a change of bracket depth;
both are composed inside each split and then over the table of splits (as for CSV quotes). A piece that begins outside
strings at the depth of the root's elements begins an element; only the pieces of one element are grouped.

* array root (S5): each element is a row.
* object root (S6): every array-valued key is a "sheet"; its elements are rows tagged with ``sheet_name``; other keys
  are ignored.
* one-level flatten (S7): object fields of a row are lifted into the row; deeper objects and arrays stay JSON text.

Elements are parsed to VARIANT, so keys and types are those of each file and sheet: no other file's value changes how
a key is read, and keys that differ in case stay apart until names are normalised (H1).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import write_and_read
from . import folder as S
from .quoted import composed

STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
IN_STRING = r'^[^"\\]*+(?:\\.[^"\\]*+)*+'
KEY = r'^\s*("[^"\\]*+(?:\\.[^"\\]*+)*+")\s*:\s*'


def _json_text(c, kind: T.DataType):
    """Scalars as they are, deeper values as JSON text, whole numbers as long, others as double."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return c.cast("double")
    return c


def flatten_one_level(df: DataFrame) -> DataFrame:
    """S7 for any DataFrame: object fields lifted one level, a later name replaces an earlier one."""
    out: dict = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for sub in f.dataType.fields:
                out.pop(sub.name, None)
                out[sub.name] = _json_text(F.col(f"`{f.name}`").getField(sub.name), sub.dataType)
        else:
            out.pop(f.name, None)
            out[f.name] = _json_text(F.col(f"`{f.name}`"), f.dataType)
    return df.select(*[c.alias(n) for n, c in out.items()])


def _effect(text: Column) -> tuple[Column, Column]:
    """(ends inside a string, change of depth) of a text that begins outside strings."""
    bare = F.regexp_replace(text, STRING, "")
    out = F.regexp_replace(bare, r'(?s)".*$', "")
    n = lambda chars: F.length(out) - F.length(F.translate(out, chars, ""))
    return F.contains(bare, F.lit('"')).cast("int"), (n("[{") - n("]}")).cast("int")


def _pieces(spark: SparkSession, root: str, root_uri: str, recursive: bool, options: Mapping) -> DataFrame:
    """All files' pieces: source_file, blk, mid, piece, st (begins inside a string), depth (at its begin), first, last."""
    reader = spark.read.format("text").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", S.ext_glob("json")).option("lineSep", ",")
    if options.get("encoding"):
        reader = reader.option("encoding", options["encoding"])
    rows = (reader.load(root).select("value", "_metadata")
            .select(S.relative_path(F.col("_metadata.file_path"), root_uri).alias("source_file"), F.col("_metadata.file_block_start").alias("blk"),
                    F.monotonically_increasing_id().alias("mid"), F.regexp_replace("value", "^\ufeff", "").alias("piece")))
    rows = rows.withColumn("stays", F.col("piece").rlike(IN_STRING + r"\\?$")).withColumn("rest", F.when(F.col("stays"), "").otherwise(
        F.regexp_replace("piece", IN_STRING + '"', "")))
    (e0, d0), (e1, d1) = _effect(F.col("piece")), _effect(F.col("rest"))
    rows = rows.withColumns({"e0": e0, "e1": F.when(F.col("stays"), 1).otherwise(e1), "d0": d0, "d1": d1}).drop("stays", "rest")
    rows = write_and_read(composed(rows, ["source_file", "blk"], "mid", "e0", "e1"), "json-pieces")
    pick = lambda p, a, b: F.when(F.col(p) == 0, F.col(a)).otherwise(F.col(b))
    splits = rows.groupBy("source_file", "blk").agg(
        F.max_by(pick("p0", "e0", "e1"), "mid").alias("e0"), F.max_by(pick("p1", "e0", "e1"), "mid").alias("e1"),
        F.sum(pick("p0", "d0", "d1")).alias("t0"), F.sum(pick("p1", "d0", "d1")).alias("t1"), F.min("mid").alias("lo"), F.max("mid").alias("hi"))
    over = Window.partitionBy("source_file").orderBy("blk")
    splits = composed(splits, ["source_file"], "blk", "e0", "e1").withColumn("d", pick("p0", "t0", "t1"))
    splits = splits.select("source_file", "blk", F.col("p0").alias("begins"), F.coalesce(F.sum("d").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"),
                           F.when(F.lag("blk").over(over).isNull(), F.col("lo")).alias("lo"), F.when(F.lead("blk").over(over).isNull(), F.col("hi")).alias("hi"))
    rows = rows.join(write_and_read(splits, "json-splits"), ["source_file", "blk"])
    rows = rows.withColumn("st", pick("begins", "p0", "p1")).withColumn("d", pick("st", "d0", "d1"))
    up = Window.partitionBy("source_file", "blk").orderBy("mid").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("source_file", "blk", "mid", "piece", "st", (F.col("above") + F.coalesce(F.sum("d").over(up), F.lit(0))).alias("depth"), "d",
                       pick("st", "e0", "e1").alias("en"), F.coalesce(F.col("mid") == F.col("lo"), F.lit(False)).alias("first"),
                       F.coalesce(F.col("mid") == F.col("hi"), F.lit(False)).alias("last"))


def _carried(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds ``name``: the last non-null ``value`` of the file at or before each row, over its splits."""
    inside = Window.partitionBy("source_file", "blk").orderBy("mid")
    rows = rows.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
    ends = rows.groupBy("source_file", "blk").agg(F.max_by("_own", "mid").alias("_end"))
    before = Window.partitionBy("source_file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("source_file", "blk", F.last("_end", ignorenulls=True).over(before).alias("_before"))
    return rows.join(ends, ["source_file", "blk"]).withColumn(name, F.coalesce("_own", "_before")).drop("_own", "_before")


def _flat(v: str) -> str:
    """A variant element as an array of (k, t, x): key, type and text, object fields lifted one level; of a name that stands
    twice the last."""
    def entry(k, e):
        kind = f"schema_of_variant({e})"
        return f"named_struct('k', {k}, 't', {kind}, 'x', if(startswith({kind}, 'OBJECT') OR startswith({kind}, 'ARRAY'), to_json({e}), CAST({e} AS STRING)))"
    entries = lambda e: f"map_entries(CAST({e} AS MAP<STRING, VARIANT>))"
    lifted = (f"flatten(transform({entries(v)}, f -> if(startswith(schema_of_variant(f.value), 'OBJECT'), "
              f"transform({entries('f.value')}, g -> {entry('g.key', 'g.value')}), array({entry('f.key', 'f.value')}))))")
    once = "filter({0}, (e, i) -> NOT exists(slice({0}, i + 2, size({0})), o -> o.k = e.k))"
    return f"if(startswith(schema_of_variant({v}), 'OBJECT'), {lifted}, array({entry(repr('value'), v)}))", once


def json_elements(spark: SparkSession, root: str, root_uri: str, recursive: bool = True, object_root: bool | None = None,
                  options: Mapping | None = None) -> tuple[DataFrame, DataFrame] | None:
    """(elements, files) of all .json files, written; None where there is none.

    elements: source_file, sheet_name (null for array roots), blk, mid (without gaps in a split), flat (array of key, type
    and text). files: source_file, failed, rows; a file fails as a whole if its brackets or strings don't end, its root
    is neither array nor object, or an element can't be parsed. Empty files and empty roots have no rows and are ok.
    """
    listed = S.files_of(spark, root, "json", recursive)
    if listed is None:
        return None
    opts = S.filter_options(options, S.JSON_OPTION_ALIASES)
    rows = _pieces(spark, root, root_uri, recursive, opts)
    trimmed = F.when(F.col("first"), F.ltrim(F.regexp_replace("piece", r"^\s+", ""))).otherwise(F.col("piece"))
    rows = write_and_read(rows.withColumn("piece", trimmed), "json-depths")
    files = rows.groupBy("source_file").agg(F.max(F.when(F.col("first"), F.substring("piece", 1, 1))).alias("root"),
                                            F.max(F.when(F.col("last"), F.col("depth") + F.col("d"))).alias("left"), F.max(F.when(F.col("last"), F.col("en"))).alias("en"),
                                            F.max(F.when(F.col("last"), F.regexp_extract("piece", r"([\]}])\s*$", 1))).alias("closing"),
                                            F.min(F.when(~F.col("last"), F.col("depth") + F.col("d"))).alias("low"))
    sound = (F.col("left") == 0) & (F.col("en") == 0) & (F.coalesce("low", F.lit(1)) > 0) & F.concat("root", "closing").isin("[]", "{}")
    files = write_and_read(files.select("source_file", "root", (F.col("root") == "").alias("empty"), F.coalesce(sound, F.lit(False)).alias("sound")), "json-roots")
    rows = rows.join(files.where("sound").select("source_file", "root"), "source_file")
    kind = F.lit("{" if object_root else "[") if object_root is not None else F.col("root")
    rows = rows.where(F.col("root") == kind)

    # a member's name may hold commas: its pieces become one
    within = (F.col("root") == "{") & (F.col("st") == 1) & (F.col("depth") == 1)
    if not rows.where(within).isEmpty():
        rows = _carried(rows, "_h", F.when(~within, F.struct("blk", "mid")))
        open_ = rows.where(within).select("source_file", "_h").distinct()
        parts = rows.join(open_, ["source_file", "_h"], "left_semi")
        joined = parts.groupBy("source_file", "_h").agg(
            F.min("blk").alias("blk"), F.min("mid").alias("mid"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("blk", "mid", "piece"))), lambda x: x["piece"]), ",").alias("piece"),
            F.min("st").alias("st"), F.min_by("depth", F.struct("blk", "mid")).alias("depth"), F.max("first").alias("first"), F.max("last").alias("last"), F.max("root").alias("root"))
        cols = ["source_file", "blk", "mid", "piece", "st", "depth", "first", "last", "root"]
        rows = write_and_read(rows.join(open_, ["source_file", "_h"], "left_anti").select(*cols).unionByName(joined.select(*cols)), "json-members")

    # the root's brackets go; what is left at depth 1 are elements or members
    body = F.when(F.col("first"), F.substring("piece", 2, 1 << 30)).otherwise(F.col("piece"))
    rows = rows.withColumn("piece", body).withColumn("piece", F.when(F.col("last"), F.regexp_replace("piece", r"[\]}]\s*$", "")).otherwise(F.col("piece")))
    top = F.col("first") | ((F.col("st") == 0) & (F.col("depth") == 1))
    member = F.when(top & (F.col("root") == "{"), F.struct(F.regexp_extract("piece", KEY, 1).alias("key"), F.col("piece").rlike(KEY + r"\[").alias("list"), "blk", "mid"))
    rows = _carried(rows, "member", member)
    start = top | ((F.col("root") == "{") & (F.col("st") == 0) & (F.col("depth") == 2) & F.col("member.list"))
    rows = rows.withColumn("piece", F.when(top & F.col("member.list"), F.regexp_replace("piece", KEY + r"\[", "")).otherwise(F.col("piece")))
    rows = _carried(rows, "at", F.when(start, F.struct("blk", "mid")))
    rows = rows.where("root = '[' OR member.list")
    texts = (rows.groupBy("source_file", "at", "member").agg(F.sort_array(F.collect_list(F.struct("blk", "mid", "piece"))).alias("parts"))
             .select("source_file", "at", "member", F.array_join(F.transform("parts", lambda x: x["piece"]), ",").alias("text")))
    # the last element of a sheet ends with the sheet's bracket
    texts = write_and_read(texts, "json-texts")
    final = texts.where("member IS NOT NULL").groupBy("source_file", "member").agg(F.max("at").alias("at")).withColumn("closes", F.lit(True))
    texts = texts.join(final.drop("member"), ["source_file", "at"], "left")
    texts = texts.withColumn("text", F.when(F.col("closes"), F.regexp_replace("text", r"\]\s*$", "")).otherwise(F.col("text")))
    ones = texts.groupBy("source_file", "member").agg(F.count(F.lit(1)).alias("n"))
    texts = texts.join(ones, texts["source_file"].eqNullSafe(ones["source_file"]) & texts["member"].eqNullSafe(ones["member"])).select(texts["*"], "n")
    texts = texts.where(~((F.regexp_replace("text", r"\s+", "") == "") & (F.col("n") == 1)))  # an empty array
    flat, once = _flat("v")
    out = texts.withColumn("v", F.expr("try_parse_json(text)")).withColumn("flat", F.expr(flat))
    names = F.expr("try_variant_get(try_parse_json(member.key), '$', 'string')")
    number = Window.partitionBy("source_file", "at.blk").orderBy("at.mid")
    out = out.select("source_file", names.alias("sheet_name"), F.col("at.blk").alias("blk"), F.row_number().over(number).cast("long").alias("mid"),
                     F.expr(once.format("flat")).alias("flat"), F.col("v").isNull().alias("failed"))
    out = write_and_read(out, "json-elements")
    count = out.groupBy("source_file").agg(F.max("failed").alias("bad"), F.count(F.lit(1)).alias("n"))
    status = (listed.select(S.relative_path(F.col("path"), root_uri).alias("source_file")).distinct().join(files, "source_file", "left").join(count, "source_file", "left")
              .select("source_file", (F.coalesce(~F.col("sound") & ~F.col("empty"), F.lit(False)) | F.coalesce("bad", F.lit(False))).alias("failed"),
                      F.coalesce("n", F.lit(0)).cast("long").alias("rows")))
    return out.where("NOT failed").drop("failed"), status


#: Type of a column by the types of its values; anything else is text.
LONG, DOUBLE, BOOLEAN = {"BIGINT"}, {"BIGINT", "DOUBLE", "FLOAT", "DECIMAL"}, {"BOOLEAN"}


def _column_type(kinds: set[str]) -> str:
    kinds = {k.split("(")[0].split("<")[0] for k in kinds} - {"VOID"}
    for known, name in ((LONG, "bigint"), (DOUBLE, "double"), (BOOLEAN, "boolean")):
        if kinds and kinds <= known:
            return name
    return "string"


def json_frames(spark: SparkSession, root: str, root_uri: str, recursive: bool = True, object_root: bool | None = None,
                options: Mapping | None = None) -> tuple[DataFrame | None, list[tuple[DataFrame, list[str]]]]:
    """(status rows, [(frame, data columns)]): one frame for each set of keys that a file's array or a sheet has.
    ``object_root`` fixes the kind for all files (None: as each file's root is); files of the other kind have no rows."""
    found = json_elements(spark, root, root_uri, recursive, object_root, options)
    if found is None:
        return None, []
    elements, status = found
    keys = elements.select("source_file", "sheet_name", F.explode("flat").alias("e")).groupBy("source_file", "sheet_name", "e.k").agg(F.collect_set("e.t").alias("t"))
    keys = write_and_read(keys, "json-keys")
    sets = keys.groupBy("source_file", "sheet_name").agg(F.sort_array(F.collect_set("k")).alias("names")).withColumn("layout", F.xxhash64("names"))
    sets = write_and_read(sets, "json-layouts")
    same = lambda a, b: (a["source_file"] == b["source_file"]) & a["sheet_name"].eqNullSafe(b["sheet_name"])
    kinds: dict = {}
    for r in keys.join(sets, same(keys, sets)).groupBy("layout", "k").agg(F.array_distinct(F.flatten(F.collect_set("t"))).alias("t")).collect():
        kinds.setdefault(r["layout"], {})[r["k"]] = _column_type(set(r["t"]))
    primitive = str(S.filter_options(options, S.JSON_OPTION_ALIASES).get("primitivesAsString", "false")) == "true"
    rows = elements.join(sets, same(elements, sets), "left").select(elements["*"], "layout").withColumn("m", F.map_from_entries(F.transform("flat", lambda e: F.struct(e["k"], e["x"]))))
    frames = []
    for r in sets.groupBy("layout").agg(F.first("names").alias("names"), F.min("source_file").alias("f"), F.max(F.col("sheet_name").isNotNull()).alias("sheets")).orderBy("f").collect():
        names = list(r["names"])
        cells = [F.try_element_at("m", F.lit(n)).try_cast("string" if primitive else kinds[r["layout"]][n]).alias(f"c{i}") for i, n in enumerate(names)]
        sheet = [F.col("sheet_name")] if r["sheets"] else []
        frames.append((rows.where(F.col("layout") == r["layout"]).select(*cells, *sheet, "source_file", F.col("source_file").alias("__file"),
                                                                        F.col("blk").alias("__blk"), F.col("mid").alias("__mid")), names))
    return status, frames
