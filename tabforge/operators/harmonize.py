"""Schema harmonisation.

Header work (normalise, alias, split) is plan-time renaming on the driver
plus Column expressions; nothing here touches rows in Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the type lattice (most permissive first) -----------------
# object > float64 > int64 > bool > datetime64[ns]; unknown labels count as object.
TYPE_ORDER = ["object", "float64", "int64", "bool", "datetime64[ns]"]
SPARK_TYPE = {
    "object": T.StringType(),
    "float64": T.DoubleType(),
    "int64": T.LongType(),
    "bool": T.BooleanType(),
    "datetime64[ns]": T.TimestampType(),
}


def normalize_name(name: str, to_lower: bool = True, spaces_to_underscores: bool = True) -> str:
    """H1 rule for one header: optional lower-case, optional ' ' -> '_'."""
    if to_lower:
        name = name.lower()
    if spaces_to_underscores:
        name = name.replace(" ", "_")
    return name


def normalize_columns(df: DataFrame, to_lower: bool = True, spaces_to_underscores: bool = True) -> DataFrame:
    """H1: rename every column with the normalisation switches."""
    return df.toDF(*[normalize_name(c, to_lower, spaces_to_underscores) for c in df.columns])


def _aliases(spec) -> list[str]:
    # Q4: accept {std: [alts]} and {std: {"type": t, "aliases": [alts]}}.
    if isinstance(spec, Mapping):
        return list(spec.get("aliases", []))
    if isinstance(spec, str):
        return [spec]
    return list(spec)


def schema_map_types(schema_map: Mapping | None) -> dict[str, str]:
    """Types declared in the typed alias form (Q5: kept apart from aliases)."""
    out = {}
    for std, spec in (schema_map or {}).items():
        if isinstance(spec, Mapping) and "type" in spec:
            out[std] = spec["type"]
    return out


def rename_plan(columns: Sequence[str], schema_map: Mapping | None, to_lower: bool = True,
                spaces_to_underscores: bool = True) -> list[tuple[str, list[str]]]:
    """Driver-side: map normalised columns to output names.

    Returns ``[(output_name, [source columns in priority order])]`` preserving the
    first position at which an output appears. Several sources for one output
    are combined with ``coalesce`` (Q3).
    """
    norm = [normalize_name(c, to_lower, spaces_to_underscores) for c in columns]
    target: dict[str, str] = {}
    priority: dict[str, int] = {}
    for std, spec in (schema_map or {}).items():
        for rank, alt in enumerate(_aliases(spec)):
            key = normalize_name(alt, to_lower, spaces_to_underscores)
            if key not in target:
                target[key] = std
                priority[key] = rank + 1
    out: dict[str, list[tuple[int, int, str]]] = {}
    order: list[str] = []
    for pos, (raw, n) in enumerate(zip(columns, norm)):
        name = target.get(n, n)
        prio = 0 if name == n and n not in target else priority.get(n, 0)
        if name not in out:
            out[name] = []
            order.append(name)
        out[name].append((prio, pos, raw))
    return [(name, [raw for _, _, raw in sorted(out[name])]) for name in order]


def apply_schema_map(df: DataFrame, schema_map: Mapping | None = None, to_lower: bool = True,
                     spaces_to_underscores: bool = True) -> DataFrame:
    """H1+H2: normalise headers, rename aliases to standard names (coalesce duplicates)."""
    plan = rename_plan(df.columns, schema_map, to_lower, spaces_to_underscores)
    cols = []
    for name, sources in plan:
        c = F.col(f"`{sources[0]}`") if len(sources) == 1 else F.coalesce(*[F.col(f"`{s}`") for s in sources])
        cols.append(c.alias(name))
    return df.select(*cols)


def split_name(df: DataFrame, col: str = "name", first: str = "first_name", last: str = "last_name",
               fill_gaps: bool = False) -> DataFrame:
    """H3: split ``name`` on the first space into first/last, drop ``name``.

    A target column that already exists is kept as is (Q1), unless
    ``fill_gaps`` asks to fill its nulls from the split. ``last_name`` is
    always added (Q2), NULL where there is no space.
    """
    if col not in df.columns:
        return df
    parts = F.split(F.col(col), " ", 2)
    split_first, split_last = F.get(parts, 0), F.get(parts, 1)
    out = []
    for c in df.columns:
        if c == col:
            if first not in df.columns:
                out.append(split_first.alias(first))
            if last not in df.columns:
                out.append(split_last.alias(last))
            continue
        if fill_gaps and c == first:
            out.append(F.coalesce(F.col(c), split_first).alias(c))
        elif fill_gaps and c == last:
            out.append(F.coalesce(F.col(c), split_last).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


# --- H5: type lattice ---------------------------------------------------------

def merge_types(existing: str | None, new: str) -> str:
    """H5: most permissive of two dtype labels (unknown = object; Q6 kept)."""
    if existing is None:
        return new
    a = TYPE_ORDER.index(existing) if existing in TYPE_ORDER else 0
    b = TYPE_ORDER.index(new) if new in TYPE_ORDER else 0
    return TYPE_ORDER[min(a, b)]


def merge_schemas(schemas: Iterable[Mapping[str, str]]) -> dict[str, str]:
    """Merge ``{column: dtype label}`` dicts; column order = first appearance."""
    out: dict[str, str] = {}
    for s in schemas:
        for c, t in s.items():
            out[c] = merge_types(out.get(c), t)
    return out


def label_of(dt: T.DataType) -> str:
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float64"
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "int64"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime64[ns]"
    return "object"


def spark_type(label: str) -> T.DataType:
    return SPARK_TYPE.get(label, T.StringType())


def to_struct(types: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, spark_type(t), True) for c, t in types.items()])


#: Text that is a decimal number. Casts alone would also take suffixes ('12D') that are no numbers.
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?(inf|infinity|nan)$"


def _label(n: int, b: int, i: int, d: int) -> str:
    if n == 0:
        return "object"
    return "bool" if b == n else "int64" if i == n else "float64" if d == n else "object"


def profile_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Infer a dtype label per string column in ONE aggregate pass.

    Rule: a column is ``bool`` if every non-null value is true/false, ``int64``
    if every non-null value is a whole number of 64 bits, ``float64`` if a decimal
    number, ``object`` otherwise; an all-null column is ``object``. Non-string
    columns keep their own type.
    """
    return profile_many([df], [list(columns or df.columns)])[0]


def profile_many(dfs: Sequence[DataFrame], columns: Sequence[Sequence[str]]) -> list[dict[str, str]]:
    """:func:`profile_types` for several frames in ONE job (one single-row aggregate per frame, unioned)."""
    parts, metas = [], []
    for gi, (df, cols) in enumerate(zip(dfs, columns)):
        strings = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
        aggs = []
        for c in strings:
            v = F.trim(F.col(f"`{c}`"))
            nn = v.isNotNull() & (v != "")
            aggs += [F.count_if(nn), F.count_if(nn & F.lower(v).isin("true", "false")),
                     F.count_if(nn & v.rlike("^[+-]?[0-9]+$") & v.try_cast("bigint").isNotNull()), F.count_if(nn & v.rlike(NUMBER))]
        metas.append((df, cols, strings))
        arr = F.array(*[a.cast("bigint") for a in aggs]) if aggs else F.array().cast("array<bigint>")
        parts.append(df.agg(arr.alias("counts")).select(F.lit(gi).alias("g"), "counts"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    got = {r["g"]: r["counts"] for r in out.collect()}
    return [{c: _label(*got[gi][4 * strings.index(c):4 * strings.index(c) + 4]) if c in strings else label_of(df.schema[c].dataType)
             for c in cols} for gi, (df, cols, strings) in enumerate(metas)]


def _cast(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    if src == dst:
        return c
    if isinstance(src, T.StringType):
        c = F.trim(c)
        c = F.when(c == "", F.lit(None)).otherwise(c)
        if isinstance(dst, (T.DoubleType, T.FloatType, T.LongType)):
            c = F.when(c.rlike(NUMBER), c)
    return c.try_cast(dst)


def align_to_schema(df: DataFrame, schema: T.StructType | Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """H7: project to the schema's columns in order; missing -> NULL; extra dropped.

    Values are converted with ``try_cast`` (ANSI-safe: a bad value is NULL,
    never a failed job). ``keep`` names extra columns carried along at the end.
    """
    if not isinstance(schema, T.StructType):
        schema = to_struct(schema)
    have = {c: df.schema[c].dataType for c in df.columns}
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(_cast(F.col(f"`{f.name}`"), have[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    cols += [F.col(f"`{k}`") for k in keep if k in have and k not in schema.fieldNames()]
    return df.select(*cols)


def union_tables(dfs: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """H8 (list form): union by name of frames with different columns.

    Columns are first cast to the merged type (a string/int pair becomes
    STRING), then ``unionByName(allowMissingColumns=True)``.
    """
    if not dfs:
        raise ValueError("union_tables needs at least one DataFrame")
    if schema is None:
        merged = merge_schemas({c: label_of(d.schema[c].dataType) for c in d.columns} for d in dfs)
        schema = to_struct(merged)
    out = None
    for d in dfs:
        cols = [f.name for f in schema.fields if f.name in d.columns]
        extra = [c for c in d.columns if c not in schema.fieldNames()]
        part = d.select(*[_cast(F.col(f"`{c}`"), d.schema[c].dataType, schema[c].dataType).alias(c) for c in cols],
                        *[F.col(f"`{c}`") for c in extra])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def union_sheets(sheets: Mapping[str, DataFrame], schema_map: Mapping | None = None, to_lower: bool = True,
                 spaces_to_underscores: bool = True, sheet_col: str = "sheet_name", split_names: bool = True) -> DataFrame:
    """H8 (dict form): normalise each sheet, tag it with its name, union."""
    parts = []
    for name, d in sheets.items():
        d = apply_schema_map(d, schema_map, to_lower, spaces_to_underscores)
        if split_names:
            d = split_name(d)
        parts.append(d.withColumn(sheet_col, F.lit(name)))
    return union_tables(parts)


def run_stats(df: DataFrame, file_col: str = "source_file", seconds: float | None = None) -> DataFrame:
    """Files, rows, columns (and rows/s when a duration is given) in one aggregate."""
    n_cols = len([c for c in df.columns if not c.startswith("__")])
    out = df.agg(
        F.count_distinct(F.col(file_col)).cast("bigint").alias("files_processed"),
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
    ).withColumn("total_columns", F.lit(n_cols).cast("bigint"))
    if seconds is not None:
        out = out.withColumn("seconds", F.lit(float(seconds))).withColumn(
            "rows_per_second", F.when(F.col("seconds") > 0, F.col("total_rows") / F.col("seconds")).otherwise(F.lit(0.0)))
    return out
