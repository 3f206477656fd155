"""Rename plan over a file catalog, collision detection and resolution.

The plan is one DataFrame; every step is a Column expression evaluated on the
executors. Shuffles happen only where the semantics need them:

* collision counts (P5/P6): partial aggregates by new name, written and joined
  back, so that adaptive execution can split a hot name.
* append_number (P7): the free numbers of a name come from positions in one
  order of wanted and taken numbers (:mod:`tabforge.operators.ordering`).
* existing files (P8): plan x catalog joins on path (unique keys); a file that
  cannot move blocks those that wanted its place, followed by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import new_name as _new_name
from ..operators.ordering import number, write_and_read
from .steps import check_type


@dataclass
class RenameSpec:
    """filters -> extractor -> converters -> template, or a one-step renamer.

    ``extractor(df) -> Column`` (a STRUCT, or a MAP where rows differ in their fields; ``field_names`` are those to keep
    beside what the steps ask for), ``converters``: ``[(fields, struct_type) -> Column]``,
    ``template(fields, struct_type) -> Column``, ``one_step(df) -> Column``.
    """
    filters: Sequence[Column] = ()
    extractor: object = None
    converters: Sequence[object] = ()
    template: object = None
    one_step: object = None
    on_internal_collision: str = "skip"
    on_existing_collision: str = "skip"
    field_names: Sequence[str] = ()
    extra: dict = field(default_factory=dict)


def _keep(filters: Sequence[Column]) -> Column:
    out = F.lit(True)
    for p in filters:
        out = out & F.coalesce(p, F.lit(False))
    return out


def _texts(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _with_fields(df: DataFrame, spec: RenameSpec) -> tuple[DataFrame, Column | None]:
    """``df`` with the struct ``fields`` and, for a MAP extractor, the array ``present`` beside it (NULL: no fields at all)."""
    ext = spec.extractor(df) if callable(spec.extractor) else spec.extractor
    kind = check_type("extractor", getattr(spec.extractor, "__name__", ""), ext, df)
    if not isinstance(kind, T.MapType):
        return df.withColumn("fields", ext), None
    df = df.withColumn("__map", ext)
    some = F.size("__map") > 0  # NULL for no map
    df = df.withColumn("present", F.when(some, F.map_keys("__map")))
    first = [*spec.field_names, *[n for c in spec.converters[:1] for n in getattr(c, "needs", ())]]
    if not first and not getattr(spec.template, "reads", ()):
        raise ValueError("an extractor that gives a map needs the names of its fields")
    names = first or spec.template.reads
    return df.withColumn("fields", F.when(some, F.struct(*[F.col("__map").getItem(n).alias(n) for n in dict.fromkeys(names)]))), F.col("present")


def _from_map(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``fields`` with those of ``names`` that neither it nor a converter has brought so far."""
    have = df.schema["fields"].dataType.fieldNames()
    fields = F.col("fields")
    for n in names:
        if n not in have:
            fields = fields.withField(n, F.col("__map").getItem(n))
    return df.withColumn("fields", fields)


def rename_plan(catalog: DataFrame, spec: RenameSpec) -> DataFrame:
    """One row per catalog file with ``kept``, ``fields``, ``new_name``, ``new_path``, ``error``.

    Filtered-out rows stay in the plan with ``kept = false`` so that metrics
    (P9) come from the same pass.

    C4 by row: with a MAP extractor a converter's field that a row lacks makes the row an error that names it; a field
    that is empty or NULL stays as it is, and a row without any fields passes through. ``present`` holds the row's field
    names. Steps of a wrong type are errors here (U2).
    """
    from ..functions.naming import t_join
    for p in spec.filters:
        check_type("filter", "", p, catalog)
    df = catalog.withColumn("kept", _keep(spec.filters)).withColumn("error", F.lit(None).cast("string"))
    if spec.one_step is not None:
        base = spec.one_step(df) if callable(spec.one_step) else spec.one_step
        check_type("all_in_one", getattr(spec.one_step, "__name__", ""), base, df)
        df = df.withColumn("new_base", base)
    else:
        if spec.extractor is None:
            df = df.withColumn("new_base", F.col("base_name"))
        else:
            df, present = _with_fields(df, spec)
            for conv in spec.converters:
                if present is not None:
                    needs = getattr(conv, "needs", ())
                    df = _from_map(df, needs)
                    for name in needs:
                        df = df.withColumn("error", F.coalesce("error", F.when(~F.array_contains(present, name), F.concat(
                            F.lit(f"no field '{name}' to convert; the fields are "), F.array_join(present, ", ")))))
                before = df.schema["fields"].dataType
                fields = conv(F.col("fields"), before)
                check_type("converter", getattr(conv, "__name__", ""), fields, df)
                df = df.withColumn("fields", fields)
                if present is not None:  # a converter's new fields are there for every row that has fields
                    new = [n for n in df.schema["fields"].dataType.fieldNames() if n not in before.fieldNames()]
                    gone = [n for n in before.fieldNames() if n not in df.schema["fields"].dataType.fieldNames()]
                    if new or gone:
                        df = df.withColumn("present", F.array_union(F.array_except("present", _texts(gone)), _texts(new)))
            if present is not None:
                df = _from_map(df, getattr(spec.template, "reads", ()))
            ft = df.schema["fields"].dataType
            if spec.template is None:  # P2: no template -> join all fields
                base = t_join(fields="fields", fields_type=ft)
            elif present is not None and getattr(spec.template, "by_row", False):
                base = spec.template(F.col("fields"), ft, present)
            else:
                base = spec.template(F.col("fields"), ft)
            check_type("template", getattr(spec.template, "__name__", ""), base, df)
            df = df.withColumn("new_base", base)
    made = [] if spec.one_step is not None or spec.extractor is None else ["fields"] if present is None else ["fields", "present"]
    df = df.withColumn("error", F.coalesce("error", F.when(F.col("new_base").isNull() | (F.col("new_base") == ""), F.lit("empty new name"))))
    df = df.withColumn("new_name", F.when(F.col("error").isNull(), _new_name("new_base", "extension")))
    df = df.withColumn("new_path", F.when(F.col("new_name").isNotNull(), F.concat_ws("/", "parent", "new_name")))
    return df.select(F.col("path").alias("old_path"), F.col("file_name").alias("old_name"), "parent", "extension",
                     "kept", "new_name", "new_path", "error", *made)


def plan_changes(plan: DataFrame) -> DataFrame:
    """Kept rows whose name changes (the preview)."""
    return plan.filter(F.col("kept") & F.col("error").isNull() & (F.col("old_name") != F.col("new_name")))


def collision_count(plan: DataFrame, per_directory: bool = False) -> DataFrame:
    """P5: changed rows minus distinct new names (Q17: optionally per directory)."""
    ch = plan_changes(plan)
    if per_directory:
        key = F.concat_ws("/", "parent", "new_name")
        return ch.agg((F.count(F.lit(1)) - F.count_distinct(key)).cast("bigint").alias("collisions"))
    return ch.agg((F.count(F.lit(1)) - F.count_distinct("new_name")).cast("bigint").alias("collisions"))


def flag_collisions(plan: DataFrame, keys: Sequence[str] = ("new_name",)) -> DataFrame:
    """``collides`` = another changed row has the same new name."""
    ch = plan_changes(write_and_read(plan, "plan"))
    counts = write_and_read(ch.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"), "collisions")
    return ch.join(counts, list(keys), "left").withColumn("__n", F.coalesce("__n", F.lit(1))).withColumn("collides", F.col("__n") > 1).drop("__n")


POLICIES = ("skip", "error", "append_number")


def _stem(name: str = "new_name") -> Column:
    """The name without the row's extension."""
    return F.expr(f"substring({name}, 1, char_length({name}) - char_length(extension))")


def _free_numbers(wanting: DataFrame, taken: DataFrame) -> DataFrame:
    """wanting (__grp, parent, new_name, extension, old_path, old_name), taken (path) -> (old_path, __k): in each group,
    in old-name order, the positive numbers k for which ``stem_k.ext`` is not taken.

    Sorted taken numbers t_1 < t_2 < ...: the r-th free number is r plus the taken ones with t_j - j < r. Both come
    from one order of the r (after) and the t_j - j (before), so no group meets in one task.
    """
    wanted = number(wanting, [F.col("__grp"), F.col("old_name"), F.col("old_path")], by="__grp", out="__r")
    wanted = wanted.select("__grp", (F.col("__r") + 1).alias("__at"), F.lit(1).alias("__kind"), "old_path")
    # a name stem_7.ext stands for number 7 of the group stem.ext; 07 is no number that is ever given
    groups = wanting.select("__grp", "parent", "extension", _stem().alias("__stem")).distinct()
    parts = taken.select(F.regexp_extract("path", r"^(.*)/([^/]*)$", 1).alias("parent"), F.regexp_extract("path", r"([^/]*)$", 1).alias("__name"))
    rx = r"(?s)^(.*)_([1-9][0-9]{0,17})(\.[^.]*)?$"
    parts = parts.select("parent", F.regexp_extract("__name", rx, 1).alias("__stem"), F.regexp_extract("__name", rx, 2).try_cast("bigint").alias("__t"),
                         F.regexp_extract("__name", rx, 3).alias("extension")).where("__t IS NOT NULL")
    held = parts.distinct().join(groups, ["parent", "__stem", "extension"]).select("__grp", "__t")
    held = number(held, [F.col("__grp"), F.col("__t")], by="__grp", out="__j")
    held = held.select("__grp", (F.col("__t") - F.col("__j") - 1).alias("__at"), F.lit(0).alias("__kind"), F.lit(None).cast("string").alias("old_path"))
    # strictly smaller: a taken one with t_j - j = r - 1 comes before r, one with t_j - j = r after it
    both = held.unionByName(wanted).withColumn("__at2", F.col("__at") * 2 + F.when(F.col("__kind") == 0, F.lit(1)).otherwise(F.lit(0)))
    placed = number(both, [F.col("__grp"), F.col("__at2")], by="__grp", out="__pos").where("__kind = 1")
    return placed.select("old_path", (F.col("__pos") + 1).alias("__k"))


def _blocked_chains(ch: DataFrame, stays: DataFrame) -> DataFrame:
    """Old paths of the rows that cannot move: their target is a file that stays, or one that cannot move either."""
    moving = ch.where("action = 'rename'").select("old_path", "new_path")
    hit = moving.join(stays.select(F.col("__p").alias("new_path")).distinct(), "new_path", "left_semi").select("old_path", F.lit(True).alias("stuck"))
    waits = moving.join(moving.select(F.col("old_path").alias("new_path")), "new_path", "left_semi").select("old_path", F.col("new_path").alias("next"))
    state = write_and_read(hit.withColumn("next", F.lit(None).cast("string")).select("old_path", "next", "stuck")
                           .unionByName(waits.withColumn("stuck", F.lit(False))), "chains")
    rounds = int(state.where("next IS NOT NULL").count()).bit_length()
    for _ in range(rounds):  # a chain of n files is followed in log2(n) rounds; rings never end and are free
        ahead = state.select(F.col("old_path").alias("next"), F.col("next").alias("__next2"), F.col("stuck").alias("__stuck2"))
        step = state.where("next IS NOT NULL").join(ahead, "next", "left")  # rows at their end wait for nothing and stay out of it
        step = step.select("old_path", F.when(~F.col("__stuck2"), F.col("__next2")).alias("next"),
                           (F.col("stuck") | F.coalesce("__stuck2", F.lit(False))).alias("stuck"))
        state = write_and_read(step.unionByName(state.where("next IS NULL")), "chains")
        if state.where("next IS NOT NULL").isEmpty():
            break
    return state.where("stuck").select("old_path")


def resolve_collisions(plan: DataFrame, internal: str = "skip", existing: str = "skip",
                       catalog: DataFrame | None = None) -> DataFrame:
    """Apply collision policies; returns changed rows with ``action`` and final names.

    internal (same parent and new name): ``skip`` (keep old names), ``error``, ``append_number`` (the first in old-name
    order keeps the name, later ones get the next free ``_1``, ``_2``, ...). existing (the new path is a file of
    ``catalog`` that stays where it is): ``skip``, ``error``, ``append_number`` (the next free number). A file stays
    if it isn't renamed - unchanged, filtered out, or skipped by a policy, which may block others in turn.

    No two rows with action ``rename`` get one path, and none gets the path of a file that stays: numbers avoid all
    planned and staying names, and a generated name belongs to one group only.
    """
    for p in (internal, existing):
        if p not in POLICIES:
            raise ValueError(f"unknown collision policy {p!r}")
    # written before it is filtered: a filter on the new name is moved below it and makes the name again for each place that reads it
    ch = plan_changes(write_and_read(plan, "plan")).withColumn("__grp", F.concat_ws("/", "parent", "new_name"))
    many = write_and_read(ch.groupBy("__grp").agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct("old_name", "old_path")).alias("__first"))
                          .where("__n > 1"), "collisions")
    ch = ch.join(many, "__grp", "left")
    extra = F.coalesce(F.col("old_path") != F.col("__first.old_path"), F.lit(False))
    if internal == "append_number":
        ch = ch.withColumn("action", F.lit("rename")).withColumn("__wants", extra)
    else:
        ch = (ch.withColumn("action", F.when(F.col("__n").isNotNull(), F.lit(internal)).otherwise(F.lit("rename")))
              .withColumn("__wants", F.lit(False)))
    ch = write_and_read(ch.drop("__first", "__n").withColumn("new_path", F.concat_ws("/", "parent", "new_name")), "policies")
    stays = None
    if catalog is not None:
        moving = ch.where("action = 'rename'").select(F.col("old_path").alias("__p"))
        stays = write_and_read(catalog.select(F.col("path").alias("__p")).join(moving, "__p", "left_anti"), "stays")
        if existing == "append_number":
            hit = stays.select(F.col("__p").alias("new_path"), F.lit(True).alias("__exists")).distinct()
            ch = write_and_read(ch.join(hit, "new_path", "left").withColumn(
                "__wants", F.col("__wants") | (F.coalesce("__exists", F.lit(False)) & (F.col("action") == "rename"))).drop("__exists"), "policies")
    if "append_number" in (internal, existing):
        taken = ch.select(F.col("new_path").alias("path"))
        if stays is not None:
            taken = taken.unionByName(stays.select(F.col("__p").alias("path")))
        wanting = ch.where("__wants").select("__grp", "parent", "new_name", "extension", "old_path", "old_name")
        ch = ch.join(_free_numbers(wanting, taken), "old_path", "left")
        ch = ch.withColumn("new_name", F.when(F.col("__k").isNotNull(), F.concat(_stem(), F.lit("_"), F.col("__k").cast("string"), F.col("extension")))
                           .otherwise(F.col("new_name"))).drop("__k")
        ch = write_and_read(ch.withColumn("new_path", F.concat_ws("/", "parent", "new_name")), "numbered")
    if stays is not None and existing != "append_number":
        blocked = _blocked_chains(ch, stays).withColumn("__stuck", F.lit(True))
        ch = (ch.join(blocked, "old_path", "left").withColumn("action", F.when(F.col("__stuck"), F.lit(existing)).otherwise(F.col("action")))
              .drop("__stuck"))
    return ch.drop("__grp", "__wants")


def plan_metrics(plan: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Found, filtered out, to rename, errors, collisions, and the three zero-guarded rates.

    One aggregate pass over the plan (joined to the resolved actions by
    ``old_path`` when given).
    """
    changed = F.col("kept") & F.col("error").isNull() & (F.col("old_name") != F.col("new_name"))
    if resolved is not None:
        plan = plan.join(resolved.select("old_path", "action"), "old_path", "left")
        renamed = F.count_if(F.col("action") == "rename")
    else:
        renamed = F.count_if(changed)
    m = plan.agg(
        F.count(F.lit(1)).cast("bigint").alias("files_found"),
        F.count_if(~F.col("kept")).cast("bigint").alias("files_filtered_out"),
        F.count_if(F.col("kept") & F.col("error").isNotNull()).cast("bigint").alias("errors"),
        F.count_if(changed).cast("bigint").alias("files_to_rename"),
        (F.count_if(changed) - F.count_distinct(F.when(changed, F.col("new_name")))).cast("bigint").alias("collisions"),
        renamed.cast("bigint").alias("files_renamed"),
    )
    pct = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(F.round(a * 100.0 / b, 6))
    return m.select("*",
                    pct(F.col("files_renamed"), F.col("files_to_rename")).alias("success_rate"),
                    pct(F.col("files_found") - F.col("files_filtered_out"), F.col("files_found")).alias("filtering_efficiency"),
                    pct(F.col("collisions"), F.col("files_to_rename")).alias("collision_impact"))
