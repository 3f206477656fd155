"""Declarative rename specs.

A spec dict (``pipeline.filters`` / ``extractor`` / ``converters`` / ``template`` or ``all_in_one``, plus
``collision_handling``) becomes a :class:`~tabforge.plans.rename.RenameSpec` of Column builders. A step is a dict of
name, args and kwargs, or a call string (:func:`~tabforge.plans.steps.parse_call`).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions import filters as FL
from .rename import POLICIES, RenameSpec, rename_plan, resolve_collisions
from .steps import BUILTIN, as_step, register_step, resolve, validate_step  # noqa: F401  (public here)


def from_dict(spec: Mapping) -> RenameSpec:
    """D1 (+U3 ordering rules): build a RenameSpec from a spec dict; unknown steps are errors (Q21)."""
    pipe = spec.get("pipeline", spec)
    coll = spec.get("collision_handling", {})
    for name in ("on_internal_collision", "on_existing_collision"):
        if coll.get(name, "skip") not in POLICIES:
            raise ValueError(f"{name}: unknown policy {coll[name]!r}; policies: {', '.join(POLICIES)}")
    filters = []
    for f in map(as_step, pipe.get("filters", []) or []):
        name = f.get("name", "")
        inverted = name.startswith("!")
        p = resolve("filter", name[inverted:], f.get("args", []), f.get("kwargs"))
        filters.append(FL.invert(p) if inverted else p)
    one = pipe.get("all_in_one")
    if one and (pipe.get("extractor") or pipe.get("converters") or pipe.get("template")):
        raise ValueError("an all_in_one step cannot be combined with extractor/converters/template (U3)")
    if pipe.get("converters") and not pipe.get("extractor"):
        raise ValueError("converters need an extractor (U3)")
    out = RenameSpec(filters=filters,
                     on_internal_collision=coll.get("on_internal_collision", "skip"),
                     on_existing_collision=coll.get("on_existing_collision", "skip"))
    if one:
        one = as_step(one)
        out.one_step = resolve("all_in_one", one["name"], one.get("args", []), one.get("kwargs"))
        return out
    ex = pipe.get("extractor")
    if ex:
        ex = as_step(ex)
        out.extractor = resolve("extractor", ex["name"], ex.get("args", []), ex.get("kwargs"))
        out.field_names = tuple(ex.get("fields", ()))
    out.converters = [resolve("converter", c["name"], c.get("args", []), c.get("kwargs"))
                      for c in map(as_step, pipe.get("converters", []) or [])]
    tp = pipe.get("template")
    if tp:
        tp = as_step(tp)
        out.template = resolve("template", tp["name"], tp.get("args", []), tp.get("kwargs"))
    return out


class Pipeline:
    """A declarative spec ready to run over a file catalog.

    >>> Pipeline.from_dict({"pipeline": {...}, "collision_handling": {...}}).run(catalog)
    """

    def __init__(self, spec: RenameSpec):
        self.spec = spec

    @classmethod
    def from_dict(cls, spec: Mapping) -> Pipeline:
        return cls(from_dict(spec))

    @classmethod
    def from_calls(cls, extractor: str | None = None, converters: Sequence[str] = (), template: str | None = None, filters: Sequence[str] = (),
                   all_in_one: str | None = None, on_internal_collision: str = "skip", on_existing_collision: str = "skip") -> Pipeline:
        """A pipeline of call strings: ``from_calls("split,_,dept,type", ["case,dept,case=upper"], "join,type,dept")``."""
        return cls.from_dict({"pipeline": {"extractor": extractor, "converters": list(converters), "template": template,
                                           "filters": list(filters), "all_in_one": all_in_one},
                              "collision_handling": {"on_internal_collision": on_internal_collision, "on_existing_collision": on_existing_collision}})

    @classmethod
    def from_json(cls, text: str) -> Pipeline:
        return cls.from_dict(json.loads(text))

    def plan(self, catalog: DataFrame) -> DataFrame:
        """One row for each file."""
        return rename_plan(catalog, self.spec)

    def run(self, catalog: DataFrame) -> DataFrame:
        """Changed rows with final names and actions under the spec's collision policies; the catalog's files exist."""
        return resolve_collisions(self.plan(catalog), self.spec.on_internal_collision, self.spec.on_existing_collision, catalog)
