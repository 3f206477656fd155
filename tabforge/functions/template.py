"""Compile a section template to ONE Spark Column.

Template syntax: literal text and ``{{...}}`` sections. A section is
``[!][tokens;]prefix;field;suffix`` with 1-3 parts (``field``,
``prefix;field``, ``prefix;field;suffix``). Leading tokens: ``#colour`` and
``@emphasis`` (accepted, stripped: a table cell has no terminal), ``?fn``
(conditional: the whole section disappears when ``fn`` is false, Q22) and
``$fn`` (its text goes before the first part, Q24). Inline tokens ``{#..}``, ``{@..}``,
``{?fn}``, ``{$fn}`` may start any part; an inline ``{$fn}`` replaces the part's text.

Semantics per section: NULL field -> the section vanishes (M2; with
``skip_empty`` also for ''); ``!`` mandatory -> ``raise_error`` (or an error
column with ``on_missing="flag"``). Functions are Column -> Column callables;
their arguments are matched by parameter names (M6).

Parsing happens once on the driver; rendering is ``concat`` of
``coalesce``/``when`` expressions inside whole-stage codegen.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_CHARS = "#@?$"


class TemplateError(ValueError):
    pass


@dataclass
class Part:
    text: str = ""
    tokens: list[tuple[str, str]] = field(default_factory=list)  # (kind, name)


@dataclass
class Section:
    literal: str | None = None          # plain text section
    mandatory: bool = False
    tokens: list[tuple[str, str]] = field(default_factory=list)
    prefix: Part = field(default_factory=Part)
    field_part: Part = field(default_factory=Part)
    suffix: Part = field(default_factory=Part)

    @property
    def field(self) -> str:
        return self.field_part.text.strip()


def _lexer(delimiter: str, escape: str) -> re.Pattern:
    """Lexemes of a template. An inline token is one lexeme, so its brace never closes a section."""
    return re.compile("|".join((
        rf"(?P<quoted>{re.escape(escape)}(?P<char>.))", r"(?P<inline>\{[#@?$][^{}]*\})", r"(?P<open>\{\{)", r"(?P<close>\}\})",
        rf"(?P<cut>{re.escape(delimiter)})", r"(?P<text>.)")), re.DOTALL)


#: How many parts a section has -> which of prefix, field and suffix they are.
_ROLES = {0: (), 1: ("field_part",), 2: ("prefix", "field_part"), 3: ("prefix", "field_part", "suffix")}


def _section(lexemes: list[re.Match], where: int) -> Section:
    """One section from the lexemes between its braces."""
    sec, parts, raw = Section(), [Part()], [""]
    for i, lex in enumerate(lexemes):
        kind = lex.lastgroup if lex.lastgroup != "char" else "quoted"
        if i == 0 and kind == "text" and lex.group() == "!":
            sec.mandatory = True
        elif kind == "cut":
            parts.append(Part())
            raw.append("")
        elif kind == "inline":
            if parts[-1].text:
                raise TemplateError(f"section at {where}: put inline tokens before the text of a part")
            parts[-1].tokens.append((lex.group()[1], lex.group()[2:-1]))
            raw[-1] += "\0"  # an inline token is no header
        else:
            parts[-1].text += lex.group("char") if kind == "quoted" else lex.group()
            raw[-1] += "\0" if kind == "quoted" else lex.group()
    if raw[0][:1] in TOKEN_CHARS and raw[0]:
        header = parts.pop(0).text
        sec.tokens = [(t[0], t[1:]) for t in re.findall(r"[#@?$][^#@?$]*", header)]
    if len(parts) not in _ROLES:
        raise TemplateError(f"section at {where}: a section has at most prefix, field and suffix")
    for role, part in zip(_ROLES[len(parts)], parts):
        setattr(sec, role, part)
    return sec


def parse(template: str, delimiter: str = ";", escape: str = "\\") -> list[Section]:
    """M1/M9: template -> sections (driver side, once), in one scan over its lexemes."""
    out: list[Section] = []
    inside: list[re.Match] | None = None
    literal, began = "", 0
    for lex in _lexer(delimiter, escape).finditer(template):
        if inside is None:
            if lex["open"]:
                if literal:
                    out.append(Section(literal=literal))
                inside, literal, began = [], "", lex.start()
            else:
                literal += lex["char"] if lex["quoted"] else lex.group()
        elif lex["close"]:
            out.append(_section(inside, began))
            inside = None
        else:
            inside.append(lex)
    if inside is not None:
        raise TemplateError(f"section at {began} has no end")
    return out + ([Section(literal=literal)] if literal else [])


def describe(template: str, delimiter: str = ";", escape: str = "\\") -> dict:
    """Sections, mandatory and optional fields, functions used."""
    secs = parse(template, delimiter, escape)
    fields = [s for s in secs if s.literal is None]
    fns = sorted({name for s in fields
                  for kind, name in s.tokens + s.prefix.tokens + s.field_part.tokens + s.suffix.tokens
                  if kind in "?$"})
    return {
        "sections": len(secs),
        "mandatory_fields": [s.field for s in fields if s.mandatory],
        "optional_fields": [s.field for s in fields if not s.mandatory],
        "functions": fns,
    }


def _call(fn: Callable, value: Column, resolve: Callable[[str], Column | None]) -> Column:
    """M6: no parameters -> fn(); all parameter names are fields -> by name; else fn(value)."""
    params = [p for p in inspect.signature(fn).parameters.values()
              if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD, p.KEYWORD_ONLY)]
    if not params:
        return fn()
    cols = [resolve(p.name) for p in params]
    if all(c is not None for c in cols):
        return fn(**{p.name: c for p, c in zip(params, cols)})
    return fn(value)


def compile_template(template: str, functions: Mapping[str, Callable] | Sequence[Callable] | None = None,
                     columns: Sequence[str] | None = None, positional: Sequence[str | Column] | None = None,
                     delimiter: str = ";", escape: str = "\\", skip_empty: bool = False,
                     on_missing: str = "raise", resolver: Mapping[str, Column] | None = None
                     ) -> Column | tuple[Column, Column]:
    """Compile a template to a string Column (``on_missing="flag"`` -> (text, error) Columns)."""
    if functions is None:
        functions = {}
    elif not isinstance(functions, Mapping):
        functions = {f.__name__: f for f in functions}
    secs = parse(template, delimiter, escape)
    named = [s.field for s in secs if s.literal is None and s.field]
    blank = [s for s in secs if s.literal is None and not s.field]
    if named and blank:
        raise TemplateError("positional {{}} sections cannot be mixed with named fields (M7)")
    if blank and (positional is None or len(positional) < len(blank)):
        raise TemplateError("positional template needs one column per {{}} section")
    known = set(columns) if columns is not None else None

    def resolve(name: str) -> Column | None:
        if resolver is not None:
            return resolver.get(name)
        if known is not None and name not in known:
            return None
        return F.col(f"`{name}`")

    def fn_of(name: str) -> Callable:
        if name not in functions:
            raise TemplateError(f"unknown function {name!r}")
        return functions[name]

    pieces, errors = [], []
    pos = 0
    for s in secs:
        if s.literal is not None:
            pieces.append(F.lit(s.literal))
            continue
        if s.field:
            value = resolve(s.field)
            if value is None:
                value = F.lit(None).cast("string")
        else:
            p = positional[pos]
            value = F.col(p) if isinstance(p, str) else p
            pos += 1
        value = value.cast("string")
        present = value.isNotNull() & ((value != "") if skip_empty else F.lit(True))
        shown = value
        for kind, name in s.field_part.tokens:
            if kind == "$":
                shown = _call(fn_of(name), value, resolve).cast("string")
        lead = [_call(fn_of(name), value, resolve).cast("string") for kind, name in s.tokens if kind == "$"]
        cond = F.lit(True)
        for kind, name in s.tokens + s.prefix.tokens + s.field_part.tokens + s.suffix.tokens:
            if kind == "?":
                cond = cond & F.coalesce(_call(fn_of(name), value, resolve).cast("boolean"), F.lit(False))

        def text(part: Part) -> Column:
            out = F.lit(part.text)
            for kind, name in part.tokens:
                if kind == "$":
                    out = _call(fn_of(name), value, resolve).cast("string")
            return out

        body = F.concat(*[F.coalesce(c, F.lit("")) for c in lead], text(s.prefix), F.coalesce(shown, F.lit("")), text(s.suffix))
        section = F.when(present & cond, body).otherwise(F.lit(""))
        if s.mandatory:
            label = s.field or f"positional {pos}"
            if on_missing == "flag":
                errors.append(F.when(value.isNull(), F.lit(f"missing mandatory field {label}")))
            else:
                section = F.when(value.isNull(), F.raise_error(F.lit(f"missing mandatory field {label}")).cast("string")) \
                    .otherwise(section)
        pieces.append(section)
    text_col = F.concat(*pieces) if pieces else F.lit("")
    if on_missing == "flag":
        err = F.concat_ws("; ", *errors) if errors else F.lit("")
        return text_col, F.when(err == "", F.lit(None)).otherwise(err)
    return text_col


def render(df, template: str, out: str = "text", **kw):
    """Add the rendered template as column ``out`` (``out_error`` too when flagging)."""
    res = compile_template(template, columns=df.columns, **kw)
    if isinstance(res, tuple):
        return df.withColumn(out, res[0]).withColumn(f"{out}_error", res[1])
    return df.withColumn(out, res)


def section_template(fmt: str, fields_col: str = "fields", fields_type=None, stem: str = "base_name",
                     functions=None) -> Column:
    """Section template over an extracted-fields STRUCT; empty template -> ''; no fields -> stem."""
    if not fmt:
        return F.lit("")
    names = fields_type.fieldNames() if fields_type is not None else []
    resolver = {n: F.col(fields_col).getField(n) for n in names}
    res = compile_template(fmt, functions=functions, resolver=resolver)
    return F.when(F.col(fields_col).isNull(), F.col(stem)).otherwise(res)
