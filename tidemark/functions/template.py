"""Compiling a remap rule into a projection (T4, T5) and its reject conditions."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a placeholder is a brace pair around any text without a closing brace.
PLACEHOLDER = re.compile(r"{([^}]*)}")

VERSION = "ver"


@dataclass(frozen=True)
class Template:
    """A mapped value: a constant, a whole column, or a column inside a text."""

    kind: str  # "constant" | "column" | "text"
    value: Any = None
    column: str | None = None
    before: str = ""
    after: str = ""


def parse(value: Any) -> Template:
    """Only a text with exactly one placeholder refers to a column."""
    if not isinstance(value, str):
        return Template("constant", value)
    found = list(PLACEHOLDER.finditer(value))
    if len(found) != 1:
        return Template("constant", value)
    hit = found[0]
    if hit.group(0) == value:
        return Template("column", column=hit.group(1))
    return Template("text", column=hit.group(1),
                    before=value[:hit.start()], after=value[hit.end():])


def _constant(value: Any) -> Column:
    if isinstance(value, list):
        return F.array(*[_constant(v) for v in value])
    if isinstance(value, dict):
        return F.lit(json.dumps(value))
    return F.lit(value)


Resolve = Callable[[str], Column]


def named(column: str) -> Column:
    return F.col(f"`{column}`")


def _compile(template: Template, columns: Iterable[str], resolve: Resolve = named) -> Column:
    if template.kind == "constant":
        return _constant(template.value)
    if template.column not in columns:
        return F.lit(None)  # untyped, so that a fan-in can give it the other side's type
    source = resolve(template.column)
    if template.kind == "column":
        return source
    return F.concat(F.lit(template.before), source, F.lit(template.after))


def _version(columns: Iterable[str], resolve: Resolve = named) -> Column:
    if VERSION in columns:
        return F.coalesce(resolve(VERSION).cast("long"), F.lit(0).cast("long"))
    return F.lit(0).cast("long")


def projection(df: DataFrame, remap: dict[str, Any] | None) -> Callable[[DataFrame], DataFrame]:
    """A rule compiled against the columns of ``df``.

    A rule lists the destination columns; everything else is dropped and ``ver`` is set
    from the row, or 0.  Being a plain ``select``, it prunes the scan below.
    """
    if remap is None:
        return lambda frame: frame
    columns = df.columns
    selected = [_compile(parse(value), columns).alias(dest)
                for dest, value in remap.items() if dest != VERSION]
    selected.append(_version(columns).alias(VERSION))
    return lambda frame: frame.select(*selected)


def _constant_type(value: Any) -> T.DataType | None:
    """Type of a constant as ``convert_value`` needs it; none for null."""
    if value is None:
        return None
    if isinstance(value, list):
        kinds = [k for k in map(_constant_type, value) if k is not None]
        return T.ArrayType(kinds[0] if kinds else T.StringType())
    for kind, dtype in ((bool, T.BooleanType()), (int, T.LongType()), (float, T.DoubleType())):
        if isinstance(value, kind):
            return dtype
    return T.StringType()


def rule_columns(types: dict[str, T.DataType], remap: dict[str, Any] | None,
                 resolve: Resolve = named) -> list[tuple[str, Column, T.DataType]]:
    """The rule's destination columns with their types; those that are null for every row are left out."""
    if remap is None:
        return [(name, resolve(name), dtype) for name, dtype in types.items()]
    out = []
    for dest, value in remap.items():
        template = parse(value)
        dtype = (_constant_type(template.value) if template.kind == "constant"
                 else T.StringType() if template.kind == "text" else types.get(template.column))
        if dest != VERSION and dtype is not None and (template.kind == "constant" or template.column in types):
            out.append((dest, _compile(template, types, resolve), dtype))
    return [*out, (VERSION, _version(types, resolve), T.LongType())]


def settle(df: DataFrame) -> DataFrame:
    """Columns still without a type become text, which every sink can store."""
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in untyped}) if untyped else df


def reject_reason(df: DataFrame, remap: dict[str, Any] | None) -> Column | None:
    """Why a row cannot be remapped, or null; ``None`` if the rule fits every row."""
    return misfit({field.name: field.dataType for field in df.schema.fields}, remap)


def misfit(types: dict[str, T.DataType], remap: dict[str, Any] | None, resolve: Resolve = named) -> Column | None:
    """The same for columns of the given types.

    Text around a column needs a text value: a missing column, a column of another
    type and a null value cannot be inserted.
    """
    reason = None
    for dest, value in (remap or {}).items():
        template = parse(value)
        if template.kind != "text":
            continue
        if template.column not in types:
            this = F.lit(f"{dest}: no column {template.column}")
        elif not isinstance(types[template.column], (T.StringType, T.VarcharType, T.CharType)):
            this = F.lit(f"{dest}: {template.column} is not text")
        else:
            this = F.when(resolve(template.column).isNull(), F.lit(f"{dest}: {template.column} is null"))
        reason = this if reason is None else F.coalesce(reason, this)
    return reason
