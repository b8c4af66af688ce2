"""JSON of unknown shape: one pass finds the shape of all rows, then every field is a column.

Texts become VARIANT values, whose schemas Spark merges as an aggregate (partially in every task): a field that some rows lack is in it,
whole and fractional numbers merge, and a field of types that do not merge stays text. The merged schema is one line of text,
however many rows there are. It turns variants into structs, lists of records become rows (:func:`flatten_json`), and nested
records become columns named by their path.

Texts that are no JSON, and missing ones, are rows without values (:func:`invalid_json` counts them by reason). A record that is not an
object (a number, a list) has no fields.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.sources.payloads import flatten_struct

RECORD = "__record"


def _outside_quotes(text: str, change) -> str:
    """``change`` what is not inside backticks, where field names with special characters are."""
    return "".join(part if part.startswith("`") else change(part) for part in re.split(r"(`(?:[^`]|``)*`)", text))


def _as_type(shape: str) -> str:
    """The schema of a variant as a type: objects are structs, numbers with a fraction doubles, and what has no common type text."""

    def change(part: str) -> str:
        part = re.sub(r"\bOBJECT<", "STRUCT<", part)
        part = re.sub(r"(: |<)DECIMAL\(\d+,\s*\d+\)", r"\1DOUBLE", part)
        return re.sub(r"(: |<)(VOID|VARIANT)\b", r"\1STRING", part)

    return _outside_quotes(shape, change)


def shape_of(df: DataFrame, c: str) -> T.StructType:
    """The merged schema of all objects in a JSON column, from one pass."""
    value = F.try_parse_json(F.col(c).cast("string"))
    objects = F.when(F.schema_of_variant(value).startswith("OBJECT<"), value)
    shape = df.agg(F.schema_of_variant_agg(objects)).first()[0]
    if not shape or not shape.startswith("OBJECT<") or shape == "OBJECT<>":
        return T.StructType([])
    return T._parse_datatype_string(_as_type(shape))


def parse_json(df: DataFrame, c: str, out: str = RECORD, shape: T.StructType | None = None) -> DataFrame:
    """The JSON column as a struct column of its own merged schema (or of a given one, which saves the pass)."""
    shape = shape_of(df, c) if shape is None else shape
    if not shape.fields:
        return df.withColumn(out, F.lit(None).cast("struct<>"))
    value = F.try_parse_json(F.col(c).cast("string"))
    return df.withColumn(out, F.try_variant_get(value, "$", _ddl(shape)))


def flatten_json(
    df: DataFrame, c: str, keep: Sequence[str] = (), explode: Sequence[str] = (), sep: str = "_", shape: T.StructType | None = None
) -> DataFrame:
    """``keep`` columns and one column per field, nested ones named by their path.

    ``explode`` names lists by their dotted path (inner ones after the outer); each element is a row with its place in ``<path>_at``, and a row
    without elements stays. Other lists stay lists.
    """
    parsed = parse_json(df, c, shape=shape)
    record = parsed.schema[RECORD].dataType
    rows = parsed.select(*keep, *[F.col(f"{RECORD}.{_quoted(f)}").alias(f) for f in record.names])
    for path in explode:
        rows = _exploded(rows, path.split("."), sep)
    return flatten_struct(rows, sep)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ddl(kind: T.DataType) -> str:
    """The type as text, field names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{_quoted(f.name)}: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def _at(path: Sequence[str]) -> Column:
    return F.col(".".join(_quoted(p) for p in path))


def _exploded(rows: DataFrame, path: list[str], sep: str) -> DataFrame:
    """One row per element of the list at ``path``; the element takes the list's place, as a column of its own."""
    name, place = sep.join(path), f"{sep.join(path)}{sep}at"
    if not isinstance(_type_at(rows.schema, path), T.ArrayType):
        raise ValueError(f"{'.'.join(path)} is no list")
    rest = [F.col(_quoted(x)) if x != path[0] else _at(path[:1]).dropFields(".".join(_quoted(p) for p in path[1:])).alias(x) for x in rows.columns if x != path[0] or len(path) > 1]
    return rows.select(*rest, F.posexplode_outer(_at(path)).alias(place, name))


def _type_at(schema: T.StructType, path: Sequence[str]) -> T.DataType:
    kind: T.DataType = schema
    for p in path:
        if not isinstance(kind, T.StructType) or p not in kind.names:
            raise ValueError(f"no field {'.'.join(path)}")
        kind = kind[p].dataType
    return kind


def invalid_json(df: DataFrame, c: str) -> DataFrame:
    """(reason, n) of the rows without a record: missing, not JSON, or not an object."""
    text = F.col(c).cast("string")
    value = F.try_parse_json(text)
    reason = F.when(text.isNull(), "missing").when(value.isNull(), "no JSON").when(~F.schema_of_variant(value).startswith("OBJECT<"), "no object")
    return df.select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
