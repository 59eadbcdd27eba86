"""Text out of records: one string from strings, lists, nested lists and lists of structs, chosen by schema and not by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_NAMES = {"id", "index", "idx", "uuid", "guid", "key"}


def joined_text(column: Column, kind: T.DataType) -> Column:
    """lists of structs join ``content``, other lists join their truthy parts, scalars are cast; null is empty."""
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, T.StructType):
            text = F.transform(column, lambda m: F.coalesce(m["content"].cast("string"), F.lit(""))) if "content" in inner.names else F.transform(column, lambda m: F.lit(""))
            return F.coalesce(F.array_join(text, " "), F.lit(""))
        if isinstance(inner, T.ArrayType):
            full = F.filter(column, lambda a: F.size(a) > 0)
            return F.coalesce(F.array_join(F.transform(full, lambda a: F.array_join(a, " ")), " "), F.lit(""))
        return F.coalesce(F.array_join(F.filter(column.cast("array<string>"), lambda s: s != ""), " "), F.lit(""))
    return F.coalesce(column.cast("string"), F.lit(""))


def flattened(column: Column, kind: T.DataType) -> Column:
    """strings, and strings one list deeper; anything else is skipped."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.array_join(column, " ")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType) and isinstance(kind.elementType.elementType, T.StringType):
        return F.array_join(F.flatten(F.filter(column, lambda a: a.isNotNull())), " ")
    return F.lit("")


def struct_texts(column: Column, kind: T.DataType, names: tuple[str, ...] = ("text",)) -> Column:
    """non-empty first choice among ``names`` of each struct, or the strings of a list."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        have = [n for n in names if n in kind.elementType.names]
        if not have:
            return F.lit("")
        text = F.transform(column, lambda m: F.coalesce(*[m[n].cast("string") for n in have], F.lit("")))
        return F.array_join(F.filter(text, lambda s: s != ""), " ")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.array_join(column, " ")
    return column.cast("string") if isinstance(kind, T.StringType) else F.lit(None).cast("string")


def first_text(df: DataFrame, names: tuple[str, ...] = ("text", "content", "code", "body", "message")) -> Column:
    """The first of ``names`` that is not null in this row, else the first string column that is no id. Empty strings count."""
    kinds = {f.name: f.dataType for f in df.schema}
    picks = [struct_texts(F.col(n), kinds[n]) for n in names if n in kinds]
    rest = [F.col(n) for n, k in kinds.items() if isinstance(k, T.StringType) and n not in names and n.lower() not in ID_NAMES]
    return F.coalesce(*picks, *rest[:1], F.lit(None).cast("string"))


def last_sublist(column: Column) -> Column:
    """F05, kept for old data only: a list joined without separator; of nested lists only the last."""
    return F.array_join(F.element_at(column, -1), "")


def text_column(schema: T.StructType, preferred: list[str]) -> str | None:
    """R1 (S02): the first preferred name that is a string, else the first string column."""
    kinds = {f.name: f.dataType for f in schema}
    for name in preferred:
        if isinstance(kinds.get(name), T.StringType):
            return name
    return next((n for n, k in kinds.items() if isinstance(k, T.StringType)), None)


def text_column_by_hint(schema: T.StructType) -> str | None:
    """R2 (S03): the first column that is a string or whose name says text, content, message, body or document."""
    hints = ("text", "content", "message", "body", "document")
    return next((f.name for f in schema if isinstance(f.dataType, T.StringType) or any(h in f.name.lower() for h in hints)), None)


def auto_column(schema: T.StructType) -> str:
    """The first of text, code, content and data; an error without any."""
    for name in ("text", "code", "content", "data"):
        if name in schema.names:
            return name
    raise ValueError("none of text, code, content, data among the columns")
