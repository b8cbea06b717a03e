"""The best text of a row, whatever the table's columns are, and the row's id.

Which columns can be text is decided once, from the schema; rows only pay for the columns that are left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.python_str import decimal_str, float_str, timestamp_str
from ..functions.text import collapse_ws, is_nonblank, truncate_ellipsis

# Column names that are text by themselves, first to last; parts of names that are never
# text; names of ids, first to last.
PREFERRED_FIELDS = ("text", "content", "document", "body", "paragraph", "sentence", "ocr", "transcript")
NO_TEXT_PARTS = ("id", "uuid", "url", "uri", "path", "link", "file", "source", "date", "time", "lang", "language", "label", "split")
ID_FIELDS = ("id", "row_id", "uuid", "doc_id", "document_id")

SOURCE_CHARS = 4000


@dataclass(frozen=True)
class TextFields:
    """Places of a schema's text columns."""

    preferred: tuple[int, ...]
    fallback: tuple[int, ...]
    ids: tuple[int, ...]


def text_fields(schema: T.StructType) -> TextFields:
    """Preferred and id columns by exact name, in their own order; fallback columns in the schema's order."""
    names = [f.name for f in schema.fields]
    strings = [isinstance(f.dataType, T.StringType) for f in schema.fields]
    return TextFields(
        tuple(names.index(n) for n in PREFERRED_FIELDS if n in names and strings[names.index(n)]),
        tuple(i for i, n in enumerate(names) if strings[i] and not any(part in n.lower() for part in NO_TEXT_PARTS)),
        tuple(names.index(n) for n in ID_FIELDS if n in names),
    )


def _add(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """df and more columns, which are made of columns c0, c1 and so on: names that clash, or hold dots, don't matter."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select("*", *(c.alias(n) for n, c in made.items())).toDF(*df.columns, *made)


def with_source_text(df: DataFrame, max_chars: int = SOURCE_CHARS, skip: tuple[str, ...] = ("row_index",)) -> DataFrame:
    """df with source_fields and source_text, both null for a row without usable text.

    The first preferred column that isn't blank, alone; else all fallback columns that aren't blank, joined.
    White space is collapsed, and the text is cut at max_chars. skip: columns that aren't the dataset's own.
    """
    fields, names = text_fields(df.schema), df.columns
    fallback = [i for i in fields.fallback if names[i] not in skip]
    c = {i: F.col(f"c{i}") for i in (*fields.preferred, *fallback)}
    choices = [F.when(is_nonblank(c[i]), F.struct(F.lit(names[i]).alias("fields"), c[i].alias("text"))) for i in fields.preferred]
    if fallback:
        # Any white space between parts gives the same text, as it's collapsed after.
        parts = F.concat_ws(" ", *(F.when(is_nonblank(c[i]), c[i]) for i in fallback))
        used = F.concat_ws(",", *(F.when(is_nonblank(c[i]), F.lit(names[i])) for i in fallback))
        choices.append(F.when(used != "", F.struct(used.alias("fields"), parts.alias("text"))))
    best = F.coalesce(*choices) if choices else F.lit(None).cast("struct<fields: string, text: string>")
    # Cutting looks at the collapsed text several times; a step of its own makes that once.
    collapsed = _add(df, {"source_fields": best["fields"], "source_text": collapse_ws(best["text"])})
    plain = collapsed.toDF(*(f"c{i}" for i in range(len(collapsed.columns))))
    return plain.select(*plain.columns[:-1], truncate_ellipsis(F.col(plain.columns[-1]), max_chars)).toDF(*collapsed.columns)


def _python_str(c: Column, kind: T.DataType) -> Column:
    """Python's str() of a value, natively for strings, numbers, dates and timestamps; bytes and nested kinds go through Python in Arrow batches."""
    if isinstance(kind, (T.StringType, T.IntegralType, T.DateType)):
        return c.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float_str(c)
    if isinstance(kind, T.DecimalType):
        return decimal_str(c, kind.scale)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_str(c)

    def text(x):
        if x is None:
            return None
        if isinstance(x, bytearray):
            x = bytes(x)
        return str(x.asDict(recursive=True) if hasattr(x, "asDict") else x)

    return F.udf(text, "string", useArrow=True)(c)


def with_row_id(df: DataFrame, row_index: str = "row_index", name: str = "row_id_text") -> DataFrame:
    """df with the row's id as text: the first id column that isn't null, else the row's ordinal."""
    fields = text_fields(df.schema)
    ids = [_python_str(F.col(f"c{i}"), df.schema[i].dataType) for i in fields.ids]
    return _add(df, {name: F.coalesce(*ids, F.col(f"c{df.columns.index(row_index)}").cast("string"))})
