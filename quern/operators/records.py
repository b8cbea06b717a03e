"""Chat records, typed and as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import escape_controls, json_quote


def _object(**values: Column) -> Column:
    """JSON text of an object, with ", " and ": " as Python's json has them."""
    parts = [x for i, (k, v) in enumerate(values.items()) for x in (F.lit((", " if i else "{") + f'"{k}": '), v)]
    return F.concat(*parts, F.lit("}"))


def raw_assistant_json(question: Column, answer: Column) -> Column:
    """assistant_json() but for escape_controls(), which looks at its text several times and is best a step of its own."""
    return _object(question=json_quote(question, False), answer=json_quote(answer, False))


def assistant_json(question: Column, answer: Column) -> Column:
    """What the assistant says: the pair, as JSON text."""
    return escape_controls(raw_assistant_json(question, answer))


def chat_record(prompt: Column, assistant: Column, dataset: Column, split: Column, row_id: Column, source_fields: Column) -> Column:
    """messages (user, then assistant) and meta, as a struct."""
    messages = F.array(*(F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in (("user", prompt), ("assistant", assistant))))
    meta = F.struct(dataset.alias("dataset"), split.alias("split"), row_id.alias("row_id"), source_fields.alias("source_fields"))
    return F.struct(messages.alias("messages"), meta.alias("meta"))


def raw_record_json(record: Column) -> Column:
    """chat_record_json() but for escape_controls()."""
    said = [_object(**{k: json_quote(record["messages"][i][k], False) for k in ("role", "content")}) for i in (0, 1)]
    meta = _object(**{k: json_quote(record["meta"][k], False) for k in ("dataset", "split", "row_id", "source_fields")})
    return _object(messages=F.concat(F.lit("["), said[0], F.lit(", "), said[1], F.lit("]")), meta=meta)


def chat_record_json(record: Column) -> Column:
    """The record's line in a JSON Lines file, byte for byte as Python's json writes it, other than ASCII as it is.

    Spark's to_json has no spaces after separators, drops nulls and writes controls in upper case.
    """
    return escape_controls(raw_record_json(record))
