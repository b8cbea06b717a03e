"""What a model replied: reasoning removed, JSON object found, strictly decoded and validated."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws

REPLY = "struct<question: string, answer: string, error: string>"
#: Errors of a reply, by their code.
NO_JSON, BAD_JSON, NO_QUESTION, NO_ANSWER = "no_json", "bad_json", "no_question", "no_answer"
#: Errors that no reply should give rise to.
NULL_CONTENT, LONE_SURROGATE, UNDECODABLE = "null_content", "lone_surrogate", "undecodable"
UNEXPECTED = (NULL_CONTENT, LONE_SURROGATE, UNDECODABLE)


def strip_reasoning(c: Column) -> Column:
    """Without closed <think> blocks (in any case, over lines), and stripped. What isn't closed stays."""
    return strip_ws(F.regexp_replace(c, r"(?isu)<think>.*?</think>", ""))


def json_span(c: Column) -> Column:
    """From the first { to the last }; null if there's none."""
    return F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))


_REASONING = re.compile("<think>.*?</think>", re.IGNORECASE | re.DOTALL)


def parse_reply(raw: str | None) -> tuple[str | None, str | None, str | None]:
    """(question, answer, error): error is None exactly if both others are there."""
    if raw is None:
        return None, None, NULL_CONTENT
    text = _REASONING.sub("", raw)
    begin, end = text.find("{"), text.rfind("}")
    if begin < 0 or end < begin:
        return None, None, NO_JSON
    try:
        found = json.loads(text[begin : end + 1])
    except json.JSONDecodeError:
        return None, None, BAD_JSON
    except (ValueError, RecursionError):
        return None, None, UNDECODABLE
    values = []
    for key, error in (("question", NO_QUESTION), ("answer", NO_ANSWER)):
        value = found.get(key)
        value = value.strip() if isinstance(value, str) else ""
        if not value:
            return None, None, error
        values.append(value)
    try:
        "".join(values).encode()
    except UnicodeEncodeError:
        return None, None, LONE_SURROGATE
    return values[0], values[1], None


def reply_struct(c: Column) -> Column:
    """parse_reply of a column, in Arrow batches, whose replies are taken one at a time; see session.small_batches for how large a batch is.

    Spark's own JSON functions are laxer than the decoder that replies are defined by: they take two
    objects, single quotes, and numbers where strings are asked for.
    """

    @F.arrow_udf(REPLY)
    def parsed(replies: pa.Array) -> pa.Array:
        found = zip(*(parse_reply(x.as_py()) for x in replies)) if len(replies) else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in found], ["question", "answer", "error"])

    return parsed(c)
