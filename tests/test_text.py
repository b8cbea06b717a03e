"""Column functions against Python's own string functions, which define them."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import collapse_ws, is_nonblank, json_quote, json_span, parse_reply, reply_struct, strip_reasoning, strip_ws, truncate_ellipsis

SPACES = [chr(i) for i in range(0x3001) if chr(i).isspace()]


def strings():
    rng = random.Random(5)
    alphabet = [*SPACES, *"ab​﻿é😀\"\\/%{}'", "\x00", "\x1b", "\x7f", " "]
    return ["", " ", "x", "".join(SPACES), "a" + "b".join(SPACES) + "c", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(300))]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate([*strings(), None])], "i int, s string").cache()


def column(frame, made):
    return [r.x for r in frame.orderBy("i").select(made.alias("x")).collect()]


def test_there_are_29_spaces():
    assert len(SPACES) == 29


def test_white_space(frame):
    given = [*strings(), None]
    assert column(frame, collapse_ws(F.col("s"))) == [None if s is None else " ".join(s.split()) for s in given]
    assert column(frame, strip_ws(F.col("s"))) == [None if s is None else s.strip() for s in given]
    assert column(frame, is_nonblank(F.col("s"))) == [bool(s and s.strip()) for s in given]


@pytest.mark.parametrize("most", [4000, 12, 4, 3, 2, 0, -1])
def test_truncation(frame, most):
    def cut(s):
        t = " ".join(s.split())
        return t if len(t) <= most else t[: most - 3].rstrip() + "..."

    assert column(frame, truncate_ellipsis(collapse_ws(F.col("s")), most)) == [None if s is None else cut(s) for s in [*strings(), None]]


def test_json_quote(spark):
    given = [*strings(), *map(chr, range(0x30)), None]
    frame = spark.createDataFrame(list(enumerate(given)), "i int, s string")
    assert column(frame, json_quote(F.col("s"))) == [None if s is None else json.dumps(s, ensure_ascii=False) for s in given]


REPLIES = {
    '{"question":" q ","answer":"a"}': ("q", "a", None),
    '<think>x {y}</think>{"question":"q","answer":"a"}': ("q", "a", None),
    '<THINK>\nx</Think>\n{"question":"q","answer":"a"}': ("q", "a", None),
    '<think>{ {"question":"q","answer":"a"}': (None, None, "bad_json"),
    '```json\n{"question":"q","answer":"a"}\n```': ("q", "a", None),
    'So: {"question":"q","answer":"a"} done': ("q", "a", None),
    '{"question":"q","answer":"a"} {"question":"q","answer":"a"}': (None, None, "bad_json"),
    '{"question":"q","answer":"a"} junk }': (None, None, "bad_json"),
    "none": (None, None, "no_json"),
    "": (None, None, "no_json"),
    "} {": (None, None, "no_json"),
    '{"question":"q","answer":"a",}': (None, None, "bad_json"),
    "{'question':'q','answer':'a'}": (None, None, "bad_json"),
    '{"question":"q\n","answer":"a"}': (None, None, "bad_json"),
    '{"question":01,"answer":"a"}': (None, None, "bad_json"),
    '{"answer":"a"}': (None, None, "no_question"),
    '{"question":null,"answer":"a"}': (None, None, "no_question"),
    '{"question":["q"],"answer":"a"}': (None, None, "no_question"),
    '{"question":true,"answer":"a"}': (None, None, "no_question"),
    '{"question":" ","answer":"a"}': (None, None, "no_question"),
    '{"question":"q","answer":1}': (None, None, "no_answer"),
    '{"question":"q"}': (None, None, "no_answer"),
    '{"QUESTION":"q","answer":"a"}': (None, None, "no_question"),
    '{"question":"a","question":"b","answer":"a"}': ("b", "a", None),
    '{"question":"q","answer":"a","x":NaN,"y":1e999,"z":{"k":1,"k":2}}': ("q", "a", None),
    '{"question":"\\ud800","answer":"a"}': (None, None, "lone_surrogate"),
    None: (None, None, "null_content"),
}


def test_replies(spark):
    assert {r: parse_reply(r) for r in REPLIES} == REPLIES
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(REPLIES)], "i int, r string")
    rows = frame.orderBy("i").select(reply_struct(F.col("r")).alias("x")).collect()
    assert [(r.x.question, r.x.answer, r.x.error) for r in rows] == list(REPLIES.values())


def test_reasoning_and_span(spark):
    given = ["<think>a</think> b <think>c", "</think>x", "<THINK>\n</tHINK>", " {a} b {c} ", "}{", ""]
    frame = spark.createDataFrame(list(enumerate(given)), "i int, s string")
    assert column(frame, strip_reasoning(F.col("s"))) == ["b <think>c", "</think>x", "", "{a} b {c}", "}{", ""]
    assert column(frame, json_span(F.col("s"))) == [None, None, None, "{a} b {c}", None, None]
