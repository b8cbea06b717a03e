"""String functions as Column expressions; all stay in whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 29 characters that Python's str.split() and str.strip() take as white space. Neither
# Spark's \s nor its (?U)\s is the same set. The 12 that are below U+0100 are listed one by one, which Java's
# matcher looks up in a table, and the others are behind one comparison that most characters fail.
_WIDE = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_SPACE = rf"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0[\u1680-\u3000&&[{_WIDE}]]]"
_NOT_WHITE_SPACE = rf"[^\t-\r\x1c-\x20\x85\xa0{_WIDE}]"


def collapse_ws(c: Column) -> Column:
    """Each run of white space as one space, none at the ends. Null stays null."""
    return F.trim(F.regexp_replace(c, f"{WHITE_SPACE}+", " "))


def strip_ws(c: Column) -> Column:
    """No white space at the ends; within, it stays as it is."""
    return F.regexp_replace(c, rf"\A{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")


def is_nonblank(c: Column) -> Column:
    """Neither null nor white space alone; never null itself."""
    return F.coalesce(c.rlike(_NOT_WHITE_SPACE), F.lit(False))


def truncate_ellipsis(c: Column, most: int) -> Column:
    """At most so many characters: a longer text is cut, spaces at the cut go, and "..." follows.

    For text that is collapsed already. Below 3 the cut is counted from the end: 3 - most characters go,
    and the result is longer than most.
    """
    kept = F.substring(c, 1, most - 3) if most >= 3 else F.substring(c, F.lit(1), F.greatest(F.length(c) - (3 - most), F.lit(0)))
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.rtrim(kept), F.lit("...")))


# JSON's short escapes, then \u00xx in lower-case hexadecimal for other controls.
_ESCAPES = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_CONTROLS = {chr(i): f"\\u{i:04x}" for i in range(0x20) if chr(i) not in _ESCAPES}


def escape_controls(c: Column) -> Column:
    """Controls without a short escape as \\u00xx. They are rare: one pattern looks for them, and only texts that have any are rewritten."""
    rare = c
    for raw, escaped in _CONTROLS.items():
        rare = F.replace(rare, F.lit(raw), F.lit(escaped))
    return F.when(c.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), rare).otherwise(c)


def json_quote(c: Column, controls: bool = True) -> Column:
    """A JSON string of the text, other than ASCII as it is. Null stays null.

    controls: as False, rare controls are left to escape_controls() on the JSON text that this becomes part of.
    """
    for raw, escaped in _ESCAPES.items():
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), escape_controls(c) if controls else c, F.lit('"'))
