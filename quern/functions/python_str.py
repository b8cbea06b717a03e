"""Python's str() of floats, decimals and timestamps, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(c: Column) -> Column:
    """(digits, point): a finite double's digits without zeros at either end, and where the point is: 0.digits * 10**point.

    From the JVM's text of it, plain or with an exponent; of large whole numbers that a bigint holds, from that.
    """
    text = F.when((F.abs(c) >= 9.1e15) & (F.abs(c) < 9e18), F.concat(F.abs(c).try_cast("bigint").cast("string"), F.lit(".0"))).otherwise(F.abs(c).cast("string"))
    mantissa, exponent = F.substring_index(text, "E", 1), F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    whole, part = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    every = F.concat(whole, part)
    lead = F.length(every) - F.length(F.ltrim(every, F.lit("0")))
    return F.struct(F.trim(every, F.lit("0")).alias("digits"), (F.length(whole) + exponent - lead).alias("point"))


def _shorter(at: Column, less: int, up: bool) -> Column:
    """The same with so many digits less, rounded up or down."""
    n = F.length(at["digits"]) - less
    kept = (F.left(at["digits"], n).try_cast("decimal(20,0)") + (1 if up else 0)).cast("string")
    return F.struct(F.rtrim(kept, F.lit("0")).alias("digits"), (at["point"] + F.length(kept) - n).alias("point"))


def float_str(c: Column) -> Column:
    """Python's str() of a float or double: the fewest digits that give it back; fixed from 1e-4 up to below 1e16, else with an exponent of two digits at least.

    The JVM's own text has a digit or two too many for some doubles, so fewer are tried where it has very many (or the double is tiny).
    Beyond 9e18 and below 1e-4, one in some 50,000 texts of 17 digits differs from Python's in the last one, where the JVM's isn't the
    nearest; it gives the double back all the same. Null stays null.
    """
    return _then(_then(F.struct(c.cast("double").alias("x"), _digits(c.cast("double")).alias("at")), _fewest), _laid_out)


def _then(c: Column, of: Callable[[Column], Column]) -> Column:
    """of(c), which may look at c many times, with c made once."""
    return F.transform(F.array(c), of)[0]


def _fewest(v: Column) -> Column:
    x, at, tried = F.abs(v["x"]), v["at"], []
    for less in (3, 2, 1):
        half = F.right(at["digits"], F.lit(less)) >= f"{5 * 10 ** (less - 1)}"
        for up in (half, ~half):
            one = F.when(up, _shorter(at, less, True)).otherwise(_shorter(at, less, False))
            back = F.concat(F.lit("0."), one["digits"], F.lit("E"), one["point"].cast("string")).try_cast("double")
            tried.append(F.when((F.length(at["digits"]) > less) & (back == x), one))
    long = (F.length(at["digits"]) >= 16) | (x < 1e-300)
    return F.struct(v["x"].alias("x"), F.when(long, F.coalesce(*tried, at)).otherwise(at).alias("at"))


def _laid_out(v: Column) -> Column:
    x, digits, point = v["x"], v["at"]["digits"], v["at"]["point"]
    zeros, n = (lambda k: F.repeat(F.lit("0"), k)), F.length(digits)
    fixed = (
        F.when(point <= 0, F.concat(F.lit("0."), zeros(-point), digits))
        .when(n <= point, F.concat(digits, zeros(point - n), F.lit(".0")))
        .otherwise(F.concat(F.left(digits, point), F.lit("."), F.right(digits, n - point)))
    )
    power = point - 1
    exponent = F.concat(F.lit("e"), F.when(power < 0, F.lit("-")).otherwise(F.lit("+")), F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
    scientific = F.concat(F.left(digits, F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.right(digits, n - 1))).otherwise(F.lit("")), exponent)
    # The sign of zero too.
    sign = F.when((x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-"))), F.lit("-")).otherwise(F.lit(""))
    body = F.when(x == 0, F.lit("0.0")).when((point > -4) & (point <= 16), fixed).otherwise(scientific)
    inf = float("inf")
    return F.when(x.isNull(), F.lit(None)).when(F.isnan(x), F.lit("nan")).when(x == inf, F.lit("inf")).when(x == -inf, F.lit("-inf")).otherwise(F.concat(sign, body))


def decimal_str(c: Column, scale: int) -> Column:
    """Python's str() of a decimal of this scale: plain, but with an exponent below 1e-6."""
    if scale <= 6:
        return c.cast("string")
    digits = F.ltrim(F.replace(F.abs(c).cast("string"), F.lit("."), F.lit("")), F.lit("0"))
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    power = F.length(digits) - 1 - scale
    text = F.concat(F.left(digits, F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.right(digits, F.length(digits) - 1))).otherwise(F.lit("")), F.lit("E"), power.cast("string"))
    return F.when(power >= -6, c.cast("string")).otherwise(F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), text))


def timestamp_str(c: Column) -> Column:
    """Python's str() of a timestamp: microseconds, all six digits, only if there are any."""
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
