"""Text expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width of a fixed-length string field and the largest decimal
# exponent the float parser applies.
STRING_WIDTH = 128
MAX_EXPONENT = 38

# Characters at or below the space, which a field trim removes.
_TRIMMED = "".join(chr(i) for i in range(33))


def split_java(line: Column) -> Column:
    """Split on single spaces: inner empties stay, trailing empties go."""
    kept = F.rtrim(line)
    blank = (kept == "") & (F.length(line) > 0)
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(kept, " "))


def split_fields(text: Column) -> Column:
    """Words between runs of Unicode white space, no empties."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def split_letters(text: Column) -> Column:
    """Maximal runs of letters."""
    return F.array_remove(F.split(text, r"\P{L}+"), "")


def trim_field(value: Column) -> Column:
    """Strip every character up to the space from both ends."""
    return F.btrim(value, F.lit(_TRIMMED))


def trim_truncate(value: Column, width: int = STRING_WIDTH) -> Column:
    """Trim, then cut at the fixed field width."""
    return F.left(trim_field(value), F.lit(width))


def lenient_float(text: Column) -> Column:
    """The number at the start of ``text``; 0 where there is none.

    Leading blanks, a sign, digits, a fraction and an exponent are read up to
    the first character that fits none of them; exponents stop at 38.
    """
    plain = text.rlike(r"^[+-]?[0-9]{1,15}(\.[0-9]{1,15})?$")
    pattern = r"^[ \t\r\n\f]*([+-]?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?)([0-9]*))?"
    part = lambda i: F.regexp_extract(text, pattern, i)
    # nine digits are enough to know that an exponent is past the limit
    digits = F.regexp_replace(part(5), "^0+", "")
    power = F.when(digits == "", F.lit(0)).otherwise(
        F.when(F.length(digits) > 9, F.lit(MAX_EXPONENT)).otherwise(
            F.least(digits.try_cast("int"), F.lit(MAX_EXPONENT))
        )
    )
    literal = F.concat(
        F.lit("0"), part(2), F.lit("."), part(3), F.lit("0e"), part(4), power.cast("string")
    )
    size = F.coalesce(literal.try_cast("double"), F.lit(0.0))
    parsed = F.when(part(1) == "-", -size).otherwise(size)
    # most fields are plain numbers, which need one match and not five
    return F.when(plain, text.try_cast("double")).otherwise(parsed).cast("float")


def kv_line(key: Column, value: Column) -> Column:
    """``key: value``."""
    return F.concat(key, F.lit(": "), value)


def tab_line(*cols: Column) -> Column:
    """Every field followed by a tab."""
    return F.concat(*[F.concat(c.cast("string"), F.lit("\t")) for c in cols])


def message(number: Column) -> Column:
    """``Message_n``."""
    return F.concat(F.lit("Message_"), number.cast("string"))


def binary_to_string(value: Column) -> Column:
    return value.cast("string")
