"""Column expressions for cleaning text, names and numbers."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A plain decimal number; Spark alone would also take `1.0d` or `1.5f`.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(col: Column) -> Column:
    """Remove Unicode blanks at both ends (``trim`` alone handles the space only)."""
    return F.btrim(col, F.lit(BLANKS))


def not_blank(col: Column) -> Column:
    """True unless the text is empty after stripping; null counts as not blank."""
    return F.coalesce(strip(col.cast("string")) != "", F.lit(True))


def joined_name(kind: Column, name: Column) -> Column:
    """``kind name``; null when either side is null."""
    return F.concat(kind, F.lit(" "), name)


def number_text(df: DataFrame, name: str) -> Column:
    """A door number as text; whole floating-point numbers print without exponent or ``.0``."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        whole = (col == F.floor(col)) & (F.abs(col) < F.lit(9.0e15))
        return F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def parse_coordinate(col: Column) -> Column:
    """Dirty coordinate text to a finite DOUBLE, else null."""
    text = strip(F.replace(col.cast("string"), F.lit("\xa0"), F.lit("")))
    value = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


@lru_cache(maxsize=1)
def _digit_table() -> tuple[str, str]:
    digits = [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def digits_id(col: Column) -> Column:
    """The id as BIGINT when its text consists of decimal digits only, else null."""
    text = col.cast("string")
    foreign, ascii_digits = _digit_table()
    plain = (
        F.when(text.rlike("^[0-9]+$"), text)
        .when(text.rlike(r"^\p{Nd}+$"), F.translate(text, foreign, ascii_digits))
    )
    return plain.try_cast("bigint")


def whole_number(col: Column) -> Column:
    """Text or number to BIGINT, decimals truncated, anything else null.

    The pattern tests come first because a cast that fails costs an exception per row.
    """
    plain = col.cast("string")
    text = strip(plain)
    return (
        F.when(plain.rlike("^[+-]?[0-9]{1,18}$"), plain.try_cast("bigint"))
        .when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
        .when(text.rlike(NUMBER_PATTERN), text.try_cast("decimal(38,10)").try_cast("bigint"))
    )


def real_number(col: Column, kind: T.DataType) -> Column:
    """Text or number to a floating-point type, anything else (also ``NaN``) null."""
    plain = col.cast("string")
    return F.when(plain.rlike(NUMBER_PATTERN), plain.try_cast(kind))


HANGUL, HANGUL_COUNT, VOWELS, TAILS = 0xAC00, 11172, 21, 28


def _plain_character(ch: str) -> str:
    """What is left of a character when its decomposition is followed to the end and marks are dropped."""
    place = ord(ch) - HANGUL
    if 0 <= place < HANGUL_COUNT:
        lead, rest = divmod(place, VOWELS * TAILS)
        vowel, tail = divmod(rest, TAILS)
        return chr(0x1100 + lead) + chr(0x1161 + vowel) + (chr(0x11A7 + tail) if tail else "")
    codes = [code for code in unicodedata.decomposition(ch).split() if not code.startswith("<")]
    if codes:
        return "".join(_plain_character(chr(int(code, 16))) for code in codes)
    return "" if unicodedata.combining(ch) else ch


@lru_cache(maxsize=1)
def _plain_table() -> dict[int, str]:
    """Every character that changes, with what it becomes."""
    codes = [c for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    return {c: plain for c in codes if (plain := _plain_character(chr(c))) != chr(c)}


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, str]:
    """(characters to replace, their replacements, pattern of characters that become several).

    The first string is longer than the second: its tail holds the marks to delete.
    """
    swap_from, swap_to, delete, expand = [], [], [], []
    for code, plain in _plain_table().items():
        ch = chr(code)
        if not plain:
            delete.append(ch)
        elif len(plain) == 1:
            swap_from.append(ch)
            swap_to.append(plain)
        else:
            expand.append(code)
    spans: list[list[int]] = []
    for code in expand:
        # Above Latin Extended-B near neighbours share a span; a wider test only costs time.
        gap = 1 if code < 0x250 else 32
        if spans and code - spans[-1][1] <= gap:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    classes = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans)
    return "".join(swap_from + delete), "".join(swap_to), f"(?=[^\\x00-\\x7F])[{classes}]"


@F.arrow_udf(T.StringType())
def _decompose(texts: pa.Array) -> pa.Array:
    table = _plain_table()
    return pa.array([None if t is None else t.translate(table) for t in texts.to_pylist()], type=pa.string())


def remove_accents(col: Column) -> Column:
    """Compatibility decomposition without combining marks.

    Almost every character maps to one character or none, which ``translate`` does in the JVM.
    Only texts holding a character that becomes several (ligatures, fractions, Hangul) reach Python;
    the rest go there as null.
    """
    swap_from, swap_to, expanding = _accent_tables()
    has_expanding = col.rlike(expanding)
    return (
        F.when(~col.rlike(r"[^\x00-\x7F]"), col)
        .when(~has_expanding, F.translate(col, swap_from, swap_to))
        .otherwise(_decompose(F.when(has_expanding, col)))
    )


def keyword(col: Column, limit: int = 256) -> Column:
    """The value itself when it is at most ``limit`` characters long, else null."""
    return F.when(F.length(col) <= limit, col)


def list_text(items: Column) -> Column:
    """A list of texts printed as ``['a', 'b']``."""
    quoted = F.transform(items, lambda item: F.concat(F.lit("'"), item, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
