"""Text expressions shared by Spark operators and documented for the SQL oracle.

Regex dialects differ (Java in Spark, RE2 in DuckDB, ``re`` in the reference),
so every class is spelled out explicitly instead of ``\\s``/``\\w``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII whitespace (what ``str.split()``-style tokenisers treat as blank).
WS = r"\t\n\x0B\f\r "
# Unicode whitespace as Python's ``str.strip()`` sees it.
UWS = WS + r"\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
# Token contract: whitespace runs | numbers with inner points or commas |
# word-character runs | any other single char.  The alternatives cover every
# character, so running lengths are offsets.
TOKEN_PATTERN = rf"[{WS}]+|\p{{Nd}}+(?:[.,]\p{{Nd}}+)+|[{WORD}]+|[^{WS}{WORD}]"
WS_PIECE = rf"^[{WS}]"
STRIP_PATTERN = rf"^[{UWS}]+|[{UWS}]+$"
# Markdown fence around a response: leading ```lang + blanks, trailing blanks + ```.
FENCE = rf"^```[{WORD}]*[{UWS}]*|[{UWS}]*```$"
TAG = r'<class="([^"]+)">(.*?)</class>'


def ustrip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(c, F.lit(STRIP_PATTERN), F.lit(""))


def strip_fence(raw: Column) -> Column:
    return F.regexp_replace(ustrip(raw), F.lit(FENCE), F.lit(""))


def py_float_text(x: Column) -> Column:
    """Render a double as Python's ``str(float)``: shortest digits, fixed notation from
    1e-4 up to 1e16 (at least one decimal), else ``1e-05`` / ``1e+30``."""
    java = x.cast("double").cast("string")
    size = F.abs(x.cast("double"))
    fixed = F.regexp_replace(x.cast("double").cast("decimal(38,21)").cast("string"),
                             F.lit("0+$"), F.lit(""))
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    mantissa = F.regexp_replace(F.split_part(java, F.lit("E"), F.lit(1)), F.lit("[.]0$"), F.lit(""))
    power = F.split_part(java, F.lit("E"), F.lit(2))
    digits = F.lpad(F.replace(power, F.lit("-"), F.lit("")), F.greatest(F.length(F.replace(power, F.lit("-"), F.lit(""))), F.lit(2)), "0")
    sign = F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+"))
    scientific = F.concat(mantissa, F.lit("e"), sign, digits)
    return (F.when(F.isnan(x.cast("double")), F.lit("nan"))
            .when(java.isin("Infinity", "-Infinity"), F.replace(F.replace(java, F.lit("Infinity"), F.lit("inf")), F.lit("+"), F.lit("")))
            .when(size == 0, java)
            .when((size < 1e-4) | (size >= 1e16), scientific).otherwise(fixed))
