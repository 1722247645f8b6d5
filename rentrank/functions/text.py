"""Text scalars: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHARS = [chr(code) for code in range(sys.maxunicode + 1) if not 0xD800 <= code <= 0xDFFF]

# Whatever Python calls white space; SQL ``trim`` on its own only knows the blank.
WHITESPACE = "".join(c for c in _CHARS if c.isspace())

# Decimal digits beyond 0-9 and the ASCII digit each stands for.
_OTHER_DIGITS = "".join(c for c in _CHARS if c > "9" and unicodedata.decimal(c, None) is not None)
_AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)

_OTHER_DIGIT = r"[\p{Nd}&&[^0-9]]"

# Superscripts and the like: digits that are not decimal, so ``\d`` does not match them.
_DIGIT_SIGNS = "".join(c for c in _CHARS if c.isdigit() and unicodedata.decimal(c, None) is None)
HAS_DIGIT = rf"(?U)[\d{_DIGIT_SIGNS}]"

_SPACE_RUN = f"[{WHITESPACE}]+"
_LINE_BREAK = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"

del _CHARS


def strip(text: Column) -> Column:
    """Remove white space, of any script, at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def nfkc(text: Column) -> Column:
    """Unicode NFKC form.

    Spark has no such function, but its collation support ships ICU, which ``reflect`` reaches
    without a Python worker. ASCII text is already in NFKC form and skips the call.
    """
    composed = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True)
    )
    return F.when(text.rlike(r"[^\x00-\x7F]"), composed).otherwise(text)


def clean_string(text: Column) -> Column:
    """NFKC, stripped, lower case."""
    return F.lower(strip(nfkc(text)))


def ascii_digits(text: Column, drop: str = "") -> Column:
    """Every decimal digit as 0-9; the characters in ``drop`` are removed in the same pass."""
    return F.translate(text, _OTHER_DIGITS + drop, _AS_ASCII)


def string_to_number(text: Column) -> Column:
    """The first run of digits and commas as BIGINT; NULL if there is no digit in it."""
    plain = F.replace(F.regexp_extract(text, r"[0-9,]+", 0), F.lit(","), F.lit(""))
    other = ascii_digits(F.regexp_extract(text, r"(?U)[\d,]+", 0), drop=",")
    digits = F.when(text.rlike(_OTHER_DIGIT), other).otherwise(plain)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def integer_text(text: Column) -> Column:
    """Whole text as INT where it is one integer literal (sign, blanks, ``1_000``); else NULL."""
    body = strip(text)
    is_integer = body.rlike(r"(?U)^[+-]?\d+(_\d+)*$")
    # Nearly all are up to nine plain digits; the other pattern and the translation cost more by far.
    plain = F.when(text.rlike(r"^[0-9]{1,9}\z"), text.cast("int"))
    return F.coalesce(plain, F.when(is_integer, ascii_digits(body, drop="_").try_cast("int")))


def id_from_url(url: Column) -> Column:
    """Text between the first and second "=", up to "&"; NULL where there is no "="."""
    # ``split_part`` would compile a pattern for each url.
    value = F.substring_index(F.substring_index(url, "=", 2), "=", -1)
    return F.when(F.contains(url, F.lit("=")), F.nullif(F.substring_index(value, "&", 1), F.lit("")))


def join_lines(text: Column) -> Column:
    """Stripped, non-blank lines joined by one blank."""
    lines = F.transform(F.split(text, _LINE_BREAK), strip)
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def drop_words_with_digits(text: Column) -> Column:
    words = F.split(text, _SPACE_RUN)
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.rlike(HAS_DIGIT)), " ")


def count_words(text: Column, words: tuple[str, ...]) -> Column:
    """How many pieces between single blanks are exactly one of ``words``."""
    pieces = F.split(text, " ")
    return F.coalesce(F.size(F.filter(pieces, lambda w: w.isin(*words))), F.lit(0))


def float_text(x: Column) -> Column:
    """A DOUBLE the way Python prints it.

    Spark switches to exponents below 1e-3 and from 1e7, Python below 1e-4 and from 1e16, and with
    another notation; a longitude near the meridian meets the former, a score that is not clamped
    the latter.
    """
    spark_text = x.cast("string")
    tidy = F.regexp_replace(spark_text, r"(\.0)?E-(\d)$", "e-0$2")
    digits = F.regexp_replace(F.regexp_replace(spark_text, r"(\.0)?E-4$", ""), r"[-.]", "")
    small = F.concat(F.when(x < 0, "-").otherwise(""), F.lit("0.000"), digits)
    # Nearly all numbers have no exponent; trying to cast what is not there costs an exception each.
    power = F.when(spark_text.contains("E"), F.regexp_extract(spark_text, r"E(\d+)$", 1).try_cast("int"))
    mantissa = F.regexp_extract(spark_text, r"^-?(\d\.\d+)E", 1)
    sign = F.when(x < 0, "-").otherwise("")
    # The digits behind the point move before it; what is missing of them is zeros.
    figures = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    whole = F.rpad(F.substring(figures, 1, power + 1), power + 1, "0")
    rest = figures.substr(power + 2, F.length(figures))
    large = F.concat(sign, whole, F.lit("."), F.when(rest != "", rest).otherwise("0"))
    huge = F.concat(sign, F.regexp_replace(mantissa, r"\.0$", ""), F.lit("e+"), power.cast("string"))
    return (
        F.when(~spark_text.contains("E"), spark_text)
        .when(spark_text.endswith("E-4"), small)
        .when(spark_text.contains("E-"), tidy)
        .when(power >= 16, huge)
        .when(power.isNotNull(), large)
        .otherwise(spark_text)
    )
