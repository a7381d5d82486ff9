"""Text, number, money and year cleansing as Column expressions.

Nothing here is a UDF: every expression runs inside the scan's own stage. Unparseable input
becomes NULL and never raises, also under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from hazardmart.schemas import AMOUNT

# All characters Unicode counts as white space (the last one is U+3000); plain ``trim`` only
# strips blanks.
WHITESPACE = "".join(char for char in map(chr, range(0x3001)) if char.isspace())

# A word starts where a cased letter follows anything else: "(sismo)-2da" -> "(Sismo)-2Da".
WORD_EDGE = (
    r"(?<=[^\p{IsLowercase}\p{IsUppercase}\p{Lt}])|(?=[^\p{IsLowercase}\p{IsUppercase}\p{Lt}])"
)

# The same characters as ranges of a regular expression.
_BLANK = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Every text that can be a number or an amount matches; possessive repeats never backtrack.
NUMERIC = (
    rf"^[{_BLANK}$,+-]*+[.]?+[0-9][0-9$,.]*+(?:[eE][+-]?+[0-9$,]++)?+[{_BLANK}$,]*+$"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Upper-cased text without surrounding white space; accents stay."""
    return F.upper(strip(text))


def title_words(text: Column) -> Column:
    """Capitalise every run of letters, whatever precedes it."""
    words = F.split(F.lower(text), WORD_EDGE)
    return F.array_join(F.transform(words, F.initcap), "")


def _number(text: Column, candidate: Column, kind: str | DataType) -> Column:
    """``candidate``, stripped and cast, where ``text`` looks numeric; otherwise NULL.

    A failed cast costs a JVM exception, so the frequent ``SD`` and ``-`` are screened out
    first. Casting to decimal, not double, keeps cents exact and refuses
    what the floating-point parser would let through: NaN, Infinity, 1d, 0x10. Text with an exponent
    goes through double first, since an exact rescaling takes as long as its exponent is large.
    """
    plain = strip(candidate)
    number = F.when(text.rlike("[eE]"), plain.try_cast("double").try_cast(kind)).otherwise(
        F.when(~text.rlike("[eE]"), plain).try_cast(kind)
    )
    return F.when(text.rlike(NUMERIC), number)


def clean_number(text: Column) -> Column:
    """Number with thousands commas; anything else, like ``SD`` or ``211 801``, is NULL."""
    return _number(text, F.replace(text, F.lit(",")), AMOUNT)


def clean_money(text: Column) -> Column:
    """Amount with currency signs and thousands commas; a lone dash or no text is NULL."""
    return _number(text, F.translate(text, "$,", ""), AMOUNT)


def coerce_number(text: Column) -> Column:
    """Plain number: thousands commas are not accepted here."""
    return _number(text, text, "decimal(20,4)")


def coerce_year(text: Column) -> Column:
    """Year as an integer, also when spelled ``2021.0``; a fractional year is none."""
    year = coerce_number(text)
    return F.when(year == F.floor(year), year).try_cast("int")


def coerce_count(text: Column) -> Column:
    """Whole count, zero where the text holds no number."""
    return F.coalesce(coerce_whole(text), F.lit(0))


def loss(text: Column, value: Column) -> Column:
    """Why a text that says something became no ``value``; NULL if it did, or if it is blank.

    ``no_number``: it is none, like ``SD``; ``unfit``: it is one, but too large for the target type or
    spelled as the column does not allow, like a year with a fraction or a comma.
    """
    number = F.translate(strip(text), "$,", "").try_cast("double")
    reason = F.when(text.rlike(NUMERIC) & number.isNotNull(), "unfit").otherwise("no_number")
    return F.when(value.isNull() & text.isNotNull() & (strip(text) != ""), reason)


def coerce_whole(text: Column) -> Column:
    """Whole count, NULL where the text holds no number that fits."""
    return F.round(coerce_number(text)).try_cast("int")
