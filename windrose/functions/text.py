"""Text cleaning with the feed's conventions, as built-in column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the feed's cleaning rules count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that mean "missing" in the CSV files of the silver and override layers.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Texts that switch a flag on.
TRUE_WORDS = ["1", "true", "t", "yes", "y"]

_DECIMAL = r"(?i)^\s*[+-]?(inf(inity)?|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*$"


def strip(c: Column) -> Column:
    """Trim all Unicode white space; the one-argument `trim` knows only the space.

    It is several times as fast, so only texts that it leaves with other white space at an end take
    the long list.
    """
    spaced = F.trim(c)
    others = [F.substring(spaced, place, 1).isin(*WHITESPACE) for place in (1, -1)]
    return F.when(others[0] | others[1], F.btrim(c, F.lit(WHITESPACE))).otherwise(spaced)


def text_or(c: Column, default: str) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit(default)))


def csv_null(c: Column) -> Column:
    return F.when(~c.isin(MISSING_TOKENS), c)


def number(c: Column) -> Column:
    """Text to double; anything that is not a decimal number or an infinity becomes null.

    The cast alone would also take "nan" and Java's suffixed and hexadecimal forms ("1d",
    "0x1p3").
    """
    text = c.cast("string")
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def truthy(c: Column) -> Column:
    """JSON scalar text to boolean: null, false, zero and the empty text are False."""
    falsy = F.lower(c).isin("false", "") | F.coalesce(c.try_cast("double") == 0.0, F.lit(False))
    return F.coalesce(~falsy, F.lit(False))


def csv_flag(c: Column) -> Column:
    """Boolean that went through CSV text: only the word true counts."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def flag_word(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(TRUE_WORDS), F.lit(False))
