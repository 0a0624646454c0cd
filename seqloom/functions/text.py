"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as surrounding whitespace, by code point.
WHITESPACE = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
# The same as a Java regular expression. (?U)\s alone leaves out the separators \x1c to \x1f.
STRIP_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def unicode_strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any script, not only blanks.

    The pattern runs over the whole text, so that it is left out where both ends are clean.
    """
    spaces = [chr(code) for code in WHITESPACE]
    padded = F.left(text, F.lit(1)).isin(spaces) | F.right(text, F.lit(1)).isin(spaces)
    return F.when(padded, F.regexp_replace(text, STRIP_PATTERN, "")).otherwise(text)


def normalized_text(value: Column, null_text: str = "drop") -> Column:
    """Cast to string and strip. `null_text="literal"` reads a null as the word None."""
    if null_text not in ("drop", "literal"):
        raise ValueError("null_text must be 'drop' or 'literal'")
    text = value.cast("string")
    if null_text == "literal":
        text = F.coalesce(text, F.lit("None"))
    return unicode_strip(text)


def has_text(text: Column) -> Column:
    """True for non-empty text; false, never null, otherwise."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def file_safe(metric: Column) -> Column:
    """A metric name that can stand in a file name."""
    return F.replace(metric, F.lit("/"), F.lit("_"))


def axis_label(metric: Column) -> Column:
    """`train_loss` as `Train Loss`."""
    return F.initcap(F.replace(metric, F.lit("_"), F.lit(" ")))
