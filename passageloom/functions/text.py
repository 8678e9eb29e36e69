"""Column expressions over passage text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space that separates words (tab to carriage return, and every Unicode space separator).
WHITESPACE = r"[\t\n\x0B\f\r\p{Zs}]+"


def commas_to_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(" "))


def lower_each_character(text: Column) -> Column:
    """Lower-case character by character.

    ``lower`` alone looks at context for the final sigma and turns one dotted capital I into two characters; both
    are mapped first, so the result has one character for each character of the input.
    """
    one_to_one = F.replace(F.replace(text, F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ"))
    return F.lower(one_to_one)


def words(text: Column, lowercase: bool = True) -> Column:
    """Array of the words of a text, in order, none empty."""
    source = lower_each_character(text) if lowercase else text
    # Only the first and the last piece of the split can be empty. array_remove stays in generated code, filter does not.
    return F.array_remove(F.split(source, WHITESPACE), "")


def distinct_words(text: Column, lowercase: bool = True) -> Column:
    return F.array_distinct(words(text, lowercase))


def key_before_comma(line: Column) -> Column:
    """The key of an ``id,text`` line: everything before the first comma."""
    return F.get(F.split(line, ",", 2), F.lit(0))


def text_after_comma(line: Column) -> Column:
    """The text of an ``id,text`` line, its further commas read as blanks; empty when there is no comma."""
    return commas_to_blanks(F.coalesce(F.get(F.split(line, ",", 2), F.lit(1)), F.lit("")))
