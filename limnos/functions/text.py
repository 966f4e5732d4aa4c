"""Text functions: number parsing, case and whitespace, words, ordered replacements."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from limnos import fixed_values as fixed

# try_cast alone would also take '1.5d' or 'Infinity', so plain numbers are recognised first.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# A sentence ends at ? or !, or at a dot whose next letter is not lower case.
SENTENCE_BREAK = r"(?<=[?!])\s+|(?<=\.)\s+(?![^\p{L}.?!]*\p{Ll})"


def to_number(text: Column, to: str = "double") -> Column:
    """Plain number text as ``double`` (or another numeric type); anything else is NULL."""
    number = F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))
    return number if to == "double" else number.try_cast(to)


def parse_decimal_comma(text: Column) -> Column:
    """``'1,25'`` -> 1.25; text that is no number is NULL."""
    return to_number(F.replace(text, F.lit(","), F.lit(".")))


def first_number(text: Column) -> Column:
    """The first number inside a text; a bracket caught with it makes the number NULL."""
    return parse_decimal_comma(F.regexp_extract(text, fixed.NUMBER_IN_TEXT, 0))


def parse_censored(
    text: Column,
    below: float = fixed.BELOW_LIMIT_FACTOR,
    above: float = fixed.ABOVE_LIMIT_FACTOR,
) -> Column:
    """Measurement text with detection limits: ``<x`` is ``x*below``, any other unparsable text
    is its first number times ``above``."""
    factor = F.when(text.contains("<"), F.lit(below)).otherwise(F.lit(above))
    return F.coalesce(parse_decimal_comma(text), first_number(text) * factor)


def parse_range_midpoint(text: Column) -> Column:
    """``'1,8-4,5'`` -> 3.15 and ``'1,7 meter'`` -> 1.7; other text as a decimal-comma number.

    The midpoint is taken in decimal arithmetic so that it reads as the printed digits do.
    """
    bounds = r"^\s*(\d+(?:[,.]\d+)?)\s*-\s*(\d+(?:[,.]\d+)?)\s*(?:m|meter)?\s*$"
    with_unit = r"^\s*(\d+(?:[,.]\d+)?)\s*(?:m|meter)\s*$"

    def bound(group: int) -> Column:
        digits = F.replace(F.regexp_extract(text, bounds, group), F.lit(","), F.lit("."))
        return digits.try_cast("decimal(18,6)")

    return (
        F.when(text.rlike(bounds), ((bound(1) + bound(2)) / F.lit(2)).cast("double"))
        .when(text.rlike(with_unit), parse_decimal_comma(F.regexp_extract(text, with_unit, 1)))
        .otherwise(parse_decimal_comma(text))
    )


def parse_over_limit(text: Column, above: float = fixed.ABOVE_LIMIT_FACTOR) -> Column:
    """``>x`` or ``≥x`` -> ``x*above`` if the text holds one number; other text as a number or NULL."""
    one = F.regexp_count(text, F.lit(fixed.NUMBER_IN_TEXT)) == 1
    return F.when(text.rlike("[>≥]"), F.when(one, first_number(text) * F.lit(above))).otherwise(
        parse_decimal_comma(text)
    )


def secchi_depth(text: Column) -> Column:
    """Transparency depth: ranges to their midpoint, depths over the limit to 10 % more."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike("[>≥]"), parse_over_limit(trimmed)).otherwise(parse_range_midpoint(trimmed))


def extract_number(text: Column, pattern: str = fixed.INDEX_NUMBER) -> Column:
    """First number of an index text, kept as text; NULL without one."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def extract_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match; NULL where the pattern does not occur."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace only the first occurrence."""
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def detect(text: Column, *marks: str) -> Column:
    """Whether the text holds any of the literal marks; NULL text stays NULL."""
    found = text.contains(marks[0])
    for mark in marks[1:]:
        found = found | text.contains(mark)
    return found


def squish(text: Column) -> Column:
    """Trim, and reduce inner whitespace to single spaces."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def sentence_case(text: Column) -> Column:
    """Lower case except the first letter of each sentence, so a capital after ``subgen.`` survives."""

    def recase(piece: Column) -> Column:
        lead = F.regexp_extract(piece, r"^([^\p{L}\p{N}\p{S}]*)", 1)
        at = F.length(lead) + 1
        return F.concat(lead, F.upper(F.substring(piece, at, F.lit(1))), F.lower(F.substr(piece, at + 1)))

    # the whitespace between sentences is kept by splitting behind it
    marked = F.regexp_replace(text, f"((?:{SENTENCE_BREAK}))", "$1\u0001")
    return F.array_join(F.transform(F.split(marked, "\u0001"), recase), "")


def word(text: Column, first: int, last: int | None = None) -> Column:
    """Words ``first..last`` counted between single spaces; NULL where there are fewer words."""
    last = first if last is None else last
    words = F.split(text, " ", -1)
    return F.when(F.size(words) >= last, F.array_join(F.slice(words, first, last - first + 1), " "))


def replace_many(text: Column, ordered_pairs: Iterable[tuple[str, str]]) -> Column:
    """Apply regular-expression replacements one after another, in the given order."""
    for pattern, replacement in ordered_pairs:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def remove_from(text: Column, marker: str) -> Column:
    """Drop the marker and everything behind it, then trim."""
    return F.trim(F.regexp_replace(text, f"({marker}).*", ""))


def recode_labels(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal short names for report labels, in order."""
    for name, short in pairs:
        text = F.replace(text, F.lit(name), F.lit(short))
    return text


def concat_na(*parts: Column) -> Column:
    """Concatenate, writing a missing part as ``NA``."""
    return F.concat(*[F.coalesce(part.cast("string"), F.lit("NA")) for part in parts])


def null_if(text: Column, *tokens: str) -> Column:
    """NULL where the text equals one of the tokens."""
    return F.when(~F.coalesce(text.isin(*tokens), F.lit(False)), text)


def null_if_contains(text: Column, fragment: str) -> Column:
    """NULL where the lower-cased text holds the fragment."""
    return F.when(~F.lower(text).contains(fragment), text)


def text_shape(text: Column) -> Column:
    """What is left of a value text without its digits."""
    return F.regexp_replace(text, r"\p{Nd}", "")
