"""Text expressions, all ``Column -> Column``, usable on batch and streaming tables alike."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType, StructType

from clicklake.schemas import extended



def has_text(text: Column) -> Column:
    """Neither null nor empty."""
    return text.isNotNull() & (text != "")


def split_spaces(line: Column) -> Column:
    """Parts of a line between single spaces, empty parts at the end dropped.

    Inner and leading empty parts stay. A line of only spaces has no parts; an empty line has one,
    the empty string.
    """
    trimmed = F.rtrim(line)
    return _parts(line, trimmed, F.split(trimmed, " "))


def split_tokens(text: Column) -> Column:
    """Lower-case parts between single white-space characters, as Spark's ``Tokenizer`` makes them."""
    trimmed = F.rtrim(text, F.lit(" \t\n\x0b\f\r"))
    return _parts(text, trimmed, F.split(F.lower(trimmed), r"\s"))


def _parts(text, trimmed, parts):
    nothing_left = (trimmed == "") & (text != "")
    return F.when(nothing_left, F.array().cast("array<string>")).otherwise(parts)


def line_word_count(line: Column) -> Column:
    """Number of parts of a line, as int; null for a null line."""
    return F.when(line.isNotNull(), F.size(split_spaces(line)))


def text_length(text: Column, utf16_units: bool = False) -> Column:
    """Length in characters, or in 16-bit units as the JVM counts them."""
    if utf16_units:
        return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    return F.length(text)


def reverse_text(text: Column) -> Column:
    return F.reverse(text)


def is_upper_case(word: Column) -> Column:
    """Unchanged by upper-casing; words without letters pass."""
    return F.upper(word) == word


def prefixed(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(prefix), text)


def number_text(number: Column) -> Column:
    return number.cast("string")


def parsed_json(text: Column, schema: StructType, corrupt: str = "_corrupt_record") -> Column:
    """Text parsed to a struct; what did not fit the schema is kept in the ``corrupt`` field."""
    with_corrupt = extended(schema, **{corrupt: StringType()})
    return F.from_json(
        text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    )
