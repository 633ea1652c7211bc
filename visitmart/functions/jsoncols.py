"""Typed columns out of JSON text, parsed once per row inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A parse reads the first JSON value of a text and leaves the rest. So the text is parsed as the
# first element of an array whose second and last element is the text's own 64-bit hash: if that is
# found where it must be, the text was exactly one value.


def marked_json(text: Column) -> Column:
    """The parsed array of the text and its hash. Keep it as a column of its own: it is the one parse."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]")))


def one_value(marked: Column, text: Column) -> Column:
    """The text as a variant if it is exactly one JSON value; ``marked`` is its ``marked_json``.

    NULL for NULL, empty text, malformed JSON and text after the value. An object that repeats
    a key keeps its last value where ``spark.sql.variant.allowDuplicateKeys`` is on, as in
    ``build_session``, and is malformed elsewhere. The JSON value ``null`` is a variant, not NULL.
    """
    complete = F.try_variant_get(marked, "$[1]", "bigint") == F.xxhash64(text)
    return F.when(complete, F.try_variant_get(marked, "$[0]", "variant"))


def marked_json_sql(text: str) -> str:
    """``marked_json`` as SQL text."""
    return f"try_parse_json(concat('[', {text}, ',', CAST(xxhash64({text}) AS string), ']'))"


def is_array(value: Column) -> Column:
    """Whether a variant is an array; told by a cast, which does not walk through the members of an object."""
    return F.try_variant_get(value, "$", "array<variant>").isNotNull()


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def first_value(value: Column) -> Column:
    """The value, or the first element of an array; NULL for an empty array."""
    return F.when(is_array(value), F.try_variant_get(value, "$[0]", "variant")).otherwise(value)


def member(value: Column, key: str) -> Column:
    """A member of an object as a variant; NULL if it is missing or the value is no object."""
    return F.try_variant_get(value, f"$['{key}']", "variant")


def as_text(value: Column) -> Column:
    """A variant as text, whatever it holds; NULL for the JSON value ``null``.

    A number that is written with a fraction of zero is not a whole number: it ends in ``.0``.
    """
    text = F.try_variant_get(value, "$", "string")
    lost = F.schema_of_variant(value).startswith("DECIMAL") & ~text.contains(".")
    return F.when(lost, F.concat(text, F.lit(".0"))).otherwise(text)


def text_only(value: Column) -> Column:
    """A variant that holds text, as text; NULL for any other."""
    return F.when(F.schema_of_variant(value) == "STRING", as_text(value))


def as_int(text: Column) -> Column:
    """Integer, or NULL where the text is not one (empty, fraction, out of 32-bit range).

    A parse with Python ``int`` would also read ``1_000``, and a 32-bit column would
    wrap larger numbers; both give NULL here.
    """
    return text.try_cast("int")


def as_flag(text: Column) -> Column:
    """``true`` and ``false``, quoted or not; NULL for any other text."""
    return F.when(text == "true", True).when(text == "false", False)


def part(text: Column, separator: str, index: int) -> Column:
    """The piece at a zero-based index; empty text when there is no such piece."""
    return F.split_part(text, F.lit(separator), F.lit(index + 1))


def object_problem(text: Column, value: Column, first: Column) -> Column:
    """Why a text gives no object; NULL if it does, or is NULL or empty.

    ``value`` and ``first`` are the text's ``json_value`` and the ``first_value`` of that.
    """
    reason = (
        F.when(value.isNull(), "malformed_json")
        .when(is_array(value) & first.isNull(), "empty_array")
        .when(~is_object(first), "not_an_object")
    )
    return F.when(F.coalesce(text, F.lit("")) != "", reason)
