"""Warehouse SQL functions that Spark lacks, as SQL functions that the analyzer inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from visitmart.functions.jsoncols import marked_json_sql

_CALL = f"json_value_at({marked_json_sql('document')}, xxhash64(document), "

# Name, arguments and body. A missing key, a missing element and malformed JSON give NULL.
# An argument is a column below its function's body, so the parse, which the body names twice, is one. Calls on one column in
# one projection have equal parses there, and generated code does these once per row.
_FUNCTIONS = {
    "json_value_at": (
        "marked VARIANT, own_hash BIGINT, path STRING",
        "CASE WHEN try_variant_get(marked, '$[1]', 'bigint') = own_hash THEN try_variant_get(marked, path, 'string') END",
    ),
    "json_extract_path_text": ("document STRING, member STRING", rf"{_CALL}concat('$[0][\'', member, '\']'))"),
    "json_extract_array_element_text": ("document STRING, at INT", f"{_CALL}concat('$[0][', at, ']'))"),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the functions known to SQL text in this session.

    ``nvl``, ``nvl2``, ``decode``, ``split_part`` and the date functions are Spark's own. Calls on
    one column in one projection share their parse.
    """
    for name, (arguments, body) in _FUNCTIONS.items():
        if not spark.catalog.functionExists(name):
            spark.sql(f"CREATE TEMPORARY FUNCTION {name}({arguments}) RETURNS STRING RETURN {body}")
