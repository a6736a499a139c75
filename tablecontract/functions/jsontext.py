"""JSON text: validity, compaction and values prepared for ``to_json``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .numbers import decimal_text, is_not_finite
from .temporal import civil_datetime_text, rfc3339

KEEP_NULLS = {"ignoreNullFields": "false"}
# A string literal (kept) or white space between tokens (dropped). The
# quantifiers are possessive, so long texts need no stack.
_STRING_OR_SPACE = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|\s+'


# Follows a text to show that parsing got past its end. A text that holds it
# itself takes the longer way.
_END = "~end of text~"
# The JSON reader's own limits on depth and length, out of the way; all of it strict.
_UNLIMITED = {
    "maxNestingDepth": str(2**31 - 1), "maxNumLen": str(2**31 - 1), "maxStringLen": str(2**31 - 1), "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
}


def is_json(text: Column) -> Column:
    """True when the text is exactly one JSON value, of any depth and length.

    ``try_parse_json`` ignores what follows the first value. As the first of two
    elements, with a known second one, the text has to be one value to its end. Texts that it
    refuses, also for their depth, their length or a key that comes twice, are read again without limits.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    reached = F.try_variant_get(pair, "$[1]", "string") == _END
    fast = F.coalesce(~text.contains(_END) & reached, F.lit(False))
    return F.when(fast, True).otherwise(F.coalesce(_is_read_two_ways(text), F.lit(False)))


def _is_read_two_ways(text: Column) -> Column:
    """Both as a member of an object and as the only element of an array, neither of which is kept, with one more member after it.

    Whatever closes the one too early, or adds to it, is an error in the other. What is not kept is skipped token by token, so depth needs no stack.
    """
    after = lambda before, behind: F.from_json(F.concat(F.lit(before), text, F.lit(behind)), "end int", _UNLIMITED)["end"] == 1
    return after('{"v":', ',"end":1}') & after('{"v":[', '],"end":1}')


def compact(text: Column) -> Column:
    """The same JSON without white space between tokens; numbers, keys and their order are kept."""
    spaced = text.contains(" ") | text.contains("\n") | text.contains("\t") | text.contains("\r")
    return F.when(spaced, F.regexp_replace(text, _STRING_OR_SPACE, "$1")).otherwise(text)


def to_json(value: Column) -> Column:
    return F.to_json(value, KEEP_NULLS)


def sorted_map(value: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(value)))


def ready_for_json(value: Column, dtype: T.DataType) -> Column:
    """Rebuild a value so that ``to_json`` writes full timestamps, decimal text and sorted maps.

    Parts that already come out right are passed through untouched.
    """
    if not _needs_rewrite(dtype):
        return value
    if isinstance(dtype, T.TimestampType):
        return rfc3339(value)
    if isinstance(dtype, T.TimestampNTZType):
        return civil_datetime_text(value)
    if isinstance(dtype, T.DecimalType):
        return decimal_text(value, dtype.scale)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        refuse = F.raise_error(F.lit("NaN and infinity have no JSON form")).cast(dtype)
        return F.when(is_not_finite(value), refuse).otherwise(value)
    if isinstance(dtype, T.StructType):
        parts = [ready_for_json(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: ready_for_json(x, dtype.elementType))
    ready = F.transform_values(value, lambda _, x: ready_for_json(x, dtype.valueType))
    return sorted_map(ready)


def _needs_rewrite(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_needs_rewrite(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _needs_rewrite(dtype.elementType)
    return isinstance(
        dtype,
        (T.TimestampType, T.TimestampNTZType, T.DecimalType, T.FloatType, T.DoubleType, T.MapType),
    )


