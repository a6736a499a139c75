"""Rows as interchange JSON, one object per row, in two dialects.

The dialects differ in two column types. ``load`` writes a timestamp as RFC 3339
text and embeds a JSON column; ``append`` writes microseconds and quotes the
JSON text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from .. import types as ct
from ..errors import ContractError
from ..functions import jsontext, numbers, temporal
from .gates import enforce

LOAD = "load"
APPEND = "append"


def render(df: DataFrame, columns, *, dialect: str = LOAD, keep=(), alias: str = "json", row_id: str | None = None, gated: bool = True) -> DataFrame:
    """One JSON text per row: keys sorted at every level, NULL columns present.

    ``columns`` describe the columns of ``df``; one of ``df`` they do not know is
    an error. Text that is not JSON is refused in the load dialect only.
    """
    if dialect not in (LOAD, APPEND):
        raise ContractError(f"unknown dialect {dialect!r}, want {LOAD} or {APPEND}")
    unknown = sorted(set(df.columns) - set(ct.names(columns)) - set(keep))
    if unknown:
        raise ContractError(f"the contract has no column {', '.join(unknown)}")
    present = [c for c in columns if c.name in df.columns]
    if gated:
        df = enforce(df, present, row_id=row_id, finite=True, json=dialect == LOAD)
    text = _object_text(present, lambda name: F.col(f"`{name}`"), dialect)
    return df.select(*keep, text.alias(alias))


def _object_text(columns, at, dialect) -> Column:
    """Runs of ordinary columns go through ``to_json``; embedded JSON is spliced in
    between as text, so its numbers and key order survive."""
    parts: list[Column] = []
    run: list[Column] = []

    def close_run():
        if run:
            inside = jsontext.to_json(F.struct(*run))
            parts.append(F.substring(inside, F.lit(2), F.length(inside) - 2))
            run.clear()

    ordered = sorted(columns, key=lambda c: c.name)
    if not any(_holds_json(c, dialect) for c in ordered):
        return jsontext.to_json(F.struct(*[_value(c, at(c.name), dialect).alias(c.name) for c in ordered]))
    for column in ordered:
        if _holds_json(column, dialect):
            close_run()
            parts.append(F.concat(F.lit(f"{json.dumps(column.name, ensure_ascii=False)}:"), _embedded(column, at(column.name), dialect)))
        else:
            run.append(_value(column, at(column.name), dialect).alias(column.name))
    close_run()
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _holds_json(column, dialect) -> bool:
    if dialect == APPEND:
        return False
    return column.type == ct.JSON or any(_holds_json(f, dialect) for f in column.fields)


def _embedded(column, value: Column, dialect) -> Column:
    if column.repeated:
        items = F.transform(value, lambda x: _embedded_element(column, x, dialect))
        text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
        return F.coalesce(text, F.lit("null"))
    return _embedded_element(column, value, dialect)


def _embedded_element(column, value: Column, dialect) -> Column:
    if column.type == ct.JSON:
        return F.coalesce(F.nullif(jsontext.compact(value), F.lit("")), F.lit("null"))
    text = _object_text(column.fields, value.getField, dialect)
    return F.when(value.isNull(), "null").otherwise(text)


def _value(column, value: Column, dialect) -> Column:
    if not _changes(column, dialect):
        return value
    if column.repeated:
        return F.transform(value, lambda x: _element(column, x, dialect))
    return _element(column, value, dialect)


def _changes(column, dialect) -> bool:
    return column.type in _TEXT_OF or column.type in (ct.TIMESTAMP, ct.RECORD, ct.JSON, ct.NUMERIC, ct.BIGNUMERIC)


def _element(column, value: Column, dialect) -> Column:
    if column.type == ct.RECORD:
        fields = sorted(column.fields, key=lambda c: c.name)
        parts = [_value(f, value.getField(f.name), dialect).alias(f.name) for f in fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if column.type == ct.TIMESTAMP:
        return temporal.rfc3339(value) if dialect == LOAD else F.unix_micros(value)
    if column.type == ct.JSON:
        return F.nullif(value, F.lit(""))
    if column.type in (ct.NUMERIC, ct.BIGNUMERIC):
        return numbers.decimal_text(value, column.decimal_shape()[1])
    return _TEXT_OF[column.type](value)


_TEXT_OF = {
    ct.DATE: lambda c: c.cast("string"),
    ct.DATETIME: temporal.civil_datetime_text,
    ct.TIME: temporal.civil_time_text,
}


def write_ndjson(df: DataFrame, columns, path: str, *, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Newline delimited JSON in the load dialect."""
    options = {"compression": compression} if compression else {}
    render(df, columns, dialect=LOAD, alias="value").write.mode(mode).options(**options).text(path)
