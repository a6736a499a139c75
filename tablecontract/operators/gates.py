"""Conditions a row has to meet. One row that does not fails its whole batch, or is split off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import types as ct
from ..functions import jsontext
from ..functions.numbers import is_not_finite

REASONS = "_reasons"
# Ends every reason while they are one text.
BREAK = "\x1e"


def once(value: Column) -> Column:
    """The value, kept where it is computed.

    A filter on it would otherwise move below the projection and compute it, and
    everything it is made of, once more per mention. An expression that looks
    non-deterministic stays in place; the condition here always holds.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def problems(columns, at=None, path: str = "", *, finite: bool = False, json: bool = True, trusted=()) -> list[Column]:
    """One text per condition, ending in ``BREAK``; NULL or empty where the row meets it.

    ``columns`` are the contract's and ``at`` reads one by name. ``finite`` also
    refuses NaN and infinity, which have no place in rendered JSON, and ``json``
    checks the text of JSON columns, ``trusted`` ones aside.
    """
    at = at or (lambda name: F.col(f"`{name}`"))
    found: list[Column] = []
    for column in columns:
        value, label = at(column.name), path + column.name
        if column.repeated:
            found += _repeated(column, value, label, finite, json and label not in trusted)
            continue
        if column.required:
            found.append(problem(value.isNull(), f"column {label}: a REQUIRED column cannot be NULL"))
        found += _element(column, value, label, finite, json and label not in trusted)
    return found


def _element(column, value, label, finite, json) -> list[Column]:
    if column.type == ct.RECORD:
        inner = problems(column.fields, value.getField, label + ".", finite=finite, json=json)
        return [F.when(value.isNotNull(), p) for p in inner]
    if json and column.type == ct.JSON:
        return [problem((value != "") & ~jsontext.is_json(value), f"column {label}: not valid JSON")]
    if finite and column.type == ct.FLOAT:
        return [problem(is_not_finite(value), f"column {label}: NaN and infinity have no JSON form")]
    return []


def _repeated(column, value, label, finite, json) -> list[Column]:
    found = [
        problem(F.exists(value, lambda x: x.isNull()), f"column {label}: a repeated column cannot hold a NULL element")
    ]
    if _element(column, F.lit(None).cast(column.element_type()), label, finite, json):
        inner = F.transform(value, lambda x: one_text(_element(column, x, label + "[]", finite, json)))
        found.append(F.array_join(F.array_distinct(inner), ""))
    return found


def problem(condition: Column, text: str | Column) -> Column:
    """A reason where the condition holds, NULL elsewhere."""
    return F.when(condition, F.lit(text + BREAK) if isinstance(text, str) else F.concat(text, F.lit(BREAK)))


def one_text(found: list[Column]) -> Column:
    """All that is wrong in one text, empty when nothing is. Never leaves code generation for plain columns."""
    return F.concat_ws("", *found)


def gate(found: list[Column], row_id: Column | None = None) -> Column:
    """A filter condition that fails the task with the row's reasons instead of dropping the row."""
    text = one_text(found)
    return F.when(text == "", F.lit(True)).otherwise(refusal(text, row_id).cast("boolean"))


def refusal(text: Column, row_id: Column | None = None) -> Column:
    """Fails the task when it is evaluated, naming the row where it can."""
    who = F.lit("") if row_id is None else F.concat(F.lit("row "), F.coalesce(row_id.cast("string"), F.lit("?")), F.lit(": "))
    return F.raise_error(F.concat(who, F.replace(F.rtrim(text, F.lit(BREAK)), F.lit(BREAK), F.lit("; "))))


def enforce(
    df: DataFrame, columns, *, row_id: str | None = None, finite: bool = False, json: bool = True, trusted=(),
    costly: bool = False,
) -> DataFrame:
    """Fail the job on a row that breaks the contract.

    It is a filter rather than a column, so pruning columns cannot remove it.
    ``costly`` columns are computed before the filter, and once.
    """
    return enforce_problems(df, problems(columns, finite=finite, json=json, trusted=trusted), row_id=row_id, costly=costly)


def enforce_problems(df: DataFrame, found: list[Column], *, row_id: str | None = None, costly: bool = False) -> DataFrame:
    """Fail the job on a row one of the problems applies to."""
    if not found:
        return df
    who = F.col(f"`{row_id}`") if row_id else None
    if not costly:
        return df.filter(gate(found, who))
    return hold_back(df.withColumn(REASONS, once(one_text(found))), who)


def hold_back(df: DataFrame, row_id: Column | None) -> DataFrame:
    """Fail on a row whose reasons, one text kept in place, are not empty."""
    return df.filter(gate([F.col(REASONS)], row_id)).drop(REASONS)


def reasons_array(found: list[Column]) -> Column:
    """The reasons as an array, cut from one text: an array of NULLs to compact
    would take all the conditions out of code generation."""
    if not found:
        return F.array().cast(T.ArrayType(T.StringType()))
    return F.array_remove(F.split(one_text(found), BREAK), "")


def with_reasons(df: DataFrame, columns, *, finite: bool = False, json: bool = True) -> DataFrame:
    """The rows with an array of what is wrong with each; empty when nothing is."""
    return df.withColumn(REASONS, once(reasons_array(problems(columns, finite=finite, json=json))))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without, rejected rows with their reasons."""
    good = F.size(REASONS) == 0
    return df.filter(good).drop(REASONS), df.filter(~good)


def violation_report(df: DataFrame) -> DataFrame:
    """How often each reason occurs; counted per task before the shuffle, so one
    frequent reason costs one row per task."""
    return df.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
