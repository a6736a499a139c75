"""Bring typed rows into the shape of their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import types as ct
from ..contract import Contract
from ..errors import BatchTypeError
from .gates import enforce_problems, problems


def conform(
    df: DataFrame, contract: Contract, *, keep=(), row_id: str | None = None, gated: bool = True, wide: bool = False
) -> DataFrame:
    """Rename, drop, promote and convert in one projection, without a shuffle.

    ``keep`` carries further columns through, ``gated`` fails the job on the first
    row that breaks the contract (naming it by its ``row_id``), and ``wide`` adds
    declared columns the rows do not write as NULL.
    """
    check_row_type(df, contract)
    out = df.select(*keep, *contract.expressions())
    if gated:
        found = contract.compiled(
            "problems", lambda: problems(contract.written_columns(), trusted=contract.encoded_json())
        )
        out = enforce_problems(
            out,
            found,
            row_id=row_id,
            costly=not all(b.is_plain for b in contract.bindings if _is_gated(b.column)),
        )
    if wide:
        out = out.select(*keep, *[_declared(c, out.columns) for c in contract.columns])
    return out


def _is_gated(column: ct.TableColumn) -> bool:
    return column.required or column.repeated or bool(column.fields)


def check_row_type(df: DataFrame, contract: Contract) -> None:
    """The rows have to be of the contract's own type; names and types, not nullability."""
    if contract.is_dynamic:
        raise BatchTypeError("a dynamic contract writes maps of variants, not typed rows")
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in contract.row_type.fields:
        if field.name not in have:
            problems.append(f"{field.name} is missing")
        elif not ct.same_type(have[field.name], field.dataType):
            problems.append(
                f"{field.name} is {have[field.name].simpleString()}, the contract reads {field.dataType.simpleString()}"
            )
    if problems:
        raise BatchTypeError("the batch is not what the contract describes: " + "; ".join(problems))


def _declared(column: ct.TableColumn, present):
    if column.name in present:
        return F.col(f"`{column.name}`")
    return F.lit(None).cast(column.spark_type()).alias(column.name)
