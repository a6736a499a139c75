"""Rows whose columns are only known at run time: maps of variants, or JSON text."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import types as ct
from ..contract import Contract
from ..errors import ContractError
from ..functions.numbers import NOT_WHOLE, whole_float_problem
from ..functions.temporal import TIME_PATTERN
from . import gates

VARIANT_MAP = "map<string,variant>"

# The variant types each contract type accepts. Nothing is parsed
# out of text, except a time of day, which has no variant type of its own.
ACCEPTED = {
    ct.STRING: ("STRING",),
    ct.GEOGRAPHY: ("STRING",),
    ct.BOOL: ("BOOLEAN",),
    ct.INTEGER: ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"),
    ct.FLOAT: ("DOUBLE", "FLOAT"),
    ct.NUMERIC: ("DECIMAL",),
    ct.BIGNUMERIC: ("DECIMAL",),
    ct.BYTES: ("BINARY",),
    ct.TIMESTAMP: ("TIMESTAMP",),
    ct.DATE: ("DATE",),
    ct.DATETIME: ("TIMESTAMP_NTZ",),
    ct.TIME: ("STRING",),
    ct.JSON: ("STRING", "BINARY"),
}
# A number in JSON text has no type of its own, so it may be whole or not.
_JSON_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
ACCEPTED_FROM_JSON = {
    **ACCEPTED,
    ct.FLOAT: _JSON_NUMBERS,
    ct.NUMERIC: _JSON_NUMBERS,
    ct.BIGNUMERIC: _JSON_NUMBERS,
}
# Variant types by the Spark type an override is registered for.
_OVERRIDE_TYPES = {
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BINARY": T.BinaryType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DATE": T.DateType(),
}


@dataclass(frozen=True)
class _Cell:
    """A variant taken apart once, so that nothing below asks it the same thing twice.

    ``parts`` holds the elements of a list or the map of a record when the column
    wants one, ``kind`` the variant's type otherwise.
    """

    value: Column
    here: Column
    kind: Column | None = None
    parts: Column | None = None

    NAMES = ("value", "here", "kind", "parts")

    @classmethod
    def open(cls, column, value: Column, *, element: bool = False) -> "_Cell":
        here = value.isNotNull() & ~F.is_variant_null(value)
        if column.repeated and not element:
            return cls(value, here, parts=F.try_variant_get(value, "$", "array<variant>"))
        if column.type == ct.RECORD:
            return cls(value, here, parts=F.try_variant_get(value, "$", VARIANT_MAP))
        return cls(value, here, kind=F.schema_of_variant(value))

    def columns(self, prefix: str = "") -> list[Column]:
        return [getattr(self, n).alias(prefix + n) for n in self.NAMES if getattr(self, n) is not None]

    def read(self, at) -> "_Cell":
        """The same cell where its parts have been computed."""
        return _Cell(**{n: at(n) for n in self.NAMES if getattr(self, n) is not None})


def _with_cell(cell: _Cell, use) -> Column:
    """Compute a cell's parts once inside an expression and use them."""
    bound = F.transform(F.array(F.struct(*cell.columns())), lambda x: use(cell.read(x.getField)))
    return F.get(bound, F.lit(0))


@dataclass(frozen=True)
class _Reader:
    """Builds the value of a column from a variant, and what is wrong with it.

    ``cells`` holds what earlier projections have taken apart, by path.
    """

    contract: Contract
    source: str
    cells: dict[str, _Cell] = field(default_factory=dict)

    def with_field(self, entries: Column, column, path: str, use) -> Column:
        """Use a field's cell: one computed before, or one bound inside the expression."""
        if path in self.cells:
            return use(self.cells[path])
        return _with_cell(_Cell.open(column, F.try_element_at(entries, F.lit(column.name))), use)

    @property
    def accepted(self):
        return ACCEPTED_FROM_JSON if self.source == "json" else ACCEPTED

    # -- one object -----------------------------------------------------------------

    def undeclared(self, entries: Column, columns, path: str) -> Column:
        extra = F.array_except(F.map_keys(entries), F.array(*[F.lit(c.name) for c in columns]))
        text = F.concat(F.lit(f"undeclared column {path}"), F.array_join(F.array_sort(extra), f", {path}"))
        return gates.problem(F.size(extra) > 0, text)

    def record_problems(self, entries: Column, columns, path: str) -> list[Column]:
        found = [self.undeclared(entries, columns, path)]
        for column in columns:
            label = path + column.name
            found.append(
                self.with_field(entries, column, label, lambda c, col=column, at=label: gates.one_text(self.problems(col, c, at)))
            )
        return found

    def record_value(self, entries: Column, columns, path: str) -> Column:
        fields = []
        for column in columns:
            label = path + column.name
            value = self.with_field(entries, column, label, lambda c, col=column, at=label: self.value(col, c, at))
            fields.append(value.alias(column.name))
        return F.struct(*fields)

    # -- one column -----------------------------------------------------------------

    def problems(self, column, cell: _Cell, label: str) -> list[Column]:
        found = []
        if column.required:
            found.append(gates.problem(~cell.here, f"column {label}: a REQUIRED column cannot be NULL"))
        if not column.repeated:
            return found + [F.when(cell.here, p) for p in self.element_problems(column, cell, label)]
        found.append(gates.problem(cell.here & cell.parts.isNull(), f"column {label}: a REPEATED column needs a list"))
        inner = F.transform(cell.parts, lambda x: _with_cell(_Cell.open(column, x, element=True), self._list_check(column, label)))
        found.append(F.array_join(F.array_distinct(inner), ""))
        return found

    def _list_check(self, column, label):
        null = F.lit(f"column {label}: a repeated column cannot hold a NULL element{gates.BREAK}")
        return lambda cell: F.when(cell.here, gates.one_text(self.element_problems(column, cell, label + "[]"))).otherwise(null)

    def element_problems(self, column, cell: _Cell, label: str) -> list[Column]:
        if column.type == ct.RECORD:
            kind = F.regexp_extract(F.schema_of_variant(cell.value), "^[A-Z_]+", 0)
            wrong = F.concat(F.lit(f"column {label}: RECORD does not take "), kind)
            inner = self.record_problems(cell.parts, column.fields, label + ".")
            return [gates.problem(cell.parts.isNull(), wrong)] + [F.when(cell.parts.isNotNull(), p) for p in inner]
        overridden, found = F.lit(False), []
        for name, override in self._overrides():
            overridden = overridden | (cell.kind == name)
            if override.target != column.type:
                text = (
                    f"column {label}: the override of {override.source.simpleString()} declares {override.target}, "
                    f"but the column is {column.type}"
                )
                found.append(gates.problem(cell.kind == name, text))
        accepted = self._is_accepted(column, cell.kind)
        refused = F.concat(F.lit(f"column {label}: {column.type} does not take "), F.regexp_extract(cell.kind, "^[A-Z_]+", 0))
        problem = gates.problem(~accepted, refused)
        for p in self._value_problems(column, cell, label):
            problem = problem.otherwise(p)
        return found + [F.when(~overridden, problem) if self._overrides() else problem]

    def _is_accepted(self, column, kind: Column) -> Column:
        names = self.accepted[column.type]
        ok = kind.isin([n for n in names if n != "DECIMAL"])
        if "DECIMAL" in names:
            # A strict INTEGER takes a decimal without a scale: an unsigned number.
            whole_only = column.type == ct.INTEGER and self.source != "json"
            ok = ok | kind.startswith("DECIMAL") & (kind.endswith(",0)") if whole_only else F.lit(True))
        return ok

    def _value_problems(self, column, cell: _Cell, label) -> list[Column]:
        """At most one, for values of an accepted type."""
        if column.type == ct.INTEGER:
            as_float = whole_float_problem(F.try_variant_get(cell.value, "$", "double"))
            exact = F.try_variant_get(cell.value, "$", "decimal(38,0)")
            too_big = F.when(
                exact.isNull() | (exact > (1 << 63) - 1) | (exact < -(1 << 63)), F.lit(NOT_WHOLE)
            )
            problem = F.when(cell.kind == "BIGINT", None).when(cell.kind.endswith(",0)"), too_big).otherwise(as_float)
            return [F.concat(F.lit(f"column {label}: "), problem, F.lit(gates.BREAK))]
        if column.type in (ct.NUMERIC, ct.BIGNUMERIC):
            lost = F.try_variant_get(cell.value, "$", column.element_type().simpleString()).isNull()
            return [gates.problem(lost, f"column {label}: a number does not fit in {column.type}")]
        if column.type == ct.TIME:
            malformed = ~F.try_variant_get(cell.value, "$", "string").rlike(TIME_PATTERN)
            return [gates.problem(malformed, f"column {label}: TIME does not take STRING")]
        return []

    def value(self, column, cell: _Cell, path: str) -> Column:
        if not column.repeated:
            return self.element_value(column, cell, path)
        return F.transform(
            cell.parts,
            lambda x: _with_cell(_Cell.open(column, x, element=True), lambda c: self.element_value(column, c, path + "[]")),
        )

    def element_value(self, column, cell: _Cell, path: str) -> Column:
        if column.type == ct.RECORD:
            return F.when(cell.parts.isNotNull(), self.record_value(cell.parts, column.fields, path + "."))
        plain = F.try_variant_get(cell.value, "$", column.element_type().simpleString())
        if column.type == ct.JSON:
            binary = F.try_variant_get(cell.value, "$", "binary").cast("string")
            plain = F.nullif(F.when(cell.kind == "BINARY", binary).otherwise(plain), F.lit(""))
        for name, override in self._overrides():
            if override.target == column.type:
                typed = F.try_variant_get(cell.value, "$", override.source.simpleString())
                converted = override.convert(typed).cast(column.element_type())
                plain = F.when(cell.kind == name, F.when(typed.isNotNull(), converted)).otherwise(plain)
        return plain

    def _overrides(self):
        pairs = ((name, self.contract.overrides.lookup(dtype)) for name, dtype in _OVERRIDE_TYPES.items())
        return [(name, override) for name, override in pairs if override]


def conform_dynamic(
    df: DataFrame, contract: Contract, row: str, *, source: str = "variant", keep=(), row_id: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Turn maps of variants into the contract's columns.

    ``row`` names a ``MAP<STRING, VARIANT>`` column, or JSON text under
    ``source="json"``. ``mode`` is ``fail`` (a bad row fails the job), ``reasons``
    (an array of reasons per row) or ``values`` (conversion alone).
    ``row_id`` names the column a bad row is reported by.

    Projections only, no shuffle: the entries of a row, their cells, those of
    records level by level, and what is made of them. Each step is used several
    times by the next, so Spark keeps them apart and parses a row once. The
    verdict is kept in the last projection, where no filter on it can move below
    the others and repeat their work.
    """
    if not contract.is_dynamic:
        raise ContractError("a contract of a row type converts typed rows, not maps")
    if source not in ("variant", "json") or mode not in ("fail", "reasons", "values"):
        raise ContractError(f"unknown source {source!r} or mode {mode!r}")
    given = F.col(f"`{row}`")
    entries = F.try_variant_get(F.try_parse_json(given), "$", VARIANT_MAP) if source == "json" else given
    who = [F.col(f"`{row_id}`").alias("_row_id")] if row_id else []
    rows = df.select(*keep, *who, entries.alias("_entries"), given.isNull().alias("_null"))
    levels, values, text = contract.compiled(("dynamic", source), lambda: _compile(contract, source))
    for level in levels:
        rows = rows.select(*[f"`{c}`" for c in rows.columns], *level)
    if mode == "values":
        return rows.select(*keep, *values)
    if mode == "reasons":
        return rows.select(*keep, *values, gates.once(gates.reasons_array([text])).alias(gates.REASONS))
    carried = [*keep, *(["_row_id"] if row_id else [])]
    rows = rows.select(*carried, *values, gates.once(text).alias(gates.REASONS))
    names = [f"`{c.name}`" for c in contract.columns]
    return gates.hold_back(rows, F.col("_row_id") if row_id else None).select(*keep, *names)


def _compile(contract: Contract, source: str) -> tuple[list[list[Column]], list[Column], Column]:
    """The projections that open a row's cells, its values, and all that is wrong with it."""
    columns, entries = contract.columns, F.col("_entries")
    levels, cells = _open_cells(entries, columns)
    reader = _Reader(contract, source, cells)
    values = [reader.value(c, cells[c.name], c.name).alias(c.name) for c in columns]
    inside = [reader.undeclared(entries, columns, "")]
    for column in columns:
        inside += reader.problems(column, cells[column.name], column.name)
    found = [
        gates.problem(F.col("_null"), "the row is NULL"),
        gates.problem(~F.col("_null") & entries.isNull(), "the row is not a JSON object"),
        F.when(entries.isNotNull(), gates.one_text(inside)),
    ]
    return levels, values, gates.one_text(found)


def _open_cells(entries: Column, columns) -> tuple[list[list[Column]], dict[str, _Cell]]:
    """One projection per level of records; a list is opened where it is used."""
    cells: dict[str, _Cell] = {}
    levels = []
    level = [(c.name, c, F.try_element_at(entries, F.lit(c.name))) for c in columns]
    while level:
        opened, following = [], []
        for path, column, value in level:
            prefix = f"_{len(cells)}_"
            cell = _Cell.open(column, value)
            opened += cell.columns(prefix)
            cells[path] = cell = cell.read(lambda name, prefix=prefix: F.col(prefix + name))
            if column.type == ct.RECORD and not column.repeated:
                following += [
                    (f"{path}.{f.name}", f, F.try_element_at(cell.parts, F.lit(f.name))) for f in column.fields
                ]
        levels.append(opened)
        level = following
    return levels, cells
