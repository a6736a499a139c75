"""Contract types, the Spark types that carry them, and the columns of a table."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from .errors import ContractError

# The contract's type names.
STRING = "STRING"
BOOL = "BOOL"
INTEGER = "INTEGER"
FLOAT = "FLOAT"
NUMERIC = "NUMERIC"
BIGNUMERIC = "BIGNUMERIC"
BYTES = "BYTES"
TIMESTAMP = "TIMESTAMP"
DATE = "DATE"
DATETIME = "DATETIME"
TIME = "TIME"
JSON = "JSON"
GEOGRAPHY = "GEOGRAPHY"
RECORD = "RECORD"

# Fractional digits of a decimal column that names no scale, and
# the number of digits Spark's decimals hold.
NUMERIC_SCALE = 9
MAX_DIGITS = 38

_PLAIN_SPARK_TYPES = {
    STRING: T.StringType(),
    GEOGRAPHY: T.StringType(),
    JSON: T.StringType(),
    TIME: T.StringType(),
    BOOL: T.BooleanType(),
    INTEGER: T.LongType(),
    FLOAT: T.DoubleType(),
    BYTES: T.BinaryType(),
    TIMESTAMP: T.TimestampType(),
    DATE: T.DateType(),
    DATETIME: T.TimestampNTZType(),
}
CONTRACT_TYPES = frozenset(_PLAIN_SPARK_TYPES) | {NUMERIC, BIGNUMERIC, RECORD}

_COLUMN_NAME = re.compile(r"[A-Za-z0-9_]+")


def is_plain_name(name: str) -> bool:
    """Letters, digits and underscores only."""
    return bool(_COLUMN_NAME.fullmatch(name))


@dataclass(frozen=True)
class TableColumn:
    """One column of a table: what it is called, what it holds and in which mode.

    ``physical`` is the name inside the data files. It differs from ``name`` only
    when a column of that name was dropped before and then declared again.
    """

    name: str
    type: str
    required: bool = False
    repeated: bool = False
    fields: tuple["TableColumn", ...] = ()
    description: str = ""
    precision: int | None = None
    scale: int | None = None
    physical: str = ""

    def __post_init__(self):
        if not self.name:
            raise ContractError("a column has no name")
        if self.type not in CONTRACT_TYPES:
            raise ContractError(f"column {self.name}: unknown type {self.type!r}")
        if self.repeated and self.required:
            object.__setattr__(self, "required", False)
        object.__setattr__(self, "fields", tuple(self.fields))
        if (self.type == RECORD) != bool(self.fields):
            raise ContractError(f"column {self.name}: a RECORD needs fields and nothing else has them")
        check_distinct(self.fields, f"column {self.name}")
        if self.type in (NUMERIC, BIGNUMERIC):
            self._check_decimal()

    def _check_decimal(self):
        digits, scale = self.decimal_shape()
        if digits > MAX_DIGITS or scale > digits:
            raise ContractError(
                f"column {self.name}: {self.type}({digits},{scale}) does not fit in {MAX_DIGITS} decimal digits"
            )

    def decimal_shape(self) -> tuple[int, int]:
        """Digits and fractional digits of a decimal column."""
        if self.type == BIGNUMERIC and self.precision is None:
            raise ContractError(
                f"column {self.name}: BIGNUMERIC needs a precision of at most {MAX_DIGITS} and a scale"
            )
        scale = self.scale if self.scale else (NUMERIC_SCALE if self.type == NUMERIC else 0)
        return self.precision or MAX_DIGITS, scale

    @property
    def stored_as(self) -> str:
        return self.physical or self.name

    @property
    def mode(self) -> str:
        return "REPEATED" if self.repeated else "REQUIRED" if self.required else "NULLABLE"

    def element_type(self) -> T.DataType:
        """The Spark type of one value, leaving REPEATED aside."""
        if self.type == RECORD:
            return T.StructType([f.spark_field() for f in self.fields])
        if self.type in (NUMERIC, BIGNUMERIC):
            return T.DecimalType(*self.decimal_shape())
        return _PLAIN_SPARK_TYPES[self.type]

    def spark_type(self) -> T.DataType:
        element = self.element_type()
        return T.ArrayType(element, containsNull=False) if self.repeated else element

    def spark_field(self) -> T.StructField:
        metadata = {"comment": self.description} if self.description else {}
        return T.StructField(self.name, self.spark_type(), not self.required, metadata)

    def relaxed(self) -> "TableColumn":
        return replace(self, required=False)

    def to_dict(self) -> dict:
        out = {"name": self.name, "type": self.type, "mode": self.mode}
        if self.fields:
            out["fields"] = [f.to_dict() for f in self.fields]
        for key in ("description", "precision", "scale", "physical"):
            if getattr(self, key):
                out[key] = getattr(self, key)
        return out

    @classmethod
    def from_dict(cls, raw: dict) -> "TableColumn":
        mode = raw.get("mode", "NULLABLE")
        if mode not in ("NULLABLE", "REQUIRED", "REPEATED"):
            raise ContractError(f"column {raw.get('name')}: unknown mode {mode!r}")
        return cls(
            name=raw["name"],
            type=raw["type"],
            required=mode == "REQUIRED",
            repeated=mode == "REPEATED",
            fields=tuple(cls.from_dict(f) for f in raw.get("fields", ())),
            description=raw.get("description", ""),
            precision=raw.get("precision"),
            scale=raw.get("scale"),
            physical=raw.get("physical", ""),
        )


def check_distinct(columns, where: str) -> None:
    """Spark resolves names ignoring case, so names equal ignoring case cannot coexist."""
    seen: dict[str, str] = {}
    for column in columns:
        folded = column.name.lower()
        if folded in seen:
            raise ContractError(f"{where}: columns {seen[folded]} and {column.name} have the same name ignoring case")
        seen[folded] = column.name


def names(columns) -> list[str]:
    return [c.name for c in columns]


def spark_schema(columns) -> T.StructType:
    return T.StructType([c.spark_field() for c in columns])


def same_type(left, right) -> bool:
    """Equal Spark types, nullability and metadata aside."""
    return _plain(left) == _plain(right)


def _plain(dtype):
    if isinstance(dtype, T.UserDefinedType):
        return _plain(dtype.sqlType())
    if isinstance(dtype, T.ArrayType):
        return ("array", _plain(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return ("map", _plain(dtype.keyType), _plain(dtype.valueType))
    if isinstance(dtype, T.StructType):
        return ("struct", tuple((f.name, _plain(f.dataType)) for f in dtype.fields))
    return dtype.simpleString()
