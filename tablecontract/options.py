"""What a contract says about one field: options kept in ``StructField.metadata``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from . import types as ct
from .errors import ContractError

PREFIX = "contract."
COMMENT = "comment"

# Option names, time options, partition units and the largest
# clustering position.
TIME_OPTIONS = {"date": ct.DATE, "datetime": ct.DATETIME, "time": ct.TIME}
PARTITION_UNITS = ("day", "hour", "month", "year")
MAX_CLUSTER_COLUMNS = 4

# Refinements of what a Spark type holds: text that is JSON, a time of day or a
# geography, a decimal with a stated kind and scale.
_REFINEMENTS = {
    T.StringType: (ct.STRING, ct.JSON, ct.TIME, ct.GEOGRAPHY),
    T.DecimalType: (ct.NUMERIC, ct.BIGNUMERIC),
}


@dataclass(frozen=True)
class ColumnOptions:
    name: str = ""
    skip: bool = False
    embed: bool = False
    required: bool = False
    nullifzero: bool = False
    record: bool = False
    as_time: str = ""
    zone: str = ""
    zone_column: str = ""
    type: str = ""
    precision: int | None = None
    scale: int | None = None
    partition: str = ""
    require_filter: bool = False
    cluster: int = 0
    description: str = ""

    @classmethod
    def of(cls, field: T.StructField) -> "ColumnOptions":
        metadata = field.metadata or {}
        given = {k[len(PREFIX):]: v for k, v in metadata.items() if k.startswith(PREFIX)}
        unknown = sorted(set(given) - set(cls.__dataclass_fields__))
        if unknown:
            raise ContractError(f"field {field.name}: unknown option {', '.join(unknown)}")
        try:
            options = cls(**given, **({"description": metadata[COMMENT]} if COMMENT in metadata else {}))
            if not options.skip:
                options.check(field.dataType)
        except ContractError as err:
            raise ContractError(f"field {field.name}: {err}") from None
        return options

    def check(self, dtype: T.DataType) -> None:
        if self.required and self.nullifzero:
            raise ContractError("required and nullifzero conflict: a REQUIRED column cannot hold NULL")
        if self.as_time and self.as_time not in TIME_OPTIONS:
            raise ContractError(f"unknown time option {self.as_time!r}, want date, datetime or time")
        stated = [o for o in ("record" if self.record else "", self.as_time, self.type) if o]
        if len(stated) > 1:
            raise ContractError(f"{' and '.join(stated)} conflict: a column has one type")
        if self.zone and self.zone_column:
            raise ContractError("zone and zone_column conflict: a value has one zone")
        if self.partition and self.partition not in PARTITION_UNITS:
            raise ContractError(f"partition is {self.partition!r}, want day, hour, month or year")
        if self.require_filter and not self.partition:
            raise ContractError("require_filter needs a partition")
        if self.cluster and not 1 <= self.cluster <= MAX_CLUSTER_COLUMNS:
            raise ContractError(f"cluster is {self.cluster}, want a position from 1 to {MAX_CLUSTER_COLUMNS}")
        if self.type:
            element = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
            if self.type not in _REFINEMENTS.get(type(element), ()):
                raise ContractError(f"{element.simpleString()} cannot be declared {self.type}")
        if self.embed and not isinstance(dtype, T.StructType):
            raise ContractError("only a struct can be embedded")


def column(source: str, dtype: T.DataType, *, partition=None, **options) -> T.StructField:
    """A field of a row type with its contract options.

    ``partition=""`` means by day. ``type=`` states what a string or decimal holds.
    """
    if partition is not None:
        unit, _, rest = partition.partition(",")
        flags = {flag for flag in rest.lower().split(",") if flag}
        if flags - {"require"}:
            raise ContractError(f"field {source}: unknown partition option {', '.join(sorted(flags - {'require'}))}")
        options["partition"] = unit.lower() or "day"
        if flags:
            options["require_filter"] = True
    metadata = {PREFIX + k: v for k, v in options.items() if k != "description"}
    if options.get("description"):
        metadata[COMMENT] = options["description"]
    field = T.StructField(source, dtype, True, metadata)
    ColumnOptions.of(field)
    return field


def parse_labels(text: str) -> dict[str, str]:
    """``team=data,env=prod,owner=``: values may be empty, keys may not repeat."""
    labels: dict[str, str] = {}
    for pair in text.split(","):
        key, separator, value = pair.partition("=")
        if not separator or not key:
            raise ContractError(f"label {pair!r} is not key=value")
        if key in labels:
            raise ContractError(f"label {key!r} is given twice")
        labels[key] = value
    return labels
