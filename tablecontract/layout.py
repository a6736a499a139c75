"""Physical layout: time partitioning and clustering, and the limits they have."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from . import types as ct
from .errors import ContractError
from .functions.temporal import to_date, utc_hour_text
from .options import MAX_CLUSTER_COLUMNS, PARTITION_UNITS

PARTITION_COLUMN = "_p"
# The folder of a batch; like the partition's, no column of a contract may be called so.
BATCH_COLUMN = "_b"

# Types a table may be partitioned by, and may not be clustered on.
PARTITIONABLE = frozenset({ct.TIMESTAMP, ct.DATE, ct.DATETIME})
UNCLUSTERABLE = frozenset({ct.FLOAT, ct.JSON, ct.BYTES, ct.RECORD})


@dataclass(frozen=True)
class Layout:
    partition_by: str = ""
    unit: str = "day"
    require_filter: bool = False
    cluster_by: tuple[str, ...] = ()

    def check(self, columns) -> "Layout":
        by_name = {c.name: c for c in columns}
        if self.partition_by:
            self._check_partition(self._find(by_name, self.partition_by))
        elif self.require_filter:
            raise ContractError("require_filter needs a partitioning column")
        if len(self.cluster_by) > MAX_CLUSTER_COLUMNS:
            raise ContractError(f"{len(self.cluster_by)} clustering columns, at most {MAX_CLUSTER_COLUMNS} are allowed")
        if len(set(self.cluster_by)) != len(self.cluster_by):
            raise ContractError("a column is named twice for clustering")
        for name in self.cluster_by:
            column = self._find(by_name, name)
            if column.repeated or column.type in UNCLUSTERABLE:
                kind = "repeated" if column.repeated else column.type
                raise ContractError(f"{name} cannot cluster the table: {kind} values have no order to cluster by")
        return self

    def _check_partition(self, column):
        if self.unit not in PARTITION_UNITS:
            raise ContractError(f"a table is not partitioned by {self.unit!r}; it can be by {', '.join(sorted(PARTITION_UNITS))}")
        if column.type not in PARTITIONABLE:
            raise ContractError(
                f"{column.name} cannot partition the table: {column.type} is no type of a day or an instant"
            )
        if column.repeated:
            raise ContractError(f"{column.name} cannot partition the table: a row with several values would be in several partitions")
        if self.unit == "hour" and column.type == ct.DATE:
            raise ContractError(f"{column.name} cannot partition the table by hour: a DATE has none")

    @staticmethod
    def _find(by_name, name):
        if name not in by_name:
            raise ContractError(f"the layout speaks of {name}, and the contract has no such column")
        return by_name[name]

    @classmethod
    def from_options(cls, named_options) -> "Layout":
        """Collect what the fields asked for; a dropped field never gets here."""
        partitioned = [(n, o) for n, o in named_options if o.partition]
        if len(partitioned) > 1:
            raise ContractError(
                f"only one of {', '.join(n for n, _ in partitioned)} can partition the table"
            )
        by_position: dict[int, str] = {}
        for name, options in named_options:
            if not options.cluster:
                continue
            if options.cluster in by_position:
                raise ContractError(
                    f"cluster={options.cluster} is given to {by_position[options.cluster]} and to {name}"
                )
            by_position[options.cluster] = name
        missing = sorted(set(range(1, len(by_position) + 1)) - set(by_position))
        if missing:
            raise ContractError(f"no column has cluster={missing[0]}, though a later one is given")
        name, options = partitioned[0] if partitioned else ("", None)
        return cls(
            partition_by=name,
            unit=options.partition if options else "day",
            require_filter=bool(options and options.require_filter),
            cluster_by=tuple(by_position[p] for p in sorted(by_position)),
        )

    # -- the derived partition value -------------------------------------------------

    @property
    def partition_type(self) -> T.DataType:
        return T.StringType() if self.unit == "hour" else T.DateType()

    def partition_value(self, value: Column, contract_type: str) -> Column:
        """The partition a value falls into, by UTC calendar and independent of the session's zone."""
        if self.unit == "hour":
            if contract_type == ct.TIMESTAMP:
                return utc_hour_text(value)
            return F.replace(F.substring(value.cast("string"), 1, 13), F.lit(" "), F.lit("T"))
        day = to_date(value, "UTC") if contract_type == ct.TIMESTAMP else value.cast("date")
        return day if self.unit == "day" else F.trunc(day, self.unit)

    def to_dict(self) -> dict:
        return {
            "partition_by": self.partition_by,
            "unit": self.unit,
            "require_filter": self.require_filter,
            "cluster_by": list(self.cluster_by),
        }

    @classmethod
    def from_dict(cls, raw: dict) -> "Layout":
        return cls(
            raw.get("partition_by", ""),
            raw.get("unit", "day"),
            bool(raw.get("require_filter")),
            tuple(raw.get("cluster_by", ())),
        )
