"""The contract: what a table holds and how rows are written into it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark import SparkContext
from pyspark.sql import Column, functions as F, types as T

from . import types as ct
from .errors import ContractError
from .layout import BATCH_COLUMN, PARTITION_COLUMN, Layout
from .mapping import Binding, Overrides, bind
from .options import column as option_column, parse_labels

# The columns describing how a row was written.
INGESTION_AT = "_ingestion_at"
INGESTION_ID = "_ingestion_id"
ROW_ID = "_ingestion_row_id"


def ingestion_fields() -> list[T.StructField]:
    return [
        option_column(INGESTION_AT, T.TimestampType()),
        option_column(INGESTION_ID, T.StringType()),
        option_column(ROW_ID, T.StringType()),
    ]


@dataclass(frozen=True)
class Contract:
    """Built once and checked when built; nothing is ever inferred from data.

    ``columns`` is what the table should hold and ``bindings`` what a row writes.
    A dynamic contract has no bindings: its rows are maps of variants.
    """

    columns: tuple[ct.TableColumn, ...]
    bindings: tuple[Binding, ...] = ()
    layout: Layout = Layout()
    description: str = ""
    labels: MappingProxyType = field(default_factory=lambda: MappingProxyType({}))
    row_type: T.StructType | None = None
    overrides: Overrides = field(default_factory=Overrides, repr=False, compare=False)
    zone: str = field(default="UTC", compare=False)
    _compiled: dict = field(default_factory=dict, init=False, repr=False, compare=False)

    def __post_init__(self):
        if not self.columns:
            raise ContractError("the contract has no columns")
        ct.check_distinct(self.columns, "the contract")
        for reserved, of in ((PARTITION_COLUMN, "partitions"), (BATCH_COLUMN, "batches")):
            if any(c.name.lower() == reserved for c in self.columns):
                raise ContractError(f"the column name {reserved} is taken by the table's {of}")
        self.layout.check(self.columns)

    @property
    def is_dynamic(self) -> bool:
        return not self.bindings

    @property
    def has_ingestion(self) -> bool:
        return not self.is_dynamic and {INGESTION_AT, INGESTION_ID, ROW_ID} <= set(self.row_type.names)

    # -- building -------------------------------------------------------------------

    @classmethod
    def of(
        cls,
        row_type: T.StructType,
        *,
        overrides=(),
        ingestion: bool = False,
        zone: str = "UTC",
        columns=None,
        layout: Layout | None = None,
        description: str = "",
        labels=None,
        table: "TableMetadata | None" = None,
    ) -> "Contract":
        """A contract from a row type whose fields carry their options as metadata.

        ``columns`` spells the table's columns out and may be wider than the row
        type, never narrower. What both the row type and ``table`` settle is an error.
        """
        if not isinstance(row_type, T.StructType):
            raise ContractError(f"a row type is a struct, not {type(row_type).__name__}")
        if ingestion:
            row_type = T.StructType(ingestion_fields() + row_type.fields)
        registered = Overrides(overrides)
        bindings = bind(row_type, registered, zone)
        tagged = Layout.from_options([(b.column.name, b.candidate.options) for b in bindings])
        labels = parse_labels(labels) if isinstance(labels, str) else dict(labels or {})
        if any(not key for key in labels):
            raise ContractError("a label has an empty key")
        given = table or TableMetadata()
        written = tuple(b.column for b in bindings)
        declared = tuple(columns or given.columns or written)
        _check_covers(written, declared)
        return cls(
            columns=declared,
            bindings=bindings,
            layout=_one_layout(tagged, layout or given.layout),
            description=_only_one("description", description, given.description),
            labels=MappingProxyType(_only_one("labels", labels, dict(given.labels))),
            row_type=row_type,
            overrides=registered,
            zone=zone,
        )

    @classmethod
    def dynamic(cls, columns, *, overrides=(), layout=None, description="", labels=None) -> "Contract":
        """A contract for rows whose columns are only known at run time."""
        return cls(
            columns=tuple(columns or ()),
            layout=layout or Layout(),
            description=description,
            labels=MappingProxyType(dict(labels or {})),
            overrides=Overrides(overrides),
        )

    @classmethod
    def from_json(cls, text: str, *, overrides=()) -> "Contract":
        """A dynamic contract from stored table metadata."""
        if not text:
            raise ContractError("there is no table metadata")
        metadata = TableMetadata.from_dict(json.loads(text))
        if not metadata.columns:
            raise ContractError("the table metadata has no columns")
        return cls.dynamic(
            [ct.TableColumn.from_dict({**c.to_dict(), "physical": ""}) for c in metadata.columns],
            overrides=overrides,
            layout=metadata.layout,
            description=metadata.description,
            labels=metadata.labels,
        )

    # -- using ----------------------------------------------------------------------

    def to_metadata(self) -> "TableMetadata":
        return TableMetadata(self.columns, self.layout, self.description, dict(self.labels))

    def to_json(self) -> str:
        return json.dumps(self.to_metadata().to_dict())

    def spark_schema(self) -> T.StructType:
        return ct.spark_schema(self.columns)

    def compiled(self, what, build):
        """Expressions are built once per contract and application, and serve every batch."""
        key = (what, SparkContext.getOrCreate().applicationId)
        if key not in self._compiled:
            self._compiled[key] = build()
        return self._compiled[key]

    def expressions(self) -> list[Column]:
        """One expression per written column, in the contract's order; a single projection."""
        if self.is_dynamic:
            raise ContractError("a dynamic contract converts maps, not typed rows")
        return self.compiled("values", lambda: [b.value(_column_at).alias(b.column.name) for b in self.bindings])

    def encoded_json(self) -> frozenset[str]:
        """JSON columns whose text is written here, so that it needs no check."""
        return frozenset(b.column.name for b in self.bindings if b.mapping.encoded)

    def written_columns(self) -> tuple[ct.TableColumn, ...]:
        """The declared side of the columns a row writes."""
        if self.is_dynamic:
            return self.columns
        by_name = {c.name: c for c in self.columns}
        return tuple(by_name[b.column.name] for b in self.bindings)


@dataclass(frozen=True)
class TableMetadata:
    """A table described apart from any row type."""

    columns: tuple[ct.TableColumn, ...] = ()
    layout: Layout | None = None
    description: str = ""
    labels: dict = field(default_factory=dict)

    def to_dict(self) -> dict:
        return {
            "columns": [c.to_dict() for c in self.columns],
            "layout": (self.layout or Layout()).to_dict(),
            "description": self.description,
            "labels": dict(self.labels),
        }

    @classmethod
    def from_dict(cls, raw: dict) -> "TableMetadata":
        return cls(
            tuple(ct.TableColumn.from_dict(c) for c in raw.get("columns", ())),
            Layout.from_dict(raw.get("layout", {})),
            raw.get("description", ""),
            dict(raw.get("labels", {})),
        )


def _column_at(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{part.replace('`', '``')}`" for part in path))


def _check_covers(written, declared):
    by_name = {c.name: c for c in declared}
    missing = [c.name for c in written if c.name not in by_name]
    if missing:
        raise ContractError(f"rows write {', '.join(missing)}, for which no column is declared")


def _only_one(what, tagged, given):
    if tagged and given:
        raise ContractError(f"{what}: both set, by the fields' options and beside them")
    return tagged or given


def _one_layout(tagged: Layout, given: Layout | None) -> Layout:
    given = given or Layout()
    for attribute, what in (("partition_by", "a partitioning column"), ("cluster_by", "clustering columns")):
        if getattr(tagged, attribute) and getattr(given, attribute):
            raise ContractError(f"{what}: both set, by the fields' options and beside them")
    source = tagged if tagged.partition_by else given
    return Layout(
        source.partition_by,
        source.unit,
        tagged.require_filter or given.require_filter,
        tagged.cluster_by or given.cluster_by,
    )
