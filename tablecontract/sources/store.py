"""The contract stored beside a table's data: numbered files, each created once.

    <table>/_contract/v000001.json
    <table>/data/g0001/_b=<id>/...
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from .. import types as ct
from ..contract import TableMetadata
from ..errors import ConcurrentChangeError
from ..layout import Layout
from .files import Files


@dataclass(frozen=True)
class TableVersion:
    """``retired`` are names in the data files that hold dropped columns."""

    version: int
    generation: int
    columns: tuple[ct.TableColumn, ...]
    layout: Layout = Layout()
    description: str = ""
    labels: dict = field(default_factory=dict)
    retired: tuple[str, ...] = ()
    created_at: str = ""

    def to_dict(self) -> dict:
        metadata = TableMetadata(self.columns, self.layout, self.description, self.labels).to_dict()
        return {
            "version": self.version,
            "generation": self.generation,
            "created_at": self.created_at,
            "retired": list(self.retired),
            **metadata,
        }

    @classmethod
    def from_dict(cls, raw: dict) -> "TableVersion":
        metadata = TableMetadata.from_dict(raw)
        return cls(
            raw["version"],
            raw["generation"],
            metadata.columns,
            metadata.layout,
            metadata.description,
            metadata.labels,
            tuple(raw.get("retired", ())),
            raw.get("created_at", ""),
        )


class ContractStore:
    def __init__(self, spark, location: str):
        self.location = location
        self.files = Files(spark)
        self._folder = f"{location}/_contract"

    def latest(self) -> TableVersion | None:
        published = [n for n in self.files.names(self._folder) if n.startswith("v") and n.endswith(".json")]
        if not published:
            return None
        return TableVersion.from_dict(json.loads(self.files.read_text(f"{self._folder}/{published[-1]}")))

    def create(self, metadata: TableMetadata) -> TableVersion:
        first = TableVersion(
            version=0,
            generation=1,
            columns=metadata.columns,
            layout=metadata.layout or Layout(),
            description=metadata.description,
            labels=metadata.labels,
        )
        self.files.mkdirs(self.data(1))
        return self.publish(first, first)

    def publish(self, change: TableVersion, seen: TableVersion) -> TableVersion:
        """Publish the version after the one that was seen, or fail when somebody else did."""
        stamp = datetime.now(timezone.utc).isoformat()
        new = replace(change, version=seen.version + 1, created_at=stamp)
        path = f"{self._folder}/v{new.version:06d}.json"
        if not self.files.create_new(path, json.dumps(new.to_dict(), indent=1)):
            raise ConcurrentChangeError(f"version {new.version} of {self.location} was published by someone else")
        return new

    def data(self, generation: int) -> str:
        return f"{self.location}/data/g{generation:04d}"
