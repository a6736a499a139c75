"""Table addresses."""

from __future__ import annotations

from dataclasses import dataclass

from ..errors import ContractError


@dataclass(frozen=True)
class Relation:
    """``catalog.schema.table`` with an optional catalog."""

    schema: str
    table: str
    catalog: str = ""

    def __post_init__(self):
        if not self.schema:
            raise ContractError("the table address has no schema")
        if not self.table:
            raise ContractError("the table address has no table")

    @classmethod
    def parse(cls, text: str) -> "Relation":
        parts = text.split(".")
        if len(parts) not in (2, 3):
            raise ContractError(f"{text!r} is not an address of the form catalog.schema.table")
        return cls(parts[-2], parts[-1], parts[0] if len(parts) == 3 else "")

    def __str__(self):
        return ".".join(p for p in (self.catalog, self.schema, self.table) if p)

    def location(self, root: str) -> str:
        """The table's folder below a warehouse folder."""
        return "/".join(p for p in (root.rstrip("/"), self.catalog, self.schema, self.table) if p)


def locate(spark, target: str) -> tuple[str, str]:
    """Name and folder of a target: a path (it has a slash) or an address in the warehouse."""
    if "/" in target:
        return target.rstrip("/"), target.rstrip("/")
    relation = Relation.parse(target)
    return str(relation), relation.location(spark.conf.get("spark.sql.warehouse.dir"))
