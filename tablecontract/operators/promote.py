"""Promotion of embedded structs: which fields of a row type become columns."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import types as T

from ..options import ColumnOptions


@dataclass(frozen=True)
class Candidate:
    """A field that may become a column; ``path`` walks through embedded structs."""

    name: str
    path: tuple[str, ...]
    position: tuple[int, ...]
    field: T.StructField
    options: ColumnOptions

    @property
    def depth(self) -> int:
        return len(self.path)


def promoted_fields(schema: T.StructType) -> list[Candidate]:
    """The columns of a row type in declaration order.

    A shallower field hides deeper ones of its name. At equal depth the only one
    named explicitly wins; without one the name is dropped and its neighbours stay.
    """
    by_name: dict[str, list[Candidate]] = defaultdict(list)
    for candidate in _walk(schema, (), ()):
        by_name[candidate.name].append(candidate)
    winners = (_winner(group) for group in by_name.values())
    return sorted((w for w in winners if w), key=lambda c: c.position)


def _walk(schema, path, position):
    for i, field in enumerate(schema.fields):
        options = ColumnOptions.of(field)
        if options.skip:
            continue
        here, place = path + (field.name,), position + (i,)
        if options.embed and not options.name:
            yield from _walk(field.dataType, here, place)
        else:
            yield Candidate(options.name or field.name, here, place, field, options)


def _winner(group: list[Candidate]) -> Candidate | None:
    depth = min(c.depth for c in group)
    level = [c for c in group if c.depth == depth]
    if len(level) > 1:
        level = [c for c in level if c.options.name]
    return level[0] if len(level) == 1 else None
