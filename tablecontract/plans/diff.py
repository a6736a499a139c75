"""How declared columns differ from a table's."""

from __future__ import annotations

from dataclasses import dataclass, replace

from .. import types as ct
from ..errors import SchemaConflictError

# The kinds of difference no migration settles.
TYPE, REPEATED, REQUIRED, NESTED = "type", "repeated", "required", "nested"


@dataclass(frozen=True)
class Conflict:
    name: str
    reason: str
    want: ct.TableColumn
    got: ct.TableColumn

    def __str__(self):
        return f"{self.name}: no migration leads from {_in_words(self.got)} to {_in_words(self.want)} ({self.reason})"


def _in_words(column: ct.TableColumn) -> str:
    """Mode, type and fields of a column in one line."""
    inside = f" of {', '.join(f.name for f in column.fields)}" if column.fields else ""
    return f"{column.mode} {column.type}{inside}"


@dataclass(frozen=True)
class SchemaDiff:
    """``added`` in the contract's order, ``removed`` and ``relaxed`` by name."""

    added: tuple[ct.TableColumn, ...] = ()
    removed: tuple[str, ...] = ()
    relaxed: tuple[str, ...] = ()
    conflicts: tuple[Conflict, ...] = ()

    @property
    def is_empty(self) -> bool:
        return self == SchemaDiff()

    def without(self, names) -> "SchemaDiff":
        """The diff with every mention of the named columns left out."""
        return self._where(lambda name: name not in names)

    def mentions(self, names) -> list[str]:
        """The named columns this diff has something to say about."""
        kept = self._where(lambda name: name in names)
        found = ct.names(kept.added) + list(kept.removed) + list(kept.relaxed) + ct.names(kept.conflicts)
        return list(dict.fromkeys(found))

    def _where(self, wanted) -> "SchemaDiff":
        return SchemaDiff(
            tuple(c for c in self.added if wanted(c.name)),
            tuple(n for n in self.removed if wanted(n)),
            tuple(n for n in self.relaxed if wanted(n)),
            tuple(c for c in self.conflicts if wanted(c.name)),
        )

    def raise_conflicts(self) -> None:
        """One error for all conflicts."""
        if self.conflicts:
            text = "; ".join(str(c) for c in self.conflicts)
            raise SchemaConflictError(f"the table's schema conflicts with the contract: {text}", self.conflicts)


def diff_columns(want, got) -> SchemaDiff:
    """Compare at the top level; a change inside a RECORD is a conflict.

    Names compare exactly. Descriptions, precision, layout and order are not compared.
    """
    table = {c.name: c for c in got}
    declared = ct.names(want)
    shared = [(w, table[w.name]) for w in want if w.name in table]
    reasons = {w.name: conflict_reason(w, g) for w, g in shared}
    return SchemaDiff(
        added=tuple(w for w in want if w.name not in table),
        removed=tuple(name for name in table if name not in declared),
        relaxed=tuple(w.name for w, g in shared if g.required and not w.required and not reasons[w.name]),
        conflicts=tuple(Conflict(w.name, reasons[w.name], w, g) for w, g in shared if reasons[w.name]),
    )


def conflict_reason(want: ct.TableColumn, got: ct.TableColumn) -> str:
    """The first thing that keeps two columns apart, or an empty text."""
    checks = (
        (TYPE, want.type != got.type),
        (REPEATED, want.repeated != got.repeated),
        (REQUIRED, want.required and not got.required),
        (NESTED, _shape(want.fields) != _shape(got.fields)),
    )
    return next((reason for reason, differs in checks if differs), "")


def _shape(fields):
    """Name, type and mode at every depth, whatever the order."""
    return frozenset((f.name, f.type, f.mode, _shape(f.fields)) for f in fields)


def merge_columns(got, added=(), relaxed=()) -> tuple[ct.TableColumn, ...]:
    """The table's columns in their order, relaxed where asked, with the new ones last."""
    kept = [c.relaxed() if c.name in relaxed else c for c in got]
    return tuple(kept) + tuple(replace(c) for c in added)
