"""What to do about a difference between contract and table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from .. import types as ct
from ..errors import ContractError
from .diff import SchemaDiff


@dataclass(frozen=True)
class TableState:
    exists: bool
    diff: SchemaDiff = field(default_factory=SchemaDiff)


@dataclass(frozen=True)
class SchemaChange:
    create: bool = False
    add: tuple[ct.TableColumn, ...] = ()
    relax: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()

    @property
    def is_empty(self) -> bool:
        return self == SchemaChange()


# A strategy is a function of the table's state and a logger; anything of this
# shape can stand in for the three below.
Strategy = Callable[[TableState, object], SchemaChange]


@dataclass(frozen=True)
class LeaveAlone:
    """Change nothing on an existing table. A conflict is still an error, since writing would fail."""

    create: bool = False

    def __call__(self, state: TableState, log) -> SchemaChange:
        if not state.exists:
            return SchemaChange(create=self.create)
        diff = state.diff
        diff.raise_conflicts()
        if not diff.is_empty:
            log.warning(
                "the table differs from the contract and is left as it is: missing %s, undeclared %s, to relax %s",
                ct.names(diff.added), list(diff.removed), list(diff.relaxed),
            )
        return SchemaChange()


@dataclass(frozen=True)
class AddColumns:
    """Add what is missing and relax what may be; keep what the contract does not have. The default."""

    create: bool = True

    def __call__(self, state: TableState, log) -> SchemaChange:
        if not state.exists:
            return SchemaChange(create=self.create)
        state.diff.raise_conflicts()
        if state.diff.removed:
            log.info("the table has columns the contract does not, and they are kept: %s", list(state.diff.removed))
        return SchemaChange(add=state.diff.added, relax=state.diff.relaxed)


@dataclass(frozen=True)
class Synchronise:
    """Add, relax and drop until the table is what the contract says, ``ignore`` aside."""

    ignore: tuple[str, ...] = ()
    create: bool = False

    def __post_init__(self):
        object.__setattr__(self, "ignore", tuple(self.ignore))
        if any(not name for name in self.ignore):
            raise ContractError("an ignored column has an empty name")

    def __call__(self, state: TableState, log) -> SchemaChange:
        if not state.exists:
            return SchemaChange(create=self.create)
        diff = state.diff.without(self.ignore)
        diff.raise_conflicts()
        left = state.diff.mentions(self.ignore)
        if left:
            log.warning("ignored columns differ from the contract and are left as they are: %s", left)
        return SchemaChange(add=diff.added, relax=diff.relaxed, drop=diff.removed)


NAMED = {"none": LeaveAlone, "append": AddColumns, "sync": Synchronise}


def strategy_of(strategy, ignore=(), create: bool | None = None) -> Strategy:
    """A strategy from its name, or the callable itself."""
    if callable(strategy):
        return strategy
    if strategy not in NAMED:
        raise ContractError(f"unknown strategy {strategy!r}, want none, append or sync")
    options = {} if create is None else {"create": create}
    if strategy == "sync":
        options["ignore"] = tuple(ignore)
    elif ignore:
        raise ContractError("only sync ignores columns")
    return NAMED[strategy](**options)
