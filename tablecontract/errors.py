"""Errors raised on the driver; a row that breaks its contract fails its Spark task instead."""


class ContractError(ValueError):
    """The contract itself is wrong: nothing was read or written."""


class SchemaConflictError(ContractError):
    """The table and the contract disagree in a way no strategy may settle."""

    def __init__(self, message, conflicts=()):
        super().__init__(message)
        self.conflicts = tuple(conflicts)


class TableMissingError(LookupError):
    """The table does not exist and creating it was not asked for."""


class BatchTypeError(TypeError):
    """The rows of a batch are not the rows the contract describes."""


class ShortWriteError(RuntimeError):
    """Fewer rows landed than were handed over."""

    def __init__(self, message, delivered=0):
        super().__init__(message)
        self.delivered = delivered


class ChangedRowsError(ShortWriteError):
    """As many rows landed as were handed over, but not the same ones."""


class ClosedError(RuntimeError):
    """The sink was closed before this call."""


class ConcurrentChangeError(RuntimeError):
    """Another process published a newer version of the table's contract."""
