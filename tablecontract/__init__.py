"""Write DataFrames under a declared contract, and keep the table in step with it."""

from .contract import INGESTION_AT, INGESTION_ID, ROW_ID, Contract, TableMetadata
from .errors import (
    BatchTypeError,
    ClosedError,
    ConcurrentChangeError,
    ContractError,
    SchemaConflictError,
    ShortWriteError, ChangedRowsError,
    TableMissingError,
)
from .layout import Layout
from .mapping import Override
from .operators.audit import audit, describe, observe_entries
from .operators.conform import conform
from .operators.dedup import deduplicate, duplicate_report
from .operators.dynamic import conform_dynamic
from .operators.enrich import AppendInfo, with_ingestion
from .operators.gates import enforce, split, violation_report, with_reasons
from .operators.render import APPEND, LOAD, render, write_ndjson
from .options import column, parse_labels
from .plans.diff import SchemaDiff, diff_columns, merge_columns
from .plans.strategy import AddColumns, LeaveAlone, SchemaChange, Synchronise, TableState
from .sources.relation import Relation
from .sources.table import AppendResult, GovernedTable, stored_contract
from .streaming.dedup import deduplicate_stream
from .streaming.sink import TableSink, open_stream
from .types import TableColumn
