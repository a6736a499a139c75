"""A parquet table kept in step with its contract."""

from __future__ import annotations

import json
import logging
import re
import threading
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from .. import types as ct
from ..contract import ROW_ID, Contract
from ..errors import BatchTypeError, ChangedRowsError, ConcurrentChangeError, ContractError, SchemaConflictError, ShortWriteError, TableMissingError
from ..functions import ids
from ..functions.fingerprint import Tally, fingerprint
from ..layout import BATCH_COLUMN, PARTITION_COLUMN
from ..operators.conform import conform
from ..operators.dynamic import conform_dynamic
from ..operators.enrich import (
    PLACE,
    AppendInfo,
    Fill,
    fill_columns,
    fill_ingestion,
    instant,
    row_id_from_key,
    row_id_from_place,
    with_place,
)
from ..operators.gates import enforce
from ..plans.migrate import migrate
from ..plans.strategy import LeaveAlone, strategy_of
from .relation import locate
from .store import ContractStore, TableVersion

LOGGER = logging.getLogger("tablecontract")

# Bytes of staged data per task of a clustered write, and the least worth a task
# while executors would stand idle.
CLUSTER_TASK_BYTES = 128 * 1024 * 1024
SMALL_TASK_BYTES = 4 * 1024 * 1024
# Bytes of batches that a purge rewrites in one job.
PURGE_BYTES = 256 * 1024**3

# A batch id names a folder.
_BATCH_ID = re.compile(r"[A-Za-z0-9_-]+")

# A user's own sink: given the prepared rows, says how many it delivered, or gives back those that are there now.
Writer = Callable[[DataFrame, AppendInfo], int | DataFrame]


def stored_contract(spark, target: str, *, overrides=()) -> Contract:
    """A contract for dynamic rows from what a table says about itself."""
    name, location = locate(spark, target)
    version = ContractStore(spark, location).latest()
    if version is None:
        raise TableMissingError(f"{name} does not exist")
    return Contract.from_json(json.dumps(version.to_dict()), overrides=overrides)


class _NamedLog(logging.LoggerAdapter):
    """Every record names the table."""

    def process(self, msg, kwargs):
        return f"{self.extra['table']}: {msg}", kwargs


@dataclass(frozen=True)
class AppendResult:
    rows: int
    batch_id: str = ""


class GovernedTable:
    """Appends conformed batches, each all or nothing, to a table it first brings in line.

    ``target`` is an address in the warehouse or a path. ``key`` names columns
    that identify a row; without one, a contract with ingestion columns stages
    its batches so that row ids survive a retry. They are staged below the table, or in
    the folder ``staging``, which has to be on the table's own file system.
    ``managed=False`` appends to a plain folder that has no contract of its own.
    """

    def __init__(
        self,
        spark,
        target: str,
        contract: Contract,
        *,
        strategy="append",
        ignore=(),
        create: bool | None = None,
        key=(),
        fill: Fill | None = None,
        row: str = "row",
        source: str = "variant",
        writer: Writer | None = None,
        managed: bool = True,
        ingestion_id: str | None = None,
        created_at: datetime | None = None,
        staging: str | None = None,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    ):
        self.spark = spark
        self.name, self.location = locate(spark, target)
        self.contract = contract
        self.strategy = strategy_of(strategy, ignore, create)
        self.key = (key,) if isinstance(key, str) else tuple(key)
        self.fill, self.row, self.source = fill, row, source
        self.writer, self.managed, self.clock = writer, managed, clock
        self.staging = (staging or f"{self.location}/_staging").rstrip("/")
        self.created_at = created_at or clock()
        self.ingestion_id = ingestion_id or ids.new_uuid7(_millis(self.created_at))
        self.log = _NamedLog(LOGGER, {"table": self.name})
        self.store = ContractStore(spark, self.location)
        self._lock = threading.Lock()
        self._outcome: TableVersion | Exception | None = None
        self._last_millis = 0
        if not managed:
            self._check_unmanaged()

    def _check_unmanaged(self):
        if not isinstance(self.strategy, LeaveAlone) or self.strategy.create:
            raise ContractError(
                f"{self.name} has no contract of its own, so it cannot be reconciled or created; use the strategy none"
            )
        self.log.warning("the target is never checked against the contract")

    # -- starting -------------------------------------------------------------------

    def start(self) -> TableVersion:
        """Reconcile the table once; the outcome, good or bad, holds for this object's life."""
        with self._lock:
            if self._outcome is None:
                try:
                    self._outcome = self._unmanaged() if not self.managed else self._reconcile()
                except Exception as err:
                    self._outcome = err
        if isinstance(self._outcome, Exception):
            raise self._outcome
        return self._outcome

    def _reconcile(self) -> TableVersion:
        version = migrate(self.store, self.contract, self.strategy, self.log)
        present = ct.names(version.columns)
        written = ct.names(self.contract.written_columns())
        absent = [n for n in written if n not in present]
        if absent:
            raise SchemaConflictError(f"the table has no column {', '.join(absent)} and the strategy did not add it")
        unmet = [c.name for c in version.columns if c.required and c.name not in written]
        if unmet:
            raise SchemaConflictError(f"rows do not write the REQUIRED columns {', '.join(unmet)}")
        return version

    def _unmanaged(self) -> TableVersion:
        return TableVersion(0, 0, self.contract.columns, self.contract.layout)

    # -- appending ------------------------------------------------------------------

    def append(
        self,
        df: DataFrame,
        *,
        staged: bool = False,
        keep: bool = False,
        batch_id: str | None = None,
        id_millis: int | None = None,
        verify: bool = False,
    ) -> AppendResult:
        """Append one batch; a row that breaks the contract fails all of it.

        ``staged`` writes the batch beside the table first and loads it from
        there; ``keep`` leaves the staged files. A ``batch_id`` that landed before
        is not appended again. An empty batch does not start anything.

        Staged rows and those that are written from them are held against each other by number
        and fingerprint; ``verify`` reads the files that were written, before they
        become part of the table, and holds their rows against those that were given too.
        """
        if self._outcome is None and df.isEmpty():
            return AppendResult(0)
        info = self.info(batch_id, id_millis)
        columns = self.columns(info)
        self.check_batch(df, columns)
        version = self.start()
        if self.writer:
            return self._append_by_writer(df, info, columns)
        landed = self._landed(version, info.batch_id)
        if landed is not None:
            return AppendResult(landed, info.batch_id)
        if self.needs_staging(version) or staged:
            return self._append_staged(df, info, version, keep, columns, verify)
        rows = self._write(self.prepare(df, info, columns=columns), version, info.batch_id, verify=verify)
        self.log.info("appended %d rows as batch %s", rows, info.batch_id)
        return AppendResult(rows, info.batch_id)

    def append_all(self, batches, **options) -> AppendResult:
        """Append several DataFrames of one type as a single batch."""
        batches = list(batches)
        if not batches:
            return AppendResult(0)
        first = batches[0]
        for i, other in enumerate(batches[1:], 1):
            if not ct.same_type(first.schema, other.schema):
                raise BatchTypeError(f"batch {i} is not of the type of batch 0; every row has to be of one type")
        for other in batches[1:]:
            first = first.unionByName(other)
        return self.append(first, **options)

    def columns(self, info: AppendInfo) -> list[dict]:
        """What fills add to a batch, in order. A custom fill runs here, once for the batch.

        Row ids in it are expressions on the key, or on the place that staging
        gives a row, so they hold wherever the batch is prepared.
        """
        if self.key:
            info = replace(info, row_id=row_id_from_key(info, self.key))
        elif self._numbers_by_place():
            info = replace(info, row_id=row_id_from_place(info))
        if self.contract.is_dynamic:
            return [] if info.row_id is None else [{ROW_ID: info.row_id}]
        fills = ([fill_ingestion] if self.contract.has_ingestion else []) + ([self.fill] if self.fill else [])
        return [fill_columns(info, fill) for fill in fills]

    def check_batch(self, df: DataFrame, columns: list[dict]) -> None:
        """Report a batch of the wrong type before anything is touched."""
        if self.contract.is_dynamic:
            have = dict(df.dtypes).get(self.row)
            want = "string" if self.source == "json" else "map<string,variant>"
            if have != want:
                raise BatchTypeError(f"the batch has {self.row} as {have}, the contract reads {want}")
            return
        if self._numbers_by_place():
            zero = F.lit(0).cast("bigint")
            df = df.withColumn(PLACE, F.struct(zero.alias("task"), zero.alias("row")))
        conform(_filled(df, columns), self.contract, gated=False)

    def info(self, batch_id: str | None = None, id_millis: int | None = None) -> AppendInfo:
        now = self.clock()
        if batch_id is not None and not _BATCH_ID.fullmatch(batch_id):
            raise ContractError(f"the batch id {batch_id!r} has other characters than letters, digits, _ and -")
        with self._lock:
            # No two batches of a sink share the time in their row ids.
            millis = id_millis if id_millis is not None else max(_millis(now), self._last_millis + 1)
            self._last_millis = max(self._last_millis, millis)
        return AppendInfo(
            table=self.name,
            ingestion_id=self.ingestion_id,
            created_at=self.created_at,
            batch_id=batch_id or ids.new_uuid7(millis),
            time=now,
            id_millis=millis,
        )

    def needs_staging(self, version: TableVersion) -> bool:
        """Row ids without a key come from a row's place in a staged file, and so
        does the tie-breaker that spreads a hot clustering value over many tasks."""
        return bool(version.layout.cluster_by) or self._numbers_by_place()

    def _numbers_by_place(self) -> bool:
        """Without a key, an id is wanted for ingestion columns, for fills, and to name dynamic rows that are refused."""
        return not self.key and (self.contract.has_ingestion or self.fill is not None or self.contract.is_dynamic)

    def prepare(self, df: DataFrame, info: AppendInfo, *, keep=(), columns: list[dict] | None = None) -> DataFrame:
        """Enriched, converted and gated rows under the contract's names; no shuffle."""
        columns = self.columns(info) if columns is None else columns
        if self.contract.is_dynamic:
            return conform_dynamic(
                _filled(df, columns), self.contract, self.row, source=self.source, keep=keep, row_id=ROW_ID if columns else None,
            ).transform(lambda out: enforce(out, self.contract.columns))
        return conform(_filled(df, columns), self.contract, keep=keep, row_id=ROW_ID if self.contract.has_ingestion else None)

    def staged(self, df: DataFrame, path: str) -> tuple[DataFrame, tuple[int, ...]]:
        """Rows written aside and read back with their places, and their number and fingerprint; what an earlier try finished is not written again."""
        there = self.spark.read.schema(df.schema).parquet
        if self.store.files.exists(f"{path}/_SUCCESS"):
            mark = fingerprint(there(path), df.columns)
        else:
            tally = Tally()
            tally.over(df, df.columns).write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)
            mark = tally.mark
        return with_place(there(path)), mark

    def _append_staged(self, df, info, version, keep, columns, verify) -> AppendResult:
        path = f"{self.staging}/{info.batch_id}"
        raw = self._numbers_by_place()
        if not raw:
            df = self.prepare(df, info, columns=columns)
            names = set(df.columns)
            df = df.select(*[F.col(f"`{c.name}`") for c in version.columns if c.name in names])
        staged, given = self.staged(df, path)
        try:
            if raw and verify:
                self._same(given, fingerprint(staged, df.columns), "were staged")
            # Raw rows are converted on their way, so that their fingerprint holds for the staged ones only.
            rows = self.load(staged, info, version, raw=raw, size=self.store.files.size(path), columns=columns, given=None if raw else given, verify=verify)
        finally:
            if not keep:
                self.remove(path)
        if rows != given[0]:
            raise ShortWriteError(f"{rows} of {given[0]} staged rows landed", rows)
        self.log.info("appended %d rows as batch %s through %s", rows, info.batch_id, path)
        return AppendResult(rows, info.batch_id)

    def stage(self, df: DataFrame, path: str, mode: str = "errorifexists") -> int:
        """Write rows aside and count them in the same job."""
        counter = Observation()
        rows = df.observe(counter, F.count(F.lit(1)).alias("rows"))
        rows.write.mode(mode).option("maxRecordsPerFile", 0).parquet(path)
        return counter.get["rows"]

    def load(
        self, staged: DataFrame, info: AppendInfo, version: TableVersion, *, raw: bool, size: int, columns: list[dict] | None = None,
        given: tuple[int, ...] | None = None, verify: bool = False,
    ) -> int:
        """Append ``size`` bytes read back from staging; ``raw`` rows are still to be prepared."""
        rows = self.prepare(staged, info, keep=(PLACE,), columns=columns) if raw else staged
        return self._write(rows, version, info.batch_id, size, given=given, verify=verify)

    @staticmethod
    def _same(given: tuple[int, ...], there: tuple[int, ...], what: str) -> None:
        """Rows by number and fingerprint."""
        if there[0] != given[0]:
            raise ShortWriteError(f"{there[0]} of {given[0]} rows {what}", there[0])
        if there != given:
            raise ChangedRowsError(f"{there[0]} rows {what}, but not the {given[0]} that were given", there[0])

    def remove(self, path: str) -> None:
        """Rows that landed stay landed when their staged copy cannot be removed."""
        try:
            self.store.files.delete(path)
        except Exception as err:
            self.log.warning("could not remove the staged rows in %s: %s", path, err)

    def _write(
        self, rows: DataFrame, version: TableVersion, batch_id: str, size: int = 0, *, given: tuple[int, ...] | None = None, verify: bool = False,
    ) -> int:
        """One job into a folder of its own, which then becomes part of the table.

        Jobs that append to one folder share their temporary files and undo each
        other; with a folder per batch, batches may be appended side by side,
        readers see all of a batch or none, and one that already landed under
        its id is not written again. Rows that are not those ``given`` do not land.
        """
        counter = Tally() if given or verify else Observation()
        out = self._distribute(self._stored(rows, version), version, size)
        values = [c for c in out.columns if c not in (PLACE, PARTITION_COLUMN)]
        out = (counter.over(out, values) if given or verify else out.observe(counter, F.count(F.lit(1)).alias("rows"))).drop(PLACE)
        if not self.managed:
            self._writer(out, version, "append").parquet(self.location)
            return counter.rows if given or verify else counter.get["rows"]
        landed = self._landed(version, batch_id)
        if landed is not None:
            return landed
        aside = f"{self.staging}/load-{batch_id}"
        try:
            self._writer(out, version, "overwrite").parquet(aside)
            written = counter.rows if given or verify else counter.get["rows"]
            if given:
                self._same(given, counter.mark, "were written")
            if verify and written:
                self._same(counter.mark, fingerprint(self.spark.read.schema(out.schema).parquet(aside), values), "are in the files")
            if written:
                self._land(aside, f"{BATCH_COLUMN}={batch_id}")
        finally:
            if self.store.files.exists(aside):
                self.remove(aside)
        return written

    def _land(self, aside: str, name: str) -> None:
        """Make a folder part of the generation that is the table's now, also when a rewrite publishes one meanwhile."""
        files, generation = self.store.files, self.store.latest().generation
        files.move_folder(aside, f"{self.store.data(generation)}/{name}")
        while (now := self.store.latest().generation) != generation:
            target = f"{self.store.data(now)}/{name}"
            try:
                files.move_folder(f"{self.store.data(generation)}/{name}", target)
            except OSError:
                if not files.exists(target):  # else the rewrite has taken it along
                    raise
            generation = now

    def takes_files(self, version: TableVersion) -> bool:
        """Whether prepared rows in files are what the table's own files would be: nothing to deal out or to sort, and the same names."""
        stored = {c.name: c.stored_as for c in version.columns}
        same = all(stored.get(c.name) == c.name for c in self.contract.written_columns())
        return self.managed and not self.writer and not version.layout.partition_by and not version.layout.cluster_by and same

    def promote(self, paths: list[str], version: TableVersion, batch_id: str, rows: int) -> int:
        """Make the prepared rows in some folders one batch by moving their files, which is not seen before all are there.

        What a try that failed has moved already stays where it is, and the next one moves the rest.
        """
        landed = self._landed(version, batch_id)
        if landed is not None:
            return landed
        files, aside = self.store.files, f"{self.staging}/promote-{batch_id}"
        files.mkdirs(aside)
        for path in paths:
            for name in files.names(path):
                if name.endswith(".parquet"):
                    files.move_folder(f"{path}/{name}", f"{aside}/{name}")
        if rows:
            self._land(aside, f"{BATCH_COLUMN}={batch_id}")
        else:
            self.remove(aside)
        return rows

    def _landed(self, version: TableVersion, batch_id: str) -> int | None:
        """Rows of a batch that is in the table already, None for any other."""
        if not self.managed or self.writer:
            return None
        target = f"{self.data_path(self.store.latest() or version)}/{BATCH_COLUMN}={batch_id}"
        if not self.store.files.exists(target):
            return None
        self.log.info("batch %s has landed before", batch_id)
        return self.spark.read.parquet(target).count()

    def _writer(self, df: DataFrame, version: TableVersion, mode: str, by: tuple[str, ...] = ()):
        writer = df.write.mode(mode)
        by = [*by, PARTITION_COLUMN] if version.layout.partition_by else by
        return writer.partitionBy(*by) if by else writer

    def data_path(self, version: TableVersion) -> str:
        return self.store.data(version.generation) if self.managed else self.location

    def _stored(self, rows: DataFrame, version: TableVersion) -> DataFrame:
        """The rows under the names used in the files, with their partition."""
        present = set(rows.columns)
        out = [F.col(f"`{c.name}`").alias(c.stored_as) for c in version.columns if c.name in present]
        layout = version.layout
        if layout.partition_by:
            column = next(c for c in version.columns if c.name == layout.partition_by)
            value = F.col(f"`{column.name}`") if column.name in present else F.lit(None).cast(column.spark_type())
            out.append(layout.partition_value(value, column.type).alias(PARTITION_COLUMN))
        return rows.select(*out, *([PLACE] if PLACE in present else []))

    def _distribute(self, out: DataFrame, version: TableVersion, size: int) -> DataFrame:
        layout = version.layout
        stored = {c.name: c.stored_as for c in version.columns}
        order = ([PARTITION_COLUMN] if layout.partition_by else []) + [
            stored[n] for n in layout.cluster_by if stored[n] in out.columns
        ]
        if layout.cluster_by:
            idle = min(self.spark.sparkContext.defaultParallelism, -(-size // SMALL_TASK_BYTES))
            tasks = max(1, idle, -(-size // CLUSTER_TASK_BYTES))
            by = [F.col(f"`{name}`") for name in order]
            # The place is unique, so any number of equal values can be cut apart.
            return out.repartitionByRange(tasks, *by, PLACE).sortWithinPartitions(*by)
        if layout.partition_by and self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
            # Few files per partition; adaptive execution cuts a large partition
            # along its map tasks and joins small ones.
            return out.hint("rebalance", F.col(PARTITION_COLUMN))
        return out

    def _append_by_writer(self, df, info, columns) -> AppendResult:
        if not self._numbers_by_place():
            return self._deliver(self.prepare(df, info, columns=columns), info)
        path = f"{self.staging}/{info.batch_id}"
        staged, _ = self.staged(df, path)
        try:
            return self._deliver(self.prepare(staged, info, columns=columns), info)
        finally:
            self.remove(path)

    def _deliver(self, prepared: DataFrame, info: AppendInfo) -> AppendResult:
        tally = Tally()
        delivered = self.writer(tally.over(prepared, prepared.columns), info)
        if delivered is None:
            raise ShortWriteError("the writer returned neither a number of rows nor an error")
        if isinstance(delivered, DataFrame):
            self._same(tally.mark, fingerprint(delivered.select(*[F.col(f"`{c}`") for c in prepared.columns]), prepared.columns), "were delivered")
            return AppendResult(tally.rows, info.batch_id)
        given = tally.rows
        if delivered != given:
            raise ShortWriteError(f"the writer delivered {delivered} of {given} rows and reported no error", delivered)
        return AppendResult(delivered, info.batch_id)

    # -- reading --------------------------------------------------------------------

    def read(self, *, start=None, end=None, where=None) -> DataFrame:
        """The table under its stored contract; columns a file lacks are NULL.

        ``start`` and ``end`` bound the partitioning column, the latter excluded,
        and prune partitions. A table that requires a filter refuses a read
        without one.
        """
        version = self.store.latest() if self.managed else self._unmanaged()
        if version is None:
            raise TableMissingError(f"{self.name} does not exist")
        layout = version.layout
        bounded = start is not None or end is not None
        if layout.require_filter and not bounded:
            raise ContractError(f"{self.name} is only read with a range of {layout.partition_by}")
        if bounded and not layout.partition_by:
            raise ContractError(f"{self.name} has no partitioning column to bound")
        fields = [T.StructField(c.stored_as, c.spark_type(), True) for c in version.columns]
        if layout.partition_by:
            fields.append(T.StructField(PARTITION_COLUMN, layout.partition_type, True))
        df = self.spark.read.schema(T.StructType(fields)).parquet(self.data_path(version))
        if bounded:
            df = df.filter(self._range(version, start, end))
        df = df.select(*[_described(c) for c in version.columns])
        return df.filter(where) if where is not None else df

    def _range(self, version, start, end):
        """The range on the column itself and, for pruning, on the derived partition."""
        layout = version.layout
        column = next(c for c in version.columns if c.name == layout.partition_by)
        value, part = F.col(f"`{column.stored_as}`"), F.col(PARTITION_COLUMN)
        keep = F.lit(True)
        if start is not None:
            bound = self._bound(start, column)
            keep = keep & (value >= bound) & (part >= layout.partition_value(bound, column.type))
        if end is not None:
            bound = self._bound(end, column)
            keep = keep & (value < bound) & (part <= layout.partition_value(bound, column.type))
        return keep

    def _bound(self, value, column):
        """A bound as a literal that the session's zone has no part in: a text or moment without a zone is in the contract's."""
        if not isinstance(column.spark_type(), T.TimestampType):
            return F.lit(value).cast(column.spark_type())
        moment = datetime.fromisoformat(value) if isinstance(value, str) else value
        if not isinstance(moment, datetime):
            moment = datetime(moment.year, moment.month, moment.day)
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=ZoneInfo(self.contract.zone))
        return instant(moment)

    def partition_counts(self) -> DataFrame:
        """Rows per partition, read from the partitions and file footers alone."""
        version = self.store.latest()
        if version is None or not version.layout.partition_by:
            raise ContractError(f"{self.name} is not a partitioned table")
        schema = T.StructType([T.StructField(PARTITION_COLUMN, version.layout.partition_type, True)])
        df = self.spark.read.schema(schema).parquet(self.data_path(version))
        return df.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("rows"))

    # -- maintenance ----------------------------------------------------------------

    def purge_dropped(self) -> TableVersion:
        """Destroy the values of dropped columns by writing the kept ones into a new generation.

        Dropping a column alone is a change of the contract. This job is for when
        the bytes have to go; without dropped columns it does nothing. Batches keep
        their folders, and so their ids; rows keep their order by partition and
        clustering columns. Batches are rewritten in groups, and a job that fails goes on, when it
        is called again, where it stopped. Appends go on meanwhile: what lands in the old
        generation is moved to the new one before the old one is deleted.
        """
        version = self.store.latest()
        if not version.retired:
            return version
        files, old, new = self.store.files, self.data_path(version), self.store.data(version.generation + 1)
        taken = set(files.names(old))  # one name a batch
        # What is finished stays there when the job fails. The contract's version is in the name: another one is another job.
        work = f"{self.staging}/purge-{version.version}"
        files.mkdirs(work)
        try:
            for names in self._purge_groups(old, sorted(taken - set(files.names(work)))):
                self._purge_group(version, old, names, work)
            if files.exists(new):
                self.remove(new)  # an earlier try that was not published
            files.move_folder(work, new)
            published = self.store.publish(replace(version, generation=version.generation + 1, retired=()), version)
        except ConcurrentChangeError:
            self.remove(new)
            raise
        except Exception:
            if files.exists(new) and not files.exists(work):
                files.move_folder(new, work)
            raise
        for name in files.names(old):
            if name not in taken and not files.exists(f"{new}/{name}"):
                files.move_folder(f"{old}/{name}", f"{new}/{name}")
        self.remove(old)
        self.log.warning("rewrote %d batches without the dropped columns", len(taken))
        return published

    def _purge_groups(self, old: str, names: list[str]):
        """Batches in groups of about ``PURGE_BYTES``."""
        group, size = [], 0
        for name in names:
            group.append(name)
            size += self.store.files.size(f"{old}/{name}")
            if size >= PURGE_BYTES:
                yield group
                group, size = [], 0
        if group:
            yield group

    def _purge_group(self, version: TableVersion, old: str, names: list[str], work: str) -> None:
        """Rewrite some batches and put each beside those that are finished."""
        files, aside = self.store.files, f"{self.staging}/purging-{ids.new_uuid7(_millis(self.clock()))}"
        fields = [T.StructField(c.stored_as, c.spark_type(), True) for c in version.columns]
        fields.append(T.StructField(BATCH_COLUMN, T.StringType(), True))
        if version.layout.partition_by:
            fields.append(T.StructField(PARTITION_COLUMN, version.layout.partition_type, True))
        present = [f.name for f in fields]
        stored = {c.name: c.stored_as for c in version.columns}
        order = [n for n in (BATCH_COLUMN, PARTITION_COLUMN) if n in present] + [stored[n] for n in version.layout.cluster_by if n in stored]
        read = self.spark.read.schema(T.StructType(fields)).option("basePath", old)
        kept = read.parquet(*[f"{old}/{name}" for name in names]).select(*[F.col(f"`{n}`") for n in present])
        try:
            self._writer(kept.sortWithinPartitions(*[F.col(f"`{n}`") for n in order]), version, "overwrite", (BATCH_COLUMN,)).parquet(aside)
            for name in files.names(aside):
                if name.startswith(f"{BATCH_COLUMN}=") and not files.exists(f"{work}/{name}"):
                    files.move_folder(f"{aside}/{name}", f"{work}/{name}")
        finally:
            if files.exists(aside):
                self.remove(aside)


def _filled(df: DataFrame, columns: list[dict]) -> DataFrame:
    for some in columns:
        df = df.withColumns(some)
    return df


def _described(column: ct.TableColumn):
    """A stored column under its own name, with its description as the comment."""
    stored = F.col(f"`{column.stored_as}`")
    if not column.description:
        return stored.alias(column.name)
    return stored.alias(column.name, metadata={"comment": column.description})


def _millis(moment: datetime) -> int:
    return int(moment.timestamp() * 1000)
