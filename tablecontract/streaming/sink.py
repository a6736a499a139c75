"""A table as the sink of a stream, or of many small batches."""

from __future__ import annotations

import json
import threading
from datetime import datetime

from pyspark.sql import DataFrame

from ..errors import ClosedError, ConcurrentChangeError, ContractError
from ..operators.enrich import AppendInfo, with_place
from ..sources.files import Files
from ..sources.table import AppendResult, GovernedTable
from ..types import spark_schema


# Holds the number of rows of a held batch; readers pass over names that begin so.
_COUNT = "_rows"


class TableSink:
    """Appends every batch on its own, or holds rows until ``flush_rows`` are there.

    Held rows are parquet files below the table, already prepared and with their
    ids, so a restart finds them and a repeated micro-batch replaces its own.
    When the threshold is reached everything held becomes one append: a batch is
    never cut, so an append may be larger than the threshold. What an append
    takes is noted first: after a crash it is finished under the same batch id,
    which a table does not take twice. Where the table's layout asks for no order, held files are moved
    into it as they are, else they are read and written once more. The micro-batches of the last append are
    remembered, so that one run again after it is not held a second time.

    ``name`` tells what a sink holds from what others hold; by default it is the table's
    ingestion id, so a restart has to be given either.
    """

    def __init__(self, table: GovernedTable, *, flush_rows: int = 0, name: str | None = None):
        if flush_rows < 0:
            raise ContractError(f"flush_rows is {flush_rows}, which is not a number of rows")
        self.table, self.flush_rows = table, flush_rows
        name = name or table.ingestion_id
        self._pending = f"{table.location}/_pending/{name}"
        self._intent = f"{table.location}/_pending/{name}.json"
        self._last = f"{table.location}/_pending/{name}.last.json"
        self._files = Files(table.spark)
        self._held: dict[str, int] | None = None
        self._errors: list[Exception] = []
        self._closed = False
        self._lock = threading.RLock()

    # -- writing --------------------------------------------------------------------

    def write(self, df: DataFrame, batch_id: int | str | None = None) -> AppendResult:
        """Take a batch. Under a threshold the result says the rows were accepted,
        and an append that fails is reported by the next flush or by close."""
        with self._lock:
            self._check_open()
            name, millis = self._identify(batch_id)
            if self.flush_rows == 0:
                return self.table.append(df, batch_id=name, id_millis=millis)
            if self.table._outcome is None and df.isEmpty():
                return AppendResult(0)
            info = self.table.info(name, millis)
            columns = self.table.columns(info)
            self.table.check_batch(df, columns)
            self.table.start()
            landed = self._landed(name)
            if landed is not None:
                return AppendResult(landed, name)
            rows = self._hold(df, info, columns)
            if sum(self._held_rows().values()) >= self.flush_rows:
                try:
                    self._append_held()
                except Exception as err:
                    self._errors.append(err)
                    self.table.log.warning("held rows did not land and are kept: %s", err)
            return AppendResult(rows, name or "")

    def foreach_batch(self, df: DataFrame, batch_id: int) -> None:
        """For ``writeStream.foreachBatch``."""
        self.write(df, batch_id)

    def flush(self) -> AppendResult:
        """Append everything held now, and report failures nobody has seen yet."""
        with self._lock:
            self._check_open()
            return self._settle()

    def close(self) -> AppendResult:
        """Append what is left; a second close does nothing."""
        with self._lock:
            if self._closed:
                return AppendResult(0)
            self._closed = True
            return self._settle()

    @property
    def held(self) -> int:
        with self._lock:
            return sum(self._held_rows().values())

    def _settle(self) -> AppendResult:
        errors, self._errors = self._errors, []
        rows = 0
        try:
            rows = self._append_held() if self._held_rows() else 0
        except Exception as err:
            errors.append(err)
        if len(errors) == 1:
            raise errors[0]
        if errors:
            raise ExceptionGroup("rows did not land", errors)
        return AppendResult(rows)

    def _check_open(self):
        if self._closed:
            raise ClosedError("the sink is closed")

    def _identify(self, batch_id):
        """A micro-batch run again has the same name and the same time in its ids."""
        if batch_id is None:
            return None, None
        name = f"{self.table.ingestion_id}-{batch_id}"
        millis = int(self.table.created_at.timestamp() * 1000) + batch_id if isinstance(batch_id, int) else None
        return name, millis

    # -- what is held ---------------------------------------------------------------

    def _hold(self, df: DataFrame, info: AppendInfo, columns: list[dict]) -> int:
        table = self.table
        path = f"{self._pending}/batch={info.batch_id}"
        if table._numbers_by_place():
            raw = f"{table.staging}/{info.batch_id}"
            rows, _ = table.staged(df, raw)
            count = table.stage(table.prepare(rows, info, columns=columns), path, "overwrite")
            table.remove(raw)
        else:
            count = table.stage(table.prepare(df, info, columns=columns), path, "overwrite")
        self._files.create_new(f"{path}/{_COUNT}", str(count))
        self._held_rows()[f"batch={info.batch_id}"] = count
        return count

    def _held_rows(self) -> dict[str, int]:
        """Rows by held batch. Each batch has its count beside it; a crash between the two leaves one to be counted."""
        if self._held is None:
            self._held = {}
            for name in self._files.names(self._pending):
                path = f"{self._pending}/{name}"
                if self._files.exists(f"{path}/{_COUNT}"):
                    self._held[name] = int(self._files.read_text(f"{path}/{_COUNT}"))
                elif self._files.exists(f"{path}/_SUCCESS"):
                    self._held[name] = self.table.spark.read.parquet(path).count()
            if self._files.exists(self._intent):
                self._finish_append()
        return self._held

    def _landed(self, name: str | None) -> int | None:
        """Rows of a micro-batch that was part of the last append, None for any other.

        A stream runs at most its last micro-batch again, so the last append is
        as far back as there is to look.
        """
        self._held_rows()
        if name is None or not self._files.exists(self._last):
            return None
        return json.loads(self._files.read_text(self._last)).get(f"batch={name}")

    def _append_held(self) -> int:
        held = self._held_rows()
        rows = self._finish_append() if self._files.exists(self._intent) else 0
        if not held:
            return rows
        note = json.dumps({"batch_id": self.table.info().batch_id, "held": held}, sort_keys=True)
        if not self._files.create_new(self._intent, note):
            raise ConcurrentChangeError(f"{self._pending} is being appended by someone else")
        return rows + self._finish_append()

    def _finish_append(self) -> int:
        """Append what the note says, unless that batch is in the table already, and let go of it."""
        table, note = self.table, json.loads(self._files.read_text(self._intent))
        info, version = table.info(note["batch_id"]), table.start()
        paths = [p for p in (f"{self._pending}/{name}" for name in note["held"]) if self._files.exists(p)]
        rows = 0
        if table.takes_files(version):
            rows = table.promote(paths, version, note["batch_id"], sum(note["held"].values()))
        elif paths:
            schema = spark_schema(table.contract.written_columns())
            held = with_place(table.spark.read.schema(schema).parquet(*paths))
            rows = table.load(held, info, version, raw=False, size=sum(map(self._files.size, paths)))
        self._files.delete(self._last)
        self._files.create_new(self._last, json.dumps(note["held"]))
        for name in note["held"]:
            table.remove(f"{self._pending}/{name}")
            self._held.pop(name, None)
        self._files.delete(self._intent)
        table.log.info("appended %d held rows of %d batches", rows, len(paths))
        return rows


def open_stream(
    df: DataFrame, make_table, checkpoint: str, *, flush_rows: int = 0, trigger: dict | None = None
):
    """Start a stream into a table; returns the sink and the running query.

    ``make_table(ingestion_id, created_at)`` builds the table. Both values and the
    table's folder are kept beside the checkpoint: a restart goes on under the
    same id, and a checkpoint of another table is refused.
    """
    spark = df.sparkSession
    files = Files(spark)
    path = f"{checkpoint.rstrip('/')}/table.json"
    known = json.loads(files.read_text(path)) if files.exists(path) else {}
    created = datetime.fromisoformat(known["created_at"]) if known else None
    table = make_table(known.get("ingestion_id"), created)
    state = {
        "table": table.location,
        "ingestion_id": table.ingestion_id,
        "created_at": table.created_at.isoformat(),
    }
    if known and known["table"] != table.location:
        raise ContractError(f"the checkpoint {checkpoint} belongs to {known['table']}, not to {table.location}")
    if not known and not files.create_new(path, json.dumps(state)):
        raise ContractError(f"the checkpoint {checkpoint} was taken by another stream")
    sink = TableSink(table, flush_rows=flush_rows, name=table.ingestion_id)
    query = (
        df.writeStream.foreachBatch(sink.foreach_batch)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/offsets")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return sink, query
