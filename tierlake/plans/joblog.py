"""Load-job state and load logs as append-only event tables.

Each state change appends one event row (one small parquet file, written
directly: no Spark job per event); the current state of a job is the latest
value per column (a NULL in a later event keeps the earlier value), computed
with a grouped ``max_by`` that combines map-side.  Appends survive a failed
data write because they are separate small writes.
"""

from __future__ import annotations

import datetime as _dt
import getpass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.sources import files

JOB_EVENT_SCHEMA = ("job_id bigint, load_type string, file_name string, status string, rows_loaded bigint, "
                    "new_count bigint, changed_count bigint, unchanged_count bigint, rows_merged bigint, "
                    "error_message string, actor string, event_ts timestamp_ntz, event_seq bigint")
LOAD_LOG_SCHEMA = ("load_type string, file_name string, step string, rows_processed bigint, rows_inserted bigint, "
                   "status string, error_message string, log_ts timestamp_ntz")
STATUSES = ("LOADING", "STAGED", "LOADED", "MERGED", "ERROR")
ERROR_TEXT_LIMIT = 4000


def _now():
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


_ARROW_TYPES = {"bigint": "int64", "string": "string", "timestamp_ntz": "timestamp[us]"}


def _append_event(folder: str, schema_ddl: str, row: dict) -> None:
    """Append one event as a small parquet file (a metadata write, no Spark job).

    Timestamps are written without a zone, which Spark reads back as
    ``timestamp_ntz``; readers see the folder as one table.
    """
    import uuid

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tierlake.sources.files import open_output
    fields = [f.split() for f in schema_ddl.split(", ")]
    schema = pa.schema([pa.field(n, pa.type_for_alias(_ARROW_TYPES[t])) for n, t in fields])
    tbl = pa.Table.from_pylist([{n: row.get(n) for n, _ in fields}], schema=schema)
    with open_output(f"{folder}/part-{uuid.uuid4().hex}.parquet") as fh:
        pq.write_table(tbl, fh)


REPORT_STATUSES = ("RUNNING", "SUCCESS", "ERROR")


class JobLog:
    """Job events under ``root/events``; current state via :meth:`current`.

    Also serves the two-phase report-load log: append RUNNING at the start,
    SUCCESS/ERROR with counts at the end (``statuses=REPORT_STATUSES``); a
    count left NULL by the second event keeps the first event's value.
    """

    def __init__(self, spark: SparkSession, root: str, statuses: tuple[str, ...] = STATUSES):
        self.spark, self.root = spark, root.rstrip("/")
        self.statuses = statuses
        self._seq = 0

    def _path(self) -> str:
        return f"{self.root}/events"

    def events(self) -> DataFrame:
        if not files.exists(self._path()):
            return self.spark.createDataFrame([], JOB_EVENT_SCHEMA)
        return self.spark.read.schema(JOB_EVENT_SCHEMA).parquet(self._path())

    _last_id = 0

    def next_job_id(self) -> int:
        """A new job id: time-ordered (microseconds), strictly increasing per driver."""
        import time
        jid = max(time.time_ns() // 1000, JobLog._last_id + 1)
        JobLog._last_id = jid
        return jid

    def append(self, job_id: int, status: str, **cols) -> None:
        if status not in self.statuses:
            raise ValueError(status)
        self._seq += 1
        err = cols.get("error_message")
        if err is not None:
            cols["error_message"] = str(err)[:ERROR_TEXT_LIMIT]
        row = {"job_id": job_id, "status": status, "actor": cols.pop("actor", None) or getpass.getuser(),
               "event_ts": _now(), "event_seq": self._seq, **cols}
        _append_event(self._path(), JOB_EVENT_SCHEMA, row)

    def current(self) -> DataFrame:
        """One row per job: the latest non-NULL value of every column."""
        from tierlake.operators.upsert import current_state
        return current_state(self.events(), ["job_id"], ["event_ts", "event_seq"]).drop("event_seq")


class LoadLog:
    """Append-only load log (step, counts, status, error text)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, root.rstrip("/") + "/load_log"

    def append(self, load_type: str, file_name: str | None, step: str, status: str,
               rows_processed: int | None = None, rows_inserted: int | None = None,
               error_message: str | None = None) -> None:
        err = None if error_message is None else str(error_message)[:ERROR_TEXT_LIMIT]
        _append_event(self.path, LOAD_LOG_SCHEMA, {
            "load_type": load_type, "file_name": file_name, "step": step, "rows_processed": rows_processed,
            "rows_inserted": rows_inserted, "status": status, "error_message": err, "log_ts": _now()})

    def read(self) -> DataFrame:
        if not files.exists(self.path):
            return self.spark.createDataFrame([], LOAD_LOG_SCHEMA)
        return self.spark.read.schema(LOAD_LOG_SCHEMA).parquet(self.path)

    def report(self) -> DataFrame:
        """Newest first, with a readable step label."""
        from tierlake.functions.casts import report_label
        return self.read().withColumn("step_label", report_label("step")).orderBy(F.col("log_ts").desc())
