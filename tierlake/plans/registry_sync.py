"""Registry-driven sync of declared REST sources from their landed pages.

Each source is a keyed snapshot table.  The time of a source's last successful
sync is part of the commit that publishes its data, so a crash between two
sources, or inside one, neither skips a window nor repeats a merge: either both
the rows and the time are there, or none.

``sync_all`` takes the active sources of the registry in order.  A failing source
keeps its table and its last sync and does not stop the others; every outcome is
a row of the run log.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tierlake.operators.incremental import OVERLAP_DAYS, sync_mode
from tierlake.operators.upsert import fold_pages
from tierlake.plans.rest_datasets import SyncErrors
from tierlake.sources.store import SnapshotTable

REGISTRY_SCHEMA = "module_static_id string, display_name string, module_code string, date_field string, sync_type string, is_active string, loader string"
RUN_SCHEMA = ("run_id string, module_static_id string, mode string, window_start timestamp_ntz, status string, "
              "rows_merged bigint, message string, run_ts timestamp_ntz")

# The registered sources (static id, name, module, date field, sync type, loader of code-based ones).
REGISTRY = [
    ("rest_sync_account_values", "Account Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_accounting_scenario_values", "Accounting Scenario Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_activity_values", "Activity Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_fund_values", "Fund Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_function_values", "Function Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_grant_values", "Grant Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_initiative_values", "Initiative Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_interfund_values", "Interfund Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_location_values", "Location Values", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_invoices", "AP Invoices", "FIN", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_receivable_transactions", "Receivable Transactions", "FIN", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_job_applications", "Job Applications", "HCM", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_job_requisitions", "Job Requisitions", "HCM", None, "CODE_BASED", "Y", "load_requisitions"),
    ("rest_sync_absences", "Absences", "HCM", "lastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_positions", "Positions", "HCM", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_salaries", "Salaries", "HCM", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_recruitingcandidates", "Recruiting Candidates", "HCM", None, "CODE_BASED", "Y", "load_candidates"),
    ("rest_sync_purchase_orders", "Purchase Orders", "PRC", "LastUpdateDate", "INCREMENTAL", "Y", None),
    ("rest_sync_locations", "Locations", "HCM", None, "FULL_ONLY", "Y", None),
    ("rest_sync_suppliers", "Suppliers", "PRC", None, "FULL_ONLY", "Y", None),
]

# The fields of a ledger segment value (one layout for all segment tables).
SEGMENT_VALUE_FIELDS = [
    ("ValueId", "bigint"), ("IndependentValue", "string"), ("IndependentValueNumber", "double"), ("IndependentValueDate", "date"),
    ("IndependentValueTimestamp", "ts"), ("Value", "string"), ("ValueNumber", "double"), ("ValueDate", "date"),
    ("ValueTimestamp", "ts"), ("TranslatedValue", "string"), ("Description", "string"), ("EnabledFlag", "string"),
    ("StartDateActive", "date"), ("EndDateActive", "date"), ("SortOrder", "bigint"), ("CreationDate", "ts"),
    ("CreatedBy", "string"), ("LastUpdateDate", "ts"), ("LastUpdatedBy", "string"),
]


def registry_table(spark: SparkSession) -> DataFrame:
    """The shipped registry rows."""
    from tierlake.session import local_rows
    return local_rows(spark, REGISTRY, REGISTRY_SCHEMA)


def declared_items(pages: DataFrame, key_field: str, order: tuple[str, ...] = ("pass_no", "page_no")) -> DataFrame:
    """Items of landed pages as rows of a declared table.

    A declared table's columns are the JSON fields in lower case; nested children are not part of it.
    ``resource_key`` is the key field as text; rows without it never load.  ``_page`` and ``_seq`` give the
    order in which pages are merged (later wins).
    """
    pos = pages.select(*[c for c in order if c in pages.columns], F.posexplode("items").alias("_pos", "item"))
    item: StructType = pages.schema["items"].dataType.elementType
    flat = [f.name for f in item.fields if not isinstance(f.dataType, (ArrayType, StructType))]
    page = F.struct(*[F.col(c) for c in order if c in pages.columns])
    rows = pos.select(page.alias("_page"), F.col("_pos").alias("_seq"), F.col(f"item.{key_field}").cast("string").alias("resource_key"),
                      *[F.col(f"item.{c}").alias(c.lower()) for c in flat])
    return rows.where(F.col("resource_key").isNotNull())


@dataclass(frozen=True)
class Outcome:
    module_static_id: str
    mode: str
    window_start: _dt.datetime | None
    status: str
    rows_merged: int
    message: str | None


class RegistrySync:
    """The declared tables of one deployment, below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, module_static_id: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{module_static_id}", keys=["resource_key"])

    def last_sync(self, module_static_id: str) -> _dt.datetime | None:
        tag = self.table(module_static_id).last_tag()
        return _dt.datetime.fromisoformat(json.loads(tag)["last_sync"]) if tag else None

    def sync_one(self, row, items: DataFrame, run_ts: _dt.datetime) -> Outcome:
        """One source: the window since its last sync (less the overlap), folded and merged, or a full refresh."""
        name = row["module_static_id"]
        mode, field = sync_mode(row["sync_type"], row["date_field"])
        target, last = self.table(name), self.last_sync(name)
        start = None
        if mode == "INCREMENTAL":
            column = next((c for c in items.columns if c.lower() == field.lower()), None)
            if column is None:
                raise ValueError(f"no date field {field}")
            if last is not None:
                start = last - _dt.timedelta(days=OVERLAP_DAYS)
                items = items.where(F.col(column).cast("timestamp_ntz") > F.lit(start).cast("timestamp_ntz"))
        folded = fold_pages(items, ["resource_key"], "_page", "_seq").drop("_page", "_seq") \
            .withColumn("row_sync_ts", F.lit(run_ts).cast("timestamp_ntz"))
        tag = json.dumps({"last_sync": run_ts.isoformat()})
        target.schema = folded.schema
        if mode == "FULL" or target.current_version() is None:
            target.publish(folded, tag=tag)
        else:
            target.schema = None
            target.read()
            target.publish_delta(folded, tag=tag)
        st = target.state()
        written = self.spark.read.parquet(target.path(st["deltas"][-1])).count() if st["deltas"] else None
        if written is None:         # a full table, or deltas folded into the base just now
            written = target.read().where(F.col("row_sync_ts") == F.lit(run_ts).cast("timestamp_ntz")).count()
        return Outcome(name, mode, start, "SUCCESS", written, None)

    def sync_all(self, registry: DataFrame, items_of: Callable[[str], DataFrame], run_id: str, run_ts: _dt.datetime,
                 strict: bool = True) -> list[Outcome]:
        """All active sources in order of module and name; ``items_of(static_id)`` gives a source's landed items.

        ``strict`` raises :class:`SyncErrors` at the end if a source failed.  A source that this run has synced
        already (the run was repeated after a crash) is not merged again.
        """
        done: list[Outcome] = []
        active = registry.where("is_active = 'Y'").orderBy("module_code", "display_name").collect()     # registry rows
        for row in active:
            name = row["module_static_id"]
            try:
                if self.last_sync(name) == run_ts:
                    done.append(Outcome(name, sync_mode(row["sync_type"], row["date_field"])[0], None, "DONE BEFORE", 0, None))
                else:
                    done.append(self.sync_one(row, items_of(name), run_ts))
            except Exception as e:  # noqa: BLE001 - one source must not stop the others
                done.append(Outcome(name, sync_mode(row["sync_type"], row["date_field"])[0], None, "ERROR", 0, str(e).split("\n")[0][:500]))
        self._log(done, run_id, run_ts)
        failed = [f"{o.module_static_id}: {o.message}" for o in done if o.status == "ERROR"]
        if failed and strict:
            raise SyncErrors(f"{len(failed)} source(s) failed: " + "; ".join(failed))
        return done

    def _log(self, done: list[Outcome], run_id: str, run_ts: _dt.datetime) -> None:
        from tierlake.session import local_rows
        rows = [(run_id, o.module_static_id, o.mode, o.window_start, o.status, o.rows_merged, o.message, run_ts) for o in done]
        if rows:
            local_rows(self.spark, rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_runs")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/_runs")
