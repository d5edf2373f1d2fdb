"""The daily run: refresh the catalog, unzip, stage, preview and merge the new files, in restartable steps.

Nothing of a run is held in memory.  The catalog is a keyed table, each load is
a job with recorded states, and a merge's commit carries its job.  A run that
died is repeated as it is: jobs that were loading are loaded again under their
own id, staged jobs are merged, a merge that was committed is not done twice, and
then the run goes on with files that no job has taken.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierlake.operators.incremental import DAILY_LOAD_TYPES, EXCLUDED_FILE_PATTERNS, select_unprocessed_latest
from tierlake.plans.entity_flow import Warehouse, load_and_preview, merge_job
from tierlake.plans.specs import EntitySpec
from tierlake.sources.catalog import CATALOG_SCHEMA, catalog_view, refresh
from tierlake.sources.store import SnapshotTable
from tierlake.sources.zipped import list_zips, stage_zip_csv


class DailyRun:
    """Loads from the archives below ``inbox`` into ``wh``.

    ``load_types`` are the types a run looks for; ``before`` is called between the catalog refresh and the loads
    (the place of the recruiting refresh).  ``multi_line`` allows quoted line breaks.
    """

    def __init__(self, wh: Warehouse, specs: dict[str, EntitySpec], inbox: str, loader_map: DataFrame,
                 load_types: Sequence[str] = DAILY_LOAD_TYPES, excluded: Sequence[str] = EXCLUDED_FILE_PATTERNS,
                 before: Callable[[], object] | None = None, multi_line: bool = True):
        self.wh, self.specs, self.inbox, self.loader_map = wh, specs, inbox, loader_map
        self.load_types, self.excluded, self.before, self.multi_line = list(load_types), excluded, before, multi_line

    def catalog(self) -> SnapshotTable:
        return SnapshotTable(self.wh.spark, f"{self.wh.root}/catalog", StructType.fromDDL(CATALOG_SCHEMA), keys=["file_name"])

    def refresh_catalog(self, now: _dt.datetime) -> None:
        """Upsert the listing into the catalog; only listed files are written."""
        target = self.catalog()
        view = catalog_view(list_zips(self.wh.spark, self.inbox), self.loader_map).dropDuplicates(["file_name"])
        known = target.matching(view.select("file_name")).join(view.select("file_name"), "file_name", "left_semi")
        target.publish_delta(refresh(known, view, F.lit(now).cast("timestamp_ntz")))

    def unzipped(self, file_names: Sequence[str]) -> dict[str, str]:
        """The staged CSV of each archive, one task per archive; at most one archive per load type."""
        zips = list_zips(self.wh.spark, self.inbox).where(F.col("file_name").isin(list(file_names))).dropDuplicates(["file_name"])
        rows = stage_zip_csv(zips, f"{self.wh.root}/unzipped").collect()
        return {r["zip_path"].rsplit("/", 1)[-1]: r["staged_path"] for r in rows}

    def resume(self) -> list[tuple[str, str]]:
        """Bring the jobs that an earlier run left behind to their end."""
        left = self.wh.jobs().current().where(F.col("status").isin("LOADING", "STAGED")).orderBy("job_id").collect()
        loading = [j for j in left if j["status"] == "LOADING"]
        paths = self.unzipped([j["file_name"] for j in loading]) if loading else {}
        done = []
        for j in left:
            spec = self.specs[j["load_type"]]
            if j["status"] == "LOADING":
                load_and_preview(self.wh, spec, paths[j["file_name"]], j["file_name"], self.multi_line, job_id=j["job_id"])
            merge_job(self.wh, spec, j["job_id"], j["file_name"])
            done.append((j["file_name"], j["load_type"]))
        return done

    def run(self, now: _dt.datetime) -> list[tuple[str, str]]:
        """One daily run; ``(file name, load type)`` of what it merged, in order of time.

        The first failure stops the run; later files wait for the next one.
        """
        done = self.resume()
        self.refresh_catalog(now)
        if self.before is not None:
            self.before()
        jobs = self.wh.jobs().current().select("file_name", "load_type", "status")
        chosen = select_unprocessed_latest(self.catalog().read(), jobs, F.lit(now).cast("timestamp"), self.load_types, self.excluded)
        rows = chosen.orderBy("file_timestamp", "file_name").collect()      # at most one row per load type
        paths = self.unzipped([r["file_name"] for r in rows]) if rows else {}
        for r in rows:
            spec = self.specs[r["load_type"]]
            job_id, _ = load_and_preview(self.wh, spec, paths[r["file_name"]], r["file_name"], self.multi_line)
            merge_job(self.wh, spec, job_id, r["file_name"])
            done.append((r["file_name"], r["load_type"]))
        return done
