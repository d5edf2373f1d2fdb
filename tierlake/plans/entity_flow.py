"""The per-file flow of an extract entity: land -> stage -> preview -> merge.

Tables (all under one root on shared storage):

* ``staging/<entity>``  parquet partitioned by ``job_id``; a restage of the
  same job replaces only its partition (dynamic partition overwrite)
* ``staging/<entity>__latest``  the job's batch after filters and
  latest-per-key, written once and read by both preview and merge
* ``final/<entity>``    :class:`~tierlake.sources.store.SnapshotTable`
* ``jobs``, ``load_log`` append-only event tables

Actions happen where the source system commits: staging write, preview
counts, final publish.  The shuffles are the dedup window and the upsert
join, both on the entity keys.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators.dedup import latest_per_key
from tierlake.operators.preview import change_preview, distinct_key_count
from tierlake.operators.upsert import upsert, upsert_surrogate
from tierlake.plans.joblog import JobLog, LoadLog
from tierlake.plans.specs import EntitySpec
from tierlake.sources import files
from tierlake.sources.landing import LandingTable, read_landing_csv
from tierlake.sources.store import SnapshotTable


def stage(landing: DataFrame, spec: EntitySpec, job_id: int, run_id: str | None = None,
          run_ts: _dt.datetime | None = None) -> DataFrame:
    """Typed staging rows of one job (casts, renames, run metadata, ``_seq``).

    Run id and time are fixed once on the driver, so a re-executed task
    writes the same values.
    """
    from tierlake.plans.specs import Col
    # all plain columns in one projection (they read landing columns only);
    # derived columns may read earlier staging columns, so they follow in order
    plain = {c.target: c.expr() for c in spec.columns if isinstance(c, Col)}
    df = landing.withColumns(plain) if plain else landing
    for c in spec.columns:
        if not isinstance(c, Col):
            df = df.withColumn(c.target, c.expr())
    run = run_id or uuid.uuid4().hex
    ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return df.select(
        *spec.staging_columns(), "_seq",
        F.lit(run).alias("last_extract_run_id"),
        F.lit(ts).cast("timestamp_ntz").alias("last_extract_run_ts"),
        F.lit(job_id).cast("bigint").alias("job_id"))


def dedup(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    """Entity filters, then the latest row per key (``_seq`` breaks ties)."""
    return latest_per_key(staged.where(spec.filter_expr()), list(spec.keys), spec.dedup_order())


def preview(staged: DataFrame, final: DataFrame, spec: EntitySpec) -> DataFrame:
    return change_preview(dedup(staged, spec), final, list(spec.keys), spec.compare_columns())


def rows_loaded(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    nn = spec.rows_loaded_not_null if spec.rows_loaded_not_null is not None else spec.not_null or spec.keys[:1]
    return distinct_key_count(staged, list(spec.keys), list(nn))


def null_key(spec: EntitySpec):
    from functools import reduce
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])


def merged_final(staged: DataFrame, final: DataFrame, spec: EntitySpec) -> DataFrame:
    """The next version of the final table (M1, M2 or M6).

    Rows with a NULL key part never match; unless the spec inserts them
    (surrogate identity), they are quarantined instead of breaking the key.
    """
    src = dedup(staged, spec)
    if spec.null_keys == "quarantine":
        src = src.where(~null_key(spec))
    if spec.surrogate_id:
        data_cols = [c for c in final.columns if c != spec.surrogate_id]
        return upsert_surrogate(final, src.select(*data_cols, "_seq"), list(spec.keys), spec.surrogate_id, "_seq")
    if spec.update is not None:
        from tierlake.operators.upsert import merge_columns
        return merge_columns(final, src, list(spec.keys), update_cols=list(spec.update))
    return upsert(final, src.select(*final.columns), list(spec.keys))


def delta_rows(deduped: DataFrame, current: DataFrame, spec: EntitySpec, max_id: int | None = None) -> DataFrame:
    """The complete new values of every row a merge changes or inserts.

    ``deduped``: the batch after the entity filters and the latest-per-key
    step.  Only final rows whose key occurs in the batch take part (semi join
    on the batch keys), so the work and the write follow the batch size.
    ``current`` may be the part of the final that can match; then ``max_id``
    must tell the largest surrogate id of the whole.
    """
    from tierlake.operators.upsert import merge_columns
    src = deduped
    if spec.null_keys == "quarantine":
        src = src.where(~null_key(spec))
    touched = current.join(src.select(*spec.keys), list(spec.keys), "left_semi")
    if spec.surrogate_id:
        data_cols = [c for c in current.columns if c != spec.surrogate_id]
        if max_id is None:
            max_id = current.agg(F.coalesce(F.max(spec.surrogate_id), F.lit(0)).cast("bigint")).scalar()
        else:
            max_id = F.lit(max_id).cast("bigint")
        return upsert_surrogate(touched, src.select(*data_cols, "_seq"), list(spec.keys), spec.surrogate_id,
                                "_seq", max_id=max_id)
    if spec.update is not None:
        return merge_columns(touched, src, list(spec.keys), update_cols=list(spec.update))
    return src.select(*current.columns)


@dataclass
class Warehouse:
    """Where one deployment keeps its tiers."""
    spark: SparkSession
    root: str
    merge_on_read: bool = True       # merges write deltas; False rewrites the final each time
    max_deltas: int = 8
    keep_landing: bool = False       # keep each extract's rows as a landing table, replaced by the next

    def __post_init__(self):
        # one meaning of a path for Spark, for the driver and inside tasks
        self.root = files.qualified(self.spark, self.root.rstrip("/"))

    def staging_path(self, spec: EntitySpec) -> str:
        return f"{self.root}/staging/{spec.name.lower()}"

    def quarantine_path(self, spec: EntitySpec) -> str:
        return f"{self.root}/quarantine/{spec.name.lower()}"

    def final(self, spec: EntitySpec) -> SnapshotTable:
        from pyspark.sql.types import LongType, StructField, StructType
        sample = self.spark.createDataFrame([], self.staging_schema(spec))
        fields = [f for f in sample.schema.fields if f.name not in ("_seq", "job_id") and not f.name.endswith("_raw")]
        if spec.surrogate_id:
            fields = [StructField(spec.surrogate_id, LongType())] + fields
        return SnapshotTable(self.spark, f"{self.root}/final/{spec.name.lower()}", StructType(fields),
                             keys=spec.keys, max_deltas=self.max_deltas,
                             stat_cols=[spec.surrogate_id] if spec.surrogate_id else [])

    def staging_schema(self, spec: EntitySpec):
        empty = self.spark.createDataFrame([], ",".join(f"`{c}` string" for c in spec.landing_columns()))
        empty = empty.withColumn("_seq", F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"),
                                                  F.lit(0).cast("bigint").alias("row")))
        return stage(empty, spec, 0, "x").schema

    def landing(self, spec: EntitySpec) -> LandingTable:
        return LandingTable(self.spark, f"{self.root}/landing/{spec.name.lower()}")

    def jobs(self) -> JobLog:
        return JobLog(self.spark, f"{self.root}/jobs")

    def load_log(self) -> LoadLog:
        return LoadLog(self.spark, self.root)

    def reset(self, specs: list[EntitySpec]) -> None:
        """Empty every data table (staging, finals, logs) and keep configuration (K10).

        Each final gets an empty new version of its own schema; staging and
        log folders are cleared by deleting their directories.
        """
        for spec in specs:
            self.final(spec).truncate()
            _delete_dir(self.staging_path(spec))
            _delete_dir(self.dedup_path(spec))
            _delete_dir(self.quarantine_path(spec))
        _delete_dir(f"{self.root}/jobs")
        _delete_dir(f"{self.root}/load_log")

    def dedup_path(self, spec: EntitySpec) -> str:
        return f"{self.root}/staging/{spec.name.lower()}__latest"

    def deduped(self, spec: EntitySpec, job_id: int) -> DataFrame:
        """The job's batch after filters and latest-per-key, as written at load time."""
        path = f"{self.dedup_path(spec)}/job_id={job_id}"
        if not files.exists(path):                       # staged by an older run: recompute
            self.require_batch(spec, job_id)
            return dedup(self.staged(spec, job_id), spec)
        return self.spark.read.parquet(self.dedup_path(spec)).where(F.col("job_id") == job_id)

    def require_batch(self, spec: EntitySpec, job_id: int) -> None:
        """Raise when the staged rows of a job are gone; a job that staged no rows has none to miss."""
        if files.exists(f"{self.staging_path(spec)}/job_id={job_id}"):
            return
        staged = self.jobs().events().where((F.col("job_id") == job_id) & (F.col("status") == "STAGED")).select("rows_loaded").collect()
        if not any(r["rows_loaded"] == 0 for r in staged):
            raise FileNotFoundError(f"{spec.name}: the staged rows of job {job_id} are missing")

    def staged(self, spec: EntitySpec, job_id: int) -> DataFrame:
        # partition pruning on job_id reads only this job's files
        return self.spark.read.parquet(self.staging_path(spec)).where(F.col("job_id") == job_id)


def load_and_preview(wh: Warehouse, spec: EntitySpec, paths: str | Sequence[str], file_name: str | None = None,
                     multi_line: bool = True, job_id: int | None = None) -> tuple[int, dict]:
    """Stage one extract and compute its preview; the job ends STAGED (or ERROR).

    ``job_id``: repeat a load that did not end, under its own id (its staging is replaced).
    """
    jobs = wh.jobs()
    if job_id is None:
        job_id = jobs.next_job_id()
    jobs.append(job_id, "LOADING", load_type=spec.name, file_name=file_name)
    try:
        if wh.keep_landing:
            landing = wh.landing(spec).land(paths, spec.landing_columns(), file_name)
        else:
            landing = read_landing_csv(wh.spark, paths, required=spec.landing_columns(), multi_line=multi_line)
        staged = stage(landing, spec, job_id)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").parquet(wh.staging_path(spec))
        staged = wh.staged(spec, job_id)
        # the deduplicated batch is written once; preview and merge read it back
        dedup(staged, spec).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").parquet(wh.dedup_path(spec))
        deduped = wh.deduped(spec, job_id)
        # the preview counts and rows_loaded in one action (two one-row aggregates)
        counts_df = change_preview(deduped, wh.final(spec).matching(deduped.select(*spec.keys)), list(spec.keys), spec.compare_columns())
        both = counts_df.unionByName(rows_loaded(staged, spec), allowMissingColumns=True).collect()
        counts = {k: v for r in both for k, v in r.asDict().items() if v is not None}
        jobs.append(job_id, "STAGED", rows_loaded=counts["rows_loaded"], new_count=counts["new_count"],
                    changed_count=counts["changed_count"], unchanged_count=counts["unchanged_count"])
        wh.load_log().append(spec.name, file_name, "STAGE", "SUCCESS", rows_processed=counts["rows_loaded"])
        return job_id, counts
    except Exception as e:
        jobs.append(job_id, "ERROR", error_message=str(e))
        wh.load_log().append(spec.name, file_name, "STAGE", "ERROR", error_message=str(e))
        raise


def merge_job(wh: Warehouse, spec: EntitySpec, job_id: int, file_name: str | None = None) -> int:
    """Upsert a staged job into the final table; the job ends MERGED (or ERROR).

    Returns the merged row count (inserted + updated = deduplicated rows).  The
    commit carries the job's id: a merge that was committed, but whose driver
    died before it could say so, is only logged when it is repeated.
    """
    jobs = wh.jobs()
    try:
        target = wh.final(spec)
        before = json.loads(target.last_tag() or "{}")
        if before.get("job") == job_id:
            drop_staging(wh, spec, job_id)
            jobs.append(job_id, "MERGED", rows_merged=before["merged"])
            return before["merged"]
        deduped = wh.deduped(spec, job_id)
        quarantine = spec.null_keys == "quarantine"
        nk = null_key(spec) if quarantine else F.lit(False)
        c = deduped.agg(F.count_if(nk).alias("held"), F.count_if(~nk).alias("merged")).first()
        merged, n_held = int(c["merged"]), int(c["held"])
        if n_held:
            deduped.where(nk).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").parquet(wh.quarantine_path(spec))
            wh.load_log().append(spec.name, file_name, "QUARANTINE", "WARNING", rows_processed=n_held,
                                 error_message=f"{n_held} rows with a NULL key part held back")
        tag = json.dumps({"job": job_id, "merged": merged})
        if wh.merge_on_read:
            # only the files of the final that can hold a key of the batch are opened
            max_id = (target.max_of(spec.surrogate_id) or 0) if spec.surrogate_id else None
            target.publish_delta(delta_rows(deduped, target.matching(deduped.select(*spec.keys)), spec, max_id), tag=tag)
        else:
            target.publish(merged_final(wh.staged(spec, job_id), target.read(), spec), tag=tag)
        drop_staging(wh, spec, job_id)
        jobs.append(job_id, "MERGED", rows_merged=merged)
        wh.load_log().append(spec.name, file_name, "MERGE", "SUCCESS", rows_processed=merged, rows_inserted=merged)
        return merged
    except Exception as e:
        jobs.append(job_id, "ERROR", error_message=str(e))
        wh.load_log().append(spec.name, file_name, "MERGE", "ERROR", error_message=str(e))
        raise


def _delete_dir(path: str) -> None:
    from pyarrow import fs as pafs
    fs, p = files.resolve(path)
    if fs.get_file_info(p).type != pafs.FileType.NotFound:
        fs.delete_dir(p)


def drop_staging(wh: Warehouse, spec: EntitySpec, job_id: int) -> None:
    """Remove one job's staging partitions after its merge succeeded (K4)."""
    _delete_dir(f"{wh.staging_path(spec)}/job_id={job_id}")
    _delete_dir(f"{wh.dedup_path(spec)}/job_id={job_id}")


def run_daily(wh: Warehouse, specs: dict[str, EntitySpec], selected: DataFrame, file_path, multi_line: bool = True) -> list[tuple]:
    """Stage and merge the selected files in time order (driver loop over a few files).

    ``selected``: output of ``select_unprocessed_latest`` (at most one file
    per load type).  ``file_path(file_name)`` locates the staged CSV.  The
    first failure stops the run (later files wait for the next run), as the
    daily load does.  ``multi_line`` allows quoted line breaks.
    """
    done = []
    for r in selected.orderBy("file_timestamp", "file_name").collect():   # ≤ one row per load type
        spec = specs[r.load_type]
        job_id, counts = load_and_preview(wh, spec, file_path(r.file_name), r.file_name, multi_line=multi_line)
        merged = merge_job(wh, spec, job_id, r.file_name)
        done.append((r.file_name, r.load_type, job_id, counts, merged))
    return done
