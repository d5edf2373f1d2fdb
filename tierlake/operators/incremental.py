"""Incremental selection: watermarks, daily windows, retention, next files to load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.casts import file_timestamp, pacific_day_window, watermark_text
from tierlake.operators.dedup import latest_per_key

OVERLAP_DAYS = 2          # REST sync re-reads two days before the last sync
LOOKBACK_DAYS = 1         # daily file load also looks at yesterday
RETENTION_DAYS = 60       # object retention default
DEFAULT_DATE_FIELD = "LastUpdateDate"
# Statuses of a load job that mean "this file was already taken care of";
# an ERROR job does not block a retry.
HANDLED_STATUSES = ("MERGED", "LOADING", "STAGED", "LOADED")
# File names the daily load never picks up (lower-case LIKE patterns).
EXCLUDED_FILE_PATTERNS = ("%poheaderdffpublic%", "%suppliersiteextract%", "%invoiceheaderextract%")
# Load types of the daily run.
DAILY_LOAD_TYPES = (
    "AP_INVOICE_HDR", "PO_HDR", "PO_LINES", "SUPPLIER_HDR", "HCM_EMPLOYEE", "HCM_POSITION",
    "HCM_ASSIGNMENT", "HCM_SALARY", "POS_CUSTOM_FLEX", "GL_CODE_COMB", "GL_BALANCE",
    "QSTNR_ANSWER", "QSTNR_QUESTION", "QSTNR_RESPONSE", "AP_DISBURSEMENT", "AP_INV_APPLICATION",
)


def high_watermark(df: DataFrame, ts_col: str, overlap_days: int = OVERLAP_DAYS) -> DataFrame:
    """One row: ``max(ts) - overlap`` as timestamp and as REST filter text.

    NULL on an empty table, which means "load everything".
    """
    m = F.max(F.col(ts_col))
    return df.agg(
        (m - F.expr(f"INTERVAL {int(overlap_days)} DAYS")).alias("watermark"),
        watermark_text(m, overlap_days).alias("watermark_text"))


def incremental_filter(df: DataFrame, ts_col: str, watermark: Column | None) -> DataFrame:
    """Rows with ``ts > watermark``; everything when there is no watermark."""
    if watermark is None:
        return df
    return df.where((F.col(ts_col) > watermark) | watermark.isNull())


def since_watermark(source: DataFrame, target: DataFrame, ts_col: str,
                    overlap_days: int = OVERLAP_DAYS) -> DataFrame:
    """Rows of ``source`` newer than ``max(target.ts) - overlap`` (full load if target is empty).

    The watermark is one value: it is computed first (a single small
    aggregate) and applied as a literal, so the filter reaches the source
    scan (row-group skipping, partition pruning).  An empty target means no
    filter at all.
    """
    wm = high_watermark(target, ts_col, overlap_days).first()["watermark"]
    if wm is None:
        return source
    return source.where(F.col(ts_col) > F.lit(wm).cast(source.schema[ts_col].dataType))


def sync_mode(sync_type: str | None, date_field: str | None) -> tuple[str, str | None]:
    """Registry mode: FULL_ONLY loads everything, otherwise incremental on a date field.

    CODE_BASED sources take the incremental path too.
    """
    if (sync_type or "").upper() == "FULL_ONLY":
        return "FULL", None
    return "INCREMENTAL", date_field or DEFAULT_DATE_FIELD


def in_daily_window(ts: Column, now: Column, lookback_days: int = LOOKBACK_DAYS) -> Column:
    """``ts`` in ``[pacific_today_start - lookback, pacific_today_start + 24h)``."""
    start, end = pacific_day_window(now)
    return (ts >= start - F.expr(f"INTERVAL {int(lookback_days)} DAYS")) & (ts < end)


def retention_candidates(files: DataFrame, name_col: str, now: Column,
                         days: int = RETENTION_DAYS) -> DataFrame:
    """Objects whose name carries a timestamp older than ``now - days``.

    Names without the ``-YYYYMMDD_HHMMSS.zip`` stamp are never selected.
    The delete itself is a separate, explicit step.
    """
    ts = file_timestamp(F.col(name_col))
    return files.withColumn("file_timestamp", ts).where(
        F.col("file_timestamp").isNotNull()
        & (F.col("file_timestamp") < now.cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")))


def purge_candidates(objects: DataFrame, name_col: str) -> DataFrame:
    """Objects a selective purge removes (LIKE patterns, ``\\_`` is a literal underscore)."""
    n = F.col(name_col)
    cond = ((n.like("file\\_%") & n.like("%.zip")) | n.like("staging/%")
            | n.like("EXTRACT\\_STATUS\\_DATA\\_%") | n.like("MANIFEST%") | n.like("%\\_unzipped.csv"))
    return objects.where(cond)


def select_unprocessed_latest(files: DataFrame, jobs: DataFrame, now: Column,
                              load_types: Sequence[str] | None = DAILY_LOAD_TYPES,
                              excluded: Sequence[str] = EXCLUDED_FILE_PATTERNS) -> DataFrame:
    """The latest file per load type in today's window that no job has handled.

    ``files``: file_name, load_type, file_timestamp, loader_available.
    ``jobs``: file_name, load_type, status.
    Latest = ``file_timestamp desc nulls last, file_name desc``; the pick is
    made before the "already handled" check, as in the daily run, so a
    handled latest file means nothing is loaded for that type today.
    """
    cond = (F.col("loader_available") == "Y") & in_daily_window(F.col("file_timestamp"), now)
    if load_types is not None:
        cond &= F.col("load_type").isin(list(load_types))
    for p in excluded:
        cond &= ~F.lower(F.col("file_name")).like(p)
    latest = latest_per_key(files.where(cond), ["load_type"],
                            [F.col("file_timestamp").desc_nulls_last(), F.col("file_name").desc()])
    handled = jobs.where(F.col("status").isin(list(HANDLED_STATUSES))).select("file_name", "load_type")
    return latest.join(handled, ["file_name", "load_type"], "left_anti") \
        .select("file_name", "load_type", "file_timestamp")


def delete_objects(candidates: DataFrame, path_col: str = "path", execute: bool = False) -> DataFrame:
    """Delete the listed objects, one task per partition of the list (K11, K12).

    With ``execute=False`` (the default) nothing is touched and every row is
    reported as ``PLANNED``.  Deleting happens inside tasks, so a long list is
    never pulled to the driver; a missing object is reported, not an error.
    """
    import pandas as pd

    def run(batches):
        from tierlake.sources import files
        for pdf in batches:
            out = []
            for p in pdf[path_col]:
                if not execute:
                    out.append((p, "PLANNED"))
                    continue
                try:
                    fs, inner = files.resolve(p)
                    fs.delete_file(inner)
                    out.append((p, "DELETED"))
                except FileNotFoundError:
                    out.append((p, "MISSING"))
                except Exception as e:  # noqa: BLE001 - reported per object
                    out.append((p, f"ERROR: {e}"))
            yield pd.DataFrame(out, columns=[path_col, "result"])
    return candidates.select(path_col).mapInPandas(run, f"{path_col} string, result string")
