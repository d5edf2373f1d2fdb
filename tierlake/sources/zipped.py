"""ZIP extracts: pick the CSV entry of every archive and stage it as text.

The archive list is a DataFrame (``binaryFile`` listing with the content
column pruned), so extraction is one task per archive across the cluster;
each task streams its entry to the shared staging folder, and the staged
CSV files are then read in parallel by the CSV source.
"""

from __future__ import annotations

import hashlib
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.session import ship_package
from tierlake.sources import files

STAGED_SCHEMA = "zip_path string, entry_name string, staged_path string, bytes bigint"


def list_zips(spark: SparkSession, root: str) -> DataFrame:
    """``path, file_name, length, modificationTime`` of every ``.zip`` (any case)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
          .select("path", "length", "modificationTime"))
    return df.where(F.lower("path").like("%.zip")) \
        .withColumn("file_name", F.regexp_extract("path", r"[^/]+$", 0))


def pick_entry(names: list[str]) -> str | None:
    """First entry ending in .csv (any case), else the first entry."""
    for n in names:
        if n.lower().endswith(".csv"):
            return n
    return names[0] if names else None


def _extract(staging_dir: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for zp in pdf["path"]:
                with files.open_input(zp) as fh, zipfile.ZipFile(fh) as z:
                    entry = pick_entry(z.namelist())
                    if entry is None:
                        out.append((zp, None, None, 0))
                        continue
                    base = zp.rsplit("/", 1)[-1]
                    # archives of one name in two folders: the whole path tells them apart
                    target = f"{staging_dir}/{base}_{hashlib.sha1(zp.encode()).hexdigest()[:16]}_unzipped.csv"
                    part = f"{staging_dir}/_attempts/{uuid.uuid4().hex}"
                    n = 0
                    with z.open(entry) as src, files.open_output(part) as dst:
                        while True:
                            chunk = src.read(1 << 20)
                            if not chunk:
                                break
                            dst.write(chunk)
                            n += len(chunk)
                    fs, done = files.resolve(target)
                    fs.move(files.resolve(part)[1], done)
                    out.append((zp, entry, target, n))
            yield pd.DataFrame(out, columns=["zip_path", "entry_name", "staged_path", "bytes"])
    return run


def stage_zip_csv(zips: DataFrame, staging_dir: str) -> DataFrame:
    """Extract the chosen entry of each archive to ``staging_dir``.

    Returns one row per archive.  Every attempt writes a file of its own below
    ``_attempts`` (hidden from the CSV reader) and moves it to the target, so
    retries and two attempts at once are harmless.
    """
    ship_package(zips.sparkSession)
    return zips.select("path").mapInPandas(_extract(staging_dir.rstrip("/")), STAGED_SCHEMA)


def _writer(out_dir: str, header: list[str], prefix: str, suffix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        path = f"{out_dir}/{prefix}-{pid:05d}{suffix}.zip"
        rows = 0
        with files.open_output(path) as fh, zipfile.ZipFile(fh, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("MANIFEST.MF", "extract\n")
            with z.open(f"{prefix}-{pid:05d}.csv", "w", force_zip64=True) as w:
                w.write((",".join(header) + "\n").encode("utf-8"))
                for pdf in batches:          # streamed batch by batch
                    w.write(pdf.to_csv(index=False, header=False).encode("utf-8"))
                    rows += len(pdf)
        yield pd.DataFrame({"zip_path": [path], "rows": [rows]})
    return run


def write_zip_csv(df: DataFrame, out_dir: str, prefix: str = "file_extract", suffix: str = "") -> DataFrame:
    """Write each partition as one ZIP holding a CSV (all columns as text).

    ``suffix`` ends the archive's name (the ``-YYYYMMDD_HHMMSS`` stamp of an extract).
    Lazy: returns ``zip_path, rows`` per archive; run an action to write.
    """
    ship_package(df.sparkSession)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return text.mapInPandas(_writer(out_dir.rstrip("/"), text.columns, prefix, suffix), "zip_path string, rows bigint")
