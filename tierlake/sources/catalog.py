"""File catalog: object listing -> (file_name, load_type, file_timestamp).

The listing is a ``binaryFile`` scan with the content column pruned, so
only paths, sizes and times are read; routing looks patterns up
(:mod:`tierlake.operators.routing`); the refresh is an upsert by file name
that overwrites the load type but keeps a file timestamp once set.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.casts import file_timestamp
from tierlake.operators.routing import route_by_pattern
from tierlake.sources.zipped import list_zips

CATALOG_SCHEMA = ("file_name string, load_type string, loader_available string, "
                  "file_timestamp timestamp_ntz, refreshed_ts timestamp_ntz")


def catalog_view(listing: DataFrame, loader_map: DataFrame) -> DataFrame:
    """``file_name, load_type, loader_available, file_timestamp`` of listed ZIPs.

    ``loader_available`` is that of the matched loader-map entry ('N' without one).
    """
    zips = listing.where(F.lower("path").like("%.zip")) \
        .select(F.regexp_extract("path", r"[^/]+$", 0).alias("file_name"))
    routed = route_by_pattern(zips, "file_name", loader_map, carry=["loader_available"])
    return routed.select("file_name", "load_type", F.coalesce("loader_available", F.lit("N")).alias("loader_available"),
                         file_timestamp("file_name").alias("file_timestamp"))


def list_catalog(spark: SparkSession, root: str, loader_map: DataFrame) -> DataFrame:
    return catalog_view(list_zips(spark, root), loader_map)


def refresh(catalog: DataFrame, view: DataFrame, now: Column | None = None) -> DataFrame:
    """Upsert the listing into the catalog by file name.

    Matched: load_type and availability overwritten, ``file_timestamp`` kept
    if already set, ``refreshed_ts`` = now.  Files that disappeared stay.
    """
    now = now if now is not None else F.lit(_dt.datetime.utcnow()).cast("timestamp_ntz")
    t, s = catalog.alias("t"), view.alias("s")
    j = t.join(s, F.col("t.file_name") == F.col("s.file_name"), "full_outer")
    in_s = F.col("s.file_name").isNotNull()
    return j.select(
        F.coalesce("t.file_name", "s.file_name").alias("file_name"),
        F.when(in_s, F.col("s.load_type")).otherwise(F.col("t.load_type")).alias("load_type"),
        F.when(in_s, F.col("s.loader_available")).otherwise(F.col("t.loader_available")).alias("loader_available"),
        F.coalesce("t.file_timestamp", "s.file_timestamp").alias("file_timestamp"),
        F.when(in_s, now).otherwise(F.col("t.refreshed_ts")).alias("refreshed_ts"))
