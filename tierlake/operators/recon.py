"""Record-count reconciliation of local tables against source-system counts.

Local counts are one-row aggregates per configured source, unioned into one
plan (each table is scanned once for all its counts).  Source
counts arrive as a small rowset (report rows or REST totals) and are joined
by entity key; a missing source count is an ERROR, never a silent variance.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.casts import pct_delta
from tierlake.sources import files

STATUSES = ("OK", "VARIANCE", "ERROR")


@dataclass(frozen=True)
class ReconSource:
    entity_name: str
    local_table: str
    source_type: str = "EXTRACT"
    count_method: str = "BIP_COUNT"        # or REST_TOTAL
    entity_key: str | None = None          # key in the source rowset
    count_expr: str | None = None          # e.g. "count(DISTINCT location_id)"
    is_active: bool = True
    report: str = "COUNTS"                  # the source system's report that holds the count


def local_counts(sources: list[ReconSource], tables: Mapping[str, DataFrame]) -> DataFrame:
    """``entity_name, local_count`` for every active source.

    ``count_expr`` may only aggregate columns of the configured table; the
    table name itself must be one of ``tables`` (names from configuration
    only, never free text).
    A source whose table is not available yields a NULL count (reported as
    ERROR), so one broken source never hides the results of the others.
    """
    per_table: dict[str, list[tuple[str, Column]]] = {}
    failed: list[str] = []
    for s in sources:
        if not s.is_active:
            continue
        count = (F.expr(s.count_expr) if s.count_expr else F.count(F.lit(1))).cast("bigint")
        try:
            if s.local_table not in tables:
                raise KeyError(s.local_table)
            tables[s.local_table].agg(count)             # analysis only: a bad expression fails here, alone
            per_table.setdefault(s.local_table, []).append((s.entity_name, count))
        except (AnalysisException, KeyError):
            failed.append(s.entity_name)
    parts = []
    for name, counts in per_table.items():               # one scan per table
        one = tables[name].agg(*[c.alias(f"c{i}") for i, (_, c) in enumerate(counts)])
        parts.append(one.select(F.inline(F.array(*[F.struct(F.lit(e).alias("entity_name"), F.col(f"c{i}").alias("local_count"))
                                                   for i, (e, _) in enumerate(counts)]))))
    if failed:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.range(1).select(F.explode(F.array(*map(F.lit, failed))).alias("entity_name"),
                                           F.lit(None).cast("bigint").alias("local_count")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def reconcile(sources: list[ReconSource], local: DataFrame, source_counts: DataFrame) -> DataFrame:
    """Per-entity result rows.

    ``source_counts``: ``entity_key, source_count``.  delta = source - local;
    pct = round(|delta| / source * 100, 2), 0 when source is not > 0.
    """
    from tierlake.session import local_rows
    cfg = local_rows(local.sparkSession,
                     [(s.entity_name, s.source_type, s.local_table, s.entity_key or s.entity_name)
                      for s in sources if s.is_active],
                     "entity_name string, source_type string, local_table_name string, entity_key string")
    # an entity that the source reports twice has no single count: ERROR, like a missing one
    once = source_counts.groupBy("entity_key").agg(F.max("source_count").alias("source_count"), F.count(F.lit(1)).alias("__n")) \
        .withColumn("source_count", F.when(F.col("__n") == 1, F.col("source_count")))
    j = cfg.join(local, "entity_name", "left").join(once, "entity_key", "left")
    delta = F.col("source_count") - F.col("local_count")
    missing = F.col("source_count").isNull() | F.col("local_count").isNull()
    return j.select(
        "entity_name", "source_type", "local_table_name",
        F.col("local_count").cast("bigint").alias("local_count"),
        F.col("source_count").cast("bigint").alias("source_count"),
        F.when(~missing, delta).cast("bigint").alias("delta"),
        F.when(~missing, pct_delta(delta, F.col("source_count"))).cast("double").alias("pct_delta"),
        F.when(missing, "ERROR").when(delta == 0, "OK").otherwise("VARIANCE").alias("status"),
        F.when(F.col("local_count").isNull(),
               F.concat(F.lit("Table "), F.col("local_table_name"), F.lit(" not found in recon configuration")))
        .when(F.col("__n") > 1, F.concat(F.lit("Entity "), F.col("entity_key"), F.lit(" found more than once in source counts")))
        .when(F.col("source_count").isNull(),
              F.concat(F.lit("Entity "), F.col("entity_key"), F.lit(" not found in source counts")))
        .alias("error_message"),
    )


def run_header(results: DataFrame) -> DataFrame:
    """Totals of one run: total / ok / variance / error sources."""
    return results.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_sources"),
        F.count_if(F.col("status") == "OK").cast("bigint").alias("sources_ok"),
        F.count_if(F.col("status") == "VARIANCE").cast("bigint").alias("sources_variance"),
        F.count_if(F.col("status") == "ERROR").cast("bigint").alias("sources_error"))


RUN_SCHEMA = ("run_id string, as_of string, total_sources bigint, sources_ok bigint, sources_variance bigint, sources_error bigint, "
              "started_ts timestamp_ntz, completed_ts timestamp_ntz")


class ReconRuns:
    """Stored reconciliation runs below ``root``: a header per run, a result per source, the reports' counts.

    A report is read once for an ``as_of`` and kept: the other sources of a run, and later runs of that day, look
    their counts up in the stored copy.  A report that fails makes errors of its sources alone.  Repeating a run
    replaces its results.
    """

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def source_counts(self, report: str, as_of: str, fetch: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/counts/{as_of}/{report}"
        if "_SUCCESS" not in files.names(self.spark, path):
            fetch().select("entity_key", F.col("source_count").cast("bigint").alias("source_count")).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def run(self, run_id: str, sources: list[ReconSource], tables: Mapping[str, DataFrame],
            fetch: Mapping[str, Callable[[], DataFrame]], as_of: str) -> DataFrame:
        """Reconcile all active sources; returns the stored results of the run."""
        started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        active = [s for s in sources if s.is_active]
        local = local_counts(active, tables)
        parts = []
        for report in dict.fromkeys(s.report for s in active):
            own = [s for s in active if s.report == report]
            try:
                parts.append(reconcile(own, local, self.source_counts(report, as_of, fetch[report])))
            except Exception as e:  # noqa: BLE001 - one report must not end the run
                text = f"report {report}: {type(e).__name__} {e}".split("\n")[0][:1000]
                none = self.spark.createDataFrame([], "entity_key string, source_count bigint")
                parts.append(reconcile(own, local, none).withColumn("error_message", F.lit(text)))
        results = reduce(lambda a, b: a.unionByName(b), parts).withColumn("run_id", F.lit(run_id))
        results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{self.root}/results")
        done = self.results().where(F.col("run_id") == run_id)
        head = run_header(done).select(F.lit(run_id).alias("run_id"), F.lit(as_of).alias("as_of"), "*", F.lit(started).cast("timestamp_ntz").alias("started_ts"),
                                       F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz").alias("completed_ts"))
        head.coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
        return done

    def results(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/results")

    def runs(self) -> DataFrame:
        """The header of each run; a repeated run counts once, as it ended last."""
        from tierlake.operators.dedup import latest_per_key
        return latest_per_key(self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/runs"), ["run_id"], [F.col("completed_ts").desc()])
