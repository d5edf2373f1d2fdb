"""MERGE without a table format: upserts composed from joins and unions.

Open-source Spark rejects ``MERGE INTO`` on parquet tables, so each variant
is a DataFrame expression that yields the new version of the final table.
Publishing that version atomically is the job of
:mod:`tierlake.sources.store` (never overwrite the path being read).

Equality on keys is plain ``=``: a NULL key part never matches, so such
source rows are inserted and such final rows are kept, as in SQL MERGE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.operators.dedup import latest_per_key
from tierlake.session import work_path


class DuplicateKeyError(ValueError):
    """A MERGE source that would match one target row twice."""


def _key_eq(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a non-NULL key occurs twice in the source (strict MERGE)."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = source.where(nn).groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"source holds key {dup[0].asDict()} more than once")


def upsert(final: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """Full-row upsert (M1/M2/M5/M7): matched rows take the source values.

    Final rows whose key is in the source are replaced, the others stay,
    source rows without a match are inserted.  Final columns the source does
    not carry (e.g. a surrogate ``id``) are kept for matched rows and NULL for
    inserts when ``update_cols`` is given; otherwise the source must carry all
    final columns.

    Plan: ``final LEFT ANTI JOIN source-keys`` plus ``UNION ALL source``.
    Only key columns of the source take part in the join, so a small daily
    batch is broadcast by the optimizer's size check and the final table is
    scanned once without an exchange; a large batch falls back to a
    sort-merge join on the keys.
    """
    cols = final.columns
    missing = [c for c in cols if c not in source.columns]
    if missing and update_cols is None:
        raise ValueError(f"source lacks final columns {missing}; pass update_cols")
    if update_cols is not None and missing:
        return merge_columns(final, source, keys, update_cols=update_cols,
                             insert_cols=[c for c in cols if c in source.columns])
    kept = final.join(source.select(*keys), list(keys), "left_anti").select(*cols)
    return kept.unionByName(source.select(*cols))


def merge_columns(final: DataFrame, source: DataFrame, keys: Sequence[str],
                  update_cols: Sequence[str], insert_cols: Sequence[str] | None = None,
                  preserve_null: bool = False) -> DataFrame:
    """General MERGE: update only ``update_cols``; insert only ``insert_cols``.

    * M3 ``preserve_null``: ``t.c = nvl(s.c, t.c)`` - a NULL in the source
      never overwrites a value.
    * M4 partial: columns outside ``update_cols`` keep the final value;
      inserted rows carry ``insert_cols`` (default: keys + update_cols) and
      NULL elsewhere.

    One full outer join on the keys (each side exchanged once).
    """
    insert_cols = list(insert_cols) if insert_cols is not None else list(dict.fromkeys([*keys, *update_cols]))
    t = final.withColumn("__t", F.lit(True)).alias("t")
    s = source.select(*dict.fromkeys([*keys, *update_cols, *insert_cols])) \
        .withColumn("__s", F.lit(True)).alias("s")
    j = t.join(s, _key_eq(keys, "t", "s"), "full_outer")
    in_t, in_s = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    out = []
    for c in final.columns:
        tc = F.col(f"t.{c}")
        if c in keys:
            v = F.when(in_t, tc).otherwise(F.col(f"s.{c}"))
        else:
            sc = F.col(f"s.{c}") if c in update_cols or c in insert_cols else F.lit(None)
            if c in update_cols:
                matched = F.coalesce(sc, tc) if preserve_null else sc
            else:
                matched = tc
            ins = F.col(f"s.{c}") if c in insert_cols else F.lit(None)
            v = F.when(in_t & in_s, matched).when(in_t, tc).otherwise(ins)
        out.append(v.cast(final.schema[c].dataType).alias(c))
    return j.select(*out)


def upsert_preserve_null(final: DataFrame, source: DataFrame, keys: Sequence[str],
                         update_cols: Sequence[str] | None = None) -> DataFrame:
    """M3: matched rows keep the final value wherever the source is NULL."""
    upd = list(update_cols) if update_cols is not None else [c for c in source.columns if c not in keys]
    return merge_columns(final, source, keys, update_cols=upd,
                         insert_cols=[c for c in source.columns], preserve_null=True)


def upsert_newest(final: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[Column]) -> DataFrame:
    """Order-independent upsert: per key the row that sorts first wins.

    Used where batches may arrive out of order (file streams): applying the
    batches in any order, or twice, gives the same table.
    """
    both = final.unionByName(source.select(*final.columns))
    return latest_per_key(both, keys, order)


def dense_sequence(df: DataFrame, order: Sequence[str], start: Column | int = 0,
                   name: str = "id") -> DataFrame:
    """Consecutive ids ``start + 1, start + 2, …`` in ``order`` without one task.

    ``row_number() over (order by …)`` would pull every row into a single
    partition.  Instead: one range shuffle on ``order``, a sort inside each
    range, the row's position in its range from ``monotonically_increasing_id``
    (partition id in the high bits, position in the low 33 bits), plus the
    running total of the per-range counts.  Range bounds come from a sample, so
    the numbered ranges are written to the shared folder once; counts and rows
    both come from that copy.  The counts table has one row per range, so
    broadcasting it is bounded by the partition count, not the data.
    ``order`` should be a total order (unique); among ties the ids are still
    dense and unique but their assignment is arbitrary.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) \
        .withColumn("__mono", F.monotonically_increasing_id())
    ranged = ranged.withColumn("__pid", F.shiftright(F.col("__mono"), 33)) \
        .withColumn("__rn", F.col("__mono") - F.shiftleft(F.col("__pid"), 33) + 1)
    path = work_path(spark, "dense-sequence", unique=True)
    ranged = ranged.drop("__mono")
    ranged.write.mode("overwrite").parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.withColumn(
        "__off",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (ranged.join(F.broadcast(offs.select("__pid", "__off")), "__pid")
            .withColumn(name, (start_col + F.col("__off") + F.col("__rn")).cast("bigint"))
            .drop("__pid", "__rn", "__off"))


def upsert_surrogate(final: DataFrame, source: DataFrame, keys: Sequence[str],
                     id_col: str = "id", seq_col: str = "_seq", max_id: Column | None = None) -> DataFrame:
    """M6: final has its own identity; the business key is only unique.

    Matched rows keep their ``id`` and take the source values; new rows (and
    every NULL-key row, which never matches) get ``max(id) + n`` in
    ``(key, seq)`` order.
    """
    data_cols = [c for c in final.columns if c != id_col]
    src = source.select(*data_cols, *([seq_col] if seq_col in source.columns else []))
    t = final.alias("t")
    s = src.alias("s")
    matched = t.join(s, _key_eq(keys, "t", "s"), "inner") \
        .select(F.col(f"t.{id_col}"), *[F.col(f"s.{c}") for c in data_cols])
    kept = final.join(src.select(*keys), list(keys), "left_anti")
    new = src.join(final.select(*keys), list(keys), "left_anti")
    # max(id) is a scalar subquery: evaluated once, no join
    if max_id is None:
        max_id = final.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()
    order = [*keys, *([seq_col] if seq_col in src.columns else [])]
    numbered = dense_sequence(new, order, start=max_id, name=id_col) \
        .withColumn(id_col, F.col(id_col).cast(final.schema[id_col].dataType))
    cols = final.columns
    return kept.select(*cols).unionByName(matched.select(*cols)).unionByName(numbered.select(*cols))


def fold_pages(pages: DataFrame, keys: Sequence[str], page_col: str = "page_no",
               seq_col: str = "_seq", preserve_null_cols: Sequence[str] = ()) -> DataFrame:
    """M8: the result of merging pages one after another, in one job.

    Later pages win (within a page the later row).  Columns listed in
    ``preserve_null_cols`` fold per column instead: the value from the latest
    page where it is not NULL (``t.c = nvl(s.c, t.c)`` applied page by page).
    Grouped with partial aggregation, so a hot key is combined map-side.
    """
    order = F.struct(F.col(page_col), F.col(seq_col))
    others = [c for c in pages.columns if c not in keys]
    whole = [c for c in others if c not in preserve_null_cols]
    # one buffer for the row-replacing columns, one per preserve-NULL column
    aggs = [F.max_by(F.struct(*[F.col(c) for c in whole]), order).alias("__row")] if whole else []
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)
             for c in others if c in preserve_null_cols]
    out = pages.groupBy(*keys).agg(*aggs)
    return out.select(*[F.col(f"__row.{c}").alias(c) if c in whole else F.col(c) for c in pages.columns])


def current_state(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Fold state-change events: per key, the latest non-NULL value of each column.

    A later event that leaves a column NULL keeps the earlier value (status
    updates that do not repeat the counts).  Grouped with map-side partial
    aggregation, so a key with very many events is combined before the shuffle.
    """
    ordering = F.struct(*[F.col(c) for c in order])
    cols = [c for c in events.columns if c not in keys and c not in order]
    return events.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c) for c in cols],
        *[F.max(F.col(c)).alias(c) for c in order])
