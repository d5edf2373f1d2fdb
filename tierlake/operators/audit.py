"""Data-quality audits: key uniqueness, orphans across documented foreign keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_audit(df: DataFrame, keys: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """Groups that share ``keys`` but differ in ``extra`` (open key questions).

    Returns ``keys, n_rows, n_variants`` for groups with more than one
    distinct ``extra`` tuple.  Distinct tuples are counted by a two-level
    aggregate (keys+extra, then keys): both levels combine map-side, so a hot
    key group never lands whole in one task before it is reduced.
    """
    per_variant = df.groupBy(*keys, *extra).agg(F.count(F.lit(1)).alias("__n"))
    per_key = per_variant.groupBy(*keys).agg(
        F.sum("__n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_variants"))
    return per_key.where(F.col("n_variants") > 1)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (non-NULL) held by more than one row: ``keys, n_rows``."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(nn).groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")) \
        .where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str]) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in child_keys])
    p = parent.select(*[F.col(pk).alias(ck) for ck, pk in zip(child_keys, parent_keys)])
    return child.where(nn).join(p, list(child_keys), "left_anti")


def orphan_audit(pairs: Sequence[tuple[str, DataFrame, DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """One row per relation: ``relation, child_rows, orphan_rows``.

    ``pairs``: (name, child, parent, child_keys, parent_keys).  Every table is
    scanned once, whatever its roles: each row says, for each relation it takes
    part in, its key and whether it refers to it or is it.  One aggregate per
    (relation, key), combined map-side, tells the references without a parent;
    there is no join.  Keys are compared as the parent's type; a NULL part
    refers to nothing.
    """
    tables: dict[int, tuple[DataFrame, list[Column]]] = {}
    for k, (_, child, parent, ck, pk) in enumerate(pairs):
        kinds = [parent.schema[p].dataType for p in pk]
        for df, keys, refers in ((child, ck, 1), (parent, pk, 0)):
            parts = [F.col(c).cast(t).cast("string") for c, t in zip(keys, kinds)]
            nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
            role = F.struct(F.lit(k).alias("relation"), F.when(nn, F.array(*parts)).alias("key"),
                            F.lit(refers).cast("bigint").alias("refers"), F.lit(1 - refers).alias("parent"))
            tables.setdefault(df.semanticHash(), (df, []))[1].append(role)
    rows = reduce(lambda a, b: a.unionByName(b), [df.select(F.inline(F.array(*roles))) for df, roles in tables.values()])
    per_key = rows.groupBy("relation", "key").agg(F.sum("refers").alias("n"), F.max("parent").alias("parent"))
    per = per_key.groupBy("relation").agg(
        F.sum("n").cast("bigint").alias("child_rows"),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull() & (F.col("parent") == 0), F.col("n"))), F.lit(0)).cast("bigint").alias("orphan_rows"))
    names = F.array(*[F.struct(F.lit(k).alias("relation"), F.lit(p[0]).alias("name")) for k, p in enumerate(pairs)])
    listed = rows.sparkSession.range(1).select(F.inline(names))
    return listed.join(per, "relation", "left").select(
        F.col("name").alias("relation"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("child_rows", "orphan_rows")])


def orphan_sample(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                  parent_keys: Sequence[str], n: int = 20) -> DataFrame:
    """Up to ``n`` distinct orphan references (the sample shown next to the counts).

    The sample size is the feature here; the counts come from
    :func:`orphan_audit`, which always covers every row.
    """
    refs = orphans(child.select(*child_keys), parent, child_keys, parent_keys).distinct()
    return refs.orderBy(*child_keys).limit(n)
