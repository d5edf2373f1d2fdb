"""Latest/first row per key (``row_number() over (...) = 1``).

Expressed as a window with ``row_number() == 1``: Catalyst infers a
WindowGroupLimit and runs a *partial* top-1 per key before the shuffle, so a
key that holds a large share of all rows is reduced to one row per map
partition before it is exchanged.  The output is hash-partitioned on the
keys, which a following join or upsert on the same keys reuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc_nulls_last(*cols) -> list[Column]:
    return [_col(c).desc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   where: Column | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (a total order).

    ``order`` items are sort expressions (``F.col('ts').desc_nulls_last()``)
    or column names (ascending).  NULL keys form one group, as in a SQL
    window.  ``where`` filters rows before ranking.
    """
    if where is not None:
        df = df.where(where)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*[_col(o) for o in order])
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def first_arrival(df: DataFrame, keys: Sequence[str], seq: str = "_seq") -> DataFrame:
    """First row per key in arrival order (``order by rowid``)."""
    return latest_per_key(df, keys, [F.col(seq).asc()])


def with_arrival_seq(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Attach the physical arrival order of a file-source DataFrame.

    ``_seq`` = (file path, split start, row id) compares like the source
    database's row address on a freshly loaded table: rows of one split are read in order
    by one task, and splits of a file are ordered by their offset.  Call it
    directly on the reader's DataFrame (``_metadata`` is only there) and
    persist the column with the staged rows.
    """
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))
