"""Change preview of a staged batch against the final table.

new       = distinct staged keys with no equal key in final (NULL never matches)
matched   = distinct staged keys that exist in final
unchanged = deduplicated staged rows equal (NULL-safe) to the final row on the
            compare list
changed   = matched - unchanged

One job: the final table is first narrowed to the batch's keys (semi join,
broadcast when the batch is small), then the deduplicated batch (already
hash-partitioned on the keys by the window) is left-joined to it on the keys;
the three counts come from one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_preview(dedup_staged: DataFrame, final: DataFrame, keys: Sequence[str],
                   compare: Sequence[str]) -> DataFrame:
    """One-row DataFrame ``new_count, matched_count, changed_count, unchanged_count``.

    ``dedup_staged`` must hold one row per key (the output of
    :func:`tierlake.operators.dedup.latest_per_key` with the entity filters);
    ``final`` is unique on ``keys``.  ``compare`` always includes the keys.
    """
    cmp = list(dict.fromkeys([*keys, *compare]))
    others = [c for c in cmp if c not in keys]
    s = dedup_staged.select(*[F.col(c).alias(f"s__{c}") for c in cmp])
    # Only final rows whose key occurs in the batch matter.  The semi join
    # has the batch keys on its build side, so a small batch is broadcast and
    # the final table is filtered during its scan instead of being exchanged.
    touched = final.join(dedup_staged.select(*keys), list(keys), "left_semi")
    f = touched.select(*[F.col(c).alias(f"f__{c}") for c in cmp]).withColumn("f__hit", F.lit(True))
    cond = reduce(lambda a, b: a & b, [F.col(f"s__{k}") == F.col(f"f__{k}") for k in keys])
    j = s.join(f, cond, "left")
    hit = F.col("f__hit").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"s__{c}").eqNullSafe(F.col(f"f__{c}")) for c in others], F.lit(True))
    counts = j.agg(
        F.count_if(~hit).cast("bigint").alias("new_count"),
        F.count_if(hit).cast("bigint").alias("matched_count"),
        F.count_if(hit & same).cast("bigint").alias("unchanged_count"),
    )
    return counts.select(
        "new_count", "matched_count",
        (F.col("matched_count") - F.col("unchanged_count")).alias("changed_count"),
        "unchanged_count",
    )


def distinct_key_count(df: DataFrame, keys: Sequence[str],
                       not_null: Sequence[str] | None = None) -> DataFrame:
    """``rows_loaded``: distinct key tuples whose ``not_null`` parts are set.

    With one key this is ``count(distinct key)``; with several it is the
    subquery form, which also counts tuples whose other parts are NULL.
    """
    nn = list(not_null) if not_null is not None else list(keys[:1])
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in nn], F.lit(True))
    return df.where(cond).select(*keys).distinct().agg(F.count(F.lit(1)).cast("bigint").alias("rows_loaded"))
