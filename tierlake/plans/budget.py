"""Budget balances and the code combinations that their segments name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.casts import segment_string
from tierlake.plans.specs import BUDGET_SEGMENT_WIDTHS, BUDGET_SEGMENTS


def segment_key(columns: Sequence[str] = BUDGET_SEGMENTS, widths: Sequence[int] = BUDGET_SEGMENT_WIDTHS) -> Column:
    """The nine segments as one key: each padded with zeros and cut to its width, NULL and '' as an empty part."""
    return segment_string([F.col(c) for c in columns], widths)


def with_code_combination(budget: DataFrame, combinations: DataFrame, budget_segments: Sequence[str] = BUDGET_SEGMENTS,
                          combination_segments: Sequence[str] = BUDGET_SEGMENTS) -> DataFrame:
    """``budget`` with ``code_combination_id``, ``account_type`` and ``n_combinations`` of its nine segments.

    One equi-join on the padded key, so segments of either side may be unpadded, too long or NULL (NULL matches
    NULL, as in the stored segment string).  The combinations are reduced to one row per key first: if several
    have the same segments, the one with the smallest id is taken and their number told.  Without any the new
    columns are NULL and 0.
    """
    key = "__segments"
    one = combinations.withColumn(key, segment_key(combination_segments)).groupBy(key).agg(
        F.min(F.struct("code_combination_id", "account_type")).alias("c"), F.count(F.lit(1)).alias("n"))
    j = budget.withColumn(key, segment_key(budget_segments)).join(one, key, "left")
    return j.select(*budget.columns, "c.code_combination_id", "c.account_type", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_combinations"))
