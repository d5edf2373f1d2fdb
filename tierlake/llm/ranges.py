"""Exact, repeatable id ranges of about equal size, from block sums instead of samples."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = 2048
MOST_BLOCKS = 1 << 20


def index_of(lows: list[int]):
    """A column function: position of the last entry of the sorted ``lows`` that is at most the value (0 below all)."""
    bounds = np.array(lows or [0], np.int64)

    @F.pandas_udf("int")
    def position(values: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(bounds, values.to_numpy(np.int64), side="right") - 1, 0).astype(np.int32))

    return position


def _block_of(lows: np.ndarray, highs: np.ndarray, steps: np.ndarray):
    """A column function: the start of the block that holds the value, NULL outside all cells."""
    @F.pandas_udf("long")
    def block(values: pd.Series) -> pd.Series:
        v = values.to_numpy(np.int64)
        k = np.maximum(np.searchsorted(lows, v, side="right") - 1, 0)
        inside = (v >= lows[k]) & (v < highs[k])
        return pd.Series(lows[k] + (v - lows[k]) // steps[k] * steps[k]).where(inside).astype("Int64")

    return block


def balanced(rows: DataFrame, target: int) -> list[tuple[int, int]]:
    """Ranges [lo, hi) in ascending order with sums of about ``target``; ``rows(id long not null, size long)``.

    The span of the ids is cut into equal blocks, at least ``BLOCKS`` and four
    per expected range, and blocks above the target are cut again until they
    fit or hold one id.  Only block sums reach the driver; the result depends on
    the rows alone.  No rows: no ranges.
    """
    span = rows.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("size").alias("n")).first()
    if span["lo"] is None:
        return []
    todo = [(span["lo"], span["hi"] + 1)]
    most = min(MOST_BLOCKS, max(BLOCKS, 4 * (span["n"] // max(1, target) + 1)))
    cells: list[tuple[int, int, int]] = []
    while todo:
        todo.sort()
        parts = max(2, most // len(todo))
        lows, highs = [c[0] for c in todo], [c[1] for c in todo]
        steps = [max(1, -(-(hi - lo) // parts)) for lo, hi in todo]
        block = _block_of(np.array(lows, np.int64), np.array(highs, np.int64), np.array(steps, np.int64))
        sums = rows.select(block("id").alias("lo"), "size").where("lo is not null").groupBy("lo").agg(F.sum("size").alias("n")).collect()
        found = []
        for r in sums:
            k = bisect_right(lows, r["lo"]) - 1
            cell = (r["lo"], min(highs[k], r["lo"] + steps[k]))
            if r["n"] > target and cell[1] - cell[0] > 1:
                found.append(cell)
            else:
                cells.append((*cell, r["n"]))
        todo = found
    out: list[list[int]] = []
    held = 0
    for lo, hi, n in sorted(cells):
        if not out or held + n > target:
            out.append([lo, hi])
            held = 0
        out[-1][1] = hi
        held += n
    return [(lo, hi) for lo, hi in out]
