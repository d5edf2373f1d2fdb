"""CSV with quoted line breaks, read by as many tasks as the file has splits.

Spark's ``multiLine`` gives a file to one task, because only a reader that has
seen all quotes before a line break knows whether it ends a record.  Here the
files are read as plain lines, which split anywhere, and the quotes are counted:

1. Each split sums the quotes of its lines.  An odd sum before a split, over the
   splits of its file in order, says that the split begins inside a quoted value.
   Without any line of an odd count no record has a line break and Spark's own
   reader takes over.
2. A running parity inside each split tells the lines that begin records.  Most
   records are one line and go straight to the parser.  The lines of a longer
   record meet in one group; the at most two pieces a split shares with its
   neighbours are put together in file order.
3. ``from_csv`` parses each record.

Only the quote counts leave the JVM, and only the sums per split reach the
driver.  Values follow RFC 4180: a quote inside a value is doubled and the value
quoted.  A file whose quotes do not pair up is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.session import ship_package

OPTIONS = {"header": "true", "inferSchema": "false", "escape": '"', "mode": "FAILFAST"}

BAD = "__malformed"


class UnpairedQuotes(ValueError):
    """A file ends inside a quoted value."""


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), quotes.alias("quotes"))


def _open_splits(splits: list) -> set[tuple[int, int]]:
    """The splits that begin inside a quoted value, from the quote sums of all splits in file order."""
    out, file, parity = set(), None, 0
    for s in [*sorted(splits, key=lambda s: (s["file"], s["block"])), None]:
        if s is None or s["file"] != file:
            if parity:
                raise UnpairedQuotes(f"the quotes of {file} do not pair up")
            file, parity = s and s["file"], 0
        if s is not None:
            if parity:
                out.add((s["file_id"], s["block"]))
            parity ^= s["quotes"] & 1
    return out


def _placed(opened: set[tuple[int, int]]):
    """For each line: is its start inside a quoted value, and how many records of its split began up to it."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        here, parity, begun = None, 0, 0
        for file, block, quotes in batches:
            file, block, quotes = file.to_numpy(), block.to_numpy(), quotes.to_numpy().astype(np.int64)
            inside, record = np.zeros(len(quotes), bool), np.zeros(len(quotes), np.int64)
            new = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            for lo, hi in zip([0, *new], [*new, len(quotes)]):
                if lo == hi:
                    continue
                if here != (file[lo], block[lo]):
                    here, begun = (file[lo], block[lo]), 0
                    parity = int((int(file[lo]), int(block[lo])) in opened)
                after = (parity + np.cumsum(quotes[lo:hi])) & 1
                inside[lo:hi] = np.concatenate(([parity], after[:-1])) == 1
                record[lo:hi] = begun + np.cumsum(~inside[lo:hi])
                parity, begun = int(after[-1]), int(record[hi - 1])
            yield pd.DataFrame({"inside": inside, "record": record})

    # the result depends on the lines before, so no filter may move below it
    return F.pandas_udf(run, "inside boolean, record bigint").asNondeterministic()


def _joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["value"]), "\n")


def _records(lines: DataFrame, opened: set[tuple[int, int]]) -> DataFrame:
    """``file, block, row, value, head``: one row per record, ``head`` for the first of a file."""
    placed = lines.withColumn("at", _placed(opened)(F.xxhash64("file"), F.col("block"), F.col("quotes")))
    placed = placed.select("file", "block", "row", "value", "quotes", "at.inside", "at.record")
    odd = F.col("quotes") % 2 == 1
    names = ["file", "block", "row", "value", "record"]
    single = placed.where(~F.col("inside") & ~odd).select(*names)
    pieces = placed.where(F.col("inside") | odd).groupBy("file", "block", "record").agg(
        F.sort_array(F.collect_list(F.struct("row", "value"))).alias("p"), (F.sum("quotes") % 2).alias("open")) \
        .select("file", "block", "record", "open", F.get("p", F.lit(0))["row"].alias("row"), _joined(F.col("p")).alias("value"))
    border = (F.col("record") == 0) | (F.col("open") == 1)
    # at most two pieces of each split: the end of a record begun before, and a record that goes on
    order = Window.partitionBy("file").orderBy("block", "record")
    chained = pieces.where(border).withColumn("chain", F.count_if(F.col("record") > 0).over(order)) \
        .groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "record", "row", "value"))).alias("p"))
    first = F.get("p", F.lit(0))
    chained = chained.select("file", first["block"].alias("block"), first["row"].alias("row"), _joined(F.col("p")).alias("value"), first["record"].alias("record"))
    found = single.unionByName(pieces.where(~border).select(*names)).unionByName(chained.select(*names))
    return found.select("file", "block", "row", F.regexp_replace("value", "\r$", "").alias("value"),
                        ((F.col("block") == 0) & (F.col("record") == 1)).alias("head"))


def read_split_csv(spark: SparkSession, paths: str | Sequence[str], required: Sequence[str] | None = None) -> DataFrame:
    """All-string rows of CSV files with a header line, plus ``_seq`` (file, split start, row: the arrival order).

    ``required`` (header names, any case) picks the columns that are parsed.  All files must have the same header.
    Empty lines between records are skipped; empty values are NULL.
    """
    ship_package(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = spark.read.options(**OPTIONS).option("multiLine", "true").csv(paths).columns
    schema = StructType([StructField(c, StringType()) for c in names])
    lines = _lines(spark, paths)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.count_if(F.col("quotes") % 2 == 1).alias("odd")) \
        .withColumn("file_id", F.xxhash64("file")).collect()      # one row per split
    opened = _open_splits(splits)
    if not any(s["odd"] for s in splits):
        from tierlake.operators.dedup import with_arrival_seq
        return with_arrival_seq(spark.read.options(**OPTIONS).csv(paths, schema=schema) if names else lines.limit(0))
    records = _records(lines, opened)
    # malformed records are told by a column: a parser that fails might be asked about pieces of records
    values = F.from_csv("value", _ddl([*names, BAD]), {"escape": OPTIONS["escape"], "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "multiLine": "true"})
    parsed = records.where(F.trim("value") != "").withColumn("r", values)
    same = F.lower(F.to_json(F.struct(*[F.col("r")[c].alias(f"c{k}") for k, c in enumerate(names)]))) == F.lower(
        F.to_json(F.struct(*[F.lit(c).alias(f"c{k}") for k, c in enumerate(names)])))
    fault = F.when(F.col("r")[BAD].isNotNull(), F.concat(F.lit("malformed record in "), "file", F.lit(": "), F.substring("value", 1, 200))) \
        .when(F.col("head") & ~same, F.concat(F.lit("another header in "), "file"))
    kept = F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(~F.col("head"))
    seq = F.struct("file", "block", "row").alias("_seq")
    wanted = names if required is None else [c for c in names if c.upper() in {r.upper() for r in required}]
    return parsed.where(kept).select(*[F.col("r")[c].alias(c) for c in wanted], seq)


def _ddl(names: Sequence[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "` string" for c in names)
