"""Landing tier: extract CSV files read as all-string rows.

Columns are bound by header *name* (Spark reads the header of the files);
a required column that is missing fails the load instead of shifting every
value by one position.  ``''`` becomes NULL, as in the source database.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.functions.casts import empty_to_null
from tierlake.operators.dedup import with_arrival_seq
from tierlake.sources.split_csv import OPTIONS, read_split_csv


class MissingColumnsError(ValueError):
    pass


class LandingTable:
    """The landing copy of an extract (all strings, ``_seq``): each landing replaces the one before atomically.

    Readers see the old file's rows until the new ones are complete.  The header is checked by name and its
    changes against the last landing are kept: columns that are new, gone, or at another place.
    """

    def __init__(self, spark: SparkSession, root: str):
        from tierlake.sources.store import SnapshotTable
        self.spark, self.table = spark, SnapshotTable(spark, root)

    def land(self, paths: str | Sequence[str], required: Sequence[str] | None = None, file_name: str | None = None) -> DataFrame:
        df = read_landing_csv(self.spark, paths)
        header = [c for c in df.columns if c != "_seq"]
        missing = [c for c in required or () if c.upper() not in {h.upper() for h in header}]
        if missing:
            raise MissingColumnsError(f"extract lacks columns {missing}")
        before = json.loads(self.table.last_tag() or "{}").get("header")
        if before:
            self.table.read()       # a commit builds on what was read
        self.table.publish(df, tag=json.dumps({"file": file_name, "header": header, "changes": header_changes(before, header)}))
        return self.read(required)

    def read(self, required: Sequence[str] | None = None) -> DataFrame:
        df = self.table.read()
        if required is None:
            return df
        have = {c.upper(): c for c in df.columns}
        return df.select(*[F.col(have[c.upper()]).alias(c) for c in required], "_seq")

    def last(self) -> dict:
        """File, header and header changes of the last landing."""
        return json.loads(self.table.last_tag() or "{}")


def header_changes(before: list[str] | None, now: list[str]) -> dict[str, list[str]]:
    """Columns that are new, gone, or stand elsewhere among those that stayed."""
    if before is None:
        return {"new": [], "gone": [], "moved": []}
    stayed = [c for c in now if c in before]
    old = [c for c in before if c in now]
    return {"new": [c for c in now if c not in before], "gone": [c for c in before if c not in now],
            "moved": [c for c, o in zip(stayed, old) if c != o]}


def all_string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_landing_csv(spark: SparkSession, paths: str | Sequence[str],
                     required: Sequence[str] | None = None, multi_line: bool = True,
                     arrival_seq: bool = True) -> DataFrame:
    """All-string rows of extract CSV files (one header line each).

    ``multi_line`` allows quoted values with line breaks; the files are still
    read by many tasks (:mod:`tierlake.sources.split_csv`).  ``required`` lists
    the header names the entity needs; only those are parsed (CSV column
    pruning) and a missing one raises.
    """
    if multi_line:
        df = read_split_csv(spark, paths, required)
    else:
        df = with_arrival_seq(spark.read.options(**OPTIONS).csv(paths if isinstance(paths, str) else list(paths)))
    if required is not None:
        have = {c.upper(): c for c in df.columns}
        missing = [c for c in required if c.upper() not in have]
        if missing:
            raise MissingColumnsError(f"extract lacks columns {missing}")
        df = df.select(*[F.col(have[c.upper()]).alias(c) for c in required], "_seq")
    if not arrival_seq:
        df = df.drop("_seq")
    return df.select(*[empty_to_null(c).alias(c) if c != "_seq" else F.col(c) for c in df.columns])
