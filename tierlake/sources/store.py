"""Versioned snapshot tables: atomic commits and data skipping without a table format.

A table is a folder of immutable data folders ``v=000001/…`` and a commit log
``_log/000001.json``, one small file per version that names the data of that
version.  A commit is the creation of the next log file, which succeeds for one
writer only; a writer that read an older version gets :class:`WriteConflict`
instead of undoing the other's merge.

* ``publish(df)`` writes a complete new base.
* ``publish_delta(rows)`` writes only the rows a merge changed or inserted
  (their complete new values), so the write follows the batch, not the table.
* ``read()`` = base rows whose key has no delta row (anti join on the delta
  keys) plus the latest delta row per key.
* ``matching(keys)`` = the part of ``read()`` that can hold one of some keys.
  The base of a keyed table is sorted by key into files whose key ranges do not
  overlap; a manifest keeps each file's range, and only files whose range holds
  a key are opened.  Preview and merge read their final table this way.
* ``compact()`` folds the deltas into the base.  It rewrites the touched files
  only; all others are carried over by the new manifest.  It runs by itself once
  ``max_deltas`` deltas exist; the table's rows stay the same.
* ``vacuum()`` deletes data that no kept version names.

Looking up a key is a binary search over the manifest's sorted ranges, an
expression of the batch's rows.  The manifest has one entry per base file; it
is the only thing besides the log that reaches the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tierlake.operators.dedup import latest_per_key
from tierlake.sources import files

LOG = "_log"
DELTA_SEQ = "__delta_seq"
SLOT = "__slot"
JSON_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class WriteConflict(RuntimeError):
    """Another writer committed since this one read the table; read again and repeat the merge."""


def last_at_most(bounds: Column, key: Column, n: int) -> Column:
    """How many entries of the ascending array ``bounds`` (of ``n`` entries) are at most ``key``, by halving."""
    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = (s["lo"] < s["hi"]) & (F.get(bounds, mid) <= key)
        return F.struct(F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(max(n, 1).bit_length())), start, halve)["lo"]


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType | None = None,
                 keys: Sequence[str] | None = None, max_deltas: int = 8, rows_per_file: int = 5_000_000,
                 stat_cols: Sequence[str] = ()):
        self.spark, self.schema = spark, schema
        self.root = files.qualified(spark, root.rstrip("/"))
        self.keys = list(keys) if keys else None
        self.max_deltas, self.rows_per_file = max_deltas, rows_per_file
        self.stat_cols = list(stat_cols)    # columns whose maximum the manifest keeps (surrogate ids)
        self._seen: int | None = None       # version of the last read: what a commit builds on

    # -- state -----------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.root}/{LOG}") if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> dict | None:
        found = self.versions()
        if not found:
            return None
        return json.loads(files.read_text(f"{self.root}/{LOG}/{found[-1] if version is None else version:06d}.json"))

    def current_version(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _commit(self, st: dict) -> int:
        v = (self.current_version() or 0) + 1
        before = self.state() or {}
        st = {"streams": before.get("streams", {}), **st}
        if self._seen is not None and v != self._seen + 1:
            raise WriteConflict(f"{self.root}: version {v - 1} was committed after version {self._seen} was read")
        if not files.create_new(self.spark, f"{self.root}/{LOG}/{v:06d}.json", json.dumps({**st, "version": v})):
            raise WriteConflict(f"{self.root}: version {v} was committed by another writer")
        self._seen = v
        return v

    def _next(self) -> str:
        """A data folder of its own for every attempt, so a loser's files never mix with the winner's."""
        return f"v={(self.current_version() or 0) + 1:06d}-{uuid.uuid4().hex[:8]}"

    def _empty(self) -> DataFrame:
        if self.schema is None:
            raise FileNotFoundError(f"{self.root} has no published version")
        return self.spark.createDataFrame([], self.schema)

    # -- reads -----------------------------------------------------------
    def read(self) -> DataFrame:
        st = self._begin()
        if st is None:
            return self._empty()
        if not st.get("manifest"):
            base = self.spark.read.parquet(self.path(st["base"])) if st["base"] else self._empty()
        else:
            base = self._files(self._manifest(st)["file"] if st["carried"] else [st["base"]])
        return self._merged(base, st)

    def matching(self, keys: DataFrame) -> DataFrame:
        """The rows of ``read()`` whose key can be among ``keys``: base files without any are not opened.

        A superset: the caller joins by key.  NULL key parts match nothing.
        """
        st = self._begin()
        if st is None or not st.get("manifest"):
            return self.read()
        return self._merged(self._files([f for _, f in self._touched(st, keys)]), st)

    def max_of(self, col: str):
        """The largest value of a ``stat_cols`` column, from manifest and deltas alone."""
        st = self._begin()
        if st is None or not st.get("manifest"):
            return self.read().agg(F.max(col)).first()[0]
        found = [self.spark.read.parquet(self.path(st["manifest"])).agg(F.max(F.col(f"max_{col}"))).first()[0]]
        if st["deltas"]:
            found.append(self._deltas(st).agg(F.max(col)).first()[0])
        return max((x for x in found if x is not None), default=None)

    def _begin(self) -> dict | None:
        st = self.state()
        self._seen = st["version"] if st else 0
        if st and self.schema is None:
            self.schema = StructType.fromJson(st["schema"])
        return st

    def _files(self, names: Sequence[str]) -> DataFrame:
        names = [self.path(n) for n in names]
        return self.spark.read.schema(self.schema).parquet(*names) if names else self._empty()

    def _deltas(self, st: dict) -> DataFrame:
        cols = self.schema.fieldNames()
        return reduce(lambda a, b: a.unionByName(b), [
            self.spark.read.parquet(self.path(name)).select(*cols).withColumn(DELTA_SEQ, F.lit(k))
            for k, name in enumerate(st["deltas"])])

    def _not_null(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    def _merged(self, base: DataFrame, st: dict) -> DataFrame:
        if not st["deltas"]:
            return base
        cols, deltas = base.columns, self._deltas(st)
        keyed = deltas.where(self._not_null())
        latest = latest_per_key(keyed, self.keys, [F.col(DELTA_SEQ).desc()]).drop(DELTA_SEQ)
        unkeyed = deltas.where(~self._not_null()).drop(DELTA_SEQ)          # NULL keys never replace anything
        kept = base.join(keyed.select(*self.keys), self.keys, "left_anti").select(*cols)
        return kept.unionByName(latest.select(*cols)).unionByName(unkeyed.select(*cols))

    # -- manifest --------------------------------------------------------
    def _key(self) -> Column:
        return F.struct(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys])

    def _manifest(self, st: dict) -> dict[str, list]:
        """File names and rows in key order; files without rows are not listed."""
        rows = self.spark.read.parquet(self.path(st["manifest"])).orderBy("lo").select("file", "rows").collect()
        return {"file": [r["file"] for r in rows], "rows": [r["rows"] for r in rows]}

    def _entries(self, st: dict) -> DataFrame:
        """``slot, lo, hi, file``: the manifest numbered in key order from 1."""
        m = self.spark.read.parquet(self.path(st["manifest"]))
        packed = m.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "file"))).alias("x"))
        return packed.select(F.posexplode("x").alias("k", "e")).select((F.col("k") + 1).alias(SLOT), "e.lo", "e.hi", "e.file")

    def _slot(self, df: DataFrame, st: dict) -> DataFrame:
        """``df`` with the slot of each row: the last file that starts at or before its key.

        The starts travel as one JSON literal, which the optimizer folds to an array once: no row carries them.
        """
        m = self.spark.read.parquet(self.path(st["manifest"]))
        said = m.agg(F.to_json(F.sort_array(F.collect_list("lo")), JSON_FORMATS).alias("x")).first()["x"]
        starts = F.from_json(F.lit(said), ArrayType(m.schema["lo"].dataType), JSON_FORMATS)
        return df.withColumn(SLOT, last_at_most(starts, self._key(), st["files"]))

    def _touched(self, st: dict, keys: DataFrame) -> list[tuple[int, str]]:
        if not st["files"]:
            return []
        slots = self._slot(keys.select(*self.keys).where(self._not_null()).distinct(), st)
        rows = slots.join(self._entries(st), SLOT).where(self._key() <= F.col("hi")).select(SLOT, "file").distinct().collect()
        return sorted((r[SLOT], r["file"]) for r in rows)   # at most one row per base file

    def _describe(self, name: str) -> DataFrame:
        """Manifest entries of a freshly written data folder (reads its key columns only)."""
        df = self.spark.read.schema(self.schema).parquet(self.path(name))
        if SLOT in df.columns:
            df = df.drop(SLOT)
        at = F.regexp_extract(F.col("_metadata.file_path"), f"({name}/.*)$", 1)
        return df.groupBy(at.alias("file")).agg(
            F.min(self._key()).alias("lo"), F.max(self._key()).alias("hi"), F.count(F.lit(1)).alias("rows"),
            *[F.max(c).alias(f"max_{c}") for c in self.stat_cols])

    def _write_manifest(self, entries: DataFrame) -> tuple[str, int]:
        name = "m=" + self._next()[2:]
        entries.coalesce(1).write.parquet(self.path(name))
        return name, self.spark.read.parquet(self.path(name)).count()

    # -- writes ----------------------------------------------------------
    def _head(self, tag) -> dict:
        return {"tag": tag, "schema": self.schema.jsonValue()}

    def publish(self, df: DataFrame, partition_by: list[str] | None = None, tag=None) -> int:
        """Write ``df`` as a complete new base and commit it.

        A keyed table is range-partitioned and sorted by its key, so its files cover separate key ranges.
        """
        name = self._next()
        if self.schema is None or not self.keys:
            self.schema = df.schema
        if not self.keys or partition_by:
            w = df.write
            (w.partitionBy(*partition_by) if partition_by else w).parquet(self.path(name))
            return self._commit({**self._head(tag), "base": name, "deltas": []})
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        self._sorted(df.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys), name)
        manifest, n = self._write_manifest(self._describe(name))
        return self._commit({**self._head(tag), "base": name, "deltas": [], "manifest": manifest, "files": n, "carried": False})

    def _sorted(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> None:
        df.write.option("maxRecordsPerFile", self.rows_per_file).partitionBy(*by).parquet(self.path(name))

    def publish_delta(self, rows: DataFrame, tag=None, stream: tuple[str, int] | None = None) -> int:
        """Record the new values of changed and inserted rows (merge-on-read).

        ``rows`` must carry every column and at most one row per non-NULL key.  ``tag`` (e.g. a stream batch
        id) is kept in the log so a replayed batch can be recognised; ``stream`` (name, batch id) is remembered by
        all later versions.
        """
        if not self.keys:
            raise ValueError("publish_delta needs a keyed table")
        if self.state() is None:
            self.publish(self._empty())
        st = self.state()
        if self.schema is None:
            self.schema = StructType.fromJson(st["schema"])
        if self._seen is None:
            self._seen = st["version"]
        name = self._next()
        rows.select(*self.schema.fieldNames()).write.parquet(self.path(name))
        streams = {**st.get("streams", {}), **({stream[0]: stream[1]} if stream else {})}
        v = self._commit({**st, "deltas": [*st["deltas"], name], "tag": tag, "streams": streams})
        return self.compact(tag=tag) if len(st["deltas"]) + 1 >= self.max_deltas else v

    def compact(self, tag=None) -> int:
        """Fold the deltas into the base; only files whose range a delta key falls into are rewritten."""
        st = self._begin()
        tag = tag if tag is not None else (st or {}).get("tag")
        if st is None or not st.get("manifest") or not st["files"]:
            return self.publish(self.read(), tag=tag)
        deltas = self._deltas(st).select(*self.keys).distinct()
        slots = {max(1, r[SLOT]) for r in self._slot(deltas, st).select(SLOT).distinct().collect()}
        old = self.spark.read.parquet(self.path(st["manifest"]))
        names = self._manifest(st)["file"]
        touched = [names[k - 1] for k in sorted(slots)]
        now = self._slot(self._merged(self._files(touched), st), st).withColumn(SLOT, F.greatest(F.col(SLOT), F.lit(1)))
        name = self._next()
        self._sorted(now.repartition(SLOT).sortWithinPartitions(SLOT, *self.keys), name, [SLOT])
        entries = old.where(~F.col("file").isin(touched)).unionByName(self._describe(name)) if touched else old
        manifest, n = self._write_manifest(entries)
        return self._commit({**self._head(tag), "base": st["base"], "deltas": [], "manifest": manifest, "files": n, "carried": True})

    def has_batch(self, stream: str, batch_id: int) -> bool:
        """Whether a batch of a stream is part of the table (batch ids of a stream only grow)."""
        return ((self.state() or {}).get("streams", {})).get(stream, -1) >= batch_id

    def tags(self) -> DataFrame:
        """``version, tag`` of every commit."""
        if not self.versions():
            return self.spark.createDataFrame([], "version bigint, tag string")
        return self.spark.read.schema("version bigint, tag string").json(f"{self.root}/{LOG}/*.json")

    def last_tag(self):
        st = self.state()
        return None if st is None else st.get("tag")

    def truncate(self) -> int:
        """Publish an empty version of the same schema (reset, K10)."""
        schema = self.schema or self.read().schema
        return self.publish(self.spark.createDataFrame([], schema))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete data folders that none of the last ``keep`` versions names; returns their names.

        A writer that has not committed yet would lose its files: run it when no other writer is at work.
        """
        used: set[str] = set()
        for v in self.versions()[-keep:]:
            st = self.state(v)
            used.update(x for x in (st.get("base") if not st.get("carried") else None, st.get("manifest"), *st["deltas"]) if x)
            if st.get("manifest"):
                used.update(f.split("/")[0] for f in self._manifest(st)["file"])
        gone = [n for n in files.names(self.spark, self.root) if n[:2] in ("v=", "m=") and n not in used]
        for n in gone:
            files.remove(self.spark, self.path(n))
        return gone
