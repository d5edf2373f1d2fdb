"""File-arrival ingest with Structured Streaming (X1).

New extract files in a folder are picked up by the file source; each
micro-batch is deduplicated and upserted into a snapshot table inside
``foreachBatch``.  The stream's checkpoint remembers which files were taken
(the "already processed" check of the daily load), and the upsert keeps the
row that sorts first per key, so replays and out-of-order files give the same
table.  Every micro-batch reads the previous version from storage, which
also bounds the lineage.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierlake.operators.dedup import latest_per_key
from tierlake.operators.upsert import upsert_newest
from tierlake.sources.store import SnapshotTable


def upsert_batch(target: SnapshotTable, keys: Sequence[str], order: Sequence[Column], stream: str):
    """``foreachBatch`` function: dedup the batch, upsert, publish a new version.

    ``stream`` names the stream (its checkpoint): batch ids start at 0 in every
    one, so a published batch is known by stream and id together.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        tag = f"{stream}#{batch_id}"
        if target.has_batch(stream, batch_id) or target.last_tag() == tag:
            return                                    # replay of a published batch
        dedup = latest_per_key(batch, keys, order)
        current = target.matching(dedup.select(*target.keys)) if target.keys else target.read()
        if target.keys:
            # merge-on-read: only keys of this batch are compared and written, only files that can hold one are opened
            touched = current.join(dedup.select(*keys), list(keys), "left_semi")
            target.publish_delta(upsert_newest(touched, dedup, keys, order), tag=tag, stream=(stream, batch_id))
        else:
            target.publish(upsert_newest(current, dedup, keys, order), tag=tag)
    return run


def ingest_files(spark: SparkSession, source_dir: str, schema: StructType, target: SnapshotTable,
                 keys: Sequence[str], order: Sequence[Column], checkpoint: str,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None,
                 options: dict | None = None, wait: bool = True):
    """Run the stream until every file present now is processed (``availableNow``).

    Returns the StreamingQuery (already finished when ``wait``).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return _started(reader.load(source_dir), upsert_batch(target, keys, order, checkpoint), checkpoint, wait)


def _started(rows: DataFrame, batch, checkpoint: str, wait: bool):
    q = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        q.awaitTermination()
    return q


COUNTS = ("stream string, batch_id bigint, rows_read bigint, rows_loaded bigint, new_count bigint, changed_count bigint, "
          "unchanged_count bigint, stale_count bigint, null_key_count bigint, merged_count bigint")


def entity_batch(target: SnapshotTable, spec, stream: str, work: str):
    """``foreachBatch`` function of an entity: stage, preview and merge; its counts are part of the commit.

    A row replaces the stored one unless the stored one sorts before it in the entity's order, so late files change
    nothing that is newer and repeated files change nothing at all.  NULL keys are counted and left out.
    """
    from tierlake.operators.preview import change_preview
    from tierlake.plans.entity_flow import dedup, null_key, stage
    keys = list(spec.keys)
    order = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in spec.order]

    def run(batch: DataFrame, batch_id: int) -> None:
        if target.has_batch(stream, batch_id):
            return                                    # replay of a published batch
        spark = batch.sparkSession
        # the staged batch is written once; every count and the merge read it back
        path = f"{work}/batch={batch_id}"
        if "_seq" not in batch.columns:             # the row's place in its file can only be counted inside a batch
            batch = batch.withColumn("_seq", F.struct(F.col("__file").alias("file"), F.col("__block").alias("block"),
                                                      F.monotonically_increasing_id().alias("row")))
        stage(batch, spec, batch_id).write.mode("overwrite").parquet(path)
        staged = spark.read.parquet(path)
        latest = dedup(staged.where(~null_key(spec)), spec)
        few = target.matching(latest.select(*keys))
        names = target.schema.fieldNames()
        touched = few.join(latest.select(*keys), keys, "left_semi").withColumn("__new", F.lit(0))
        both = touched.unionByName(latest.select(*names).withColumn("__new", F.lit(1)))
        won = latest_per_key(both, keys, [*order, F.col("__new").desc()])
        tallies = [change_preview(latest, few, keys, spec.compare_columns()),
                   won.agg(F.count_if(F.col("__new") == 0).alias("stale_count"), F.count_if(F.col("__new") == 1).alias("merged_count")),
                   staged.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(null_key(spec)).alias("null_key_count"),
                              F.count_distinct(F.when(~null_key(spec), F.struct(*keys))).alias("rows_loaded"))]
        counts = {k: v for t in tallies for k, v in t.first().asDict().items()}
        target.publish_delta(won.where(F.col("__new") == 1).select(*names), stream=(stream, batch_id),
                             tag=json.dumps({"stream": stream, "batch_id": batch_id, **counts}))
    return run


def ingest_entity(wh, spec, source_dir: str, checkpoint: str, max_files_per_trigger: int | None = None, wait: bool = True):
    """Stream the CSV extracts of a folder (one header, the entity's landing columns first to last) into its final table.

    Runs until every file present now is processed.  Each micro-batch is one commit.
    """
    from tierlake.sources.landing import all_string_schema
    target = wh.final(spec)
    reader = wh.spark.readStream.schema(all_string_schema(spec.landing_columns())).option("header", "true").option("escape", '"') \
        .option("mode", "FAILFAST").option("enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.csv(source_dir)
    rows = rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in rows.columns],
                       F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    work = f"{wh.root}/stream/{spec.name.lower()}-{abs(hash_of(checkpoint)):x}"
    return _started(rows, entity_batch(target, spec, checkpoint, work), checkpoint, wait)


def hash_of(text: str) -> int:
    import zlib
    return zlib.crc32(text.encode())


def stream_counts(target: SnapshotTable) -> DataFrame:
    """What every batch did, from the commits themselves."""
    said = target.tags().select(F.from_json("tag", COUNTS).alias("c")).select("c.*")
    return said.where(F.col("batch_id").isNotNull()).distinct()
