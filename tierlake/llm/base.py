"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.session import shared_dir, ship_package


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder of the cluster."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the folder of a table made by ``written`` once nothing reads it any more."""
    spark = table.sparkSession
    for root in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if "/llm/" not in root:
            raise ValueError(f"not a scratch table: {root}")
        p = spark._jvm.org.apache.hadoop.fs.Path(root)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished jobs before the next ones are written.

    It acts on the driver's garbage collection and deletes in the background: the first round lets go of the plans that
    Python still held, the second of what hung on them, and each gives the deletion a moment.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1.0)


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` (NULL becomes empty) of a table, whatever else it holds."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` has it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def all_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
