"""Session construction and the shared working folder.

On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach;
all intermediate tables (checkpoints, landed copies, snapshot versions) go
below it.  Only when it is unset (tests, local runs) do we pick a folder of our
own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tierlake", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide working folder (``spark.checkpoint.dir``).

    Set only when unset, which happens in tests and local runs.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tierlake-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` adds a fresh run id."""
    segs = [shared_dir(spark), *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    p = "/".join(s.strip("/") if i else s for i, s in enumerate(segs))
    if p.startswith("/") and not os.path.exists(p):
        os.makedirs(p, exist_ok=True)
    return p


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The driver may have found the package through its own ``sys.path`` only, so
    the sources travel as one zip that Spark hands to every executor.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="tierlake-ship-"), "tierlake_src.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver-generated parquet tables.

    The DataFrame (file listing and footer schema) is reused within a
    session; the data itself is read by every query that uses it.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def local_rows(spark: SparkSession, rows, schema_ddl: str):
    """A small literal table (registries, configuration) built inside the JVM.

    Rows become literal structs expanded with ``inline``; no Python worker
    and no SQL text (so values may contain ``${…}``).
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(schema_ddl)
    names = schema.fieldNames()
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(*names)
