"""File access beside Spark's readers and writers.

Inside tasks (ZIP extraction) paths are Hadoop-style URIs and ``pyarrow.fs``
resolves the scheme (local, HDFS, S3, GCS …).  The driver uses Hadoop's own
file systems: ``qualified`` gives a path without a scheme the one Spark would
use, and commits need a rename that never replaces a file.
"""

from __future__ import annotations

from urllib.parse import urlparse


def resolve(path: str):
    """``(filesystem, path_inside_it)`` for a URI or a local path."""
    from pyarrow import fs
    u = urlparse(path)
    if u.scheme in ("", "file"):
        p = u.path if u.scheme == "file" else path
        return fs.LocalFileSystem(), p
    if u.scheme in ("s3a", "s3n"):  # the names Hadoop's connectors use for the same store
        path = "s3" + path[3:]
    return fs.FileSystem.from_uri(path)


def open_input(path: str):
    f, p = resolve(path)
    return f.open_input_file(p)


def open_output(path: str):
    f, p = resolve(path)
    parent = p.rsplit("/", 1)[0]
    if parent:
        f.create_dir(parent, recursive=True)
    return f.open_output_stream(p)


def exists(path: str) -> bool:
    from pyarrow import fs as pafs
    f, p = resolve(path)
    return f.get_file_info(p).type != pafs.FileType.NotFound


def read_text(path: str) -> str:
    with open_input(path) as fh:
        return fh.read().decode("utf-8")


def write_text_atomic(path: str, text: str) -> None:
    """Write a small file via a temporary name and a move."""
    import uuid
    f, p = resolve(path)
    tmp = f"{p}.{uuid.uuid4().hex}.tmp"
    parent = p.rsplit("/", 1)[0]
    if parent:
        f.create_dir(parent, recursive=True)
    with f.open_output_stream(tmp) as out:
        out.write(text.encode("utf-8"))
    f.move(tmp, p)


# -- on the driver, through Hadoop ---------------------------------------
def _hadoop(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark, path: str) -> str:
    """The path with the scheme and authority that Spark itself would give it."""
    p, fs = _hadoop(spark, path)
    return fs.makeQualified(p).toString()


def names(spark, path: str) -> list[str]:
    """Names in a folder, empty if there is none."""
    p, fs = _hadoop(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.delete(p, True)


def create_new(spark, path: str, text: str) -> bool:
    """Write a small file under a temporary name and rename it; False if ``path`` exists already.

    The rename does not replace, so of several writers one succeeds (on stores whose rename is atomic).
    """
    import uuid
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p, fs = _hadoop(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.exists(p):
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(tmp, p, options)
            return True
        except Exception as e:  # noqa: BLE001 - py4j wraps Java's FileAlreadyExistsException
            if "FileAlreadyExistsException" not in str(e):
                raise
    fs.delete(tmp, False)
    return False
