"""Deterministic sharded WARC writer and reader.

Records are put in order of (id, payload digest), dealt to shards by exact id
ranges, and each shard is one task that rolls its files by compressed size.
Every record is a gzip member of its own with headers and digests made anew, so
a file depends on the records alone: no clock, no random id, no task order.

Ranges come from exact block sums (``ranges.balanced``), not from a sample.  Rows
of one id stay in one shard; a task streams its rows, so a shard above the
target costs time and no memory.

Equal payloads: the slim (id, digest) pairs decide which row is the response;
each verdict travels as an extra row that sorts directly before its page, so the
payloads are shuffled once.

Commit: tasks write to names with an attempt's random part; Spark's own commit
of the manifest table decides which attempts count; those files are then
renamed (idempotent: a repeated attempt finds the final name).  Readers follow
the manifest, never the folder listing, so files of lost attempts are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.base import written
from tierlake.llm.ranges import balanced, index_of
from tierlake.session import ship_package
from tierlake.sources.files import resolve as filesystem

DATE = "1970-01-01T00:00:00Z"
MANIFEST = "shard int, seq int, temporary string, name string, records long, bytes long, sha256 string"
READ = ("page_id long, occurrence int, record_type string, refers_to long, uri string, payload binary, payload_bytes long, "
        "payload_digest string, sound boolean")


def verdicts(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(id, digest, refers_to, repeated): of the rows with one payload the largest id is the response.

    ``pages(id, digest, bytes)``.  Digests of a hot payload are combined before the shuffle; the side with
    all rows is the one that adaptive execution splits.
    """
    top = pages.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1")
    ids = pages.select("id", "digest").distinct()
    return ids.join(top.select("digest", "refers_to"), "digest")


def _base32(digest_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(digest_hex)).decode()


def record_id(page_id: int | None, digest: str, occurrence: int) -> str:
    return f"<urn:x-record:{'none' if page_id is None else page_id}:{digest}:{occurrence}>"


def record(page_id: int | None, uri: str, payload: bytes, digest: str, occurrence: int, refers: str | None, refers_to: int | None, size: int) -> bytes:
    """The bytes of one record, without compression."""
    body = payload if refers is None else b""
    one_line = "".join(c if c.isprintable() else "%" + c.encode("utf-8", "replace").hex() for c in uri)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest, occurrence)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {one_line}", "Content-Type: text/html; charset=utf-8",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if refers is None:
        head.append(f"WARC-Block-Digest: sha1:{digest}")
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers}",
                 f"X-Refers-To-Page: {'none' if refers_to is None else refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class _Roller:
    """Writes the gzip members of one shard to files of at least ``roll_bytes`` (the last may be smaller)."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.folder, self.shard, self.roll_bytes, self.seq, self.out = folder, shard, roll_bytes, 0, None
        self.rows: list[dict] = []

    def add(self, data: bytes) -> None:
        if self.out is None:
            name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.row = {"shard": self.shard, "seq": self.seq, "temporary": f"_attempts/{name}.{uuid.uuid4().hex}", "name": name, "records": 0, "bytes": 0}
            fs, path = filesystem(f"{self.folder}/{self.row['temporary']}")
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            self.out, self.sum = fs.open_output_stream(path, compression=None), hashlib.sha256()
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = z.compress(data) + z.flush()
        self.out.write(member)
        self.sum.update(member)
        self.row["records"] += 1
        self.row["bytes"] += len(member)
        if self.row["bytes"] >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append(self.row | {"sha256": self.sum.hexdigest()})
            self.out, self.seq = None, self.seq + 1


def write(pages: DataFrame, folder: str, shard_bytes: int = 1 << 30, roll_bytes: int = 256 << 20, min_revisit_bytes: int = 0,
          id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record per row below ``folder``; returns the committed manifest (shard, seq, name, records, bytes, sha256).

    The payload is the column's text in UTF-8, empty for NULL.  Of rows with
    equal payloads of at least ``min_revisit_bytes`` bytes the one with the
    largest id is a response and the others are revisits of it; rows that
    repeat both id and payload of the response are revisits too, except the
    first.  Rows without id come first, are never referred to while a row with
    an id has the payload, and get the id ``none``.  An empty table gives an
    empty manifest.  Other columns are ignored.
    """
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(uri_col).cast("string"), F.lit("")).alias("uri"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .select("id", "uri", "payload", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("bytes"))
    slim = written(rows.select("id", "digest", "bytes"), "warc-slim")
    least = slim.agg(F.min("id").alias("x")).first()["x"] or 0
    whole = F.coalesce("id", F.lit(least - 1))
    ranges = balanced(slim.select(whole.alias("id"), (F.col("bytes") + 512).alias("size")), shard_bytes)
    says = written(verdicts(slim, min_revisit_bytes), "warc-verdicts")
    shard = index_of([lo for lo, _ in ranges])(whole)
    tagged = rows.select("id", "digest", F.lit(1).alias("kind"), "uri", "payload", F.lit(None).cast("long").alias("refers_to")) \
        .unionByName(says.select("id", "digest", F.lit(0).alias("kind"), F.lit("").alias("uri"), F.lit(b"").alias("payload"), "refers_to"))
    dealt = tagged.withColumn("shard", shard).repartitionById(max(1, len(ranges)), "shard") \
        .sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "digest", "kind", "uri")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers: dict[int, _Roller] = {}
        verdict: Any = None
        last, occurrence = None, 0
        for b in batches:
            for i in range(b.num_rows):
                page_id, digest, kind, uri, payload, refers_to, k = (c[i].as_py() for c in b.columns)
                if kind == 0:
                    verdict = (page_id, digest, refers_to)
                    continue
                if k not in rollers:
                    for r in rollers.values():
                        r.close()
                    rollers[k] = _Roller(folder, k, roll_bytes)
                occurrence = occurrence + 1 if last == (page_id, digest) else 0
                last = (page_id, digest)
                sha = _base32(digest)
                refers = None
                if verdict and verdict[:2] == last and (verdict[2] != page_id or occurrence):
                    refers = record_id(verdict[2], sha, 0)
                rollers[k].add(record(page_id, uri, payload, sha, occurrence, refers, verdict[2] if refers else None, len(payload)))
        for r in rollers.values():
            r.close()
        got = [x for r in rollers.values() for x in r.rows]
        if got:
            yield pa.RecordBatch.from_pylist(got, schema=pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("temporary", pa.string()), ("name", pa.string()),
                                                                    ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    manifest = written(dealt.select("id", "digest", "kind", "uri", "payload", "refers_to", "shard").mapInArrow(run, MANIFEST), "warc-manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                fs, source = filesystem(f"{folder}/{row['temporary']}")
                target = source.rsplit("/", 2)[0] + "/" + row["name"]
                if fs.get_file_info(source).type.name == "File":
                    fs.move(source, target)
                elif fs.get_file_info(target).type.name != "File":
                    raise FileNotFoundError(target)
            yield b

    done = manifest.repartition(max(1, min(len(ranges), spark.sparkContext.defaultParallelism)), "shard", "seq").mapInArrow(rename, MANIFEST)
    done.drop("temporary").write.parquet(f"{folder}/_MANIFEST")
    return spark.read.parquet(f"{folder}/_MANIFEST")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files in the manifest; digests of responses are computed from the payload and held against the header.

    ``sound`` is false where a digest or length does not agree; revisits carry
    the digest and length of the payload they stand for and no payload.
    """
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                fs, path = filesystem(f"{folder}/{name}")
                out: list[dict] = []
                held = 0
                with fs.open_input_stream(path, compression=None) as f:
                    for rec in members(f):
                        out.append(parse(rec))
                        held += len(rec)
                        if held > 8 << 20:
                            yield _batch(out)
                            out, held = [], 0
                if out:
                    yield _batch(out)

    files = spark.read.parquet(f"{folder}/_MANIFEST").select("name")
    n = max(1, files.count())
    return files.repartition(min(n, 100_000)).mapInArrow(run, READ)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("page_id", pa.int64()), ("occurrence", pa.int32()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("sound", pa.bool_())]))


def members(stream) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one at a time."""
    z, parts, left = zlib.decompressobj(31), [], b""
    while True:
        data = left or stream.read(1 << 20)
        if not data:
            break
        parts.append(z.decompress(data))
        left = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("a WARC file ends within a record")


def parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[:int(fields["Content-Length"])]
    _, _, page, digest, occurrence = fields["WARC-Record-ID"].strip("<>").split(":")
    kind = fields["WARC-Type"]
    said, size = fields["WARC-Payload-Digest"].partition(":")[2], int(fields["X-Payload-Length"])
    if kind == "response":
        made = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        sound = made == said == digest and len(payload) == size and fields["WARC-Block-Digest"] == f"sha1:{made}"
    else:
        made, sound = said, said == digest and not payload
    refers = fields.get("X-Refers-To-Page")
    return {"page_id": None if page == "none" else int(page), "occurrence": int(occurrence), "record_type": kind,
            "refers_to": None if refers in (None, "none") else int(refers), "uri": fields["WARC-Target-URI"], "payload": payload if kind == "response" else None,
            "payload_bytes": size if kind != "response" else len(payload), "payload_digest": made, "sound": sound}
