"""Document fingerprints: bottom-k sketches of word shingle hashes.

A sketch holds the ``k`` smallest distinct 64-bit shingle hashes of a text.  The
sketch of a union is the bottom k of the joined sketches, so parts of a text or
of a corpus merge.  Two sketches estimate resemblance (Jaccard of the shingle
sets) and containment; one estimates the number of distinct shingles.  A sketch
of fewer than k hashes is the whole set and its estimates are exact.

``edited_neighbours`` needs each row's successor in id order.  Rows are dealt to
exact id ranges (``ranges.balanced``), the first row of each range is also sent
to the range before it, and every task walks its sorted rows once: one
shuffle of the texts, no window over the whole table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import rows_of, written
from tierlake.llm.ranges import balanced, index_of
from tierlake.llm.shingles import Powers, shingle_hashes

K = 128
WORDS = 5
ROWS_AT_ONCE = 256


def bottom(h: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    if len(h) > 8 * k:
        few = np.unique(h[h <= np.partition(h, 2 * k)[2 * k]])
        if len(few) >= k:
            return few[:k]
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated Jaccard; two empty sketches are alike (1), an empty one is unlike any other (0)."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float(np.isin(both, a, assume_unique=True).__and__(np.isin(both, b, assume_unique=True)).sum() / len(both))


def distinct(a: np.ndarray, k: int) -> float:
    """Estimated number of distinct shingles."""
    if len(a) < k:
        return float(len(a))
    return float((k - 1) * 2.0 ** 64 / float(a[k - 1]))


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of a's shingles that b holds too (1 for an empty a)."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return float(min(1.0, shared / distinct(a, k)))


def pack(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def unpack(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def sketches(texts: list[str], words: int, k: int, powers: Powers) -> list[np.ndarray]:
    return [bottom(h, k) for h in shingle_hashes([t.encode("utf-8", "surrogatepass") for t in texts], words, powers)]


def sketch(docs: DataFrame, words: int = WORDS, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, distinct_shingles)`` of every row; NULL and empty texts have the empty fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                got = sketches(b.column(1).to_pylist(), words, k, powers)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pack(s) for s in got], pa.string()), pa.array([distinct(s, k) for s in got], pa.float64())],
                                                 ["doc_id", "fingerprint", "distinct_shingles"])

    return rows_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string, distinct_shingles double")


def merged(parts: DataFrame, key: str, k: int = K, fingerprint: str = "fingerprint") -> DataFrame:
    """``(key, fingerprint, distinct_shingles)``: the sketch of everything under each key.

    Every task merges its own rows first, so a key gets one row per task however many rows it has; the second
    merge reads those.  NULL keys form one group.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for name, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = unpack(s or "")
                held[name] = merge(held[name], h, k) if name in held else h
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([pack(h) for h in held.values()], pa.string()),
                                              pa.array([distinct(h, k) for h in held.values()], pa.float64())], [key, "fingerprint", "distinct_shingles"])

    schema = f"`{key}` string, fingerprint string, distinct_shingles double"
    some = parts.select(F.col(key).cast("string").alias(key), F.col(fingerprint).alias("fingerprint")).mapInArrow(fold, schema)
    return some.select(key, "fingerprint").repartition(key).mapInArrow(fold, schema)


NEIGHBOURS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
              "contained_in_edited double, distinct_shingles double")


def edited_neighbours(docs: DataFrame, words: int = WORDS, k: int = K, shard_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness.

    The edited text loses its last floor(n/4) code points and gains the first
    as many (or all) of the next row's text; the next row is the one with the
    next larger id, after the last comes the first.  Rows of one id follow each
    other in the order of their texts' hashes; rows without id come first.  A
    table of one row is its own successor.  NULL texts count as empty.  An empty
    table gives an empty result; very long texts are sketched whole.  Other
    columns, whatever their names, are left out.
    """
    rows = rows_of(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    slim = written(rows.select("doc_id", "h", F.length(F.col("text").cast("binary")).cast("long").alias("size")), "fingerprint-slim")
    least = (slim.agg(F.min("doc_id").alias("x")).first()["x"] or 0) - 1
    whole = F.coalesce("doc_id", F.lit(least))
    lows = [lo for lo, _ in balanced(slim.select(whole.alias("id"), (F.col("size") + 64).alias("size")), shard_bytes)]
    shard = index_of(lows)
    n = max(1, len(lows))
    first = slim.select(shard(whole).alias("shard"), F.struct(whole.alias("id"), "h").alias("x")).groupBy("shard").agg(F.min("x").alias("x")).collect()
    head = np.zeros((n, 2), np.int64)
    for r in first:
        head[r["shard"]] = r["x"]["id"], r["x"]["h"]

    @F.pandas_udf("boolean")
    def leads(s: pd.Series, i: pd.Series, h: pd.Series) -> pd.Series:
        at = head[s.to_numpy(np.int64)]
        return pd.Series((at[:, 0] == i.to_numpy(np.int64)) & (at[:, 1] == h.to_numpy(np.int64)))

    placed = rows.withColumn("shard", shard(whole)).withColumn("lead", leads("shard", whole, "h"))
    here = F.struct("shard", F.lit(0).alias("tail"))
    before = F.struct(F.pmod(F.col("shard") - 1, F.lit(n)).alias("shard"), F.lit(1).alias("tail"))
    dealt = placed.withColumn("to", F.explode(F.when(F.col("lead"), F.array(here, before)).otherwise(F.array(here)))) \
        .select("doc_id", "text", "h", F.col("to.tail").alias("tail"), F.col("to.shard").alias("to")) \
        .repartitionById(n, "to").sortWithinPartitions("tail", F.col("doc_id").asc_nulls_first(), "h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, waiting, ended = Powers(), [], False
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS_AT_ONCE):
                if ended:
                    continue
                b = whole_batch.slice(at, ROWS_AT_ONCE)
                for i, text, tail in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                    waiting.append((i, text))
                    if tail:
                        ended = True
                        break
                if len(waiting) > 1:
                    yield answer(waiting, powers)
                    waiting = waiting[-1:]

    def answer(held: list, powers: Powers) -> pa.RecordBatch:
        texts = [t for _, t in held]
        edited = []
        for text, after in zip(texts, texts[1:]):
            m = len(text) // 4
            edited.append(text[:len(text) - m] + after[:m])
        own, new = sketches(texts, words, k, powers), sketches(edited, words, k, powers)
        out = {"doc_id": [i for i, _ in held[:-1]], "n_chars": list(map(len, texts[:-1])),
               "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
               "fingerprint": [pack(s) for s in own[:-1]], "edited_fingerprint": [pack(s) for s in new],
               "near_edited": [resemblance(a, b, k) for a, b in zip(own, new)], "near_next": [resemblance(a, b, k) for a, b in zip(own, own[1:])],
               "contained_in_edited": [containment(a, b, k) for a, b in zip(own, new)], "distinct_shingles": [distinct(a, k) for a in own[:-1]]}
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.float64()] * 4
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return dealt.select("doc_id", "text", "h", "tail").mapInArrow(run, NEIGHBOURS)
