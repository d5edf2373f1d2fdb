"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (documents
labelled good) and one of raw text (every document), give each document the
log ratio of its likelihoods.  The documents of the k largest ``log weight +
Gumbel noise`` are a sample without replacement in proportion to the weights.

N-grams: word unigrams and bigrams (words and runs of punctuation are tokens,
case kept) and trigrams of token shapes, where a shape is the punctuation itself
or the letter case of a word and whether it repeats one of the three tokens
before.  The log weight is the mean over the n-grams and ``NEUTRAL`` ones of ratio 0,
times ``LENGTH``, as if all documents had that many: length alone selects
nothing and a few words decide little.

k is the number of documents whose weight is above the cut that separates the
labelled rows best, so a corpus without bad documents loses none.

Raw counts cover every document; a task sends at most one row per bucket.  The
labelled rows that fit the target model and the cut are a bounded sample (the
``sample`` rows with the smallest hashes of their ids), the only thing that is
broadcast besides the table of ``BUCKETS`` ratios.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import rows_of, written
from tierlake.llm.shingles import Powers, chunks, mix, tokens

BUCKETS = 1 << 17
LENGTH = 256
SAMPLE = 20_000
SMOOTHING = 1.0
NEUTRAL = 16
ROWS_AT_ONCE = 512

# kinds of bytes: 0 white space, 1 letters, digits, underscore and everything beyond ASCII, 2 punctuation
_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[list(b"_0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 1
_KIND[128:] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[list(b"0123456789")] = 1


def _bucket(h: np.ndarray, part: int) -> np.ndarray:
    """Each of the three kinds of n-grams has a part of the buckets of its own: 1/4, 1/2, 1/4."""
    lo, size = ((0, BUCKETS // 4), (BUCKETS // 4, BUCKETS // 2), (3 * BUCKETS // 4, BUCKETS // 4))[part]
    return lo + (h % np.uint64(size)).astype(np.int64)


def features(raws: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and of every n-gram the index of its text."""
    data, starts, ends, h, counts = tokens(raws, powers, _KIND)
    owner = np.repeat(np.arange(len(raws)), counts)
    n = len(h)
    if not n:
        return np.zeros(0, np.int64), owner
    size = ends - starts
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    digit = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    ups, digits = upper[ends] - upper[starts], digit[ends] - digit[starts]
    shape = np.zeros(n, np.int64)
    shape[ups > 0] = 1
    shape[(ups > 1) & (2 * ups >= size)] = 2
    shape[2 * digits > size] = 3
    again = np.zeros(n, bool)
    for back in (1, 2, 3):
        again[back:] |= (h[back:] == h[:-back]) & (owner[back:] == owner[:-back])
    coded = np.where(_KIND[data[starts]] == 2, h, mix((shape * 2 + 1).astype(np.uint64)))
    coded = coded + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    two = owner[1:] == owner[:-1]
    three = owner[2:] == owner[:-2]
    pairs = mix(h[:-1] * np.uint64(3) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))[two]
    shapes = mix(coded[:-2] * np.uint64(5) + coded[1:-1] * np.uint64(0x165667B19E3779F9) + coded[2:] * np.uint64(0x27D4EB2F165667C5))[three]
    return (np.concatenate((_bucket(h, 0), _bucket(pairs, 1), _bucket(shapes, 2))),
            np.concatenate((owner, owner[:-1][two], owner[:-2][three])))


def means(texts: list[str], ratio: np.ndarray, powers: Powers) -> np.ndarray:
    """Mean log ratio of each text, ``NEUTRAL`` n-grams of ratio 0 included; 0 without n-grams."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    out = np.zeros(len(raws))
    for at, end in chunks(raws):
        bucket, owner = features(raws[at:end], powers)
        total = np.bincount(owner, weights=ratio[bucket], minlength=end - at)
        out[at:end] = total / (NEUTRAL + np.bincount(owner, minlength=end - at))
    return out


@dataclass
class Model:
    ratio: np.ndarray
    cut: float


def labelled(labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """``(label_id, good)`` of at most ``sample`` labelled ids; an id with several labels is good if all are 1.  NULLs are left out."""
    found = labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("good")).where("label_id is not null and good is not null")
    return found.groupBy("label_id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Ratio table over all documents and the cut of the labelled ones.

    Without labelled rows of both kinds the cut is minus infinity: nothing is rejected.
    """
    rows = rows_of(docs, id_col, text_col)
    chosen = written(labelled(labels, sample, "doc_id", label_col), "quality-labels")
    marked = rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["label_id"], "left").select("text", "good")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, raw, target = Powers(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            raws = [t.encode("utf-8", "surrogatepass") for t in b.column(0).to_pylist()]
            good = np.array([g == 1 for g in b.column(1).to_pylist()], bool)
            for at, end in chunks(raws):
                bucket, owner = features(raws[at:end], powers)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[good[at:end][owner]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    sums = marked.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = sums.toPandas()  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    ratio = np.zeros(BUCKETS, np.float32)
    for lo, hi in ((0, BUCKETS // 4), (BUCKETS // 4, 3 * BUCKETS // 4), (3 * BUCKETS // 4, BUCKETS)):
        t, r = target[lo:hi], raw[lo:hi]
        if t.sum():  # the target model backs off to the raw one where it has few counts
            prior = (r + SMOOTHING) / (r + SMOOTHING).sum()
            ratio[lo:hi] = np.log((t + SMOOTHING * len(t) * prior) / (t.sum() + SMOOTHING * len(t)) / prior)
    model = Model(ratio, float("-inf"))
    known = rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["label_id"]).select(log_weight(model, F.col("text")).alias("w"), "good").toPandas()
    model.cut = min(0.0, best_cut(known["w"].to_numpy(), known["good"].to_numpy()))  # no n-grams, no evidence: weight 0 passes
    return model


def best_cut(weight: np.ndarray, good: np.ndarray) -> float:
    """The weight that separates the two labels best: the middle of the gap with the most rows on their right side."""
    if not (good == 1).any() or not (good == 0).any():
        return float("-inf")
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order]
    below = np.concatenate(([0], np.cumsum(g == 0))) + (g == 1).sum() - np.concatenate(([0], np.cumsum(g == 1)))
    at = int(np.argmax(below))
    if at == 0:
        return float("-inf")
    return float(w[at - 1] + (w[at] - w[at - 1]) / 2) if at < len(w) else float(w[-1]) + 1.0


def log_weight(model: Model, text: Column) -> Column:
    """The log importance weight of a text; NULL and empty texts have weight 0."""
    ratio = model.ratio

    @F.pandas_udf("double")
    def weight(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        powers = Powers()
        for texts in batches:
            t = texts.tolist()
            yield pd.Series(np.concatenate([means(t[k:k + ROWS_AT_ONCE], ratio, powers) for k in range(0, len(t), ROWS_AT_ONCE)] or [np.zeros(0)]) * LENGTH)

    return weight(F.coalesce(text.cast("string"), F.lit("")))


def gumbel(doc_id: Column, text: Column, seed: int) -> Column:
    """Gumbel noise from a hash of seed, id and text: the same in every run and at every partitioning."""
    h = F.xxhash64(F.lit(seed), doc_id, text)
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, k: int) -> float:
    """The exact k-th largest of ``values(key double)`` by counting in ever finer bins; only bin counts reach the driver."""
    if k <= 0:
        return float("inf")
    span = values.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("key").alias("n")).first()
    if not span["n"] or k >= span["n"]:
        return float("-inf")
    lo, hi, above = span["lo"], span["hi"], 0  # the answer lies in [lo, hi]; ``above`` values are larger than hi
    while lo < hi:
        step = (hi - lo) / 1024
        place = F.least(F.lit(1023), F.floor((F.col("key") - lo) / F.lit(step)).cast("int")) if step > 0 else F.lit(0)
        bins = sorted(values.where((F.col("key") >= lo) & (F.col("key") <= hi)).groupBy(place.alias("bin"))
                      .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect(), key=lambda r: -r["bin"])
        for r in bins:
            if above + r["n"] >= k:
                break
            above += r["n"]
        if (r["lo"], r["hi"]) == (lo, hi):
            break
        lo, hi = r["lo"], r["hi"]
    if lo < hi:  # neighbouring doubles that no bin can part
        held = sorted((r["key"] for r in values.where((F.col("key") >= lo) & (F.col("key") <= hi)).select("key").distinct().collect()), reverse=True)
        for v in held:
            above += values.where(F.col("key") == v).count()
            if above >= k:
                return v
    return lo


def resample(docs: DataFrame, labels: DataFrame, seed: int = 7, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[Column, Column, float]:
    """Columns over ``docs``: log weight and sampling key; and the smallest key that is selected.

    Rows with equal keys (the same id and text) share their fate.  An empty table selects nothing.
    """
    model = fit(docs, labels, sample, id_col, text_col, label_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    weight = log_weight(model, F.col(text_col))
    noise = gumbel(F.col(id_col).cast("long"), text, seed)
    scored = written(docs.select(weight.alias("w"), noise.alias("noise")), "quality-scores")
    k = scored.where(F.col("w") >= model.cut).count()
    return weight, noise, kth_largest(scored.select((F.col("w") + F.col("noise")).alias("key")), k)


def keep_selected(docs: DataFrame, labels: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The selected rows of ``docs``, all columns unchanged, whatever their names.

    NULL and empty texts have log weight 0.  Rows of equal id and text, and ties of the k-th key, share their fate.
    An empty table stays empty; without labels of both kinds all rows stay.  Very long texts are weighed whole.
    """
    weight, noise, least = resample(docs, labels, seed, id_col=id_col, text_col=text_col)
    return docs.where(weight + noise >= F.lit(least))
