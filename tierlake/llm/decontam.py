"""Benchmark decontamination by latent semantic retrieval.

Every text is read and hashed once, into the column numbers of its words; the model's passes and the search
read these.  Documents are read as passages of ``WINDOW`` words, end to end for the model and
half overlapping for the search.  Passages and benchmark items become TF-IDF
vectors (document frequencies over all passages).  A randomised range finder gives the latent space
(no singular values or vectors are formed): each task multiplies its own passages with a seeded random matrix and
sends one terms x rank matrix, and these are added up.  Only terms of
the benchmark are kept as columns, since no other term moves a passage towards an
item.  The items are rows of the matrix as well: ``POWER`` random vectors take one
power step over all passages, the other ``RANK - POWER`` are random mixtures of
items, which span the items only up to that number.

A passage and an item are a candidate if their latent cosine reaches
``least_cosine``, which is lower for items that fill a small part of a passage, and
if the passage has ``least_shared`` words of the item, which the best passage of
every match has (these are counted first, from the items that have a word; only passages that pass get a latent vector).
Candidates without enough words of the item in the passages around (``enough_around``) are not read again.  A candidate counts if the longest common subsequence of words of the item and of
a stretch of text in and around the passage, at most ``STRETCH`` times as long as
the item, covers ``OVERLAP`` of the item (copies, insertions, deletions and
replaced words alike) and the answer is part of it: at least half of the item's
last ``ANSWER`` words.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import rows_of, written
from tierlake.llm.shingles import AT_ONCE, Powers, chunks, word_hashes

WINDOW = 32
RANK, POWER = 96, 32
COSINE, SHORT = 0.3, 12
OVERLAP = 0.7
ANSWER = 5
STRETCH = 1.5
ITEMS_AT_ONCE, WORDS_AT_ONCE = 256, 1 << 16
MOST_ITEM_BYTES = 256 << 20
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain(text: str) -> bytes:
    """Lower-cased words of letters and digits, joined by one space."""
    return b" ".join(_WORD.findall(text.lower().encode("utf-8", "surrogatepass")))


_BLANKED = bytes(c if _WORD.match(bytes([c])) else 32 for c in range(256))


def spaced(text: str) -> bytes:
    """The words of ``plain`` with as many spaces between them as there were other characters."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED)


@dataclass
class Space:
    """Latent space of the benchmark: terms -> rank, with the items' unit vectors."""
    column: np.ndarray  # sorted hashes of the benchmark's terms
    idf: np.ndarray
    basis: np.ndarray  # terms x rank
    ids: list[int | None]
    words: list[list[int]]  # word hashes of the items
    latent: np.ndarray  # items x rank, unit rows


def _columns(h: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Column numbers of word hashes, -1 for terms that the benchmark does not have."""
    if not len(column):
        return np.full(len(h), -1, np.int64)
    at = np.minimum(np.searchsorted(column, h), len(column) - 1)
    return np.where(column[at] == h, at, -1)


class Lookup:
    """``_columns`` by a table of the last bits of the hashes; where several terms share these, by search."""

    def __init__(self, column: np.ndarray):
        size = 1 << max(10, (4 * len(column)).bit_length())
        self.column, self.last = column, np.uint64(size - 1)
        slot = (column & self.last).astype(np.int64)
        self.at = np.full(size, -1, np.int32)
        self.at[slot] = np.arange(len(column))
        self.at[np.bincount(slot, minlength=size) > 1] = -2

    def of(self, h: np.ndarray) -> np.ndarray:
        at = self.at[(h & self.last).astype(np.int64)]
        several, one = np.flatnonzero(at == -2), np.flatnonzero(at >= 0)
        at[one[self.column[at[one]] != h[one]]] = -1
        at[several] = _columns(h[several], self.column)
        return at


def windows(counts: np.ndarray, step: int = WINDOW // 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and owner of the passages, one every ``step`` words, of texts with so many words."""
    firsts = np.cumsum(counts) - counts
    n = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW + step) // step)), 0)
    owner = np.repeat(np.arange(len(counts)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = firsts[owner] + k * step
    return start, np.minimum(start + WINDOW, (firsts + counts)[owner]), owner


def _sparse(cols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, column, term frequency) triples of the passages with at least one benchmark term."""
    size = end - start
    row = np.repeat(np.arange(len(start)), size)
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    c = cols[at]
    row, c = row[c >= 0], c[c >= 0]
    key, tf = np.unique(row * np.int64(1 << 32) + c, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, tf


def _weighted(row: np.ndarray, col: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """(1 + log tf) idf, every passage scaled to length one."""
    if not len(row):
        return np.zeros(0, np.float32)
    w = (1.0 + np.log(tf)) * idf[col]
    norm = np.sqrt(np.bincount(row, weights=w * w))
    return (w / np.maximum(norm[row], 1e-12)).astype(np.float32)


def _times(row: np.ndarray, col: np.ndarray, w: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct passages and their products with a terms x rank matrix."""
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros((0, right.shape[1]), np.float32)
    return row[first], np.add.reduceat(right[col] * w[:, None], first, axis=0)


def benchmark_items(benchmark: DataFrame, item_id_col: str = "item_id", item_text_col: str = "text") -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Ids, word hashes and word counts of the items in a fixed order.

    The benchmark is the query side; it is collected and broadcast, and raises beyond ``MOST_ITEM_BYTES``.
    """
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    if size > MOST_ITEM_BYTES:
        raise ValueError("the benchmark is larger than MOST_ITEM_BYTES; search it in parts")
    found = sorted(((r["item_id"], r["text"]) for r in items.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    h, counts = word_hashes([plain(t) for _, t in found], Powers()) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return [i for i, _ in found], h, counts


def encoded(docs: DataFrame, column: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, cols)`` of every row: its words in order as column numbers, -1 for words that the benchmark does not have.

    Written once, so that the model's passes and the search do not read and hash the texts again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, lookup = Powers(), Lookup(column)
        for b in batches:
            raws = [spaced(t) for t in b.column(2).to_pylist()]
            for at, stop in chunks(raws):
                h, counts = word_hashes(raws[at:stop], powers)
                ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts))).astype(np.int32)
                cols = pa.ListArray.from_arrays(pa.array(ends), pa.array(lookup.of(h)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, stop - at), b.column(1).slice(at, stop - at), cols], ["doc_id", "text_key", "cols"])

    rows = rows_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return written(rows.mapInArrow(run, "doc_id long, text_key long, cols array<int>"), "passages")


def _passages(cols: pa.ListArray, step: int = WINDOW // 2):
    """Sparse passages of some encoded texts: (columns, words per text, start, end, owner, row, col, tf)."""
    flat = cols.flatten().to_numpy().astype(np.int64)
    counts = np.diff(cols.offsets.to_numpy()).astype(np.int64)
    if len(flat):
        start, end, owner = windows(counts, step)
        # taken in blocks of passages that the processor's cache holds
        for lo in range(0, len(start), 1 << 10):
            part = slice(lo, lo + (1 << 10))
            row, col, tf = _sparse(flat, start[part], end[part])
            yield flat, counts, start[part], end[part], owner[part], row, col, tf


def fit(texts: DataFrame, items: tuple[list[int | None], np.ndarray, np.ndarray], column: np.ndarray, rank: int = RANK, seed: int = 11) -> Space:
    """Document frequencies and the latent space over the passages of all encoded texts."""
    ids, h, counts = items
    ends = np.cumsum(counts)
    words = [h[e - c:e].tolist() for c, e in zip(counts.tolist(), ends.tolist())]
    rows = texts.select("cols")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(column) + 1, np.int64), 0
        for b in batches:
            for *_, start, _, _, _, col, _ in _passages(b.column(0), WINDOW):
                df[:-1] += np.bincount(col, minlength=len(column))
                n += len(start)
        df[-1] = n
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(df[used])], ["col", "n"])

    df = np.zeros(len(column) + 1)
    for r in rows.mapInArrow(frequencies, "col int, n long").groupBy("col").agg(F.sum("n").alias("n")).collect():  # one row per benchmark term
        df[r["col"]] = r["n"]
    idf = np.log((df[-1] + 1.0) / (df[:-1] + 1.0)) + 1.0
    k = min(rank, max(1, len(column)))
    own = [_sparse(_columns(h, column), ends[i:i + 1] - counts[i:i + 1], ends[i:i + 1]) for i in range(len(ids))]
    item_rows = [(c, _weighted(r, c, tf, idf)) for r, c, tf in own]

    def gram(right: np.ndarray) -> np.ndarray:
        """A'A right: every task sends the sum over its own passages."""
        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(right.shape, np.float32)
            for b in batches:
                for *_, row, col, tf in _passages(b.column(0), WINDOW):
                    w = _weighted(row, col, tf, idf)
                    some, y = _times(row, col, w, right)
                    back = np.searchsorted(some, row)
                    order = np.argsort(col.astype(np.uint16) if len(column) <= 1 << 16 else col, kind="stable")  # short numbers are sorted by radix
                    ordered = col[order]
                    first = np.flatnonzero(np.concatenate(([True], np.diff(ordered) > 0))) if len(col) else np.zeros(0, np.int64)
                    if len(first):
                        out[ordered[first]] += np.add.reduceat(y[back[order]] * w[order, None], first, axis=0)
            used = np.flatnonzero(np.abs(out).sum(axis=1))
            for lo in range(0, len(used), 1 << 12):
                u = used[lo:lo + (1 << 12)]
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int32()), pa.array(list(out[u]), pa.list_(pa.float32()))], ["col", "v"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for c, v in zip(b.column(0).to_pylist(), b.column(1)):
                    x = v.values.to_numpy()
                    total[c] = total[c] + x if c in total else x.astype(np.float64)
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["col", "v"])

        some = rows.mapInArrow(multiply, "col int, v array<float>").repartition("col").mapInArrow(add, "col int, v array<double>")
        out = np.zeros(right.shape)
        for r in some.toLocalIterator():  # benchmark terms x rank numbers
            out[r["col"]] = r["v"]
        for c, w in item_rows:
            out[c] += w[:, None] * (w @ right[c])
        return out

    basis = np.zeros((len(column), 0), np.float32)
    if len(column):
        p = min(POWER, k // 2)
        # the other vectors are mixtures of the items, so that a few items in a large corpus are not lost
        mixed = np.zeros((len(column), k - p), np.float32)
        for (c, w), m in zip(item_rows, np.random.default_rng(seed + 1).standard_normal((len(ids), k - p))):
            mixed[c] += w[:, None] * m[None, :].astype(np.float32)
        drawn = np.random.default_rng(seed).standard_normal((len(column), p)).astype(np.float32)
        power = np.linalg.qr(gram(drawn))[0].astype(np.float32) if p else drawn
        basis = np.linalg.qr(np.concatenate((power, mixed), axis=1))[0].astype(np.float32)
    latent = np.stack([(w @ basis[c]) if len(c) else np.zeros(basis.shape[1], np.float32) for c, w in item_rows]) if ids else np.zeros((0, basis.shape[1]), np.float32)
    latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return Space(column, idf, basis, ids, words, latent)


def places(item: list[int]) -> dict[int, int]:
    """Of each word of an item the bits of its positions."""
    out: dict[int, int] = {}
    for j, x in enumerate(item):
        out[x] = out.get(x, 0) | 1 << j
    return out


def common_subsequence(a: list[int], where: dict[int, int], size: int) -> tuple[int, int]:
    """Length of the longest common subsequence with an item of so many words, and how much of it the last ``ANSWER`` words add.

    Bit-parallel: a zero in bit j says that the subsequence grows with the item's word j.
    """
    full = (1 << size) - 1
    v = full
    for x in a:
        m = where.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    grown = ~v & full
    return grown.bit_count(), (grown >> max(0, size - ANSWER)).bit_count()


def confirmed(text: list[int], where: dict[int, int], size: int) -> float:
    """The largest share of the item that a stretch of the text holds in order together with the answer; 0 below ``OVERLAP``."""
    long = int(STRETCH * size) + 1
    best = 0.0
    need = OVERLAP * size
    # words that the item does not have add nothing
    at = [i for i, x in enumerate(text) if x in where]
    if len(at) < need:
        return best
    own = [text[i] for i in at]
    if sum(min(k, where[x].bit_count()) for x, k in Counter(own).items()) < need:
        return best
    for lo in range(0, max(1, len(text) - long + max(1, size // 4)), max(1, size // 4)):
        part = own[bisect_left(at, lo):bisect_left(at, lo + long)]
        if len(part) < need or sum(min(k, where[x].bit_count()) for x, k in Counter(part).items()) < need:
            continue  # too few words, in whatever order
        n, answer = common_subsequence(part, where, size)
        if n >= need and 2 * answer >= min(ANSWER, size):
            best = max(best, n / size)
    return best


def least_cosine(size: int) -> float:
    """The cut for an item of so many words: ``COSINE``, and below ``SHORT`` words in proportion to the length; without words none reaches it."""
    return COSINE * min(1.0, size / SHORT) if size else 2.0


def least_shared(size: int) -> int:
    """Words of an item of so many words that some passage on every match of it has, repeats counted as often as in both.

    A stretch lies in that many passages end to end, counted from the better of the two half-overlapping rows.
    """
    long = int(STRETCH * size) + 1
    return -(-math.ceil(OVERLAP * size - 1e-9) // -(-(long + WINDOW // 2 - 1) // WINDOW))


def item_blocks(words: list[list[int]]) -> list[tuple[int, int]]:
    """Runs of items of bounded number and length."""
    out, lo, n = [], 0, 0
    for k, w in enumerate(words):
        if k > lo and (k - lo >= ITEMS_AT_ONCE or n + len(w) > WORDS_AT_ONCE):
            out.append((lo, k))
            lo, n = k, 0
        n += len(w)
    return out + [(lo, len(words))] if words else out


def word_table(words: list[list[int]], column: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, int]]:
    """(first entry of every column and the end, entries: item, how often it has the word, number of items), column by column."""
    n = max(1, len(words))
    sizes = [len(w) for w in words]
    flat = _columns(np.array([x for w in words for x in w], np.uint64), column)
    key, times = np.unique(flat * n + np.repeat(np.arange(len(words)), sizes), return_counts=True)
    return np.searchsorted(key, np.arange(len(column) + 1) * n), (key % n, np.minimum(times, WINDOW), len(words))


def shared_words(row: np.ndarray, col: np.ndarray, tf: np.ndarray, place: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Distinct passages x items: the words that both have, repeats counted as often as in both."""
    item, times, n = table
    new = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
    which = np.cumsum(new) - 1
    out = np.zeros(int(new.sum()) * n, np.int16)

    def add(which: np.ndarray, col: np.ndarray, tf: np.ndarray | None) -> None:
        """One for every entry of the columns, or what repeats add to it."""
        size = place[col + 1] - place[col]
        for lo, hi in _runs_of(size, 1 << 16):
            s = size[lo:hi]
            at = np.arange(int(s.sum())) + np.repeat(place[col[lo:hi]] - (np.cumsum(s) - s), s)
            first, last = int(which[lo]), int(which[hi - 1]) + 1
            cell = item[at] + np.repeat((which[lo:hi] - first) * n, s)
            more = None if tf is None else np.minimum(times[at], np.repeat(tf[lo:hi], s)) - 1
            out[first * n:last * n] += np.bincount(cell, weights=more, minlength=(last - first) * n).astype(np.int16)

    add(which, col, None)
    again = tf > 1
    add(which[again], col[again], tf[again])
    return out.reshape(-1, n)


def _runs_of(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of entries whose sizes add up to about ``most``."""
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def enough_around(shared: np.ndarray, owner: np.ndarray, size: int, which: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Of each passage (of ``which``) whether some stretch in or around it can hold ``OVERLAP`` of an item of so many words.

    ``shared`` are the words that the passages of the texts ``owner``, one after the other, share with the item.  A stretch
    lies in passages end to end, so these share what it holds; where they leave out the end of a text, its last passage has
    it, which therefore comes twice.  Beyond both ends of ``shared`` anything may follow.
    """
    if not len(shared):
        return np.zeros(0, bool)
    long = int(STRETCH * size) + 1
    step = WINDOW // 2
    reach, end_to_end = long // step + 3, -(-(long + step - 1) // WINDOW)
    pad = reach + 2 * end_to_end
    at = pad + np.arange(len(shared)) + owner - owner[0]
    s = np.full(at[-1] + 1 + pad, size, np.int32)
    s[pad:at[-1] + 1] = 0
    s[at] = shared
    last = np.flatnonzero(np.diff(owner))
    s[at[last] + 1] = shared[last]
    n = len(s) - 2 * (end_to_end - 1)
    held = np.zeros(n, np.int32)
    for j in range(end_to_end):
        held += s[2 * j:2 * j + n]
    good = np.zeros(n + 1, np.int32)
    np.cumsum(held >= math.ceil(OVERLAP * size - 1e-9), out=good[1:])
    at = at[which]
    return good[np.minimum(at + reach + 1, n)] > good[at - reach]


def search(texts: DataFrame, space: Space) -> DataFrame:
    """``(doc_id, text_key, item_id, cosine, overlap)``: one row per encoded text and item found in it (the best candidate).

    Documents and items without words match nothing.  An item without id is found with a NULL item_id.
    """
    held = texts.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = held.value
        bits = [places(_columns(np.array(w, np.uint64), sp.column).tolist()) for w in sp.words]
        cut = np.array([least_cosine(len(w)) for w in sp.words], np.float32)
        least = np.array([min(WINDOW, least_shared(len(w))) for w in sp.words], np.int16)
        blocks = item_blocks(sp.words)
        kept = word_table(sp.words, sp.column) if len(blocks) == 1 else None
        for b in batches:
            best: dict[tuple[int, int], tuple[float, float]] = {}
            for flat, counts, start, end, owner, row, col, tf in _passages(b.column(2)):
                weight = _weighted(row, col, tf, sp.idf)
                known = np.unique(row)  # passages with words of the benchmark
                text_end = np.cumsum(counts)
                for lo, hi in blocks:
                    shared = shared_words(row, col, tf, *(kept or word_table(sp.words[lo:hi], sp.column)))
                    alike = shared >= least[lo:hi]
                    # cosines of the passages that share words enough with some item
                    some = alike.any(axis=1)
                    mine = some[np.searchsorted(known, row)]
                    _, y = _times(row[mine], col[mine], weight[mine], sp.basis)
                    y = y / np.maximum(np.linalg.norm(y, axis=1), 1e-9)[:, None]
                    near = y @ sp.latent[lo:hi].T
                    ps, qs = np.nonzero((near >= cut[lo:hi]) & alike[some])
                    order = np.argsort(qs, kind="stable")
                    ps, qs = ps[order], qs[order]
                    ends = np.searchsorted(qs, np.arange(hi - lo + 1))
                    passage = known[some]
                    for q in np.unique(qs).tolist():
                        item, size = lo + q, len(sp.words[lo + q])
                        with_item = np.zeros(len(start), np.int32)
                        with_item[known] = shared[:, q]
                        mine = ps[ends[q]:ends[q + 1]]
                        mine = mine[enough_around(with_item, owner, size, passage[mine])]
                        # the item may begin or end in a neighbouring passage
                        long = int(STRETCH * size) + 1
                        for p in mine.tolist():
                            w = passage[p]
                            d = int(owner[w])
                            left, right = max(text_end[d] - counts[d], start[w] - long), min(text_end[d], end[w] + long)
                            share = confirmed(flat[left:right].tolist(), bits[item], size)
                            if share and share > best.get((d, item), (0.0, 0.0))[0]:
                                best[d, item] = (share, float(near[p, q]))
            if best:
                ids, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
                rows = [(ids[d], keys[d], sp.ids[i], c, s) for (d, i), (s, c) in sorted(best.items())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                                                 ["doc_id", "text_key", "item_id", "cosine", "overlap"])

    return texts.mapInArrow(run, "doc_id long, text_key long, item_id long, cosine double, overlap double")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, item_id, cosine, overlap)``: the benchmark items that the rows of ``docs`` hold.

    NULL and empty texts and items match nothing.  Repeated rows are answered each on its own; of several places of an
    item in a text the one with the largest overlap counts, then the first.  An empty table on either side gives an
    empty result; very long texts are searched whole, passage by passage.  Other columns are left out.
    """
    items = benchmark_items(benchmark, item_id_col, item_text_col)
    column = np.unique(items[1])
    texts = encoded(docs, column, id_col, text_col)
    return search(texts, fit(texts, items, column))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns unchanged, whatever their names.

    NULL and empty texts stay, and so does every row if there are no items.  Repeated rows share their fate.
    """
    bad = written(contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "contaminated")
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["__id"]) & (key == bad["__key"]), "left_anti")
