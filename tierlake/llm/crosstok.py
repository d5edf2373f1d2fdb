"""Alignment of two tokenizations of the same bytes: byte-level BPE ids (A) and SentencePiece ids (B).

Both sides of a text are ranges over the same bytes, so they are aligned by position.  Per batch, ``pandas.merge_asof``
keyed by document finds for each token's start the token of the other side that covers it; both directions together are
all overlaps.  Overlaps that end together are links, and the ends that both sides share cut the tokens into groups.

How often an id pair is linked in the whole corpus needs a second step.  Tokens that end together read the same bytes up
to there, so one is a suffix of the other: the pairs that can ever be linked follow from the two vocabularies alone and
number at most the sum of their tokens' lengths (``linkable``), whatever the corpus.  Links are stored as positions in
that list, every task sums its own with ``bincount`` before the shuffle, and the counts that go back to the tasks have a
size that the vocabularies bound.

The texts are encoded once; their links are written to the shared folder and read twice (counts, results), so a lost
executor repeats only its own part.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.base import rows_of, written

#: Bytes of text that are aligned together, and bytes that are given to a tokenizer at once.
AT_ONCE = 1 << 20
LOT = 1 << 16
#: So many units are remembered before all are forgotten (or so many bytes of them: 16 times ``AT_ONCE``).
MOST_KNOWN = 1 << 19
#: The end of a unit after which a space starts a new word: a visible character that is no space of several bytes.
VISIBLE = re.compile(rb"[\x21-\x7e]\Z|(?<!\xc2)(?<![\xe1-\xe3][\x80\x81\x9a])[\x80-\xff]\Z")
SPACE = "▁"

LINKS = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def file_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file: of the driver if the path has no scheme, else by Spark's reader."""
    if "://" in path or path.startswith("file:"):
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as f:
        return f.read()


def byte_letters() -> dict[str, int]:
    """The letters that byte-level BPE writes for bytes: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Sides:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters, words = byte_letters(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(words.values()) + 1)
        for w, i in words.items():
            self.a_bytes[i] = bytes(letters[c] for c in w) if all(c in letters for c in w) else w.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if not all(self.a_bytes) or not all(self.b_bytes):
            raise ValueError("a token without bytes cannot be placed")
        #: No piece goes on over the start of a word, so a text may be encoded in units that start there; A's
        #: words never go on from a visible character to a space.
        self.parts_ok = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.a_table, self.b_table = pa.array(self.a_bytes, pa.binary()), pa.array(self.b_bytes, pa.binary())
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self._forget()
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = pa.array([f"{i}{s}" for s in ",|;" for i in range(self.most)], pa.string())

    def units(self, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """Offsets that cut ``data`` at the borders and before each space that follows a visible character."""
        if not self.parts_ok:
            return borders
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (data[1:] == 32) & (data[:-1] > 32) & (data[:-1] != 127)
        wide = np.flatnonzero(cut[1:-1] & (data[:-1] >= 0x80)) + 1  # the character may be a space of its own
        before, lead = data[wide - 2], data[np.maximum(wide - 3, 0)]
        cut[wide[(before == 0xC2) | ((lead >= 0xE1) & (lead <= 0xE3) & ((before == 0x80) | (before == 0x81) | (before == 0x9A)))]] = False
        cut[borders[1:] - 1] = False  # B adds no space to an empty rest
        cut[borders] = True
        return np.flatnonzero(cut)

    def _a_said(self, lots: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all units of the lots, one after the other, and how many each unit has; a lot is encoded as one text."""
        texts = [b"".join(x) for x in lots]
        flat = [np.array(x.ids, np.int64) for x in self.a.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
        counts = []
        for text, lot, ids in zip(texts, lots, flat):
            if len(lot) == 1:
                counts.append([len(ids)])
                continue
            ends = np.cumsum(self.a_size[ids])
            if not len(ids) or ends[-1] != len(text) or _joined(self.a_table, ids) != text:
                return self._a_said([[u] for x in lots for u in x])  # tokens that are not the bytes have no places
            counts.append(np.diff(np.concatenate(([0], np.searchsorted(ends, np.cumsum(list(map(len, lot))), side="right")))))
        return np.concatenate(flat), np.concatenate(counts)

    def _b_said(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.b.encode([u[1:].decode("utf-8", "replace") for u in units], num_threads=1)
        return np.fromiter(chain.from_iterable(found), np.int64), np.fromiter(map(len, found), np.int64, len(found))

    def _learn(self, units: list[bytes]) -> None:
        """Encode units and remember them.  A gets units that end visibly many at a time, the others alone."""
        plain = np.array([VISIBLE.search(u) is not None for u in units])
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain))).tolist()
        self.known.update(zip((units[k] for k in order), range(len(self.known), len(self.known) + len(units))))
        lots = [*_lots([units[k] for k in np.flatnonzero(plain)]), *([units[k]] for k in np.flatnonzero(~plain))]
        while lots:
            end = held = 0
            while end < len(lots) and held < LOT:
                held += sum(map(len, lots[end]))
                end += 1
            now, lots = lots[:end], lots[end:]
            for side, (flat, counts) in enumerate((self._a_said(now), self._b_said([u for x in now for u in x]))):
                self.ids[side].append(flat.astype(np.int32))
                self.counts[side].append(counts.astype(np.int32))
        for side in (0, 1):
            self.ids[side], self.counts[side] = [np.concatenate(self.ids[side])], [np.concatenate(self.counts[side])]

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.ids, self.counts = ([[np.zeros(0, np.int32)] for _ in "ab"] for _ in "xy")

    def encoded(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of either side of texts that begin with the added space, one after the other, and how many each text has."""
        joined = b"".join(raws)
        borders = np.concatenate(([0], np.cumsum(list(map(len, raws)))))
        ends = self.units(np.frombuffer(joined, np.uint8), borders)
        units = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(joined)]).dictionary_encode()
        if len(self.known) > MOST_KNOWN or self.known_bytes > 16 * AT_ONCE:
            self._forget()
        distinct = units.dictionary.to_pylist()
        if new := [u for u in distinct if u not in self.known]:
            self.known_bytes += sum(map(len, new))
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        at = place[units.indices.to_numpy()]
        upto = np.searchsorted(ends, borders)
        out = []
        for (flat,), (n,) in zip(self.ids, self.counts):
            first = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
            size = n[at].astype(np.int64)
            last = np.cumsum(size)
            ids = flat[np.arange(last[-1]) + np.repeat(first[at] - (last - size), size)].astype(np.int64)
            out += [ids, np.diff(np.concatenate(([0], last))[upto])]
        return out[0], out[2], out[1], out[3]

    def linkable(self) -> np.ndarray:
        """All pairs ``a * len(b) + b`` of which one token's bytes end in the other's, ascending."""
        by_a, by_b = defaultdict(list), defaultdict(list)
        for by, tokens in ((by_a, self.a_bytes), (by_b, self.b_bytes)):
            for i, t in enumerate(tokens):
                by[t].append(i)
        pairs = [(a, b) for a, t in enumerate(self.a_bytes) for k in range(len(t)) for b in by_b.get(t[k:], ())]
        pairs += [(a, b) for b, t in enumerate(self.b_bytes) for k in range(1, len(t)) for a in by_a.get(t[k:], ())]
        found = np.array(pairs, np.int64).reshape(-1, 2)
        return np.unique(found[:, 0] * len(self.b_bytes) + found[:, 1])


def _lots(units: list[bytes]) -> Iterator[list[bytes]]:
    """Lists of at most ``LOT`` bytes, or of one unit."""
    lot, held = [], 0
    for u in units:
        if lot and held + len(u) > LOT:
            yield lot
            lot, held = [], 0
        lot.append(u)
        held += len(u)
    if lot:
        yield lot


def _joined(table: pa.Array, ids: np.ndarray) -> memoryview:
    """The bytes of some tokens."""
    buffer = pc.take(table, pa.array(ids)).buffers()[2]
    return memoryview(buffer).cast("B") if buffer is not None else memoryview(b"")


def covering(left: np.ndarray, left_doc: np.ndarray, right: np.ndarray, right_doc: np.ndarray) -> np.ndarray:
    """For each start on the left the token of the right side, in the same document, that covers it."""
    here = pd.DataFrame({"at": left, "doc": left_doc})
    there = pd.DataFrame({"at": right, "doc": right_doc, "token": np.arange(len(right))})
    return pd.merge_asof(here, there, on="at", by="doc", direction="backward")["token"].to_numpy(np.int64)


def overlaps(a_end: np.ndarray, a_size: np.ndarray, a_doc: np.ndarray, b_end: np.ndarray, b_size: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose byte ranges share a byte, each once."""
    a_at, b_at = a_end - a_size, b_end - b_size
    to_b, to_a = covering(a_at, a_doc, b_at, b_doc), covering(b_at, b_doc, a_at, a_doc)
    new = a_at[to_a] != b_at  # equal starts were found from the A side already
    return np.concatenate((np.arange(len(a_at)), to_a[new])), np.concatenate((to_b, np.flatnonzero(new)))


def _aligned(sides: Sides, pairs: np.ndarray, ids: list, texts: list[str | None]) -> pa.RecordBatch:
    n = len(texts)
    whole = [k for k, t in enumerate(texts) if t]
    a_n, b_n, n_groups = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    digests, links, first = [""] * n, np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    if whole:
        raws = [b" " + texts[k].encode() for k in whole]
        a, b, a_own, b_own = sides.encoded(raws)
        size = np.array(list(map(len, raws)), np.int64)
        same = _same(raws, size, _joined(sides.a_table, a), sides.a_size[a], a_own) & _same(raws, size, _joined(sides.b_table, b), sides.b_size[b], b_own)
        kept = np.array(whole, np.int64)[same]
        a, b = a[np.repeat(same, a_own)], b[np.repeat(same, b_own)]
        a_n[kept], b_n[kept] = a_own[same], b_own[same]
    if whole and len(a):
        a_doc, b_doc = np.repeat(kept, a_own[same]), np.repeat(kept, b_own[same])
        a_size, b_size = sides.a_size[a], sides.b_size[b]
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)  # both sides of the kept texts hold the same bytes
        i, j = overlaps(a_end, a_size, a_doc, b_end, b_size, b_doc)
        together = a_end[i] == b_end[j]
        i, j = i[together], j[together]
        i, j = (x[np.argsort(a_end[i], kind="stable")] for x in (i, j))
        code = a[i] * len(sides.b_bytes) + b[j]
        links = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1).astype(np.int32)
        if not np.array_equal(pairs[links], code):
            raise ValueError("linked tokens whose bytes do not end alike")
        n_groups = np.bincount(a_doc[i], minlength=n)  # every shared end is the end of one link
        first = np.concatenate(([0], np.cumsum(n_groups)))
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[i], b_last[j] = 1, 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        code = np.empty(len(a) + len(b), np.int64)  # the ids in the order in which a group says them, each with what follows it
        code[np.arange(len(a)) + np.concatenate(([0], j + 1))[a_group]] = a + sides.most * a_last
        code[np.arange(len(b)) + (i + 1)[b_group]] = b + 2 * sides.most * b_last
        said = pc.take(sides.digits, pa.array(code))
        _, ends, data = said.buffers()
        ends, data = np.frombuffer(ends, np.int32), memoryview(data)
        upto = np.concatenate(([0], np.cumsum(a_n + b_n)))
        for k in kept.tolist():
            digests[k] = hashlib.sha256(data[ends[upto[k]]:ends[upto[k + 1]] - 1]).hexdigest()
    listed = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(links, pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a_n), pa.array(b_n), pa.array(n_groups), pa.array(digests, pa.string()), listed],
                                      ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])


def _same(raws: list[bytes], size: np.ndarray, joined: memoryview, token_size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of each text whether its joined tokens are its bytes."""
    ends = np.concatenate(([0], np.cumsum(token_size)))[np.concatenate(([0], np.cumsum(own)))]
    out = np.diff(ends) == size
    for k in np.flatnonzero(out).tolist():
        out[k] = joined[ends[k]:ends[k + 1]] == raws[k]
    return out


_SIDES: dict = {}


def _sides(files) -> Sides:
    """The tokenizers of a broadcast pair of files, made once in each Python process."""
    key = tuple(hashlib.sha256(x).digest() for x in files)
    if key not in _SIDES:
        _SIDES.clear()
        _SIDES[key] = Sides(*files)
    return _SIDES[key]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at = held = 0
    for k, n in enumerate(sizes):
        if k > at and held + n > AT_ONCE:
            yield at, k
            at, held = k, 0
        held += n
    if sizes:
        yield at, len(sizes)


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Sides, np.ndarray]:
    """Per row the token counts, the groups' digest and the links as positions in the returned list of linkable pairs."""
    spark = docs.sparkSession
    files = (file_bytes(spark, a_path), file_bytes(spark, b_path))
    sides = _sides(files)
    pairs = sides.linkable()
    held = spark.sparkContext.broadcast((files, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, pairs = held.value
        sides = _sides(files)
        for batch in batches:
            for lo, hi in _slices(batch.column(1)):
                yield _aligned(sides, pairs, batch.column(0)[lo:hi].to_pylist(), batch.column(1)[lo:hi].to_pylist())

    return rows_of(docs, id_col, text_col).mapInArrow(run, LINKS), sides, pairs


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``RESULT``: one row per row of ``docs``.

    A encodes a space and the text, B the text (its model adds the space), both without special tokens; strings that
    look like such tokens are plain text.  ``n_best`` counts the links whose pair is linked most often, in the whole
    table, among the pairs of its B id (ties included); ``count_sum`` sums the counts of the links' pairs;
    ``groups_sha256`` is the digest of ``a1,a2|b1;a3|b2,b3``.

    NULL and empty texts, and texts that either side does not give back byte for byte, have no tokens: zeros and an
    empty digest.  Repeated rows count each time; NULL ids stay.  A text is encoded by its units, cut before the spaces
    that follow a visible character, which gives the same ids; equal units of a batch are encoded once, and long texts
    never pass a tokenizer whole unless they have no spaces.  An empty table gives an empty result.  Other columns,
    whatever their names, are left out.
    """
    found, sides, pairs = links(docs, a_path, b_path, id_col, text_col)
    found = written(found, "token-links")
    spark, n_pairs = docs.sparkSession, len(pairs)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=n_pairs)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["pair", "n"])

    # at most n_pairs rows, which the vocabularies bound
    counted = found.select("links").mapInArrow(summed, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(n_pairs, np.int64)
    counts[counted["pair"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    highest = np.zeros(len(sides.b_bytes), np.int64)
    np.maximum.at(highest, pairs % len(sides.b_bytes), counts)
    held = spark.sparkContext.broadcast((counts, counts == highest[pairs % len(sides.b_bytes)]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = held.value
        for b in batches:
            own = b.column(5)
            n = pc.list_value_length(own).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = own.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(n)))
            sums = [np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(x[flat], dtype=np.int64)))[ends]) for x in (best, counts)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n), pa.array(sums[0]), pa.array(sums[1]), b.column(4)],
                                             ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return found.mapInArrow(scored, RESULT)
