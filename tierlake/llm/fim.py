"""Fill-in-the-middle transformation with a sparse index of the characters that are not one byte long.

A text is cut twice and its parts are reordered around sentinels, so a left-to-right
model learns to fill the gap.  All slicing is done on UTF-8 bytes.  Where a cut
has to be known in code points too (or is given in them), ``Exceptions`` converts:
it records only the multibyte characters, each with its position and the excess
bytes up to it, and one ``searchsorted`` over those entries turns any number of
positions of either kind into the other.  ASCII spans have no entries; inside them
the conversion is the addition of a constant.  One index serves all texts of a
chunk, as positions count from the chunk's start.

The work is one pass over the rows without a shuffle; a lost task is repeated and
gives the same rows, because every choice comes from a hash of the row's id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import let, rows_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that are indexed together; a longer text is a chunk of its own.
AT_ONCE = 4 << 20
UNITS = ("token", "char")

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output string"


class Exceptions:
    """The multibyte characters of some UTF-8 bytes: position in bytes, position in code points, excess bytes before."""

    def __init__(self, data: np.ndarray) -> None:
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate((np.zeros(1, np.int64), np.cumsum(excess)))
        self.char = self.byte - self.before[:-1]

    def to_byte(self, chars: np.ndarray) -> np.ndarray:
        """Byte offsets of code-point offsets."""
        return chars + self.before[np.searchsorted(self.char, chars, side="left")]

    def to_char(self, offsets: np.ndarray) -> np.ndarray:
        """Code-point offsets of byte offsets (at the start of a character)."""
        return offsets - self.before[np.searchsorted(self.byte, offsets, side="left")]


def token_starts(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Byte offsets at which a token ``[A-Za-z]+|[^A-Za-z]`` starts; a token never runs over a border of two texts."""
    letter = ((data | 0x20) - 97).astype(np.uint8) < 26
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[borders[borders < len(data)]] = True
    return np.flatnonzero(start)


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from SHA-256 of ``seed:id``; a NULL id counts as an empty string."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[k:k + 8], 16) for k in (0, 8, 16, 24))


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    at = held = 0
    for k, n in enumerate(sizes.tolist()):
        if k > at and held + n > AT_ONCE:
            yield at, k
            at, held = k, 0
        held += n
    if len(sizes):
        yield at, len(sizes)


def _formed(ids: list, data: np.ndarray, offsets: np.ndarray, seed: int, unit: str, plain_percent: int, spm_percent: int) -> pa.RecordBatch:
    """The rows of texts that lie one after the other in ``data``."""
    index = Exceptions(data)
    lows, highs = offsets[:-1], offsets[1:]
    base = index.to_char(lows)
    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    if unit == "token":
        starts = np.concatenate((token_starts(data, lows[lows < highs]), [len(data)]))
        first = np.searchsorted(starts, lows)
        n = np.searchsorted(starts, highs) - first
        cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
        at = np.where(cuts < n[:, None], starts[np.minimum(first[:, None] + cuts, len(starts) - 1)], highs[:, None])
    else:
        n = index.to_char(highs) - base
        cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
        at = index.to_byte(base[:, None] + cuts)
    chars = index.to_char(at) - base[:, None]
    raw, p, s, m = data.tobytes(), PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    forms, outputs = [], []
    for lo, hi, (a, b), third, fourth in zip(lows.tolist(), highs.tolist(), at.tolist(), h[:, 2].tolist(), h[:, 3].tolist()):
        text = raw[lo:hi]
        a, b = a - lo, b - lo
        if not text or p in text or s in text or m in text or third % 100 >= 100 - plain_percent:
            forms.append("plain")
            outputs.append(text)
        elif fourth % 100 < spm_percent:
            forms.append("spm")
            outputs.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
    cut = ~np.array([f == "plain" for f in forms], bool)
    columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(forms, pa.string())]
    for lengths in (chars[:, 0], chars[:, 1] - chars[:, 0], at[:, 0] - lows, at[:, 1] - at[:, 0]):
        columns.append(pa.array(lengths, pa.int64(), mask=~cut))
    made = pa.array(outputs, pa.binary())
    columns.append(pa.Array.from_buffers(pa.string(), len(made), made.buffers()))
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"])


def transform(docs: DataFrame, seed: int = 1, unit: str = "token", plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text in one of three forms, one row per row of ``docs``.

    The two cuts are drawn between the ``n`` units of a text (``unit``: runs of ASCII letters and single other
    code points, or code points).  ``psm`` is prefix, suffix, middle behind their sentinels, ``spm`` is suffix,
    prefix, middle; ``plain`` is the text itself: empty texts, texts that hold a sentinel, and a share of
    ``plain_percent``.  Lengths of prefix and middle come in code points and in bytes, NULL for plain rows.

    NULL texts count as empty.  A NULL id draws from an empty string; equal ids draw alike, so repeated rows
    give equal results.  An empty table gives an empty result.  Very long texts are a chunk of their own and are
    never cut short.  Other columns of the table, whatever their names, are left out.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column(1).cast(pa.large_binary())
            _, ends, held = texts.buffers()
            offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
            ids = whole.column(0).to_pylist()
            for lo, hi in _chunks(np.diff(offsets)):
                own = offsets[lo:hi + 1]
                yield _formed(ids[lo:hi], data[own[0]:own[-1]], own - own[0], seed, unit, plain_percent, spm_percent)

    return rows_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def restored(output: Column | str, form: Column | str) -> Column:
    """The exact text that ``transform`` made an output of; NULL if either is NULL."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    marks = "|".join(re.escape(x) for x in (PREFIX, SUFFIX, MIDDLE))

    def order(parts: Column) -> Column:  # behind the first mark, the second and the third
        return F.when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))) \
            .otherwise(F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))

    return F.when(form == "plain", output).when(form.isNotNull(), let(F.split(output, marks, -1), order))


#: DuckDB SQL for ``transform`` with its defaults, as digests.
ORACLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS k,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, t, k, len(k) AS n,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(k) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(k) + 1) AS c2,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS c4
  FROM cut),
parts AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 90 THEN 'plain'
              WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(k[1:least(c1, c2)], '') AS p,
         array_to_string(k[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(k[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
