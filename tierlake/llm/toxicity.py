"""Toxicity scores over text restored by a noisy channel.

Writers hide words by leetspeak (``1d1ot``), by spacing (``i d i o t``,
``i.d.i.o.t``) and by repetition (``idiooot``).  Each suspicious token is read as
a lattice: a written character stands for itself or for a letter of ``LEET``,
a run of one letter stands for one or two of it; a written separator may vanish
or be a border between words, also between fragments of several letters.
Viterbi decoding picks the letters with the highest channel and language model
score; the restored text is scored.

Language model: character trigrams (with word boundaries) over the clean words
of all documents, counted in one pass into a table.  Every task holds the probabilities
of grams over a to z and the most frequent letters (all grams, if there are few); texts with
other letters are decoded group by group, each with the grams of the table that it asks for.

Scorer: naive Bayes over the presence of restored words and of their first 4, 5
and 6 letters (a word counts by its most telling part), for and against label 1,
with those parts whose counts differ between the labels beyond chance, calibrated by a logistic curve; fitted on a
bounded sample of labelled rows of the training part, of which near copies (the
same smallest shingle hash and label) count once.  Labels, language, source and
id are never features.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from string import ascii_lowercase
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import rows_of, written
from tierlake.llm.shingles import Powers, shingle_hashes

# fixed values: what a written character may stand for besides itself
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i"}
SAMPLE = 20_000
BUCKETS = 1 << 22
#: Grams that every task holds; the others are joined to the texts that ask for them, in groups of about so many characters.
RESIDENT, GROUP_CHARS = 200_000, 1_000_000
#: Grams of a task's count that wait for the next message.
PENDING = 500_000
#: A part takes part from so many rows on, and if its counts differ from the labels' share by this log-likelihood ratio (about 1 in 1000 by chance).
LEAST_DOCS, LEAST_G = 3, 10.8
PREFIXES = (4, 5, 6)
CACHE_WORDS, CACHE_CHARS = 200_000, 64
#: Log costs of the channel: another letter for a sign, a dropped repeat.
SWAP, DROP = -1.0, -0.5
EDGE = "^"

# tokens are letters and digits, also with signs between them, and lone signs in front of what may stand inside a spelled-out word
_LONE = re.compile(r"[@$|+€£¡!](?=[ \t.\-_*·~]+\w)")
_SEPARATORS = " \t.-_*·~"
_LETTER = re.compile(r"[^\W\d_]")
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1\1")
_SIGNS = "@$!|+€£¡"
_TRIM = "\"'()[]{}<>.,;:?*#%&^~`=/\\-_"


def plain_words(text: str) -> list[str]:
    return _PLAIN.findall(text.lower())


@dataclass
class LanguageModel:
    """Log probabilities of character trigrams with linear backing off."""
    three: dict[str, float]
    two: dict[str, float]
    one: dict[str, float]
    letters: frozenset[str] | None = None  # the letters whose grams are here; None: all
    name: str = field(default_factory=lambda: uuid.uuid4().hex)  # the same in all tasks

    def knows(self, text: str) -> bool:
        """Whether all grams that a text may ask for are here."""
        return self.letters is None or all(c in self.letters for c in set(text.lower()) if c.isalpha())

    def score(self, a: str, b: str, c: str) -> float:
        got = self.three.get(a + b + c)
        if got is not None:
            return got
        got = self.two.get(b + c)
        if got is not None:
            return got - 1.0
        return self.one.get(c, -14.0) - 2.0


class Asked(LanguageModel):
    """Notes the grams that a search asks for; what a search asks for does not hang on the answers."""

    def __init__(self, letters: frozenset[str]):
        super().__init__({}, {}, {}, letters)
        self.grams: set[str] = set()

    def score(self, a: str, b: str, c: str) -> float:
        self.grams.update((a + b + c, b + c, c))
        return 0.0


def chances(grams: DataFrame) -> DataFrame:
    """``(gram, n, among, places)`` of all trigrams, bigrams and letters: count, count of what they are a share of, code points."""
    three = grams.withColumn("ahead", F.shiftright("gram", 21)).withColumn("pair", F.col("gram").bitwiseAND((1 << 42) - 1))
    pairs = three.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("before", F.shiftright("pair", 21))
    one = three.groupBy(F.col("gram").bitwiseAND((1 << 21) - 1).alias("gram")).agg(F.sum("n").alias("n"))
    # a trigram seen once backs off
    longest = three.join(three.groupBy("ahead").agg(F.sum("n").alias("among")), "ahead").where("n > 1").select("gram", "n", "among", F.lit(3).alias("places"))
    middle = pairs.join(pairs.groupBy("before").agg(F.sum("n").alias("among")), "before").select(F.col("pair").alias("gram"), "n", "among", F.lit(2).alias("places"))
    letters = one.crossJoin(F.broadcast(one.agg(F.sum("n").alias("among")))).select("gram", "n", "among", F.lit(1).alias("places"))
    return longest.unionByName(middle).unionByName(letters)


def gram_text(gram: int, places: int) -> str:
    return "".join(chr(gram >> 21 * k & 0x1FFFFF) for k in range(places - 1, -1, -1))


def model_of(rows: Iterable, letters: frozenset[str] | None = None, base: LanguageModel | None = None) -> LanguageModel:
    """From rows of ``(gram, n, among, places)``, added to those of another model."""
    held = [dict(x) for x in (base.one, base.two, base.three)] if base else [{}, {}, {}]
    for gram, n, among, places in rows:
        held[places - 1][gram_text(gram, places)] = float(np.log(n / among))
    return LanguageModel(held[2], held[1], held[0], letters)


def language_model(grams: DataFrame) -> LanguageModel:
    """The grams that every task holds: all, or those of a to z and the most frequent other letters, about ``RESIDENT``."""
    return resident(written(chances(grams), "toxic-chances"))


def resident(table: DataFrame) -> LanguageModel:
    if table.count() <= RESIDENT:
        return model_of(table.collect())
    # at most one row per letter of Unicode
    points = [r["gram"] for r in table.where("places = 1").orderBy(F.desc("n"), "gram").select("gram").collect()]
    always = [ord(c) for c in sorted({EDGE, *ascii_lowercase, *"".join(LEET.values())})]
    order = list(dict.fromkeys(always + points))
    rank = np.zeros(0x110000, np.int32)
    rank[order] = np.arange(len(order))

    @F.pandas_udf("int")
    def highest(gram: pd.Series) -> pd.Series:
        g = gram.to_numpy(np.int64)
        return pd.Series(np.maximum.reduce([rank[g >> s & 0x1FFFFF] for s in (42, 21, 0)]))

    ranked = table.withColumn("rank", highest("gram"))
    last, total = len(always) - 1, 0
    for r in ranked.groupBy("rank").count().orderBy("rank").collect():
        total += r["count"]
        if total <= RESIDENT:
            last = max(last, r["rank"])
    got = ranked.where(F.col("rank") <= last).select(*table.columns).collect()
    return model_of(got, frozenset(chr(c) for c in order[:last + 1]))


def readings(c: str) -> list[tuple[str, float]]:
    """What one written character may stand for, with the channel's cost."""
    own = [(c, 0.0)] if c.isalpha() else []
    return own + [(x, SWAP) for x in LEET.get(c, "")]


def decode(token: str, lm: LanguageModel, before: str = "", after: str = "") -> str:
    """The most likely letters behind written characters (lower case); a space may vanish or be a border between words.

    ``before`` and ``after`` are letters that stand fixed on both sides: the last two of the word before and the first two of the word after.
    """
    runs: list[tuple[str, int]] = []
    for c in token:
        if runs and runs[-1][0] == c:
            runs[-1] = (c, runs[-1][1] + 1)
        elif c == " " or readings(c):
            runs.append((c, 1))
    # state: the last two letters -> (score, letters as a chain from the last one)
    first = ((EDGE + before)[-2], before[-1]) if before else (EDGE, EDGE)
    beam: dict[tuple[str, str], tuple[float, tuple]] = {first: (0.0, ())}
    score_of = lm.score
    for k, (c, n) in enumerate(runs):
        picks = [(x, times, cost * min(n, 2), DROP if times < n else 0.0) for x, cost in readings(c) for times in ((1, 2) if n > 1 else (1,))]
        new: dict[tuple[str, str], tuple[float, tuple]] = {}
        again = k > 1 and runs[k - 1][0] == " " and runs[k - 2][0] == c  # a repeat with separators inside
        for (a, b), (score, text) in beam.items():
            if c == " ":
                options = [((a, b), score, text), ((EDGE, EDGE), score + lm.score(a, b, EDGE), (" ", text))]
            else:
                options = [((a, b), score + DROP, text)] if again and b != EDGE else []
                for x, times, cost, drop in picks:
                    s = score + cost + drop + score_of(a, b, x)
                    if times == 1:
                        options.append(((b, x), s, (x, text)))
                    else:
                        options.append(((x, x), s + score_of(b, x, x), (x + x, text)))
            for state, s, chain in options:
                if state not in new or s > new[state][0]:
                    new[state] = (s, chain)
        beam = new
    ends = []
    for (p, q), (s, chain) in beam.items():
        for x in after or EDGE:
            s += lm.score(p, q, x)
            p, q = q, x
        out = []
        while chain:
            out.append(chain[0])
            chain = chain[1]
        ends.append((s, "".join(reversed(out))))
    return max(ends)[1]


def suspicious(token: str) -> bool:
    """Letters mixed with digits or signs that stand for letters, or a character three times in a row."""
    return bool(_LETTER.search(token)) and (not LEET.keys().isdisjoint(token) or bool(_RUN.search(token)))


def restored_words(text: str, lm: LanguageModel, cache: dict[str, str]) -> set[str]:
    """The distinct words of a text as written, and the restored forms of the suspicious ones."""
    low = text.lower()
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds(code)
    start, end = _places(low, kind)
    split = _cut(low, code, start, end)
    tokens = set(split)  # every letter is part of one
    words = set(filter(str.isalpha, tokens))
    others = tokens - words
    for t in others:
        words.update(_PLAIN.findall(t))
    odd: set[str] = set()
    third = np.flatnonzero((code[:-2] == code[1:-1]) & (code[1:-1] == code[2:]) & (kind[2:] & SPACE == 0))
    runs = [3 * chr(c) for c in sorted(set(code[third].tolist()))]
    at = np.concatenate([third, np.flatnonzero(kind & SWAPPED)])
    if len(at):
        edge = np.flatnonzero(np.diff(kind & SPACE == 0, prepend=False, append=False))
        spans = edge.reshape(-1, 2)[np.unique(np.searchsorted(edge[::2], at, "right") - 1)]
        parted = {low[a:b] for a, b in spans.tolist()}
        parted = {s for t in parted if not t.isalpha() for s in (t.strip(_TRIM), t.strip(_TRIM + _SIGNS))}
        odd = {s for s in parted if suspicious(s)}
    for r in runs:
        if r.isalnum():
            odd |= {w for w in words if r in w}
            others |= {t for t in tokens if r in t}
    others.update(split[k] for k in np.flatnonzero(end - start == 1).tolist())
    for t in odd:
        got = _decoded(t, "", "", lm, cache)
        if got:
            words.add(got)
    words.update(joined_words(code, kind, start, end, split, others, lm, cache))
    return words


#: What characters are, by code point; 0: not looked at yet.
_KINDS = np.zeros(0x110000, np.uint8)
SEEN, INSIDE, SIGN, SEPARATOR, SPACE, SWAPPED = (1 << k for k in range(6))


def _kinds(code: np.ndarray) -> np.ndarray:
    got = _KINDS[code]
    if not got.all():
        for x in np.unique(code[got == 0]).tolist():
            c = chr(x)
            _KINDS[x] = SEEN | INSIDE * c.isalnum() | SIGN * (c in _SIGNS) | SEPARATOR * (c in _SEPARATORS) | SPACE * c.isspace() | SWAPPED * (c in LEET)
        got = _KINDS[code]
    return got


def _places(text: str, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of a text begin and end."""
    edge = np.flatnonzero(np.diff(kind & INSIDE > 0, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    sign = kind & SIGN > 0
    if sign.any():
        signs = np.concatenate([[0], np.cumsum(sign)])
        apart = signs[start[1:]] - signs[end[:-1]] < start[1:] - end[:-1]
        start, end = (start[np.append(True, apart)], end[np.append(apart, True)]) if len(start) else (start, end)
        lone = np.flatnonzero(sign[:-1] & (kind[1:] & SEPARATOR > 0))
        lone = np.array([k for k in lone.tolist() if _LONE.match(text, k)], np.int64)
        start, end = np.sort(np.concatenate([start, lone])), np.sort(np.concatenate([end, lone + 1]))
    return start, end


def _cut(text: str, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    """The tokens of a text."""
    if (start[1:] == end[:-1]).any():
        return [text[a:b] for a, b in zip(start.tolist(), end.tolist())]
    edge = np.zeros(len(code) + 1, np.int8)
    edge[start], edge[end] = 1, -1
    kept = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, code, np.uint32(32))
    return kept.tobytes().decode("utf-32-le", "surrogatepass").split()


#: Decodings of one model that the tasks of a worker share.
_SHARED: dict[str, dict[str, str]] = {}


def _cache_of(lm: LanguageModel) -> dict[str, str]:
    if lm.name not in _SHARED:
        _SHARED.clear()
    return _SHARED.setdefault(lm.name, {})


def _decoded(token: str, before: str, after: str, lm: LanguageModel, cache: dict[str, str]) -> str:
    key = f"{before}\t{token}\t{after}"
    got = cache.get(key)
    if got is None:
        if len(cache) >= CACHE_WORDS:
            cache.clear()
        got = decode(token, lm, before, after)
        if len(key) <= CACHE_CHARS:
            cache[key] = got
    return got


class Borders:
    """Whether a separator stays (1) or vanishes (2) between two words of two letters or more, 0 if not known yet, by the
    last two letters of one and the first two of the other; of the first 63 letters met, which the four places number from 1."""
    def __init__(self):
        self.place, self.letters = np.zeros(0x110000, np.int32), 0
        self.known = np.zeros(1 << 24, np.uint8)

    def cells(self, around: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The cell of four letters, and whether all of them have a number."""
        got = [self.place[x] for x in around]
        numbered = got[0] * got[1] * got[2] * got[3] > 0
        if self.letters < 63 and not numbered.all():
            for c in np.unique(np.concatenate([x[g == 0] for x, g in zip(around, got)])).tolist():
                if self.letters < 63:
                    self.letters += 1
                    self.place[c] = self.letters
            got = [self.place[x] for x in around]
            numbered = got[0] * got[1] * got[2] * got[3] > 0
        return got[0] << 18 | got[1] << 12 | got[2] << 6 | got[3], numbered


#: Borders of one model that the tasks of a worker share.
_BORDERS: dict[str, Borders] = {}


def _borders_of(lm: LanguageModel) -> Borders:
    if lm.name not in _BORDERS:
        _BORDERS.clear()
    return _BORDERS.get(lm.name) or _BORDERS.setdefault(lm.name, Borders())


def joined_words(code: np.ndarray, kind: np.ndarray, start: np.ndarray, end: np.ndarray, tokens: list[str], others: set[str], lm: LanguageModel,
                 cache: dict[str, str]) -> set[str]:
    """The words of a text with tokens at ``start`` to ``end`` once its separators are read as borders or vanish.

    A trigram reaches over one separator only, so one between two words of two letters or more is
    decided by the two letters on each side; the ``others``, single characters and suspicious tokens, are decoded
    together with the letters around them.  Numbers of several digits part words.
    """
    if not tokens:
        return set()
    # a gap with anything but separators always parts words
    parting = np.concatenate([[0], np.cumsum(kind & SEPARATOR == 0)])
    apart = parting[start[1:]] > parting[end[:-1]]
    at = [k for k, t in enumerate(tokens) if t in others] if others else []
    plain = np.ones(len(tokens), bool)
    plain[at] = False
    own = np.flatnonzero(plain[:-1] & plain[1:] & ~apart)
    last, first = end[own], start[own + 1]
    borders = _borders_of(lm)
    cell, numbered = borders.cells([code[last - 2], code[last - 1], code[first], code[first + 1]])
    got = np.where(numbered, borders.known[cell], 0)
    for j in np.flatnonzero(got == 0).tolist():
        k = int(own[j])
        got[j] = numbered[j] and borders.known[cell[j]]
        if not got[j]:
            got[j] = 1 if _decoded(" ", tokens[k][-2:], tokens[k + 1][:2], lm, cache) else 2
            if numbered[j]:
                borders.known[cell[j]] = got[j]
    gone = np.zeros(len(tokens) - 1, bool)
    gone[own] = got == 2
    between = ["" if x else " " for x in gone.tolist()]
    hard, begun, all_done = apart.tolist(), False, set()
    # each run of other tokens gives way to what stands for it and the separators around it
    for k, follows in zip(at, at[1:] + [0]):
        token, tokens[k] = tokens[k], ""
        if not begun:
            soft = k > 0 and not hard[k - 1]
            before, done = (tokens[k - 1][-2:], "") if soft else ("", " ")
            pending: list[str] = []
        number = len(token) > 1 and token.isdigit()
        if number or begun and hard[k - 1]:
            if pending:
                done += _around(pending, before, "", lm, cache)
            before, done = "", done + " "
        if not number:
            pending.append(token)
        begun = follows == k + 1
        if not begun:
            after = tokens[k + 1][:2] if k + 1 < len(tokens) and not hard[k] else ""
            if pending:
                done += _around(pending, before, after, lm, cache)
            tokens[k] = done if after else done + " "
            all_done.add(done)
        if k > 0:
            between[k - 1] = ""
        if k < len(between):
            between[k] = ""
    parts = [""] * (len(tokens) + len(between))
    parts[::2], parts[1::2] = tokens, between
    single = {w for done in all_done for w in done.split(" ") if len(w) < 2}
    return set("".join(parts).split(" ")) - single - {""}


def _around(pending: list[str], before: str, after: str, lm: LanguageModel, cache: dict[str, str]) -> str:
    """What stands for the pending tokens, which it settles, and for the separators around them."""
    text = " ".join(pending)
    pending.clear()
    return _decoded((" " if before else "") + text + (" " if after else ""), before, after, lm, cache)


def gather(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Character trigram counts ``(gram, n)`` over the plain words of all documents; a gram is three code points of 21 bits."""
    def rows(total: dict[int, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # letters up to U+00FF are counted in a table, grams with others one by one
        known = [EDGE] + [chr(c) for c in range(256) if chr(c).isalpha() and chr(c).lower() == chr(c)]
        place = np.array([-1 if _LETTER.match(chr(c)) else 0 for c in range(256)], np.int32)
        place[[ord(c) for c in known]] = np.arange(len(known))
        size = len(known)
        table, total = np.zeros(size ** 3, np.int64), {}
        for b in batches:
            for at in range(0, b.num_rows, 64):
                # two borders before the first letter, one behind the last
                line = f"  {'  '.join(b.column(0).slice(at, 64).to_pylist()).lower()} "
                code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
                cell = place[np.minimum(code, 255)]
                others = np.flatnonzero(code > 255)
                points, which = np.unique(code[others], return_inverse=True)
                cell[others] = np.array([-1 if _LETTER.match(chr(x)) else 0 for x in points.tolist()], np.int32)[which]
                letter = cell != 0
                # every letter with the two before it, as far as they are of its word, and every last letter with a border
                ends = np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1
                ends = ends[ends > 1]
                own = np.flatnonzero(letter)
                far = np.where(letter[own - 1], own - 2, own - 1)
                for x, y, z in ((far, own - 1, own), (ends - 1, ends, ends + 1)):
                    p, q, r = cell[x], cell[y], cell[z]
                    seen = (p >= 0) & (q >= 0) & (r >= 0)
                    table += np.bincount(((p * size + q) * size + r)[seen], minlength=size ** 3)
                    if not seen.all():
                        i, j, k = (np.where(letter[v], code[v], ord(EDGE)).astype(np.int64) for v in (x[~seen], y[~seen], z[~seen]))
                        for g, n in zip(*(v.tolist() for v in np.unique(i << 42 | j << 21 | k, return_counts=True))):
                            total[g] = total.get(g, 0) + n
                if len(total) >= PENDING:
                    yield rows(total)
                    total = {}
        for k in np.flatnonzero(table).tolist():
            x, y, z = (ord(known[i]) for i in (k // size // size, k // size % size, k % size))
            total[x << 42 | y << 21 | z] = int(table[k])
        yield rows(total)

    counted = rows_of(docs, id_col, text_col).select("text").mapInArrow(count, "gram long, n long")
    return written(counted.groupBy("gram").agg(F.sum("n").alias("n")), "toxic-grams")


def parts(word: str) -> list[str]:
    """A word and its first letters."""
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def slot(part: str) -> int:
    return crc32(part.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class Model:
    lm: LanguageModel
    table: DataFrame  # chances of all grams
    weight: dict[str, float]  # of telling words, and of telling first letters with a star
    slope: float = 1.0
    bias: float = -5.0


def held_out(doc_id: Column) -> Column:
    """Rows that are never used for learning: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Language model of all documents; word weights from at most ``sample`` labelled rows of the training part.

    Without labels of both kinds every document has score 0.
    """
    table = written(chances(gather(docs, id_col, text_col)), "toxic-chances")
    lm = resident(table)
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label_col).cast("int").alias("label")) \
        .where("label_id is not null and label is not null").where(~held_out(F.col("label_id")))
    chosen = written(known.groupBy("label_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("label_id"), "label_id").limit(sample), "toxic-labels")
    rows = rows_of(docs, id_col, text_col)
    labelled = rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["label_id"]).select("text", "label")
    single = written(labelled.withColumn("same", _smallest_shingle(F.col("text"))).dropDuplicates(["same", "label"]), "toxic-train").select("text", "label")
    train = with_words(single, lm, table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yes, no, docs_of = {}, {}, [0, 0]
        for b in batches:
            for words, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held = yes if label else no
                docs_of[1 if label else 0] += 1
                for s in {slot(p) for w in words for p in parts(w)}:
                    held[s] = held.get(s, 0) + 1
        keys = sorted(yes.keys() | no.keys())
        yield pa.RecordBatch.from_arrays([pa.array([-1, *keys], pa.int32()), pa.array([docs_of[1], *[yes.get(k, 0) for k in keys]], pa.int64()),
                                          pa.array([docs_of[0], *[no.get(k, 0) for k in keys]], pa.int64())], ["slot", "yes", "no"])

    sums = written(train.mapInArrow(count, "slot int, yes long, no long").groupBy("slot").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "toxic-counts")
    total = sums.where("slot = -1").first()
    if total is None or not total["yes"] or not total["no"]:
        return Model(lm, table, {})
    yes, no = float(total["yes"]), float(total["no"])
    ratio = (F.col("yes") + 0.5) / (yes + 1.0) / ((F.col("no") + 0.5) / (no + 1.0))
    share = yes / (yes + no)

    def term(n: str, part: float) -> Column:
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / ((F.col("yes") + F.col("no")) * part))).otherwise(0.0)

    # bounded by the sample, not by the corpus
    tells = sums.where((F.col("slot") >= 0) & (F.col("yes") + F.col("no") >= LEAST_DOCS) & (2 * (term("yes", share) + term("no", 1 - share)) >= LEAST_G)) \
        .select("slot", ratio.alias("r")).collect()
    chosen_slots = {r["slot"]: float(np.log(r["r"])) for r in tells}

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for b in batches:
            for words in b.column(0).to_pylist():
                for p in {p for w in words for p in parts(w) if slot(p) in chosen_slots}:
                    found[p] = found.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["part", "n"])

    # of the parts in one slot the most frequent one is the telling one
    spelt = train.select("words").mapInArrow(names, "part string, n long").groupBy("part").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS).collect()
    best: dict[int, tuple[int, str]] = {}
    for r in spelt:
        best[slot(r["part"])] = max(best.get(slot(r["part"]), (0, "")), (r["n"], r["part"]))
    model = Model(lm, table, {part: chosen_slots[k] for k, (_, part) in best.items()})
    seen = train.select(_evidence_of_words(model, F.col("words")).alias("e"), "label").toPandas()  # at most ``sample`` rows
    model.slope, model.bias = calibrate(seen["e"].to_numpy(), seen["label"].to_numpy())
    return model


def _smallest_shingle(text: Column) -> Column:
    @F.pandas_udf("long")
    def smallest(texts: pd.Series) -> pd.Series:
        found = shingle_hashes([t.encode("utf-8", "surrogatepass") for t in texts], 5, Powers())
        return pd.Series([int(h.min().astype(np.int64)) if len(h) else 0 for h in found], dtype="int64")

    return smallest(text)


def calibrate(evidence: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the logistic curve; a prior at (1, -5) keeps them finite where the labels are parted cleanly."""
    prior, force = np.array([1.0, -5.0]), 10.0
    x, t = np.stack([evidence, np.ones(len(evidence))], 1), prior.copy()
    for _ in range(60):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ t, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + force * np.eye(2), x.T @ (p - label) + force * (t - prior))
        size = np.abs(step).max()
        t = t - step * min(1.0, 1.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return float(t[0]), float(t[1])


def with_words(texts: DataFrame, lm: LanguageModel, table: DataFrame) -> DataFrame:
    """``words`` (as written and restored) and ``label`` of rows of ``text`` and ``label``."""
    @F.pandas_udf("array<string>")
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _cache_of(lm)
        for b in batches:
            yield pd.Series([sorted(restored_words(t, lm, cache)) if lm.knows(t) else None for t in b], dtype=object)

    got = written(texts.withColumn("words", words("text")).select("words", "label", F.when(F.col("words").isNull(), F.col("text")).alias("text")), "toxic-words")
    if lm.letters is None:
        return got.select("words", "label")
    left = got.where("words is null").select("label", "text", F.sha2("text", 256).alias("key"))
    late = written(rest_words(left.select("key", "text"), lm, table), "toxic-rest")
    return got.where("words is not null").select("words", "label").unionByName(left.join(late, "key").select("words", "label"))


def rest_words(texts: DataFrame, lm: LanguageModel, table: DataFrame) -> DataFrame:
    """``(key, words)`` of the distinct texts ``(key, text)`` that ask for grams outside of ``lm``.

    The texts fall into groups; each gets the grams of the table that it asks for, so a decoding sees the same
    probabilities as with the whole table.
    """
    letters = lm.letters
    alone = written(texts.groupBy("key").agg(F.first("text").alias("text")), "toxic-other")
    size = alone.agg(F.sum(F.length("text"))).first()[0] or 0
    grouped = alone.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(size // GROUP_CHARS + 1)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                asked = Asked(letters)
                restored_words(text, asked, {})
                want = [g for g in asked.grams if not all(c in letters for c in g)]
                points = [[ord(c) for c in g] for g in want]
                code = [sum(p << 21 * k for k, p in enumerate(reversed(x))) for x in points]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(want), pa.int64()), pa.array(code, pa.int64()),
                                                  pa.array([len(g) for g in want], pa.int32())], ["part", "gram", "places"])

    asked = grouped.select("part", "text").mapInArrow(ask, "part long, gram long, places int").distinct()
    known = asked.join(table, ["gram", "places"]).select("part", "gram", "n", "among", "places")

    def decoded(part: pd.DataFrame, grams: pd.DataFrame) -> pd.DataFrame:
        own = model_of(zip(*(grams[c].tolist() for c in ("gram", "n", "among", "places"))), base=lm)
        cache: dict[str, str] = {}
        return pd.DataFrame({"key": part["key"], "words": [sorted(restored_words(t, own, cache)) for t in part["text"]]})

    return grouped.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(decoded, "key string, words array<string>")


def _evidence_of(words: Iterable[str], weight: dict[str, float], heads: set[str]) -> float:
    """Sum of the log ratios of the telling words of a text."""
    head = min(PREFIXES)
    return float(sum(sorted(max((weight.get(p, 0.0) for p in parts(w)), key=abs) for w in words if w[:head] in heads)))


def _heads(model: Model) -> set[str]:
    return {p[:min(PREFIXES)].rstrip("*") for p in model.weight}


def _evidence_of_words(model: Model, words: Column) -> Column:
    weight, heads = model.weight, _heads(model)

    @F.pandas_udf("double")
    def total(words: pd.Series) -> pd.Series:
        return pd.Series([_evidence_of(w, weight, heads) for w in words], dtype="float64")

    return total(words)


def _evidence(model: Model, text: Column) -> Column:
    """Evidence of a text, NULL if it asks for grams that the tasks do not hold."""
    lm, weight, heads = model.lm, model.weight, _heads(model)

    @F.pandas_udf("double")
    def total(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _cache_of(lm)
        for texts in batches:
            yield pd.Series([_evidence_of(restored_words(t, lm, cache), weight, heads) if lm.knows(t) else None for t in texts], dtype="float64")

    return total(text)


def _chance(model: Model, evidence: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-(F.lit(model.slope) * evidence + F.lit(model.bias))))


def score(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` with the probability of label 1 of their ``text`` as ``score`` in its place; NULL and empty texts have the score of no evidence, 0 if nothing was learnt."""
    others = [c for c in rows.columns if c != "text"]
    if not model.weight:
        return rows.select(*others, F.lit(0.0).alias("score"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    e = rows.select(*others, text.alias("text")).withColumn("e", _evidence(model, F.col("text")))
    if model.lm.letters is None:
        return e.select(*others, _chance(model, F.col("e")).alias("score"))
    first = written(e.withColumn("text", F.when(F.col("e").isNull(), F.col("text"))), "toxic-first")
    left = first.where("e is null").withColumn("key", F.sha2("text", 256))
    late = rest_words(left.select("key", "text"), model.lm, model.table)
    late = written(late.select("key", _evidence_of_words(model, F.col("words")).alias("late")), "toxic-late")
    late = left.drop("e", "text").join(late, "key").select(*others, F.col("late").alias("e"))
    return first.where("e is not null").select(*others, "e").unionByName(late).select(*others, _chance(model, F.col("e")).alias("score"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; a row without id is not held out and has no label.

    NULL and empty texts have the score of no evidence.  Repeated rows get the same score, very long texts are read
    whole, and an empty table gives an empty result.  A score at the threshold counts as 1.  Other columns, whatever
    their names, are left out.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return score(model, rows).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
