"""SentencePiece encoding and decoding with N-best segmentation.

The text is normalised by the model's own rules and read as a lattice whose
edges are vocabulary pieces with the model's scores.  A position that no piece
spans is a cut: every path passes it, so the lattice falls into independent
segments (mostly words).  In each segment a forward Viterbi pass gives the best
score from the start to every position; the backward A* search from the end
uses these scores as exact heuristics and therefore pops complete paths in
order of their score.  The N best paths of the whole text combine those of the
segments; only the N-1 segments with the smallest loss of their second path can
take part in a deviation, so the combination is exact as well.

Best paths and losses of the words of a batch are computed for all distinct
words at once (forward and backward Viterbi over arrays, the loss of the best
path through each edge off the best path); the A* search then runs for the few
segments that can deviate.

Characters outside the vocabulary cost the lowest piece score minus 10 and are
written as byte pieces where the model has them, else as the unknown piece.
A model trained by merges (BPE) is read the same way: the lattice over its
pieces and scores.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierlake.llm.base import rows_of

UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 600_000
ROWS_AT_ONCE = 1024
#: Words up to this many characters are searched many at a time; longer ones each on its own.
WIDEST = 48
SPACE = "▁"

ENCODED = ("doc_id long, n_pieces int, score double, ids array<int>, "
           "alternatives array<struct<score:double,edits:array<struct<at:int,drop:int,ids:array<int>>>>>, decoded string")


class PieceModel:
    """Vocabulary of a SentencePiece model with lattice search; made in each worker from the model's bytes."""

    def __init__(self, model: bytes, n_best: int = 4):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n_best = n_best
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.raw: list[bytes] = []
        prefixes: set[str] = set()
        self.pairs: set[str] = set()
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.id[p], self.score[p] = i, sp.get_score(i)
                self.raw.append(p.replace(SPACE, " ").encode())
                for k in range(1, len(p)):
                    prefixes.add(p[:k])
                    self.pairs.add(p[k - 1:k + 1])
        self.prefixes = prefixes
        self.longest = max(map(len, self.id), default=1)
        self.unknown_id = sp.unk_id()
        self.unknown_score = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        spaced = any(x[0] != SPACE and x[1] == SPACE for x in self.pairs)
        # word-wise cuts before a run of spaces hold only if no piece crosses them
        self.splitter = None if spaced else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.line_cuts = not any("\n" in x for x in self.pairs)
        self.rows: dict[str, int] = {}
        self.others: dict[str, list] = {}
        self.t_count, self.t_score, self.t_loss, self.t_ids = self.nothing
        self.tree()

    def edges(self, s: str, i: int) -> list[tuple[int, float, int]]:
        """Pieces that start at position i: (end, score, id); -1 for a character outside the vocabulary."""
        out = []
        n, score, ids, prefixes = len(s), self.score, self.id, self.prefixes
        for j in range(i + 1, min(n, i + self.longest) + 1):
            p = s[i:j]
            if p in score:
                out.append((j, score[p], ids[p]))
            if p not in prefixes:
                break
        if not out or out[0][0] != i + 1:
            out.append((i + 1, self.unknown_score, -1))
        return out

    def search(self, s: str, n_best: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best paths of one segment, best first; ties in a fixed search order."""
        n = len(s)
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        back: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            b = best[i]
            for j, w, k in self.edges(s, i):
                if b + w > best[j]:
                    best[j] = b + w
                back[j].append((i, w, k))
        heap, turn, found = [(-best[n], 0, n, 0.0, None)], 0, []
        while heap and len(found) < n_best:
            f, _, at, done, path = heapq.heappop(heap)
            if not at:
                ids = []
                while path:
                    ids.append((path[0], path[1]))
                    path = path[2]
                found.append((done, ids))
                continue
            for i, w, k in back[at]:
                turn -= 1  # the newest of equal entries first: depth before breadth
                heapq.heappush(heap, (-(best[i] + done + w), turn, i, done + w, (k, i, path)))
        return [(w, tuple(x for k, i in ids for x in ((k,) if k >= 0 else self.spelled(s[i])))) for w, ids in found]

    def spelled(self, c: str) -> tuple[int, ...]:
        if not self.byte_id:
            return (self.unknown_id,)
        return tuple(self.byte_id[b] for b in c.encode("utf-8", "surrogatepass"))

    def one(self, w: str) -> tuple[list[int], float, float]:
        """Best ids, their score and the loss of the second path of a word of any length."""
        ids: list[int] = []
        total, loss = 0.0, float("inf")
        for s in self.cut(w):
            two = self.search(s, 2)
            ids.extend(two[0][1])
            total += two[0][0]
            if len(two) > 1:
                loss = min(loss, two[0][0] - two[1][0])
        return ids, total, loss

    def cut(self, word: str) -> list[str]:
        """Segments of a word: a cut wherever the two neighbours stand together in no piece."""
        pairs, out, last = self.pairs, [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in pairs:
                out.append(word[last:i])
                last = i
        out.append(word[last:])
        return out

    def tree(self) -> None:
        """Prefix tree of the pieces as arrays: a hash table from (node, character) to the next node."""
        nodes: dict[str, int] = {"": 0}
        for p in sorted(self.id):
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        self.node_id = np.full(len(nodes), -1, np.int32)
        self.node_score = np.full(len(nodes), -np.inf)
        for p, n in nodes.items():
            if p in self.id:
                self.node_id[n], self.node_score[n] = self.id[p], self.score[p]
        self.slots = 1 << max(12, (8 * len(nodes)).bit_length())
        self.table_key = np.full(self.slots, -1, np.int64)
        self.table_next = np.zeros(self.slots, np.int32)
        for p, n in nodes.items():
            if p:
                key = nodes[p[:-1]] << 21 | ord(p[-1])
                at = int(self.slot(np.array([key], np.int64))[0])
                while self.table_key[at] >= 0:
                    at = (at + 1) % self.slots
                self.table_key[at], self.table_next[at] = key, n

    def slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next nodes, -1 where the tree ends."""
        key = node.astype(np.int64) << 21 | char
        at = self.slot(key)
        out = np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.table_key[at]
            hit = held == key
            out[todo[hit]] = self.table_next[at[hit]]
            go = ~hit & (held >= 0)
            todo, key, at = todo[go], key[go], (at[go] + 1) % self.slots
        return out

    def many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of every word: number of best ids, score, loss of the second path; and all best ids, one word after the other."""
        count, score, loss = np.zeros(len(words), np.int64), np.zeros(len(words)), np.full(len(words), np.inf)
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids: list = [()] * len(words)
        for i in np.flatnonzero(size > WIDEST).tolist():
            ids[i], score[i], loss[i] = self.one(words[i])
        for lo, hi in ((0, 6), (6, 9), (9, 12), (12, 16), (16, 24), (24, WIDEST)):
            chosen = np.flatnonzero((size > lo) & (size <= hi))
            for at in range(0, len(chosen), 2048):
                self.block([words[i] for i in chosen[at:at + 2048].tolist()], chosen[at:at + 2048], size, ids, score, loss)
        count[:] = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate([np.asarray(x, np.int32) for x in ids if len(x)]) if count.any() else np.zeros(0, np.int32)
        return count, score, loss, flat

    def block(self, words: list[str], where: np.ndarray, sizes: np.ndarray, ids: list, score: np.ndarray, loss: np.ndarray) -> None:
        """Forward and backward Viterbi over words of like length; arrays are [position, word]."""
        n, size = len(words), sizes[where]
        wide = int(size.max())
        codes = np.frombuffer("".join(w.ljust(wide, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        chars = np.ascontiguousarray(codes.reshape(n, wide).T)
        inside = np.arange(wide)[:, None] < size
        # of edges with k characters: scores and pieces by the (position, word) where they start
        edge, piece = [np.zeros((0, 0))], [np.zeros((0, 0), np.int32)]
        start = np.flatnonzero(inside)  # flat (position, word) of live walks
        node = np.zeros(len(start), np.int32)
        for k in range(1, min(self.longest, wide) + 1):
            pos = start // n + k - 1
            live = pos < wide
            live[live] &= inside.ravel()[(start + (k - 1) * n)[live]]
            start, node = start[live], node[live]
            if not len(start) and k > 1:
                break
            node = self.step(node, chars.ravel()[start + (k - 1) * n])
            live = node >= 0
            start, node = start[live], node[live]
            edge.append(np.full((wide, n), -np.inf))
            piece.append(np.full((wide, n), -1, np.int32))
            edge[k].ravel()[start] = self.node_score[node]
            piece[k].ravel()[start] = self.node_id[node]
        lost = inside & (piece[1] < 0)
        edge[1][lost] = self.unknown_score
        ahead = np.full((wide + 1, n), -np.inf)
        ahead[0] = 0.0
        for i in range(wide):
            for k in range(1, min(len(edge) - 1, wide - i) + 1):
                np.maximum(ahead[i + k], ahead[i] + edge[k][i], out=ahead[i + k])
        col = np.arange(n)
        total = ahead[size, col]
        behind = np.full((wide + 1, n), -np.inf)
        behind[size, col] = 0.0
        for i in range(wide - 1, -1, -1):
            for k in range(1, min(len(edge) - 1, wide - i) + 1):
                np.maximum(behind[i], behind[i + k] + edge[k][i], out=behind[i])
        best = np.full((wide, n), -2, np.int32)  # the piece of the best path that starts here; -1: a character without piece
        end, open_ = size.copy(), col
        while len(open_):
            e = end[open_]
            took = np.zeros(len(open_), np.int64)
            for k in range(1, len(edge)):  # of equal paths the one with the longest last piece
                i = e - k
                ok = i >= 0
                j = np.where(ok, i, 0)
                ok &= ahead[j, open_] + edge[k][j, open_] == ahead[e, open_]
                took[ok] = k
            i = e - took
            for k in range(1, len(edge)):
                mine = took == k
                if mine.any():
                    best[i[mine], open_[mine]] = piece[k][i[mine], open_[mine]]
                    edge[k][i[mine], open_[mine]] = -np.inf
            end[open_] = i
            open_ = open_[i > 0]
        second = np.full(n, -np.inf)
        for k in range(1, len(edge)):
            if k <= wide:
                through = ahead[:wide - k + 1] + edge[k][:wide - k + 1] + behind[k:]
                np.maximum(second, through.max(axis=0), out=second)
        score[where], loss[where] = total, total - second
        for c, w in enumerate(where.tolist()):
            path = best[:, c]
            path = path[path > -2].tolist()
            if -1 in path:
                path, i = [], 0
                for i in np.flatnonzero(best[:, c] > -2).tolist():
                    path.extend((best[i, c],) if best[i, c] >= 0 else self.spelled(words[c][i]))
            ids[w] = path

    def tokens(self, text: str) -> list[str]:
        """Words of a text: no piece reaches from one into the next.  Empty strings may stand between them."""
        t = self.sp.normalize(text)
        if not self.splitter:
            return [t]
        if SPACE * 2 in t or "\0" in t:
            return self.splitter.findall(t)
        t = t.replace(SPACE, "\0" + SPACE)
        return (t.replace("\n", "\0\n\0") if self.line_cuts else t).split("\0")

    def known(self, words: list[str]) -> np.ndarray:
        """Rows of the words in the table of searched words; unknown ones are searched together and added."""
        if len(self.rows) + len(words) > CACHE_WORDS:
            self.rows, self.t_count, self.t_score, self.t_loss, self.t_ids = {}, *self.nothing
        new = [w for w in words if w not in self.rows]
        if new:
            count, score, loss, flat = self.many(new)
            for w in new:
                self.rows[w] = len(self.rows)
            self.t_count = np.concatenate((self.t_count, count))
            self.t_score = np.concatenate((self.t_score, score))
            self.t_loss = np.concatenate((self.t_loss, loss))
            self.t_ids = np.concatenate((self.t_ids, flat))
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    nothing = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.int32))

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Piece counts, scores, all best ids one text after the other, and of each text its other paths."""
        split = [self.tokens(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        coded = pa.array([w for ws in split for w in ws], pa.string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        row = self.known(words)[coded.indices.to_numpy()]
        count = self.t_count[row]
        first = np.concatenate(([0], np.cumsum(self.t_count)))[row]
        ends = np.cumsum(count)
        begins = ends - count
        ids = self.t_ids[np.repeat(first - begins, count) + np.arange(int(count.sum()))]
        loss, score = self.t_loss[row], self.t_score[row]
        edge = np.concatenate(([0], np.cumsum(sizes)))
        zero = np.concatenate(([0], ends))
        pieces = zero[edge[1:]] - zero[edge[:-1]]
        totals, others = np.zeros(len(texts)), []
        for k in range(len(texts)):
            lo, hi = int(edge[k]), int(edge[k + 1])
            totals[k] = score[lo:hi].sum()
            part = loss[lo:hi]
            near = np.argsort(part, kind="stable")[: self.n_best - 1] if len(part) < 64 else self.smallest(part)
            near = sorted((lo + i for i in near.tolist() if part[i] < np.inf))
            base = int(zero[lo])
            others.append(self.deviate(totals[k], [(split[k][i - lo], int(begins[i]) - base, ids[begins[i]:ends[i]].tolist()) for i in near]))
        return pieces, totals, ids, others

    def smallest(self, part: np.ndarray) -> np.ndarray:
        n = self.n_best - 1
        if not n:
            return np.zeros(0, np.int64)
        limit = np.partition(part, n - 1)[n - 1]
        at = np.flatnonzero(part <= limit)
        return at[np.argsort(part[at], kind="stable")[:n]]

    def deviate(self, total: float, words: list[tuple[str, int, list[int]]]) -> list[tuple[float, list]]:
        """(score, edits) of the next paths of a text, from the words (with offset and best ids) that can deviate."""
        mixed: list[tuple[float, tuple]] = [(0.0, ())]
        for w, at, best in words:
            options = [(0.0, ())] + [(x, ((at, len(best), p),)) for x, p in self.ways(w, tuple(best))]
            mixed = sorted(((a + b, x + y) for a, x in mixed for b, y in options), key=lambda m: m[0])[: self.n_best]
        return [(float(total - x), list(edits)) for x, edits in mixed[1:]]

    def ways(self, w: str, best: tuple[int, ...]) -> list[tuple[float, list[int]]]:
        """(loss, ids) of the paths of a word next to its best one."""
        got = self.others.get(w)
        if got is None:
            paths = [(s, p) for s, p in self.search(w, self.n_best + 1)]
            top = paths[0][0]
            got = [(top - s, list(p)) for s, p in paths if p != best][: self.n_best - 1]
            if len(self.others) >= CACHE_WORDS:
                self.others.clear()
            if len(w) <= WIDEST:
                self.others[w] = got
        return got

    def encode(self, text: str) -> tuple[float, list[int], list[tuple[float, list]]]:
        """Score and ids of the best path of one text, then (score, edits of the best ids) of the others."""
        _, totals, ids, others = self.encode_many([text])
        return float(totals[0]), ids.tolist(), others[0]

    def decode(self, ids: list[int]) -> str:
        """Text of a piece sequence; the space that the model puts in front of a text goes again."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text

    @property
    def dummy(self) -> bool:
        if not hasattr(self, "_dummy"):
            self._dummy = self.sp.normalize("a").startswith(SPACE)
        return self._dummy


def apply_edits(ids: list[int], edits: list) -> list[int]:
    """The piece sequence of an alternative."""
    out, last = [], 0
    for at, drop, new in edits:
        out += ids[last:at] + list(new)
        last = at + drop
    return out + ids[last:]


def _model(spark: SparkSession, path: str):
    """The model's bytes, read through Spark and broadcast (a vocabulary file, a few MB at most)."""
    found = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content", "length").first()
    if found["length"] > 64 * 1024 * 1024:
        raise ValueError("a SentencePiece model of more than 64 MB is not broadcast")
    return spark.sparkContext.broadcast(bytes(found["content"]))


def encode(docs: DataFrame, model_path: str, n_best: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: piece ids of the best path, its score, the next paths and the decoded text.

    An alternative holds its score and its edits of the best ids: at piece
    ``at``, ``drop`` pieces give way to ``ids`` (``apply_edits``).  ``decoded``
    is the text made from the best ids; it equals the text for a model that
    normalises nothing.  NULL and empty texts give no pieces, score 0 and no
    alternatives.  Texts are read whole, very long ones too; a row without
    doc_id or with a repeated one is encoded like any other, and of equal paths
    the one with the longest last piece counts as the best.  An empty table gives
    an empty result.  Other columns, whatever their names, are left out.
    """
    model = _model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = PieceModel(model.value, n_best)
        edits = pa.list_(pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))]))
        ways = pa.list_(pa.struct([("score", pa.float64()), ("edits", edits)]))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(start, ROWS_AT_ONCE)
                counts, scores, ids, others = m.encode_many(b.column(1).to_pylist())
                ends = np.concatenate(([0], np.cumsum(counts)))
                other = [[{"score": s, "edits": [{"at": a, "drop": d, "ids": x} for a, d, x in e]} for s, e in o] for o in others]
                every = ids.tolist()
                text = [m.decode(every[lo:hi]) for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(counts, pa.int32()), pa.array(scores), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                     pa.array(other, ways), pa.array(text, pa.string())], ["doc_id", "n_pieces", "score", "ids", "alternatives", "decoded"])

    return rows_of(docs, id_col, text_col).mapInArrow(run, ENCODED)
