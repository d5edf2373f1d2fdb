"""64-bit hashes of word shingles for many texts at a time, with numpy alone."""

from __future__ import annotations

import numpy as np

_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text that are hashed together; a longer text is hashed on its own.
AT_ONCE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, r, np.uint64)))) for r in (_R, _R_INVERSE))
        return self.up[:n], self.down[:n]


def chunks(raws: list[bytes]) -> list[tuple[int, int]]:
    """Index ranges of about ``AT_ONCE`` bytes together."""
    out, at = [], 0
    while at < len(raws):
        held, end = 0, at
        while end < len(raws) and (end == at or held + len(raws[end]) <= AT_ONCE):
            held += len(raws[end])
            end += 1
        out.append((at, end))
        at = end
    return out


def tokens(raws: list[bytes], powers: Powers, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of one kind (``kind[byte]``; 0 is left out): joined bytes, starts, ends, hashes, and runs per text."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    k = kind[data]
    starts = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1))
    ends = np.concatenate((starts[1:], [len(data)]))
    real = k[starts] > 0
    starts, ends = starts[real], ends[real]
    up, down = powers.of(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    h = mix((total[ends] - total[starts]) * down[starts])
    upto = np.searchsorted(starts, np.cumsum(sizes))
    return data, starts, ends, h, np.diff(np.concatenate(([0], upto)))


def word_hashes(raws: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in order, and of each text how many words it has.

    Words end at space, tab, line feed, vertical tab, form feed and carriage return.
    """
    *_, h, counts = tokens(raws, powers, (~_SPACE).astype(np.uint8))
    return h, counts


def shingle_hashes(raws: list[bytes], words: int, powers: Powers) -> list[np.ndarray]:
    """Of each text the hashes of its shingles, repeats included; a text of fewer words is one shingle, none without words."""
    out: list[np.ndarray] = []
    for at, end in chunks(raws):
        h, counts = word_hashes(raws[at:end], powers)
        factor = [np.uint64(pow(_R, 2 * k + 3, 1 << 64)) for k in range(words)]
        n = len(h) - words + 1
        full = np.zeros(max(n, 0), np.uint64)
        for k in range(words):
            if n > 0:
                full += h[k:k + n] * factor[k]
        mix(full)
        first = 0
        for c in counts.tolist():
            if c >= words:
                out.append(full[first:first + c - words + 1])
            elif c:
                short = np.array([c], np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                for k in range(c):
                    short += h[first + k] * factor[k]
                out.append(mix(short))
            else:
                out.append(np.zeros(0, np.uint64))
            first += c
    return out
