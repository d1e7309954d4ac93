"""Texts as flat arrays of code points.

The operators of this subpackage that must look at every character do it on one flat numpy array per block of rows:
no Python object is made per word or per character. A block holds whole rows and about BLOCK code points, so memory
stays flat however many rows an Arrow batch has; a longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}

#: White space as str.split() sees it.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: The same for Java's and RE2's regular expressions.
WHITE_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WHITE_CLASS = "[^" + WHITE_CLASS[1:]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on whole arrays."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse modulo 2**64."""
    if "p" not in _POWERS or len(_POWERS["p"]) <= n:
        size = max(n, BLOCK) + 1
        for name, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, _U(base))
            a[0] = _U(1)
            _POWERS[name] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"][: n + 1], _POWERS["i"][: n + 1]


def lookup(test, most: int = 0x3100) -> np.ndarray:
    """A table by code point of what test says of each character below most."""
    return np.array([bool(test(chr(i))) for i in range(most)])


class Classes:
    """What a function says of each code point, of all planes; a code point is asked for once, when it first comes."""

    def __init__(self, of):
        self.of, self.known = of, np.full(0x110000, 255, np.uint8)

    def __call__(self, cps: np.ndarray) -> np.ndarray:
        got = self.known[cps]
        new = got == 255
        if new.any():
            for c in np.unique(cps[new]).tolist():
                self.known[c] = int(self.of(chr(c)))
            got = self.known[cps]
        return got


def blocks(texts: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, code points, bounds): row first + i is cps[bounds[i]:bounds[i + 1]]. A null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    lo, n = 0, len(size)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, "right")))
        joined = "".join(texts.slice(lo, hi - lo).to_pylist())
        cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        yield lo, hi, cps, np.concatenate([[0], ends[lo:hi] - base])
        lo = hi


def spans(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never crosses a row."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    edge = bounds[1:-1]
    before[edge[edge < n]] = False
    after[edge[edge > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def white(cps: np.ndarray) -> np.ndarray:
    """Which code points are white space."""
    if "white" not in _POWERS:
        _POWERS["white"] = lookup(lambda c: c in WHITE)
    table = _POWERS["white"]
    return table[np.minimum(cps, len(table) - 1)]


def prefix(cps: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash: with them gram() hashes any stretch in one step."""
    n = len(cps)
    p, _ = powers(n)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(cps.astype(np.uint64) + _U(0x1234567)) * p[:n], out=out[1:])
    return out


def gram(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of cps[start:end], wherever in the block they stand."""
    _, inverse = powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def runs_of_words(words: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive word hashes inside one row, and the index of the first word of each."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * _U(0xD1342543DE82EF95) + words[j : j + n]
    same = row[:n] == row[k - 1 :]
    return mix(total[same]), np.flatnonzero(same)
