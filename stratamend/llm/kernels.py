"""Vectorised text kernels (numpy) shared by the training-data operators.

Everything works on the UTF-8 bytes of an Arrow string column: word spans by
a 256-entry byte class, and position-independent hashes of byte or word runs
from one prefix sum (arithmetic modulo 2**64, an odd random base, random
symbol codes).  Memory is proportional to the slice given, so callers cut
batches with ``row_slices``; a single document is never cut.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None

U64 = np.uint64
SPACE = b" \t\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: True at bytes of words that white space separates.
PLAIN_WORD = np.ones(256, bool)
PLAIN_WORD[list(SPACE)] = False
#: True at bytes of words made of digits, lower-case ASCII letters and non-ASCII characters.
ITEM_WORD = np.zeros(256, bool)
ITEM_WORD[0x30:0x3A] = ITEM_WORD[0x61:0x7B] = ITEM_WORD[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the one of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        self.base = int(r.integers(1 << 61, 1 << 63)) * 2 % (1 << 64) | 5
        self.codes = r.integers(0, 1 << 64, 256, dtype=U64)
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size, inverse = len(self.up), pow(self.base, -1, 1 << 64)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(inverse, size, 1 << 64))])
        return self.up[:n], self.down[:n]


BYTES, BYTES2, WORDS, WORDS2 = (Powers(s) for s in (11, 12, 13, 14))


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z only."""
    return _LOWER[buf]


def text_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_binary())
    col = col.cast(pa.large_binary()) if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else col.cast(pa.binary()).cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64, len(col) + 1, col.offset * 8) if offs is not None else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def release() -> None:
    """Gives memory that was freed back to the system, so that idle workers are small."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def row_slices(offs: np.ndarray, most: int = (1 << 19) - 8):
    """Ranges of rows of at most ``most`` bytes each, or of one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j
    release()


def word_spans(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each row (with the total at the end)."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    m = is_word[buf]
    first = np.empty_like(m)
    first[0], first[1:] = True, ~m[:-1]
    last = np.empty_like(m)
    last[-1], last[:-1] = True, ~m[1:]
    cuts = offs[(offs > 0) & (offs < len(buf))]
    first[cuts], last[cuts - 1] = True, True
    starts, ends = np.flatnonzero(m & first), np.flatnonzero(m & last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _prefix(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.empty(len(values) + 1, U64)
    out[0] = 0
    np.cumsum(values * up, out=out[1:])
    return out


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers = BYTES) -> np.ndarray:
    """A hash of each byte run."""
    up, down = powers.upto(len(buf) + 1)
    p = _prefix(powers.codes[buf], up[:-1])
    # the length keeps runs apart that differ by symbols whose code happens to be 0
    return mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(U64))


def byte_windows(buf: np.ndarray, k: int, powers: Powers = BYTES) -> np.ndarray:
    """A hash of each run of ``k`` bytes, by its start; it may cross rows."""
    n = len(buf) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers.upto(len(buf) + 1)
    p = _prefix(powers.codes[buf], up[:-1])
    return mix((p[k:] - p[:-k]) * down[:n])


def word_windows(ids: np.ndarray, k: int, powers: Powers = WORDS) -> np.ndarray:
    """A hash of each run of ``k`` word hashes, by its start; it may cross rows."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers.upto(len(ids) + 1)
    p = _prefix(ids, up[:-1])
    return mix((p[k:] - p[:-k]) * down[:n])


def inside(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` window starts of length ``k`` stay in their row; ``first`` has the rows' starts and the total."""
    ok = np.zeros(n, np.int32)
    a, b = first[:-1], first[1:] - k + 1
    keep = b > a
    np.add.at(ok, a[keep], 1)
    b = b[keep]
    np.subtract.at(ok, b[b < n], 1)
    return np.cumsum(ok) > 0


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``k`` from one of ``starts``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.subtract.at(d, np.minimum(starts + k, n), 1)
    return np.cumsum(d[:-1]) > 0


def member(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``table``."""
    if not len(table) or not len(x):
        return np.zeros(len(x), bool)
    at = np.searchsorted(table, x)
    at[at == len(table)] = 0
    return table[at] == x


def difference_cover(q: int) -> tuple[np.ndarray, int]:
    """A perfect difference set of q + 1 residues modulo v = q * q + q + 1, for a prime q (Singer's construction).

    Any two places i, j have a step d < v at which both i + d and j + d are
    in the cover.  The set holds the exponents at which the powers of a
    generator of GF(q**3) fall in a plane.
    """
    v = q * q + q + 1
    for c0 in range(1, q):
        for c1 in range(q):
            for c2 in range(q):
                x, found = (1, 0, 0), []
                for i in range(v):
                    if x[2] == 0:
                        found.append(i)
                    top = x[2]  # times t, with t**3 = c2 t**2 + c1 t + c0
                    x = (top * c0 % q, (x[0] + top * c1) % q, (x[1] + top * c2) % q)
                if len(found) == q + 1 and is_cover(found, v):
                    return np.array(found, np.int64), v
    raise ValueError(f"{q} is not a prime")


def is_cover(d, v: int) -> bool:
    return len({(int(a) - int(b)) % v for a in d for b in d}) == v


class Runs:
    """Hashes of byte runs at chosen places of one buffer."""

    def __init__(self, buf: np.ndarray, powers: Powers = BYTES):
        up, self.down = powers.upto(len(buf) + 1)
        self.p = _prefix(powers.codes[buf], up[:-1])

    def at(self, places: np.ndarray, k) -> np.ndarray:
        return mix((self.p[places + k] - self.p[places]) * self.down[places])
