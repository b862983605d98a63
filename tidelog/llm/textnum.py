"""Vectorised text primitives over Arrow string columns.

Everything here works on the UTF-8 bytes of a bounded slice of an Arrow column, so a
worker's memory depends on the slice size and on the longest single text, never on the
partition.  Words, lines and n-gram windows come out as numpy arrays of byte offsets and
64-bit hashes; two different strings of n bytes share a hash with probability about n * 2**-61.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once in one worker (a longer single text is handled alone).
SLICE_BYTES = 1 << 19

_U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U64(2) + _U64(1)
#: Byte strings are hashed as polynomials modulo this prime, at a base without small powers.
PRIME = 2**61 - 1
_P = _U64(PRIME)
_STEP = 0x123456789ABCDEF1 % PRIME
_STEP_INV = pow(_STEP, -1, PRIME)
_powers: dict[int, np.ndarray] = {}
#: Bytes whose partial sums are added up before they are reduced (at most 2**20); so few stay in the cache.
_CHUNK = 1 << 15

#: ASCII A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of 256 entries, true for the bytes of the inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


#: White space of the word contract: space and \t\n\v\f\r.
SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_SPACE = ~SPACE


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that low bits and order depend on all input bits."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, but 0 may stand as PRIME."""
    return (x & _P) + (x >> _U64(61))


def _shifted(x: np.ndarray, bits: int) -> np.ndarray:
    """x * 2**bits modulo PRIME of x < 2**61: the bits turn round."""
    return ((x & _U64((1 << (61 - bits)) - 1)) << _U64(bits)) | (x >> _U64(61 - bits))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME of numbers under 2**61, by halves."""
    low, up = _U64(0xFFFFFFFF), _U64(32)
    a0, a1, b0, b1 = a & low, a >> up, b & low, b >> up
    mid = _reduced(a1 * b0 + a0 * b1)
    total = _reduced((a1 * b1) << _U64(3)) + _shifted(_canonical(mid), 32) + _reduced(a0 * b0)
    return _canonical(_reduced(total))


def _canonical(x: np.ndarray) -> np.ndarray:
    """x <= 2**61 brought under PRIME."""
    return np.minimum(x, x - _P)  # below PRIME the difference wraps round


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 2)
        have = np.ones(1, dtype=np.uint64)
        while len(have) < size:
            have = np.concatenate([have, product(have, _U64(pow(base, len(have), PRIME)))])[:size]
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s] == step**s * hash(buf[s:e]) modulo PRIME for every range."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    step = powers(_STEP, len(buf))
    low, up = _U64(0xFFFFFFFF), _U64(32)
    for at in range(0, len(buf), _CHUNK):
        part, p = buf[at : at + _CHUNK].astype(np.uint64) + _U64(1), step[at : at + _CHUNK]
        # sums of up to 2**15 products of 9 and 32 bits
        lo, hi = np.cumsum(part * (p & low)), np.cumsum(part * (p >> up))
        out[at + 1 : at + 1 + len(part)] = _canonical(_reduced(_shifted(_canonical(_reduced(hi)), 32) + _canonical(_reduced(lo)) + out[at]))
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each range; equal strings have equal hashes, and two of n bytes share one for at most n of 2**61 bases."""
    raw = product(_canonical(prefix[end] + _P - prefix[start]), powers(_STEP_INV, len(prefix))[start])
    return mix64(raw + (end - start).astype(np.uint64) * _U64(0xD6E8FEB86659FD93))


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive bounded slices; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, len(column))
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Runs:
    """Maximal runs of bytes of a class: byte ranges, owning row, and 64-bit hashes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    #: index of each row's first run, with the total at the end
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def _with_rows(start: np.ndarray, end: np.ndarray, offsets: np.ndarray, prefix: np.ndarray) -> Runs:
    first = np.searchsorted(start, offsets, "left")
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Runs(start, end, row, range_hash(prefix, start, end), first)


def runs(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray, prefix: np.ndarray | None = None) -> Runs:
    """Maximal runs of bytes of the class ``inside``; a run never crosses a row."""
    return class_runs(buf, offsets, inside.astype(np.uint8), prefix)


def class_runs(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray, prefix: np.ndarray | None = None) -> Runs:
    """Maximal runs of equal non-zero class (``classes``: 256 small numbers)."""
    n = len(buf)
    prefix = prefix_hash(buf) if prefix is None else prefix
    kind = classes[buf]
    edge = np.ones(n + 1, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    if n == 0:
        start = end = np.zeros(0, dtype=np.int64)
    else:
        good = kind[start] != 0
        start, end = start[good], end[good]
    return _with_rows(start, end, offsets, prefix)


def lines(buf: np.ndarray, offsets: np.ndarray, prefix: np.ndarray) -> Runs:
    r"""Non-empty \n-split lines."""
    return class_runs(buf, offsets, (np.arange(256) != 10).astype(np.uint8), prefix)


def gram_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n consecutive values (len(values) - n + 1 of them)."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out += values[k : k + m] * _GRAM[k]
    return mix64(out + _U64(n))


def grams(words: Runs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each window of n words that lies inside one row."""
    h = gram_hash(words.hash, n)
    keep = np.flatnonzero(words.row[: len(h)] == words.row[n - 1 :][: len(h)]) if len(h) else np.zeros(0, np.int64)
    return keep, h[keep]


def row_sums(row: np.ndarray, n_rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Exact integer totals for each row."""
    if weights is None:
        return np.bincount(row, minlength=n_rows).astype(np.int64)
    out = np.zeros(n_rows, dtype=np.int64)
    np.add.at(out, row, weights.astype(np.int64))
    return out


def prefix_counts(flags: np.ndarray) -> np.ndarray:
    """c with c[e] - c[s] == number of true flags in [s, e)."""
    out = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def dup_flags(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal to another item of its row, equal to an earlier item of its row)."""
    full = mix64(key ^ (row.astype(np.uint64) * _U64(0xA0761D6478BD642F)))
    order = np.argsort(full, kind="stable")
    same = np.zeros(len(order) + 1, dtype=bool)
    if len(order) > 1:
        same[1:-1] = full[order[1:]] == full[order[:-1]]
    any_dup = np.empty(len(order), dtype=bool)
    earlier = np.empty(len(order), dtype=bool)
    any_dup[order] = same[:-1] | same[1:]
    earlier[order] = same[:-1]
    return any_dup, earlier


def cover(starts: np.ndarray, length: int | np.ndarray, n: int) -> np.ndarray:
    """Boolean array of n cells, true where some [start, start + length) lies."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + length, -1)
    return np.cumsum(delta[:-1]) > 0
