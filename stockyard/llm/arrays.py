"""Vectorised text primitives used inside tasks (numpy over Arrow buffers).

Everything here works on one Arrow batch at a time: a column of texts becomes a
byte buffer plus document offsets, and words or symbols become 64-bit hashes
with offsets per document.  Memory is a small multiple of ``CHUNK`` bytes (or
of the longest single text).  Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes of text worked on at once; a longer single text is its own chunk

_U = np.uint64
_RADIX = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_RADIX_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijective finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def salted(values: np.ndarray, salt: int) -> np.ndarray:
    """Independent 64-bit hash of ``values`` for each ``salt``."""
    return mix64(values + _U((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64)))


_POW = np.ones(1, _U)
_INV = np.ones(1, _U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the radix and of its inverse modulo 2**64."""
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _RADIX, _U), np.full(size, _RADIX_INV, _U)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        if size > 4 * CHUNK:  # one very long text: do not keep its tables
            return up[:n], down[:n]
        _POW, _INV = up, down
    return _POW[:n], _INV[:n]


def segment_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Polynomial hash (mod 2**64, finalised) of each segment of ``values``.

    Segments begin at ``starts`` and run to the next start; zeros do not count,
    so separators inside a segment's tail can be stored as zero.  The hash does
    not depend on where the segment lies.
    """
    if not len(starts):
        return np.empty(0, _U)
    up, down = powers(len(values))
    return mix64(np.add.reduceat(values * up, starts) * down[starts])


# Byte tables.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
_BYTE_CODES = mix64(np.arange(1, 257, dtype=_U)) | _U(1)


def separator_table(keep: np.ndarray) -> np.ndarray:
    """Hash codes per byte: 0 for separators, else the code of the A-Z-lowered byte."""
    codes = _BYTE_CODES[LOWER]
    codes[~keep] = 0
    return codes


_white = np.zeros(256, bool)
_white[[0x20, 9, 10, 11, 12, 13]] = True
#: Words are runs of anything but \x20 and \x09-\x0D.
WHITE_WORDS = separator_table(~_white)
_alnum = np.zeros(256, bool)
_alnum[48:58] = _alnum[65:91] = _alnum[97:123] = True
_alnum[128:] = True
#: Words are runs of ASCII letters, digits and non-ASCII characters.
ALNUM_WORDS = separator_table(_alnum)


def release() -> None:
    """Give memory that earlier tasks of this worker process freed back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc keeps freed arrays otherwise
        libc.malloc_trim(0)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null texts become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def text_list(column: pa.Array) -> list[str | None]:
    """The texts of an Arrow string column; bytes that are not UTF-8 become replacement characters."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        raw = column.cast(pa.large_string()).view(pa.large_binary()).to_pylist()
        return [None if b is None else b.decode("utf-8", "replace") for b in raw]


def doc_chunks(off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents holding about ``limit`` bytes, each document whole."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def words(
    buf: np.ndarray, off: np.ndarray, table: np.ndarray = WHITE_WORDS, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, word offsets per document).

    With ``prefixes`` every word is followed by the hashes of its first 4, 5, ... bytes, as named;
    a word without that many bytes and one more has 0 in that place.
    """
    all_hashes, counts = [], []
    width = 1 + len(prefixes)
    for lo, hi in doc_chunks(off):
        a, b = off[lo], off[hi]
        if a == b:
            counts.append(np.zeros(hi - lo, np.int64))
            continue
        codes = table[buf[a:b]]
        inside = codes != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = off[lo:hi] - a
        firsts = firsts[firsts < b - a]
        begins[firsts] = inside[firsts]
        starts = np.flatnonzero(begins)
        hashes = segment_hashes(codes, starts)  # a word ends at a separator (0) or with its text, where the next segment begins
        if prefixes:
            ends = np.append(starts[1:], len(codes))
            hashes = np.column_stack([hashes, *(_prefix_hashes(codes, starts, ends, k) for k in prefixes)]).ravel()
        all_hashes.append(hashes)
        counts.append(width * np.diff(np.searchsorted(starts, off[lo : hi + 1] - a)))
    woff = np.zeros(len(off), np.int64)
    if counts:
        np.cumsum(np.concatenate(counts), out=woff[1:])
    return (np.concatenate(all_hashes) if all_hashes else np.empty(0, _U)), woff


def _prefix_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the first ``size`` bytes of the words that are longer than that, else 0."""
    out = np.zeros(len(starts), _U)
    long = np.flatnonzero(starts + size < ends)
    long = long[codes[starts[long] + size] != 0]
    at, total = starts[long], np.full(len(long), size, _U)
    for k in range(size):
        total = total * _RADIX + codes[at + k]
    out[long] = mix64(total)
    return out


def owners(woff: np.ndarray) -> np.ndarray:
    """The document index of every item, from offsets per document."""
    return np.repeat(np.arange(len(woff) - 1), np.diff(woff))


def pairs(hashes: np.ndarray, woff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every pair of adjacent words, offsets per document)."""
    n = np.diff(woff)
    keep = np.ones(len(hashes), bool)
    keep[woff[1:][n > 0] - 1] = False  # the last word of a document begins no pair
    idx = np.flatnonzero(keep)
    poff = np.zeros(len(woff), np.int64)
    np.cumsum(np.maximum(n - 1, 0), out=poff[1:])
    if not len(idx):
        return np.empty(0, _U), poff
    return mix64(hashes[idx] * _U(0xA0761D6478BD642F) ^ (hashes[idx + 1] + _U(0xE7037ED1A0B428DB))), poff
