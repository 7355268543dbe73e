"""Vectorised word splitting and hashing over Arrow string columns.

Used inside tasks (numpy over the raw UTF-8 bytes of a batch).  A word's
hash is a 64-bit polynomial hash, mixed; equal hashes are taken as equal
words.  For n distinct strings the chance of any clash is about n^2 / 2^65.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MASK = (1 << 64) - 1
BASE = 0x5851F42D4C957F2D  # odd multiplier, congruent to 5 mod 8


def lean(tokenizers: bool = False) -> None:
    """Begin a task in a worker as small as can be.

    Workers go from task to task, and an executor's workers count with its
    heap.  So what the tasks before have freed is given back to the system,
    and their tokenizers are let go unless this task is one of ``tokenizers``.
    """
    if not tokenizers:
        sys.modules.pop("_encoders", None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (xor-shift, multiply), elementwise."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers from a seed."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


class Powers:
    """BASE^i and BASE^-i modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                f = np.full(n + 1024, base, U64)
                f[0] = 1
                setattr(self, name, np.cumprod(f, dtype=U64))
        return self.up, self.down


def byte_sums(buf: np.ndarray, powers: Powers) -> np.ndarray:
    """What ``span_hashes`` takes differences of: one more than the bytes."""
    up, _ = powers.upto(len(buf) + 1)
    h = np.zeros(len(buf) + 1, U64)
    np.cumsum(multipliers(256, 7)[buf] * up[: len(buf)], dtype=U64, out=h[1:])
    return h


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span [start, end); ``sums`` of the same bytes serve several calls."""
    h = byte_sums(buf, powers) if sums is None else sums
    _, down = powers.upto(len(buf) + 1)
    return mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(U64))


def byte_table(pattern: str, invert: bool = False) -> np.ndarray:
    """256 flags for the characters of ``pattern`` (ASCII)."""
    t = np.zeros(256, bool)
    t[list(pattern.encode())] = True
    return ~t if invert else t


#: the white space that separates words: [\x20\x09-\x0D]
SPACES = byte_table(" \t\n\x0b\x0c\r")
#: ASCII lower case: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: separators of alphanumeric words: all ASCII but 0-9, A-Z, a-z
NON_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def slices(column, max_bytes: int = 2 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for runs of rows of about max_bytes.

    A null text counts as empty; a text longer than max_bytes is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(off, off[row] + max_bytes, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, data[off[row]: off[end]], off[row: end + 1] - off[row]
        row = end


def spans(buf: np.ndarray, off: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word index (n + 1 values)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~separators[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def grams(words: np.ndarray, first: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and which lie within one text.

    ``first``: each text's first word index (as from spans).
    """
    k = multipliers(n, seed)
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, bool)
    h = words[:m] * k[0]
    for j in range(1, n):
        h = h + words[j: m + j] * k[j]
    ok = np.ones(m, bool)
    for j in range(1, n):  # a run may not cross a text's start
        at = first[1:-1] - j
        ok[at[(at >= 0) & (at < m)]] = False
    return mix(h), ok


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes of the smallest width (lz4 drops what is zero)."""
    v = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    return bytes([width]) + np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as packed differences."""
    v = values.astype(U64)
    return pack(np.diff(v, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=U64)
