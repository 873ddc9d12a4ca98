r"""Vectorised word splitting and Rabin-Karp hashing over Arrow text columns.

Texts of a batch are one byte buffer with offsets. Word boundaries come from a
256-entry class table, word hashes from one cumulative polynomial over the
buffer, so no Python object is made per word. Long buffers are walked in
slices cut between words, which bounds the working memory.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
LONG_WORD = 64
_BASE = np.uint64(0x9E3779B97F4A7C55)
_ROLL = np.uint64(0xD6E8FEB86659FD93)


def _class_table(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for b in separators:
        table[b] = False
    return table


#: Words ``[^\x20\x09-\x0D]+``.
SPACED = _class_table([0x20, *range(0x09, 0x0E)])
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased texts, told from the text as it is (A-Z count).
ALNUM = _class_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Bytes with A-Z lower-cased and nothing else changed.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER_ARRAY = np.frombuffer(LOWER, dtype=np.uint8)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer and n+1 offsets of a string column; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def row_groups(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def sliced(batches: Iterator[pa.RecordBatch], at: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to rows of at most ``limit`` bytes (of a text column) or items
    (of an array column); a longer row stands alone. Bounds what a step holds."""
    for batch in batches:
        column = batch.column(at)
        offsets = column.offsets.to_numpy() if pa.types.is_list(column.type) else flat(column)[1]
        for lo, hi in row_groups(offsets - offsets[0], limit):
            yield batch.slice(lo, hi - lo)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_slices(word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SLICE_BYTES that cut no run of word bytes."""
    a, n = 0, len(word)
    while a < n:
        b = a + SLICE_BYTES
        if b >= n:
            yield a, n
            return
        gaps = np.flatnonzero(~word[a:b])
        if len(gaps):
            b = a + int(gaps[-1]) + 1
        else:  # one run of word bytes: up to the next gap
            step = SLICE_BYTES
            while b < n and word[b]:
                more = np.flatnonzero(~word[b:b + step])
                b = b + int(more[0]) if len(more) else min(b + step, n)
            b = min(b, n)
        yield a, b
        a = b


def word_table(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray, lower: bool = False,
               spans: bool = False, hashes: bool = True):
    """Words of every row: 64-bit hashes, first word index per row (n+1), spans.

    A word never crosses a row. ``spans`` adds byte starts and ends.
    """
    word = classes[buf]
    inner = offsets[1:-1]
    hs, starts, ends = [], [], []
    for a, b in word_slices(word):
        w = word[a:b]
        before = np.empty(b - a, dtype=bool)
        before[0] = a > 0 and word[a - 1]
        before[1:] = w[:-1]
        cut = inner[np.searchsorted(inner, a, "left"):np.searchsorted(inner, b, "left")] - a
        before[cut] = False
        after = np.empty(b - a, dtype=bool)
        after[-1] = False
        after[:-1] = w[1:]
        after[cut[cut > 0] - 1] = False
        s = np.flatnonzero(w & ~before)
        e = np.flatnonzero(w & ~after) + 1
        starts.append(s + a)
        if spans:
            ends.append(e + a)
        if hashes:
            size = b - a
            up, down = _powers(max(SLICE_BYTES, 1 << (size - 1).bit_length()))
            bytes_ = buf[a:b]
            if lower:
                bytes_ = _LOWER_ARRAY[bytes_]
            total = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum((bytes_.astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
            h = (total[e] - total[s]) * down[s]
            h += (e - s).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)
            hs.append(mix(h))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    starts = join(starts, np.int64)
    first = np.searchsorted(starts, offsets, "left")
    out = (join(hs, np.uint64) if hashes else None, first)
    return (*out, starts, join(ends, np.int64)) if spans else out


def word_keys(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every word (byte spans of ``buf``).

    Words take in eight bytes at a time and are mixed after each, so words of up to eight bytes never share the first
    hash with another of their length; words over LONG_WORD bytes are hashed by XXH3 (128 bits).
    """
    size = (ends - starts).astype(np.uint64)
    one = mix(size * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x243F6A8885A308D3))
    two = mix(size * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x13198A2E03707344))
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    at = np.flatnonzero(size <= LONG_WORD)
    for j in range(0, LONG_WORD, 8):
        at = at[size[at] > j] if j else at
        if not len(at):
            break
        piece = eight[starts[at] + j]
        left = size[at] - np.uint64(j)
        piece &= np.where(left < 8, (np.uint64(1) << (np.minimum(left, 7) * np.uint64(8))) - np.uint64(1), ~np.uint64(0))
        one[at] = mix((one[at] ^ piece) * np.uint64(0xFF51AFD7ED558CCD))
        two[at] = mix((two[at] + piece) * np.uint64(0xC4CEB9FE1A85EC53))
    for i in np.flatnonzero(size > LONG_WORD):
        whole = xxhash.xxh3_128_intdigest(buf[starts[i]:ends[i]].tobytes())
        one[i], two[i] = whole & (1 << 64) - 1, whole >> 64
    return one, two


def rolling_prime(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp of each k consecutive words modulo the prime 2^31 - 1 (32-bit integers)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint32)
    prime = np.uint64((1 << 31) - 1)
    h = h % prime
    out = h[:n].copy()
    for j in range(1, k):
        out *= np.uint64(1_220_703_125)
        out += h[j:j + n]
        out %= prime
    return out.astype(np.uint32)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hash of each k consecutive words (rows not regarded)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _ROLL
        out += h[j:j + n]
    return mix(out)


def text_slices(data: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``limit`` bytes, cut after ASCII space only."""
    a, n = 0, len(data)
    while a < n:
        b = a + limit
        if b >= n:
            yield data[a:]
            return
        cut = max(data.rfind(c, a, b) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1
        while cut <= a:
            window = data[b:b + limit]
            found = [window.find(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")]
            found = [x for x in found if x >= 0]
            if found:
                cut = b + min(found) + 1
            elif b + limit >= n:
                cut = n
            else:
                b += limit
        yield data[a:cut]
        a = cut
