"""Words of whole texts, hashed on their UTF-8 bytes a batch at a time.

A word's hash is a polynomial over per-byte random 64-bit values, taken from
running sums, so no Python object is made per word. Long texts are worked on
in pieces that end between words, which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19  # bytes worked on at a time

_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = 20240607
_BYTES = np.random.RandomState(_SEED).randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_BYTES = _BYTES * np.uint64(2) + np.uint64(1)


def _table(members) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


#: Bytes of words ``[^\\x20\\x09-\\x0D]+``.
SOLID = ~_table([0x20, *range(0x09, 0x0E)])
#: ASCII letters and every byte of a longer UTF-8 character.
LETTERS = _table([*range(65, 91), *range(97, 123), *range(128, 256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up = np.full(n, _BASE % 2**64, dtype=np.uint64)
    down = np.full(n, pow(_BASE, -1, 2**64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def columns(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    text = pc.fill_null(text.cast(pa.large_utf8()), "")
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = text.buffers()
    at = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``PIECE`` bytes (a longer text stands alone)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def runs(data: np.ndarray, member: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of ``member`` bytes; ``cuts`` end runs."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = member[data]
    start, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    start[cuts] |= inside[1:-1][cuts]
    end[cuts - 1] |= inside[1:-1][cuts - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _pieces(data: np.ndarray, member: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most a few ``PIECE`` bytes that end between words."""
    at = 0
    while at < len(data):
        end = min(at + 4 * PIECE, len(data))
        if end < len(data):
            gap = np.flatnonzero(~member[data[at:end]])
            if len(gap):
                end = at + int(gap[-1]) + 1
            else:  # one word longer than a piece
                more = np.flatnonzero(~member[data[end:]])
                end = end + int(more[0]) + 1 if len(more) else len(data)
        yield at, end
        at = end


def words(
    data: np.ndarray, offsets: np.ndarray, member: np.ndarray = SOLID, first: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, rows): the lower-cased words of texts laid end to end.

    ``rows`` has one more entry than there are texts: text i has the words
    ``rows[i]`` to ``rows[i + 1]``. With ``first``, hashes are of the first so
    many bytes of each word, and 0 for words that are not longer.
    """
    hashes, starts, ends = [], [], []
    for lo, hi in _pieces(data, member):
        part = LOWER[data[lo:hi]]
        s, e = runs(part, member, offsets - lo)
        up, down = _powers(1 << max(19, int(hi - lo).bit_length()))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[part] * up[: len(part)], out=sums[1:])
        till = np.minimum(e, s + first) if first else e
        value = mix((sums[till] - sums[s]) * down[s] + (till - s).astype(np.uint64))
        hashes.append(np.where(e - s > first, mix(value + np.uint64(first)), np.uint64(0)) if first else value)
        starts.append(s + lo)
        ends.append(e + lo)
    if not hashes:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    s = np.concatenate(starts)
    return np.concatenate(hashes), s, np.concatenate(ends), np.searchsorted(s, offsets)


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its ``k``-word shingles.

    A text with fewer words has its whole sequence as one; without words none.
    """
    n = len(hashes)
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        if n - j > 0:
            factor = np.uint64(pow(_BASE, j + 2, 2**64))
            grams[: n - j] += mix(hashes[j:] + np.uint64(j)) * factor
    grams = mix(grams)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            whole = b - a
            for h in hashes[a:b].tolist():
                whole = (whole * _BASE + h) % 2**64
            yield mix(np.array([whole], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; equal bytes have equal hashes."""
    up, down = _powers(1 << max(19, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
