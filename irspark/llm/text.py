"""Shared text helpers for Arrow batches: whole texts as bytes, words, hashes, shingles.

A word is a run of bytes other than space and the control characters 0x09 to 0x0D, after
lower-casing A-Z only.  Both rules are those of ``bytes.lower`` and ``bytes.split``, and they
never cut a UTF-8 sequence.  A null text counts as empty.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20                      # bytes of text handled at once; longer texts go block by block
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
IS_LETTER = np.zeros(256, bool)      # A-Z, a-z and every byte of a non-ASCII character
IS_LETTER[0x41:0x5B] = IS_LETTER[0x61:0x7B] = IS_LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_WEIGHTS = np.full(1 << 12, np.uint64(0x9E3779B97F4A7C15)).cumprod(dtype=np.uint64)


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of a text column of an Arrow batch; null is b''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.string()).cast(pa.binary()).to_pylist()]


def slices(batches, column: int, limit: int = BLOCK):
    """Arrow batches in slices of about ``limit`` bytes of text, so that a task holds few texts as
    Python objects at once.  One long text stands alone; no row is left out."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.string())), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 1)
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def groups(texts: list[bytes], limit: int = BLOCK):
    """(first, last) index ranges of about ``limit`` bytes each; one long text stands alone."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def blocks(text: bytes, limit: int = BLOCK):
    """The whole text in pieces of about ``limit`` bytes, cut only at white space."""
    at = 0
    while len(text) - at > limit:
        cut = _SPACE.search(text, at + limit)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (a fixed bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


IS_WORD = ~_IS_SPACE


def spans(buf: np.ndarray, kind: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (or of the runs of another kind of byte) in a byte array."""
    inside = np.empty(len(buf) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = kind[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    byte = buf[at + np.repeat(starts, sizes)]
    value = (_LOWER[byte] + np.uint64(1)) * _WEIGHTS[at & (len(_WEIGHTS) - 1)]
    return mix(np.add.reduceat(value, np.cumsum(sizes) - sizes) + mix(sizes.astype(np.uint64)))


def hashed_words(texts: list[bytes], kind: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word of the texts, in order.  Rows index the list."""
    rows, hashes = [], []
    for first, last in groups(texts):
        if last - first == 1:
            for piece in blocks(texts[first]):
                buf = np.frombuffer(piece, np.uint8)
                h = hash_words(buf, *spans(buf, kind))
                hashes.append(h)
                rows.append(np.full(len(h), first, np.int64))
            continue
        sizes = np.array([len(t) + 1 for t in texts[first:last]])
        buf = np.frombuffer(b" ".join(texts[first:last]), np.uint8)
        starts, ends = spans(buf, kind)
        hashes.append(hash_words(buf, starts, ends))
        rows.append(first + np.searchsorted(np.cumsum(sizes), starts, "right"))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def shingle_hashes(rows: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every k-word shingle; a row of fewer words has its whole sequence as one."""
    if not len(rows):
        return rows, words
    step = np.uint64(0xD6E8FEB86659FD93)
    h = words.copy()
    full = np.ones(len(rows), bool)
    for j in range(1, k):
        ahead = np.zeros_like(words)
        ahead[:-j] = words[j:]
        same = np.zeros(len(rows), bool)
        same[:-j] = rows[j:] == rows[:-j]
        full &= same
        h = np.where(same, mix(h * step + ahead), h)
    first = np.r_[True, rows[1:] != rows[:-1]]
    short = np.zeros(len(rows), bool)
    short[first] = ~full[first]
    keep = full | short
    return rows[keep], h[keep]


def shingle_set(text: bytes, k: int) -> set[bytes]:
    """The distinct shingles of one text as byte strings (exact, for verifying)."""
    words = text.lower().split()
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


def bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of n rows in a sorted row array: row i is [b[i], b[i + 1])."""
    return np.searchsorted(rows, np.arange(n + 1))
