"""Words and word-window hashes of many texts at once (numpy, inside tasks).

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``; that is what
``bytes.split()`` gives, and the same as the regex ``[^\\x20\\x09-\\x0D]+`` on
the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are hashed at a time; bounds a task's arrays.
CHUNK_BYTES = 3 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash by word; forgets everything when full, so its memory is bounded."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, salt, np.uint64)
    for j in range(n):
        out *= _ODD
        out += words[j:j + count]
    return mix(out)


def chunks(lengths: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer row is a range of its own."""
    total, lo = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > most:
            yield lo, i
            total, lo = 0, i
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def text_chunks(batch: pa.RecordBatch, column: str = "text",
                most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with their texts, about ``most`` bytes at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for lo, hi in chunks(sizes, most):
        part = batch.slice(lo, hi - lo)
        yield part, byte_texts(part.column(column))


class Hashed:
    """Word hashes of several texts behind each other.

    ``words``: all hashes; ``ends``: index behind each text's last word;
    ``doc``: the text of each word; ``at``: index of a word in its text.
    """

    def __init__(self, texts: list[bytes], hashes: WordHashes):
        lists = [t.split() for t in texts]
        self.counts = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        get = hashes.__getitem__
        total = int(self.counts.sum())
        self.words = np.fromiter((h for x in lists for h in map(get, x)), np.uint64, total)
        self.doc = np.repeat(np.arange(len(lists)), self.counts)
        self.at = np.arange(total) - np.repeat(self.starts, self.counts)

    def whole(self, n: int) -> np.ndarray:
        """Start positions of the windows of ``n`` words that stay inside one text."""
        if len(self.words) < n:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.doc[:len(self.words) - n + 1] == self.doc[n - 1:])
