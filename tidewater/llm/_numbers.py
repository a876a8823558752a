"""Texts as numbers, without a vocabulary on any one machine.

A task turns about ``CHUNK_BYTES`` of text into a chunk: a dictionary of the
chunk's own words and, in place of each word, its place in that dictionary.
What all chunks know of a word is found by key: the dictionaries are summed or
joined by Spark, a row for each chunk and word, and the answers go back to their
chunk in one sort (``answered``). A word of any frequency has one row a chunk, so no
key is hot beyond the number of chunks, and nothing grows on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._scratch import Tables

CHUNK_BYTES = 16 << 20
#: One of each a process: making them anew costs as much as a short row.
_SHRINK, _GROW = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
#: Cells of a bit filter: 8 MB, whatever it holds.
FILTER_BITS = 26
#: Values that are worked on at a time, so that what is between two steps stays in the processor's cache.
BLOCK = 1 << 15


class Places(dict):
    """Place of each word in order of appearance; ``skip`` words have the given negative places."""

    def __init__(self, skip: dict[bytes, int]):
        super().__init__(skip)
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        p = self[word] = len(self.words)
        self.words.append(word)
        return p


def shrunk(data: bytes) -> bytes:
    return _SHRINK.compress(data)


def grown(data: bytes) -> bytes:
    return _GROW.decompress(data)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes: equal bytes of neighbours stand together, so small numbers take little room."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return shrunk(np.ascontiguousarray(planes))


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(grown(data), np.uint8)
    size = np.dtype(kind).itemsize
    out = np.empty((len(raw) // size, size), np.uint8)
    for j, plane in enumerate(raw.reshape(size, -1)):
        out[:, j] = plane
    return out.reshape(-1).view(kind)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values in order, by one sort."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def near_order(keys: np.ndarray) -> np.ndarray:
    """Order of 64-bit keys by the high bits that their places leave free: a plain sort is much faster than one that moves places along."""
    bits = np.uint64(max(1, len(keys) - 1).bit_length())
    order = np.sort(keys >> bits << bits | np.arange(len(keys), dtype=np.uint64))
    return (order & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)


def order_of(keys: np.ndarray) -> np.ndarray:
    """Stable order of 64-bit hashes, of which few differ in their low bits alone."""
    order = near_order(keys)
    there = keys[order]
    return order if (there[1:] >= there[:-1]).all() else np.argsort(keys, kind="stable")


def starts_of(ordered: np.ndarray) -> np.ndarray:
    """Whether a value is the first of its equals."""
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return first


def gathered(batches: Iterator[pa.RecordBatch], texts: str, most: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """Rows of a task in tables of about ``most`` bytes of text; a longer row is a table of its own."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > most:
                yield pa.Table.from_batches([*held, batch.slice(at, i - at)])
                held, size, at = [], 0, i
            size += n
        held.append(batch.slice(at))
    if size or any(len(b) for b in held):
        yield pa.Table.from_batches(held)


def answered(chunks: DataFrame, answers: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(chunk row, its answers)`` for each chunk.

    ``answers`` has the column ``chunk`` and columns that ``chunks`` has not. Chunk
    and answers meet in one shuffle by chunk, the chunk before its answers; ``run``
    takes a dict of the chunk's values and a dict of numpy arrays (lists, for binary columns), and returns a RecordBatch.
    """
    own, theirs = [c for c in chunks.columns if c != "chunk"], [c for c in answers.columns if c != "chunk"]
    kinds = {**dict(chunks.dtypes), **dict(answers.dtypes)}
    left = chunks.select("chunk", F.lit(True).alias("first_row"), *own, *[F.lit(None).cast(kinds[c]).alias(c) for c in theirs])
    right = answers.select("chunk", F.lit(False).alias("first_row"), *[F.lit(None).cast(kinds[c]).alias(c) for c in own], *theirs)
    rows = left.unionByName(right).repartition("chunk").sortWithinPartitions("chunk", F.desc("first_row"))

    def closed(head: dict, parts: list[pa.RecordBatch]):
        cols = {c: [x for p in parts for x in p.column(c).to_pylist()] if kinds[c] == "binary"
                else np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) if parts else np.empty(0) for c in theirs}
        return run(head, cols)

    def each(batches):
        head, parts = None, []
        for batch in batches:
            first = np.flatnonzero(batch.column("first_row").to_numpy(zero_copy_only=False))
            edges = [0, *first.tolist(), len(batch)]
            for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if k:  # a chunk's own row
                    if head is not None:
                        yield closed(head, parts)
                    head, parts = {c: batch.column(c)[lo].as_py() for c in ("chunk", *own)}, []
                    lo += 1
                if hi > lo:
                    parts.append(batch.slice(lo, hi - lo).select(theirs))
        if head is not None:
            yield closed(head, parts)

    return rows.mapInArrow(each, schema)


def ranked(rows: DataFrame, order: list, tables: Tables, key: str) -> DataFrame:
    """``rows`` with ``id``, 0 and up in the given order, which must be a total one.

    Spark sorts and writes them; a row's number is its place in its task plus the
    rows of the tasks before. Only the number of rows of each task passes the driver.
    """
    t = tables.put(key, rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    counts = sorted((r["part"], r["count"]) for r in t.groupBy(part.alias("part")).count().collect())
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(starts, "part long, start long")
    return (t.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("id", F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "start", "place"))


def filter_of(keys: DataFrame, key: str) -> np.ndarray:
    """A bit for the low ``FILTER_BITS`` bits of each 64-bit key: 8 MB for any number of keys.

    It spares shuffling most rows that no key matches; those it lets through by
    chance find nothing in the join that follows, so results never depend on it.
    """
    low = F.col(key).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (keys.select(F.shiftright(low, 6).alias("word"), F.pmod(low, F.lit(64)).cast("int").alias("bit"))
             .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return out


def may_hold(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out, cells = np.empty(len(keys), bool), cells.astype("<u8", copy=False).view(np.uint8)
    for lo in range(0, len(keys), BLOCK):
        low = (keys[lo:lo + BLOCK] & np.uint64((1 << FILTER_BITS) - 1)).view(np.int64)
        out[lo:lo + BLOCK] = cells[low >> 3] >> (low.astype(np.uint8) & np.uint8(7)) & np.uint8(1)
    return out
