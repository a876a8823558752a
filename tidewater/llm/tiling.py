"""Benchmark decontamination by greedy string tiling.

Words are lower-cased ASCII-wise and stripped of ASCII punctuation. A document
and a benchmark item that share a seed, ``MIN_MATCH`` consecutive words, are
tiled: the longest match of words that are unmarked on both sides is found by
running Karp-Rabin fingerprints and marked, again and again, until none of ``MIN_MATCH`` words is left. A word is in
one tile at most, and tiles may lie in any order, so a passage whose sentences
were moved is still found. A document whose tiles cover at least ``THRESHOLD``
of an item's words is contaminated. An item of fewer than ``MIN_MATCH`` words is matched whole.

Seeds join as distinct ones: a text's different seeds against the places of the items' seeds, so a text that
repeats a phrase costs no more than the benchmark's words, and tiling takes memory in proportion to text and item. An item
is tiled only if the words that its shared seeds cover could reach the best coverage so far or the threshold.

The benchmark is the query set: its words' hashes are sent to the tasks in
slices of about ``SLICE_WORDS`` counted words (more only if a single item has more), one pass over the documents for each.
A pass takes the documents with what the passes before found and writes them for the next one; slice and
broadcast are released before the next is built, so driver and tasks hold one at a time. The last pass is not written.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.llm._scratch import Tables
from tidewater.llm._text import Hashed, WordHashes, text_chunks, windows

MIN_MATCH = 5
THRESHOLD = 0.8
SLICE_WORDS = 4_000_000
_FOLD = bytes.maketrans((string.ascii_uppercase + string.punctuation).encode(),
                        (string.ascii_lowercase + " " * len(string.punctuation)).encode())
_BASE = 0x9E3779B97F4A7C15


def fold(text: bytes) -> bytes:
    return text.translate(_FOLD)


class Seeds:
    """A slice of the benchmark: items' words behind each other, and by length their seeds in order of hash."""

    def __init__(self, ids: list, texts: list[bytes]):
        h = Hashed([fold(t) for t in texts], WordHashes())
        self.ids, self.counts, self.starts, self.words, self.item = ids, h.counts, h.starts, h.words, h.doc
        self.least = np.minimum(h.counts, MIN_MATCH)
        self.tables = {}
        for n in np.unique(self.least[self.least > 0]).tolist():
            at = h.whole(n)
            at = at[self.least[h.doc[at]] == n]
            seeds = windows(h.words, n, salt=n)[at]
            order = np.argsort(seeds, kind="stable")
            may = np.zeros(1 << max(16, int(len(seeds) * 16).bit_length()), bool)
            may[seeds & np.uint64(len(may) - 1)] = True
            self.tables[n] = seeds[order], at[order], may

    def shared(self, n: int, seeds: np.ndarray) -> np.ndarray:
        """Which of a text's seeds of n words some item has."""
        known, _, may = self.tables[n]
        out = may[seeds & np.uint64(len(may) - 1)]
        some = seeds[out]
        out[out] = known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some
        return out

    def places(self, n: int, seeds: np.ndarray) -> np.ndarray:
        """Places in the benchmark's words of the given different seeds of n words."""
        known, at, _ = self.tables[n]
        lo, hi = np.searchsorted(known, seeds, "left"), np.searchsorted(known, seeds, "right")
        count = hi - lo
        return at[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]

    def of(self, i: int) -> np.ndarray:
        return self.words[self.starts[i]:self.starts[i] + self.counts[i]]


class _Side:
    """The words of a text or an item that its shared seeds cover, with Karp-Rabin fingerprints of their windows of any length."""

    def __init__(self, words: np.ndarray, at: np.ndarray, least: int):
        covered = np.zeros(int(at.max()) + least, bool)
        for j in range(least):
            covered[at + j] = True
        self.place = np.flatnonzero(covered)
        n = len(self.place)
        self.cut = np.r_[True, np.diff(self.place) != 1]
        self.free = np.ones(n, bool)
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64)])
        self.sums = np.r_[np.uint64(0), np.cumsum(words[self.place] * down)]

    def room(self) -> np.ndarray:
        """Unmarked words in a row from each place on."""
        n = len(self.free)
        stop = np.where(~self.free | self.cut, np.arange(n), n)
        after = np.r_[np.minimum.accumulate(stop[::-1])[::-1][1:], n]
        return np.where(self.free, after - np.arange(n), 0)

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.up[at]


def _common(text: _Side, item: _Side, text_room: np.ndarray, item_room: np.ndarray, n: int):
    """Unmarked matches of n words: places in the text, first of the equal ones in the item, and the item's fingerprints and places in order."""
    a, b = np.flatnonzero(text_room >= n), np.flatnonzero(item_room >= n)
    if not len(a) or not len(b):
        return None
    keys = item.prints(b, n)
    order = np.argsort(keys, kind="stable")
    keys, b = keys[order], b[order]
    wanted = text.prints(a, n)
    at = np.searchsorted(keys, wanted)
    there = keys[np.minimum(at, len(keys) - 1)] == wanted
    return (a[there], at[there], keys, b) if there.any() else None


def tile(text: np.ndarray, item: np.ndarray, text_at: np.ndarray, item_at: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(text place, item place, words)`` of a text's and an item's word hashes.

    ``text_at`` and ``item_at`` hold the places of all seeds of ``least`` words that both have, and may hold more. The longest
    match goes first (of equal ones the first in the text, then in the item). Its length is
    searched by halving, as a match holds shorter ones; all matches of that length are marked in one go over the text.
    """
    if not len(text_at) or not len(item_at):
        return []
    t, i = _Side(text, text_at, least), _Side(item, item_at, least)
    tiles, most = [], min(len(t.place), len(i.place))
    while most >= least:
        rooms = t.room(), i.room()
        low, high, found = least - 1, min(most, int(rooms[0].max()), int(rooms[1].max())), None
        while low < high:
            n = (low + high + 1) // 2
            matches = _common(t, i, *rooms, n)
            if matches is None:
                high = n - 1
            else:
                low, found = n, matches
        if found is None:
            break
        n, end, (starts, firsts, keys, places) = low, -1, found
        marked, turn = bytearray((~i.free).tobytes()), {}
        for a, first in zip(starts.tolist(), firsts.tolist(), strict=True):
            if a < end:
                continue
            k = turn.get(first, first)  # the first of the item's equal places that is not marked yet
            while k < len(keys) and keys[k] == keys[first] and (marked[places[k]] or marked[places[k] + n - 1]):
                k += 1
            turn[first] = k
            if k < len(keys) and keys[k] == keys[first]:
                b, end = int(places[k]), a + n
                tiles.append((int(t.place[a]), int(i.place[b]), n))
                t.free[a:end] = False
                i.free[b:b + n] = False
                marked[b:b + n] = b"\x01" * n
        most = n - 1
    return tiles


def _cover(seeds: Seeds, texts: list[bytes], hashes: WordHashes) -> list[tuple]:
    """By text: item of the largest coverage, coverage, tiles of that item, and all items over the threshold; items by number."""
    h = Hashed([fold(t) for t in texts], hashes)
    found = {}  # by text and length: places and hashes of the seeds that some item has
    for n in seeds.tables:
        every, at = windows(h.words, n, salt=n), h.whole(n)
        if len(at):
            at = at[seeds.shared(n, every[at])]
            doc = h.doc[at]
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(at) else []
            for lo, hi in zip(first, [*first[1:], len(at)], strict=False):
                d = int(doc[lo])
                found.setdefault(d, {})[n] = (at[lo:hi] - h.starts[d], every[at[lo:hi]])
    out = [(None, 0.0, 0, [])] * len(texts)
    for d, by_length in found.items():
        words = h.words[h.starts[d]:h.ends[d]]
        bounds = []  # words of an item that its shared seeds cover, by item
        for n, (_, keys) in by_length.items():
            places = np.sort(seeds.places(n, np.unique(keys)))
            item = seeds.item[places]
            first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
            step = np.minimum(np.diff(np.r_[places, places[-1] + n]), n)
            step[np.r_[first[1:] - 1, len(places) - 1]] = n
            total = np.add.reduceat(step, first)
            bounds += [(-c / int(seeds.counts[i]), int(i), n, places[lo:hi] - seeds.starts[i])
                       for c, i, lo, hi in zip(total.tolist(), item[first], first, np.r_[first[1:], len(places)], strict=True)]
        best, hits = None, []
        for bound, i, n, item_at in sorted(bounds, key=lambda x: x[:2]):
            if best is not None and -bound < min(-best[0], THRESHOLD):
                break  # items come by bound, so no later one reaches either
            text_at, keys = by_length[n]
            own = np.sort(windows(seeds.of(i), n, salt=n))
            text_at = text_at[own[np.minimum(np.searchsorted(own, keys), len(own) - 1)] == keys]
            tiles = tile(words, seeds.of(i), text_at, item_at, n)
            covered = sum(x[2] for x in tiles) / int(seeds.counts[i])
            this = (-covered, seeds.ids[i], len(tiles), i)
            if best is None or this[:3] < best[:3]:
                best = this
            if covered >= THRESHOLD:
                hits.append(i)
        out[d] = (best[3], -best[0], best[2], sorted(hits))
    return out


def _slices(benchmark: DataFrame, most: int):
    """The benchmark's items with id and words, one slice at a time, each in order of id.

    Items are dealt to classes by hash, many for each slice; the classes' counted words decide which of them make a slice.
    """
    items = benchmark.select(F.col("item_id").alias("id"), F.col("text").alias("t")).where("id IS NOT NULL AND t IS NOT NULL").distinct()
    size = F.size(F.regexp_extract_all(F.translate("t", string.punctuation, " " * len(string.punctuation)), F.lit(r"[^\x20\x09-\x0D]+"), 0))
    items = items.withColumn("n", size).where("n > 0")
    words = items.agg(F.sum("n").alias("n")).first()["n"] or 0
    classes = 64 * -(-words // most) if words > most else 1
    items = items.withColumn("class", F.pmod(F.xxhash64("t"), F.lit(classes)))
    group, total = [], 0
    for r in items.groupBy("class").agg(F.sum("n").alias("n")).orderBy("class").collect():
        if group and total + r["n"] > most:
            yield _seeds(items, group)
            group, total = [], 0
        group.append(r["class"])
        total += r["n"]
    if group:
        yield _seeds(items, group)


def _seeds(items: DataFrame, classes: list[int]) -> Seeds:
    rows = items.where(F.col("class").isin(classes)).orderBy("id", "t").collect()
    return Seeds([r["id"] for r in rows], [r["t"].encode() for r in rows])


def _passes(rows: DataFrame, benchmark: DataFrame, slice_words: int, run) -> DataFrame:
    """``run(batches, seeds)`` over the rows for each slice in turn; all but the last result are written."""
    context, tables, last = rows.sparkSession.sparkContext, Tables(rows.sparkSession, "tiling"), None
    for seeds in _slices(benchmark, slice_words):
        if last is not None:
            rows = tables.put("rows", rows)
            last.unpersist()
        last = context.broadcast(seeds)
        rows = rows.mapInArrow(lambda batches, shared=last: run(batches, shared.value), rows.schema)
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Contamination of each document.

    ``docs(doc_id, text)`` and ``benchmark(item_id, text)`` to doc_id,
    contaminated, item_id and coverage of the item covered most (of equal ones
    the smallest id; null and 0 if no seed is shared), n_tiles,
    and item_ids, all items over the threshold in order. Ids may have any type that has an order. Null texts count as empty; items
    without id or words match nothing, items of fewer than ``MIN_MATCH`` words match as a whole. An empty benchmark leaves
    every document clean. Repeated rows have a row each, whatever the benchmark's size. Other columns are not read.
    """
    kind = benchmark.schema["item_id"].dataType
    names = ["contaminated", "item_id", "coverage", "n_tiles", "item_ids"]
    kinds = [T.BooleanType(), kind, T.DoubleType(), T.LongType(), T.ArrayType(kind)]
    arrow = [to_arrow_type(k) for k in kinds]

    def run(batches, seeds):
        hashes = WordHashes()
        for batch in batches:
            for part, texts in text_chunks(batch):
                rows = []
                before = zip(*(part.column(c).to_pylist() for c in names), strict=True)
                for (_, item, most, count, every), (i, covered, tiles, hits) in zip(before, _cover(seeds, texts, hashes), strict=True):
                    if i is not None and (item is None or (-covered, seeds.ids[i], tiles) < (-most, item, count)):
                        item, most, count = seeds.ids[i], covered, tiles
                    every = sorted([*every, *(seeds.ids[k] for k in hits)])
                    rows.append((bool(every), item, most, count, every))
                cols = zip(*rows, strict=True) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), *(pa.array(c, k) for c, k in zip(cols, arrow, strict=True))],
                                                 ["doc_id", "text", *names])

    start = [F.lit(x).cast(k).alias(c) for c, k, x in zip(names[:4], kinds[:4], (False, None, 0.0, 0), strict=True)]
    rows = docs.select("doc_id", "text", *start, F.array().cast(kinds[4]).alias("item_ids"))
    return _passes(rows, benchmark, slice_words, run).drop("text")


def keep_clean(docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """The documents, all columns, that are not contaminated."""
    def run(batches, seeds):
        hashes = WordHashes()
        for batch in batches:
            for part, texts in text_chunks(batch):
                yield part.filter(pa.array([not x[3] for x in _cover(seeds, texts, hashes)], pa.bool_()))

    return _passes(docs, benchmark, slice_words, run)


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document against the whole benchmark."""
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
