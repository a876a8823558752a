"""Ranked lexical search with bit-sliced Bloom signatures.

The index cuts the documents into blocks of similar size. A block is a bit matrix,
a column for each document and a row (a slice) for each place of a Bloom filter: a document's column
holds, for each of its terms and each level 0 to ``LEVELS - 1`` that the term's count reaches (level l: 2^l
occurrences or more), ``PROBES`` bits. The AND of a term's slices at a level is the
set of the block's documents that may hold it that often; it never misses one.

A search sums, level by level, the weights of an item's terms over these sets.
Each level's sum times the most that the level can add to a term of that document, whose length is known exactly,
is an upper bound of the document's score. The documents of a block are rescored exactly, from their texts, in the
order of their bounds, until the bound is below the item's last place so far: whatever is left is
provably no hit. Each task keeps its best by item; Spark ranks those.

Items are searched in blocks of at most ``BLOCK_TERMS`` terms, a pass over the index for each, and what is
broadcast is such a block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tidewater.llm._numbers import gathered
from tidewater.llm._scratch import Tables
from tidewater.llm._text import byte_texts, mix

LEVELS = 4
PROBES = 4
#: Rows of a block's matrix for each entry of its largest document.
ROWS_BY_ENTRY = 12
BLOCK_DOCS = 512
#: Cells of a block's matrix; bounds its memory and the documents of a block of long texts.
BLOCK_CELLS = 1 << 23
#: Terms, repeats included, of the items that are searched at a time.
BLOCK_TERMS = 20_000
FIRST = 10
_STEPS = 2 ** np.arange(1, LEVELS)
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters, digits and whatever is not ASCII; only A-Z lower-cased."""
    return text.translate(_TERMS).split()


def entry_rows(hashes: np.ndarray, level: np.ndarray | int, rows: int) -> np.ndarray:
    """The ``PROBES`` rows of terms at a level, a line for each."""
    h = mix(hashes + np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = mix(h) | np.uint64(1)
    return np.stack([((h + np.uint64(k) * step) & np.uint64(rows - 1)).astype(np.int64) for k in range(PROBES)])


class _Hashes(dict):
    limit = 200_000

    def __missing__(self, term: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[term] = xxhash.xxh3_64_intdigest(term)
        return h


def signature(hashes: list[np.ndarray], levels: list[np.ndarray], rows: int) -> np.ndarray:
    """The slices of a block, packed: bit d of row r is document d's."""
    bits = np.zeros((rows, len(hashes)), bool)
    h, top = np.concatenate(hashes), np.concatenate(levels)
    doc = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
    for level in range(LEVELS):
        at = top >= level
        bits[entry_rows(h[at], level, rows), doc[at]] = True
    return np.packbits(bits, axis=1)


def _index(batches):
    get = _Hashes().__getitem__
    for table in gathered(batches, "text"):
        texts = byte_texts(table.column("text").combine_chunks())
        ids = table.column("doc_id").combine_chunks()
        hashes, levels, n, most, entries = [], [], [], [], []
        for text in texts:
            counts = Counter(terms(text))
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            top = np.searchsorted(_STEPS, tf, "right")
            hashes.append(np.fromiter(map(get, counts), np.uint64, len(counts)))
            levels.append(top)
            n.append(int(tf.sum()))
            most.append(int(tf.max(initial=0)))
            entries.append(int((top + 1).sum()))
        order = np.argsort(entries, kind="stable")
        lo = 0
        while lo < len(order):
            # documents of a block differ in their entries by a factor of two at most
            rows, hi = 64, lo
            while hi < len(order) and hi - lo < BLOCK_DOCS:
                need = entries[order[hi]]
                size = 1 << max(6, math.ceil(math.log2(max(1, need * ROWS_BY_ENTRY))))
                if hi > lo and (need > 2 * max(8, entries[order[lo]]) or size * (hi - lo + 1) > BLOCK_CELLS):
                    break
                rows, hi = size, hi + 1
            block = order[lo:hi].tolist()
            slices = signature([hashes[i] for i in block], [levels[i] for i in block], rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows], pa.int64()), pa.array([slices.tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), ids.take(pa.array(block))),
                 pa.array([[n[i] for i in block]], pa.list_(pa.int64())), pa.array([[most[i] for i in block]], pa.list_(pa.int64())),
                 pa.array([[texts[i] for i in block]], pa.list_(pa.binary()))],
                ["rows", "slices", "doc_ids", "n", "most", "texts"])
            lo = hi


def build_index(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to blocks: rows, slices, doc_ids, n and most (a document's terms, and the most of one), texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _index, f"rows long, slices binary, doc_ids array<{kind}>, n array<long>, most array<long>, texts array<binary>")


def _saturation(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n, docs: int, total: int):
    """A document's m."""
    return 100 - 75 + (75 * n * docs) // total


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Block:
    """Items that are searched together: their distinct terms, and each item's terms with repeats."""

    def __init__(self, items: list[list[bytes]]):
        counts = [Counter(x) for x in items]
        self.words = sorted(set().union(*counts))
        place = {w: i for i, w in enumerate(self.words)}
        self.at = [np.array([place[w] for w in c], np.int64) for c in counts]
        self.times = [np.array(list(c.values()), np.int64) for c in counts]
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)
        self.weights = np.zeros(len(self.words), np.int64)
        self.docs = self.total = 0

    def weigh(self, docs: int, total: int, df: dict[int, int]) -> None:
        self.docs, self.total = docs, total
        self.weights = np.array([weight(docs, df.get(i, 0)) for i in range(len(self.words))], np.int64)
        self.worth = [self.weights[at] * times for at, times in zip(self.at, self.times, strict=True)]
        self.pairs = [[(self.words[i], w) for i, w in zip(at.tolist(), worth.tolist(), strict=True)]
                      for at, worth in zip(self.at, self.worth, strict=True)]
        # sums of whole numbers below 2^24 are exact in single precision
        self.kind = np.float32 if max((int(x.sum()) for x in self.worth), default=0) < 1 << 24 else np.float64

    def bounds(self, slices: np.ndarray, n: np.ndarray, most: np.ndarray) -> Iterator[np.ndarray]:
        """By item: an upper bound of the score of each of the index block's documents."""
        m = length_norm(n, self.docs, self.total)
        sets, before, gains = [], None, []
        for level in range(LEVELS):
            found = np.bitwise_and.reduce(slices[entry_rows(self.hashes, level, len(slices))], axis=0)
            if before is not None:
                found &= before
            before = found
            sets.append(np.unpackbits(found, axis=1, count=len(n)).astype(self.kind))
            top = most if level == LEVELS - 1 else np.minimum(most, (1 << level + 1) - 1)
            gains.append(_saturation(top, m) - (_saturation(np.minimum(most, (1 << level) - 1), m) if level else 0))
        for at, worth in zip(self.at, self.worth, strict=True):
            w = worth.astype(self.kind)
            # the margin is wider than what doubles may round away of very large sums
            yield sum((w @ sets[level][at]) * gains[level] for level in range(LEVELS)) * (1 + 1e-12)

    def score(self, item: int, tf: dict[bytes, int], n: int) -> int:
        m, out, get = 8 * length_norm(n, self.docs, self.total), 0, tf.get
        for word, worth in self.pairs[item]:
            f = get(word)
            if f:
                out += worth * ((1_000_000_000 * f) // (1000 * f + m))
        return out


def _found(shared):
    """How many documents of a task hold each term of the items."""
    def run(batches):
        block = shared.value
        place = {w: i for i, w in enumerate(block.words)}
        known, df = frozenset(place), np.zeros(len(place), np.int64)
        for batch in batches:
            for text in batch.column("texts").flatten():
                for w in known.intersection(terms(text.as_py())):
                    df[place[w]] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])
    return run


class _Top:
    """The best of one item, worst first; of equal scores the larger id is worse, null ids worst of all."""

    def __init__(self, first: int):
        self.first, self.heap = first, []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.first else 1

    def add(self, score: int, key: tuple, doc_id) -> None:
        if score > 0:
            entry = (score, key, len(self.heap), doc_id)
            if len(self.heap) < self.first:
                heappush(self.heap, entry)
            elif entry[:2] > self.heap[0][:2]:
                heapreplace(self.heap, entry)


class _Later:
    """Orders ids the other way round, null before all."""

    def __init__(self, doc_id):
        self.doc_id = doc_id

    def __lt__(self, other):
        if self.doc_id is None or other.doc_id is None:
            return self.doc_id is None and other.doc_id is not None
        return self.doc_id > other.doc_id

    def __eq__(self, other):
        return self.doc_id == other.doc_id


def _search(shared, kind: pa.DataType, first: int, tally=None):
    def run(batches):
        block = shared.value
        tops = [_Top(first) for _ in block.at]
        for batch in batches:
            cols = [batch.column(c) for c in ("rows", "slices", "doc_ids", "n", "most", "texts")]
            for r in range(len(batch)):
                rows, raw, ids, n, most, texts = (c[r] for c in cols)
                n, most = n.values.to_numpy(), most.values.to_numpy()
                slices = np.frombuffer(raw.as_buffer(), np.uint8).reshape(rows.as_py(), -1)
                ids, texts, counted = ids.values, texts.values, {}
                for item, bound in enumerate(block.bounds(slices, n, most)):
                    top = tops[item]
                    for d in np.argsort(-bound, kind="stable").tolist():
                        if bound[d] < top.least():
                            break
                        if d not in counted:
                            counted[d] = dict(Counter(terms(texts[d].as_py())))
                        doc_id = ids[d].as_py()
                        if tally:
                            tally.add(1)
                        top.add(block.score(item, counted[d], int(n[d])), _Later(doc_id), doc_id)
        out = [(i, e[3], e[0]) for i, t in enumerate(tops) for e in t.heap]
        i, d, s = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(d, kind), pa.array(s, pa.int64())], ["item", "doc_id", "score"])
    return run


def item_blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Distinct items with a term, their ids and terms, in blocks of about ``most`` terms; one block at a time is on the driver."""
    ids, words, size = [], [], 0
    for r in items.select("item_id", "text").where("text IS NOT NULL").distinct().toLocalIterator():
        found = terms(r["text"].encode())
        if not found:
            continue
        if words and size + len(found) > most:
            yield ids, words
            ids, words, size = [], [], 0
        ids.append(r["item_id"])
        words.append(found)
        size += len(found)
    if words:
        yield ids, words


def search(docs: DataFrame, items: DataFrame, first: int = FIRST, block_terms: int = BLOCK_TERMS, tally=None) -> DataFrame:
    """The ``first`` documents for each item: item_id, rank, doc_id, score.

    ``docs(doc_id, text)`` and ``items(item_id, text)``. Only scores above 0 count; equal scores go by ascending doc_id,
    null last. A null text, or one without a term, is found by no item and finds nothing; very long texts
    are blocks of their own. Repeated documents are documents each, repeated items one; texts of one
    item_id that differ are items each. Empty tables give no rows. Other columns are not read.
    ``tally``, an accumulator, counts the documents that are rescored.
    """
    spark = docs.sparkSession
    doc_kind, item_kind = (t.schema[c].dataType for t, c in ((docs, "doc_id"), (items, "item_id")))
    tables = Tables(spark, "signatures")
    index = tables.put("index", build_index(docs))
    sizes = index.select(F.explode("n").alias("n")).where("n > 0").agg(F.count("n").alias("docs"), F.sum("n").alias("total")).first()
    out, arrow = None, to_arrow_type(doc_kind)
    for k, (ids, words) in enumerate(item_blocks(items, block_terms) if sizes["docs"] else ()):
        block = Block(words)
        plain = spark.sparkContext.broadcast(block)
        df = {r["term"]: r["df"] for r in index.select("texts").mapInArrow(_found(plain), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()}
        plain.unpersist()
        block.weigh(sizes["docs"], sizes["total"], df)
        shared = spark.sparkContext.broadcast(block)
        hits = index.mapInArrow(_search(shared, arrow, first, tally), f"item long, doc_id {doc_kind.simpleString()}, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {item_kind.simpleString()}")
        ranks = (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
                 .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        ranks = tables.put(f"ranks{k}", ranks)
        shared.unpersist()
        out = ranks if out is None else out.unionByName(ranks)
    tables.drop("index")
    if out is None:
        return spark.createDataFrame([], f"item_id {item_kind.simpleString()}, rank int, doc_id {doc_kind.simpleString()}, score long")
    return out


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: DuckDB: all terms of all documents, counted.
SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
len AS (SELECT doc_id, count(*)::BIGINT AS n FROM t GROUP BY doc_id),
tot AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM len),
m AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // total AS m FROM len, tot),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, tot GROUP BY term, docs),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
