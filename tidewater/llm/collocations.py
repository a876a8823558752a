"""Phrase collocations by direct-address tiling.

Frequent words are numbered by falling frequency, so the numbers that meet most
often are small. A chunk of text is a row of such numbers; its pairs of neighbours
are the cells of a square, which is cut into tiles of ``TILE`` by ``TILE`` numbers.
A tile with many pairs is counted cell by cell with a dense ``bincount``, all others
as one sorted list of coordinates with their counts. Spark adds up the chunks'
counts; the pairs that are frequent are numbered by falling frequency again, take the
place of the words in the chunks, and are paired the same way: two neighbouring
phrases of k words that overlap in all but one are a phrase of k + 1. A phrase
is frequent only if both its parts are, so nothing that counts is lost.

No vocabulary is held by one machine (``_numbers``). The first ``HEAD`` numbers, which occur in nearly every chunk, are
sent to all tasks, a bound of 24 bytes each for pairs and of ``HEAD_WORD`` bytes more for words; chunks ask for the rest, and a
bit filter of fixed size spares asking for most pairs that are not frequent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm._numbers import Places, answered, distinct, filter_of, gathered, may_hold, pack, ranked, unpack
from tidewater.llm._scratch import Tables
from tidewater.llm._text import byte_texts, mix

UNKNOWN = "und"
HEAD = 1 << 18
HEAD_WORD = 32
TILE = 2048
#: Pairs in a tile from which it is counted densely: an eighth of its cells.
DENSE = TILE * TILE // 8
_FOLD = bytearray(range(256))
for _c in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_c] = 10
for _c in range(65, 91):
    _FOLD[_c] = _c + 32
_FOLD[9] = 32
_FOLD = bytes(_FOLD)


def _read(batches):
    """Chunks by language: dictionary, counts, and the words' places with -1 between pieces."""
    for table in gathered(batches, "text"):
        langs = table.column("lang").to_pylist()
        by: dict[str, tuple[Places, list]] = {}
        for lang, text in zip(langs, byte_texts(table.column("text").combine_chunks()), strict=True):
            if lang not in by:
                by[lang] = (Places({b"": -2, b"\n": -1}), [])
            places, codes = by[lang]
            words = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
            words.append(b"\n")
            codes.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
        for lang, (places, codes) in by.items():
            codes = np.concatenate(codes)
            codes = codes[codes != -2]
            counts = np.bincount(codes[codes >= 0], minlength=len(places.words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([places.words], pa.list_(pa.binary())),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([int(counts.sum())], pa.int64()), pa.array([pack(codes)], pa.binary())],
                ["lang", "words", "counts", "n_words", "codes"])


def _numbered(head: dict, found: dict) -> pa.RecordBatch:
    """The chunk's phrases by their numbers: the distinct ones in order of frequency, and their places there."""
    codes = unpack(head["codes"], np.int32)
    size = int(codes.max(initial=-1)) + 1
    number = np.full(size + 1, -1, np.int64)  # the last cell answers for -1
    number[found["local"].astype(np.int64)] = found["id"].astype(np.int64)
    ids = distinct(number[number >= 0])
    place = np.where(number >= 0, np.searchsorted(ids, number), -1).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([head["chunk"]], pa.int64()), pa.array([pack(ids)], pa.binary()), pa.array([pack(place[codes])], pa.binary())],
        ["chunk", "ids", "codes"])


def neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where two phrases follow each other, and both."""
    at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    return at, codes[at].astype(np.int64), codes[at + 1].astype(np.int64)


def tiled_counts(a: np.ndarray, b: np.ndarray, tile: int = TILE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of ``a`` and ``b`` and how often each occurs, tile by tile."""
    if not len(a):
        return a, b, np.empty(0, np.int64)
    side = int(max(a.max(), b.max())) // tile + 1
    tiles = (a // tile) * side + b // tile
    numbers, sizes = np.unique(tiles, return_counts=True)
    out = []
    full = numbers[sizes >= dense]
    for t in full.tolist():
        mine = tiles == t
        cells = np.bincount((a[mine] % tile) * tile + b[mine] % tile, minlength=tile * tile)
        cell = np.flatnonzero(cells)
        out.append(((t // side) * tile + cell // tile, (t % side) * tile + cell % tile, cells[cell]))
    rest = ~np.isin(tiles, full) if len(full) else slice(None)
    width = side * tile
    cell, n = np.unique(a[rest] * width + b[rest], return_counts=True)
    out.append((cell // width, cell % width, n))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pairs(batches):
    """Counts of neighbouring phrases by chunk."""
    for batch in batches:
        for raw_ids, raw_codes in zip(batch.column("ids"), batch.column("codes"), strict=True):
            ids = unpack(raw_ids.as_py(), np.int64)
            _, a, b = neighbours(unpack(raw_codes.as_py(), np.int32))
            a, b, n = tiled_counts(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(n)], ["a_id", "b_id", "n"])


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits of a pair of numbers, for the bit filter only."""
    return mix(a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(b.astype(np.uint64)))


def _keys(batches):
    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in ("a_id", "b_id"))
        yield pa.RecordBatch.from_arrays([pa.array(_key(a, b).view(np.int64))], ["key"])


class Head:
    """The numbers of the most frequent pairs."""

    B_BITS = 44

    def __init__(self, a: np.ndarray, b: np.ndarray, ids: np.ndarray):
        if len(b) and int(b.max()) >> self.B_BITS:
            raise OverflowError(f"numbers of {self.B_BITS} bits at most")
        self.first = distinct(a)
        code = np.searchsorted(self.first, a) << self.B_BITS | b
        order = np.argsort(code)
        self.code, self.ids = code[order], ids[order]

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each pair, -1 for one that is not among them."""
        if not len(self.code):
            return np.full(len(a), -1, np.int64)
        at = np.minimum(np.searchsorted(self.first, a), len(self.first) - 1)
        code = at << self.B_BITS | b
        place = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where((self.first[at] == a) & (self.code[place] == code), self.ids[place], -1)


def _asking(head, cells):
    """The pairs of a chunk that may be frequent and are not of the head, by their place among the chunk's distinct pairs."""
    def run(batches):
        for batch in batches:
            for chunk, raw_ids, raw_codes in zip(batch.column("chunk").to_pylist(), batch.column("ids"), batch.column("codes"), strict=True):
                ids = unpack(raw_ids.as_py(), np.int64)
                _, a, b = neighbours(unpack(raw_codes.as_py(), np.int32))
                width = len(ids) + 1
                pair = distinct(a * width + b)
                left, right = ids[pair // width], ids[pair % width]
                may = np.flatnonzero(may_hold(cells.value, _key(left, right)) & (head.value.numbers(left, right) < 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(may), chunk, np.int64)), pa.array(may.astype(np.int32)), pa.array(left[may]), pa.array(right[may])],
                    ["chunk", "local", "a_id", "b_id"])
    return run


def _paired(most_frequent):
    """A chunk with its frequent pairs in place of the phrases they begin with."""
    def run(head: dict, found: dict) -> pa.RecordBatch:
        codes, old = unpack(head["codes"], np.int32), unpack(head["ids"], np.int64)
        width = len(old) + 1
        at, a, b = neighbours(codes)
        pair = a * width + b
        cells = distinct(pair)
        number = most_frequent.value.numbers(old[cells // width], old[cells % width])
        number[found["local"].astype(np.int64)] = found["id"].astype(np.int64)
        ids = distinct(number[number >= 0])
        place = np.where(number >= 0, np.searchsorted(ids, number), -1).astype(np.int32)
        new = np.full(max(0, len(codes) - 1), -1, np.int32)
        new[at] = place[np.searchsorted(cells, pair)]
        return pa.RecordBatch.from_arrays(
            [pa.array([head["chunk"]], pa.int64()), pa.array([pack(ids)], pa.binary()), pa.array([pack(new)], pa.binary())],
            ["chunk", "ids", "codes"])
    return run


_CODED = "chunk long, ids binary, codes binary"


def collocations(docs: DataFrame, least: int = 30, most_words: int = 4, inside: tuple[int, int] = (80, 100), first: int = 2000,
                 head: int = HEAD) -> DataFrame:
    """The strongest phrases of each language in ``docs(text, lang)``.

    lang, rank (from 1), phrase, a, l, r, n and score, as the query's contract
    has them: phrases of 2 to ``most_words`` words of one piece that occur ``least`` times or more, without
    those that lie in a longer one with ``inside`` of their occurrences, the ``first``
    of each language. A null language is ``und``; null and empty texts, and texts of punctuation alone, add nothing;
    very long texts are a chunk of their own. Repeated rows count as often as they occur.
    An empty table gives no rows. Other columns are not read. ``head`` changes what is sent where, not the result.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "collocations")
    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").mapInArrow(
        _read, "lang string, words array<binary>, counts array<long>, n_words long, codes binary")
    texts = tables.put("texts", read.withColumn("chunk", F.monotonically_increasing_id()))
    entries = texts.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    words = (entries.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("a")).where(F.col("a") >= least))
    totals = tables.put("totals", texts.groupBy("lang").agg(F.sum("n_words").alias("n")))
    words = tables.put("words", ranked(words, [F.desc("a"), "lang", "word"], tables, "sort"))
    used = texts.select("chunk", "lang", F.posexplode("words").alias("local", "word"))
    in_head = (F.col("id") < head) & (F.length("word") <= HEAD_WORD)
    often = F.broadcast(words.where(in_head).select("lang", "word", "id"))
    asked = (used.join(often, ["lang", "word"]).select("chunk", "local", "id").unionByName(
        used.join(often, ["lang", "word"], "left_anti").join(words.where(~in_head).select("lang", "word", "id"), ["lang", "word"])
        .select("chunk", "local", "id")))
    coded = tables.put("coded", answered(texts.select("chunk", "codes"), asked, _numbered, _CODED))
    tables.drop("texts")

    none = F.array().cast("array<long>")
    level = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", none.alias("heads"), none.alias("tails"))
    scored = None
    for size in range(2, most_words + 1):
        pairs = (coded.mapInArrow(_pairs, "a_id long, b_id long, n long").groupBy("a_id", "b_id")
                 .agg(F.sum("n").alias("a")).where(F.col("a") >= least))
        pairs = tables.put(f"pairs{size}", ranked(pairs, [F.desc("a"), "a_id", "b_id"], tables, "sort"))
        if size < most_words:
            t = pairs.where(F.col("id") < head).select("a_id", "b_id", "id").toArrow()
            most = spark.sparkContext.broadcast(Head(*(t[c].to_numpy() for c in ("a_id", "b_id", "id"))))
            rest = pairs.where(F.col("id") >= head).select("a_id", "b_id", "id")
            cells = spark.sparkContext.broadcast(filter_of(rest.select("a_id", "b_id").mapInArrow(_keys, "key long"), "key"))
            asked = (coded.mapInArrow(_asking(most, cells), "chunk long, local int, a_id long, b_id long")
                     .join(rest, ["a_id", "b_id"]).select("chunk", "local", "id"))
            coded = tables.put("coded", answered(coded, asked, _paired(most), _CODED))
            cells.unpersist()
            most.unpersist()
        left = level.select(F.col("id").alias("a_id"), "lang", "phrase", F.concat("heads", F.array("a")).alias("heads"))
        right = level.select(F.col("id").alias("b_id"), "last", F.concat("tails", F.array("a")).alias("tails"))
        longer = (pairs.join(left, "a_id").join(right, "b_id")
                  .select("id", "lang", F.concat("phrase", F.lit(b" "), "last").alias("phrase"), "last", "a", "heads", "tails", "a_id", "b_id"))
        longer = tables.put(f"level{size}", longer)
        if size > 2:  # an inner phrase with that share of a longer one has it of every phrase between them too
            held = (longer.select(F.col("a_id").alias("id"), F.col("a").alias("outer"))
                    .unionByName(longer.select(F.col("b_id").alias("id"), F.col("a").alias("outer")))
                    .groupBy("id").agg(F.max("outer").alias("outer")))
            kept = level.join(held, "id", "left").where(F.col("outer").isNull() | (F.lit(inside[1]) * F.col("outer") < F.lit(inside[0]) * F.col("a")))
            scored = _scored(kept, size - 1, scored)
        level = longer
    scored = _scored(level, most_words, scored)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
            .join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"),
                                         "a", "l", "r", "n", "score"))
    best = tables.put("best", best)
    tables.keep_only("best")
    return best


def _scored(level: DataFrame, size: int, others: DataFrame | None) -> DataFrame:
    """Phrases of ``size`` words with their lowest-scoring cut; the products are decimals of 26 digits, divided exactly."""
    cuts = []
    for k in range(1, size):
        l, r = F.col("heads")[k - 1], F.col("tails")[size - k - 1]  # noqa: E741
        score = F.expr(f"cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div cast(heads[{k - 1}] + tails[{size - k - 1}] as decimal(20,0))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    best = F.array_min(F.array(*cuts))
    out = level.withColumn("cut", best).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return out if others is None else others.unionByName(out)


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language over all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB: every phrase of one to four words of every piece, counted by its text.
SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, w[i:i + s - 1] AS g FROM w, unnest(range(1, 5)) x(s), unnest(range(1, len(w) - s + 2)) y(i)),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT * FROM f WHERE len(g) > 1),
held AS (SELECT lang, g[i:i + s - 1] AS g, max(f) AS outer_f FROM c, unnest(range(2, 4)) x(s), unnest(range(1, len(g) - s + 2)) y(i)
         WHERE s < len(g) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN held h ON c.lang = h.lang AND c.g = h.g WHERE outer_f IS NULL OR 100 * outer_f < 80 * c.f),
cut AS (SELECT k.lang, k.g, k.f AS a, i, x.f AS l, y.f AS r, ((2000000::HUGEINT * k.f) // (x.f + y.f))::BIGINT AS score
        FROM kept k, unnest(range(1, len(k.g))) t(i) JOIN f x ON x.lang = k.lang AND x.g = k.g[:i] JOIN f y ON y.lang = k.lang AND y.g = k.g[i + 1:]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
best AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
                array_to_string(g, ' ') AS phrase, a, l, r, score FROM low QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN tot USING (lang)
"""
