"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame operations only).

Every source's documents, shuffled by md5 of their id, form one long stream of
words that is cut into blocks of equal size (they differ by a word at most).
Targets give each source a number of slots; the slots of all sources lie behind
each other on a line, so a source owns an interval as wide as its share. Slot
``n`` of the mix is the ``n``-th van der Corput point: its reversed bits, an
integer on that line, fall into the interval of the source it draws from.
As every integer of an interval is the point of exactly one slot, each source
gets exactly its number of slots, and each stretch of the mix holds about its
share. A slot's rank within its source, the number of earlier points in the
interval, has a closed form (:func:`_points_below`); no sort or window over a
source is needed. Rank ``r`` takes block ``r mod blocks`` of the source's
stream in epoch ``r div blocks``; the last slot of a source is cut so that the
words taken equal the rounded target.

At scale: documents are sized in one scan (only id, source and size go on).
Positions in a source's stream are prefix sums over 4096 hash ranges and, within
a range, over its own rows, so a source with a third of all rows is spread over
4096 groups. Slots and pieces of documents meet on (source, block), keys of
a few rows each. Only the table of sources, a row for each, is ordered by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._scratch import settle

WORD = r"[^\x20\x09-\x0D]+"
#: Most times that a source, and so each document, is repeated.
MOST_EPOCHS = 3
BLOCK_WORDS = 64
_CHUNK = 4096


def _reversed_bits(x: str, bits: str) -> str:
    """The lowest ``bits`` bits of ``x`` in reverse order: the number of the slot whose point is ``x``."""
    return f"aggregate(sequence(0, {bits} - 1), 0L, (t, j) -> t * 2 + (shiftright({x}, j) & 1L))"


def _points_below(x: str, y: str, bits: str) -> str:
    """How many slots before that of point ``x`` have their point under ``y``.

    An earlier slot first differs, from the high end, at a bit that is set in
    the later one; reversed, that is bit ``j`` of ``x``. The points of such slots
    share the bits of ``x`` below ``j`` and go in steps of ``2^(j+1)``.
    """
    first = f"({x} & (shiftleft(1L, j) - 1L))"
    return (f"aggregate(sequence(0, {bits} - 1), 0L, (t, j) -> t + CASE WHEN (shiftright({x}, j) & 1L) = 1L "
            f"AND {y} > {first} THEN shiftright({y} - {first} - 1L, j + 1) + 1L ELSE 0L END)")


def _block_start(k: str) -> str:
    return f"({k} * base + least({k}, extra))"


def _block_of(p: str) -> str:
    """The block that holds word ``p`` of the stream: the first ``extra`` blocks have a word more."""
    return (f"(CASE WHEN {p} < extra * (base + 1) THEN {p} div (base + 1) "
            f"ELSE extra + ({p} - extra * (base + 1)) div base END)")


def _blocks_before(p: str) -> str:
    """How many blocks start before word ``p``."""
    return f"(CASE WHEN {p} <= 0 THEN 0L ELSE {_block_of(f'({p} - 1)')} + 1 END)"


def sized(docs: DataFrame) -> DataFrame:
    """A row per document: id, source, size in words, and its place in the shuffle."""
    skey = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
    return docs.select(
        F.col("doc_id"), F.col("source"), skey.alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
    ).withColumn("bucket", F.substring("key", 1, 3))


def sources_with_targets(buckets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per source: weight, target, words to take, blocks, and its interval of slots.

    Weights 1, 2, 3, repeating, by source in code-point order, null last. The
    targets share all words; none is above three times its source. Ordered by
    cap for each unit of weight, the sources are capped until the rest's share
    fits; that is where resharing the excess by weight ends.
    """
    all_rows = Window.partitionBy()
    by_name = Window.orderBy("skey")
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    s = (buckets.groupBy("skey").agg(F.sum("words").alias("stream"))
         .withColumn("s", F.row_number().over(by_name).cast("long") - 1)
         .withColumn("weight", F.col("s") % 3 + 1)
         .withColumn("cap", F.col("stream") * MOST_EPOCHS)
         .withColumn("left_words", F.sum("stream").over(all_rows) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
         .withColumn("level", F.col("left_words").cast("double") / F.col("left_weight"))
         .withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
         .withColumn("level", F.min_by("level", F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "skey")))
                     .over(all_rows))
         .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))))
    s = (s.withColumn("take", F.floor(F.col("target") + 0.5).cast("long"))
         .withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("stream") / block_words).cast("long")))
         .withColumn("base", F.expr("stream div blocks")).withColumn("extra", F.expr("stream % blocks"))
         .withColumn("slots", F.expr(f"CASE WHEN stream = 0 THEN 0L ELSE take div stream * blocks + "
                                     f"{_blocks_before('(take % stream)')} END"))
         .withColumn("hi", F.sum("slots").over(by_name.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("lo", F.col("hi") - F.col("slots"))
         .withColumn("bits", F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(F.sum("slots").over(all_rows), F.lit(1))))
                                        .cast("int"))))
    return s.select("skey", "s", "weight", "stream", "target", "take", "blocks", "base", "extra", "slots", "lo", "hi",
                    "bits")


def schedule_slots(sources: DataFrame) -> DataFrame:
    """A row per slot of the mix: its number, source, rank, epoch and block.

    Chunks are dealt to a given number of partitions: by their bytes, which do not
    show the slots that they become, they would be put together again.
    """
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = (sources.where("slots > 0")
             .withColumn("outer", F.explode(F.expr(f"sequence(0L, (slots - 1) div {_CHUNK * _CHUNK})")))
             .withColumn("chunk", F.explode(F.expr(
                 f"sequence(outer * {_CHUNK}, least((slots - 1) div {_CHUNK}, outer * {_CHUNK} + {_CHUNK - 1}))")))
             .select("s", "chunk", "slots", "lo", "hi", "bits", "blocks")
             .repartition(tasks, "s", "chunk"))
    point = chunk.withColumn("x", F.explode(F.expr(
        f"sequence(lo + chunk * {_CHUNK}, lo + least(slots - 1, chunk * {_CHUNK} + {_CHUNK - 1}))")))
    rank = (point.withColumn("slot", F.expr(_reversed_bits("x", "bits")))
            .withColumn("rank", F.expr(f"{_points_below('x', 'hi', 'bits')} - {_points_below('x', 'lo', 'bits')}")))
    return rank.select("slot", "s", "rank", F.expr("rank div blocks").alias("epoch"),
                       F.expr("rank % blocks").alias("block"))


def placed(sizes: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents with ``start``, their first word's place in their source's stream, and the sources."""
    buckets = settle(sizes.groupBy("skey", "bucket").agg(F.sum("size").alias("words")))
    sources = settle(sources_with_targets(buckets, block_words))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (buckets.withColumn("before", F.sum("words").over(before) - F.col("words"))
              .join(sources.drop("weight", "lo", "hi", "bits", "slots"), "skey")
              .drop("words"))
    within = (Window.partitionBy("skey", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    docs = (sizes.withColumn("within", F.sum("size").over(within) - F.col("size"))
            .join(ranges.hint("merge"), ["skey", "bucket"])
            .withColumn("start", F.col("before") + F.col("within")))
    return docs, sources


def mix_schedule(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix, a row per piece of a document in a slot.

    Returns slot, s (source's number), epoch, doc_id, start (the document's
    place in its source), first_word and words (the piece, in words of the document).
    """
    first, last = _block_of("start"), _block_of("(start + size - 1)")
    pieces = (docs.where("size > 0")
              .withColumn("block", F.explode(F.expr(f"sequence({first}, {last})")))
              .withColumn("from", F.greatest(F.col("start"), F.expr(_block_start("block"))))
              .withColumn("to", F.least(F.col("start") + F.col("size"), F.expr(_block_start("(block + 1)"))))
              .select("s", "block", "doc_id", "start", "from", "to", "stream", "take"))
    # both sides grow with the words: never a broadcast, whatever size the planner expects
    return (schedule_slots(sources).hint("merge").join(pieces, ["s", "block"])
            .withColumn("words", F.least("to", F.col("take") - F.col("epoch") * F.col("stream")) - F.col("from"))
            .where("words > 0")
            .select("slot", "s", "epoch", "doc_id", "start", (F.col("from") - F.col("start")).alias("first_word"), "words"))


def mix_documents(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken.

    A null text, or one without words, has size 0 and is taken 0 times; a source
    without words gets target 0. Equal ids keep a place in the mix each. An empty
    table gives no rows. Columns other than doc_id, text and source are not read.
    """
    docs, sources = placed(settle(sized(documents)), block_words)
    docs = settle(docs)
    taken = mix_schedule(docs, sources).groupBy("s", "start").agg(F.sum("words").alias("got"))
    return (docs.join(taken.hint("merge"), ["s", "start"], "left")
            .select("doc_id", "size", F.col("stream").alias("source_size"), "target",
                    F.when(F.col("size") > 0, F.coalesce("got", F.lit(0))).otherwise(0).cast("long").alias("taken"),
                    "source"))


#: DuckDB: the mix takes the first round(target) words of each source's shuffled, repeated stream.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS stream FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight,
             row_number() OVER (ORDER BY encode(source) NULLS LAST) AS s FROM s),
l AS (SELECT *, CAST(sum(stream) OVER () - coalesce(sum(3 * stream) OVER b, 0) AS DOUBLE)
             / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS lv,
             CAST(3 * stream AS DOUBLE) / weight AS ratio
      FROM w WINDOW b AS (ORDER BY CAST(3 * stream AS DOUBLE) / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, stream, least(CAST(3 * stream AS DOUBLE),
             (SELECT lv FROM l WHERE lv <= ratio ORDER BY ratio, s LIMIT 1) * weight) AS target FROM l),
p AS (SELECT d.*, t.stream, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS take,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, stream AS source_size, target,
       CAST(greatest(0, least(size, take - start)) + greatest(0, least(size, take - stream - start))
            + greatest(0, least(size, take - 2 * stream - start)) AS BIGINT) AS taken, source
FROM p
"""


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, repeating."""
    return mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
