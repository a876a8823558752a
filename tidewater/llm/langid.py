"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds the n-grams of all languages at once: each cell
is a bitmask with a bit for each language, an n-gram sets its language's bit in
``PROBES`` cells, and the AND of these cells is the set of all languages that
contain it. A text's n-grams give one mask each; the number of set bits by
language, less the share that a filter with that language's fill lets through
by chance, estimates which share of the text's n-grams the language knows. The
largest such share decides.

Learning: the n-grams of a bounded sample of labelled rows by language
(``SAMPLE_DOCS`` each on average, chosen by a hash of the id) are counted within
tasks and summed by (language, n-gram); those with at least ``LEAST_SHARE`` of
their language's n-grams are kept, at most 1/LEAST_SHARE each. The cells are
ORed together by Spark; only the finished filter, of fixed size, passes the
driver to the tasks. Prediction is a map over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._text import mix, text_chunks

UNKNOWN = "und"
ORDERS = (3, 4)
PROBES = 3
CELL_BITS = 20
LEAST_SHARE = 2e-5
#: Labelled rows by language that the filter is fitted on, on average.
SAMPLE_DOCS = 3000
#: Share of held-out ids: those whose crc32 is 0 modulo this.
FOLDS = 5
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of lower-case letters in texts, and the text of each.

    Words are runs of letters; an n-gram may begin before and end behind its
    word by one place, never cross it.
    """
    lower = [t.decode("utf-8", "replace").lower() for t in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower)) + 1
    points = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "replace"), np.uint32)
    doc = np.concatenate([[0], np.repeat(np.arange(len(lower)), sizes)])
    points = np.where(_letters()[points], points, 0)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    c, doc = points[keep].astype(np.uint64), doc[keep]
    out, at = [], []
    for n in ORDERS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        inside = c[1:1 + m] != 0
        for j in range(2, n - 1):
            inside &= c[j:j + m] != 0
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x110003) + c[j:j + m]
        out.append(mix(h[inside]))
        at.append(doc[1:1 + m][inside])
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(at)


@dataclass
class Filters:
    """All languages' filters: ``cells[w]`` has bits of languages ``64 w`` on; ``chance`` by language."""

    languages: list[str]
    cells: np.ndarray
    chance: np.ndarray

    def shares(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """By text: n-grams, and by language the corrected share of them that it knows."""
        h, doc = grams(texts)
        count = np.bincount(doc, minlength=len(texts))
        out = np.zeros((len(texts), len(self.languages)))
        probes = [(h >> np.uint64(21 * k)) & np.uint64((1 << CELL_BITS) - 1) for k in range(PROBES)]
        for w in range(len(self.cells)):
            masks = self.cells[w][probes[0]]
            for p in probes[1:]:
                masks &= self.cells[w][p]
            for b in range(min(64, len(self.languages) - 64 * w)):
                hit = (masks >> np.uint64(b)) & np.uint64(1) != 0
                out[:, 64 * w + b] = np.bincount(doc[hit], minlength=len(texts))
        seen = out / np.maximum(count, 1)[:, None]
        return count, np.clip((seen - self.chance) / (1 - self.chance), 0, 1)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score by text; of equal shares the first language."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        count, share = self.shares(texts)
        best = share.argmax(axis=1)
        none = count == 0
        return ([UNKNOWN if z else self.languages[b] for z, b in zip(none, best, strict=True)],
                np.where(none, 0.0, share[np.arange(len(texts)), best]))


def held_out(doc_id):
    """Whether a document's language is never learnt from; a null id is not held out, nor learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_chunks(batch):
            h, doc = grams(texts)
            langs = np.array(part.column("lang").to_pylist())[doc] if len(doc) else np.empty(0, str)
            for lang in np.unique(langs):
                gram, n = np.unique(h[langs == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"])


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Filters:
    """Filters from ``docs(doc_id, text, lang)``: rows with language and text that are not held out."""
    spark = docs.sparkSession
    labelled = (docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
                .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id"))))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Filters([], np.zeros((0, 1 << CELL_BITS), np.uint64), np.zeros(0))
    rate = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n))])
    sample = labelled.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < rate[F.col("lang")] * 1_000_000)
    counts = (sample.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(total, "lang").where(F.col("n") >= F.col("total") * LEAST_SHARE)
    languages = sorted(sizes)
    number = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    cell = F.explode(F.array(*[F.call_function("shiftrightunsigned", F.col("gram"), F.lit(21 * k))
                               .bitwiseAND(F.lit((1 << CELL_BITS) - 1).cast("long")) for k in range(PROBES)]))
    table = (kept.withColumn("l", number[F.col("lang")]).select("l", cell.alias("cell"))
             .groupBy("cell", F.expr("l div 64").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(l % 64 as int)))").alias("mask"))).toArrow()
    cells = np.zeros(((len(languages) + 63) // 64, 1 << CELL_BITS), np.uint64)
    cells[table["word"].to_numpy(), table["cell"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    fill = np.array([((cells[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return Filters(languages, cells, fill ** PROBES)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs(doc_id, text)`` to doc_id, held_out, lang_pred and score, a row for each.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text if nothing could be learnt. Repeated rows have a row each; an empty
    table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # 8 MB for each 64 languages, however large the input
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part, texts in text_chunks(batch):
                lang, score = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"))


def keep_known(docs: DataFrame, filters: Filters, least_score: float) -> DataFrame:
    """The documents, all columns, whose language is known with at least ``least_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for batch in batches:
            for part, texts in text_chunks(batch):
                lang, score = shared.value.predict(texts)
                keep = [x != UNKNOWN and s >= least_score for x, s in zip(lang, score, strict=True)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit(docs))
