"""N-gram Jaccard join by MinHash banding at one fixed depth, in place of an LSH forest's tries (no prefix is shortened in the data).

Shingles are ``SHINGLE`` consecutive words (a shorter text is one shingle), a
document is the set of its shingles, and documents of similarity ``THRESHOLD`` or
more are linked. Documents with the same words are one class; one set stands
for the class. A forest of ``TREES`` prefix tries holds the classes'
signatures, ``DEPTH`` MinHash values a tree. Sets of similarity s share a prefix of
length d in a tree with probability s^d, so all the trees find them with
probability 1 - (1 - s^d)^TREES. The depth d is the
largest for which that recall reaches ``TARGET_RECALL`` for
pairs at the threshold itself (:func:`prefix_length`), computed from constants. The nodes at that depth, in
order, are the groups in which every pair is a candidate, and every candidate is verified
exactly on the shingle sets; a pair counts in the first tree that it meets in.

At scale: a group is compared in tiles of bounded size and returns, for each member, its
number of links and one edge to the smallest member it is connected with, never pairs,
so thousands of near copies cost rows in proportion to their number. Which members
have a pair to compare in which tile is decided on the prefixes alone; only their texts are
turned to sets and travel, once for each such tile. Exact copies never meet in a tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._components import components
from tidewater.llm._scratch import settle
from tidewater.llm._text import Hashed, WordHashes, mix, text_chunks, windows
from tidewater.llm._tiles import dealt, groups, roots, sides, tiles

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
TARGET_RECALL = 0.995
#: Shingles of a tile's slot, about; groups of long documents get more slots.
SLOT_SHINGLES = 500_000


def prefix_length(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix whose matches over all trees reach the recall at the threshold."""
    d = depth
    while d > 1 and 1 - (1 - threshold ** d) ** trees < recall:
        d -= 1
    return d


def shingles(texts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, Hashed]:
    """Shingle hashes of texts, behind each other, and the text of each."""
    h = Hashed(texts, hashes)
    at = h.whole(SHINGLE)
    s, doc = (windows(h.words, SHINGLE)[at] if len(at) else np.empty(0, np.uint64)), h.doc[at]
    short = np.flatnonzero((h.counts > 0) & (h.counts < SHINGLE))
    if len(short):
        one = np.array([windows(h.words[h.starts[i]:h.ends[i]], int(h.counts[i]), salt=int(h.counts[i]))[0] for i in short], np.uint64)
        s, doc = np.concatenate([s, one]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        s, doc = s[order], doc[order]
    return s, doc, h


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32), (rng.integers(0, 1 << 31, n, dtype=np.uint64) * 2 + 1).astype(np.uint32)


def _prefixes(s: np.ndarray, starts: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Hash of each text's prefix of ``depth`` MinHash values in each tree."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    flip, odd = _constants(trees * depth)
    out = np.empty((len(starts), trees), np.uint64)
    for t in range(trees):
        acc = np.full(len(starts), t + 1, np.uint64)
        for k in range(t * depth, (t + 1) * depth):
            v = x ^ flip[k]
            v *= odd[k]
            acc = mix(acc ^ np.minimum.reduceat(v, starts).astype(np.uint64))
        out[:, t] = acc
    return out


def signatures(docs: DataFrame, trees: int = TREES, depth: int | None = None) -> DataFrame:
    """doc_id, key (16 bytes that stand for the words in order; null without words) and the trees' prefixes."""
    depth = depth or prefix_length()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part, texts in text_chunks(batch):
                s, doc, h = shingles(texts, hashes)
                keys = [xxhash.xxh3_128_digest(h.words[a:b].tobytes()) if b > a else None for a, b in zip(h.starts, h.ends, strict=True)]
                have = np.flatnonzero(h.counts > 0)
                pre = np.empty((0, trees), np.uint64)
                if len(have):
                    pre = _prefixes(s, np.searchsorted(doc, have), trees, depth)
                width = np.where(h.counts > 0, trees, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(width)].astype(np.int32)), pa.array(pre.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(keys, pa.binary()), lists], ["doc_id", "key", "pre"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key binary, pre array<long>")


def _first_met(pre_a: np.ndarray, pre_b: np.ndarray, tree: int, same: bool) -> np.ndarray:
    """Which pairs of a tile's sides meet in no tree before this one."""
    new = np.ones((len(pre_a), len(pre_b)), bool)
    for t in range(tree):
        new &= pre_a[:, t, None] != pre_b[None, :, t]
    return np.triu(new, 1) if same else new


def _lists(column: pa.ChunkedArray, trees: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, trees)


def _prune(trees: int):
    """Members of tiles that have a pair to compare there."""
    cols = ["bucket", "ti", "tj", "slot", "tree", "node"]

    def run(batches):
        out: list[pa.Table] = []
        held = 0
        for g in groups(batches, ["bucket", "ti", "tj"]):
            ti, tj, tree = (g.column(c)[0].as_py() for c in ("ti", "tj", "tree"))
            a, b = sides(g.column("slot").to_numpy(), ti, tj)
            pre = _lists(g.column("pre"), trees)
            new = _first_met(pre[a], pre[b], tree, ti == tj)
            use = np.zeros(len(g), bool)
            use[a] |= new.any(axis=1)
            use[b] |= new.any(axis=0)
            if use.any():
                out.append(g.select(cols).filter(pa.array(use)))
                held += len(out[-1])
            if held > 5000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, held = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return run


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, exactly, as products of 0/1 matrices over 4096 elements at a time."""
    every = np.concatenate([*a, *b])
    side = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    _, index, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[index]
    number, side = number[index[use]], side[use]
    out = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(number, kind="stable")
    number, side = number[order], side[order]
    total = int(number[-1]) + 1 if len(number) else 0
    for lo in range(0, total, 4096):
        i, j = np.searchsorted(number, [lo, lo + 4096])
        m = np.zeros((len(a) + len(b), min(4096, total - lo)), np.float32)
        m[side[i:j], number[i:j] - lo] = 1
        out += m[:len(a)] @ m[len(a):].T
    return out


def _verify(trees: int, threshold: float):
    """Tiles with sets to a row for each linked member: documents it links to, and the smallest member it reaches."""

    def run(batches):
        nodes: list = []
        links: list = []
        to: list = []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(to, pa.binary())], ["node", "links", "to"])

        for g in groups(batches, ["bucket", "ti", "tj"]):
            ti, tj, tree = (g.column(c)[0].as_py() for c in ("ti", "tj", "tree"))
            a, b = sides(g.column("slot").to_numpy(), ti, tj)
            pre = _lists(g.column("pre"), trees)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in g.column("shingles").chunks for x in c]
            size = np.array([len(x) for x in sets], np.float64)
            inter = intersections([sets[i] for i in a], [sets[i] for i in b]).astype(np.float64)
            with np.errstate(invalid="ignore"):
                link = inter / (size[a][:, None] + size[b][None, :] - inter) >= threshold
            link &= _first_met(pre[a], pre[b], tree, ti == tj)
            x, y = np.nonzero(link)
            if not len(x):
                continue
            copies = g.column("copies").to_numpy()
            total = np.zeros(len(g), np.int64)
            np.add.at(total, a[x], copies[b[y]])
            np.add.at(total, b[y], copies[a[x]])
            root = roots(len(g), a[x], b[y])
            names = g.column("node").to_pylist()
            for i in np.flatnonzero(total):
                nodes.append(names[i])
                links.append(int(total[i]))
                to.append(names[root[i]])
            if len(nodes) > 5000:
                yield batch_of()
                nodes, links, to = [], [], []
        if nodes:
            yield batch_of()

    return run


def _sets(batches):
    hashes = WordHashes()
    for batch in batches:
        for part, texts in text_chunks(batch, most=1 << 20):
            s, doc, h = shingles(texts, hashes)
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            keys = [xxhash.xxh3_128_digest(h.words[a:b].tobytes()) for a, b in zip(h.starts, h.ends, strict=True)]
            sets = [np.unique(s[lo:hi]) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
            mine = [k == n for k, n in zip(keys, part.column("node").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64())],
                ["node", "shingles", "n"]).filter(pa.array(mine, pa.bool_()))


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = TARGET_RECALL) -> DataFrame:
    """Links and groups of near copies.

    ``docs(doc_id, text)`` to doc_id, class_id (smallest document with the same
    words), n_links (other documents of similarity ``threshold`` or more, copies among
    them), component_id (smallest document reachable by links, itself included)
    and kept (whether it is that document); a row for each row. Null texts and
    texts without words, and rows with a null id, link with nothing. Repeated rows link as copies do;
    one id with two texts is two documents. An empty table gives no rows. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    depth = prefix_length(threshold, recall, trees)
    sig = settle(signatures(docs, trees, depth))
    has = F.col("key").isNotNull() & F.col("doc_id").isNotNull()
    classes = settle(sig.where(has).groupBy(F.col("key").alias("node")).agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("pre").alias("pre")))
    entries = classes.select("node", F.posexplode("pre").alias("tree", "bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = entries.join(shared, "bucket")
    light = tiles(met, "bucket", "node", F.col("members")).drop("members").join(classes.select("node", "pre"), "node")
    pruned = settle(dealt(light.select("bucket", "ti", "tj", "slot", "tree", "node", "pre"), "bucket", "node")
                    .mapInArrow(_prune(trees), "bucket long, ti int, tj int, slot int, tree int, node binary"))
    wanted = pruned.select("node").distinct().join(classes.select("node", "rep"), "node")
    texts = docs.join(wanted.select("node", F.col("rep").alias("doc_id")), "doc_id").select("node", "text")
    # rows that repeat an id with the same text give the same set
    sets = settle(texts.mapInArrow(_sets, "node binary, shingles binary, n long")).dropDuplicates(["node"])
    # groups of long documents are dealt again, by the shingles they hold
    members = (pruned.join(sets.select("node", "n"), "node").groupBy("bucket", "ti", "tj")
               .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).where(F.col("n") > 2 * SLOT_SHINGLES))
    small = pruned.join(members.select("bucket", "ti", "tj"), ["bucket", "ti", "tj"], "left_anti")
    large = _split(pruned.join(members, ["bucket", "ti", "tj"]))
    rows = (small.unionByName(large).join(sets.select("node", "shingles"), "node")
            .join(classes.select("node", "pre", "copies"), "node"))
    found = settle(dealt(rows.select("bucket", "ti", "tj", "slot", "tree", "node", "pre", "copies", "shingles"), "bucket", "node")
                   .mapInArrow(_verify(trees, threshold), "node binary, links long, to binary"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    sets_of = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    home = classes.select("node", "rep", "copies").join(sets_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = home.groupBy("component").agg(F.min("rep").alias("component_id"))
    home = (home.join(first, "component").join(linked, "node", "left")
            .select("node", F.col("rep").alias("class_id"), "component_id",
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    # settled, so that the join below is between two plain exchanges, of which a large class's side can be split
    home = settle(home)
    out = sig.select("doc_id", F.when(has, F.col("key")).alias("node")).join(home, "node", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def _split(rows: DataFrame) -> DataFrame:
    """Tiles with too many shingles as several smaller ones: each side is dealt into parts, and each pair of parts is a tile."""
    parts = F.ceil(F.col("n") / SLOT_SHINGLES).cast("int")
    out = (rows.withColumn("parts", parts).withColumn("one", F.expr("ti = tj"))
           .withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts").cast("long")).cast("int")))
    # parts of the left side are numbered before those of the right, beyond the numbers of whole slots
    number = F.when(F.col("slot") == F.col("ti"), F.col("part")).otherwise(F.col("part") + F.col("parts")) + 1_000_000
    out = out.withColumn("mine", number).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    other = F.when(F.col("one") | (F.col("slot") != F.col("ti")), F.col("other")).otherwise(F.col("other") + F.col("parts")) + 1_000_000
    bucket = F.when(F.col("one"), F.xxhash64("bucket", "ti")).otherwise(F.xxhash64("bucket", "ti", "tj"))
    return out.select(bucket.alias("bucket"), F.least("mine", other).alias("ti"), F.greatest("mine", other).alias("tj"),
                      F.col("mine").alias("slot"), "tree", "node")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents, all columns, one of each group of near copies: the smallest id, equal rows once.

    Rows with a null id are in no group and stay.
    """
    near = near_copies(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(1))
    chosen = docs.join(near, "doc_id", "left_semi").withColumn("__row", F.row_number().over(same)).where("__row = 1").drop("__row")
    return chosen.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Near copies among all documents."""
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB: all pairs that share a shingle, verified, and the closure of their links.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ') ELSE len(w) || ' ' || array_to_string(w, ' ') END AS g
      FROM d, unnest(range(1, greatest(2, len(w) - 3))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE CAST(c AS DOUBLE) / (p.n + q.n - c) >= 0.8),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CASE WHEN len(w) = 0 THEN d.doc_id ELSE min(d.doc_id) OVER (PARTITION BY w) END AS class_id,
       (SELECT count(*) FROM l WHERE l.x = d.doc_id) AS n_links, component_id, component_id = d.doc_id AS kept
FROM d JOIN c USING (doc_id)
"""
