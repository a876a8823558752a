"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets 64 random hyperplane bits, concatenated to one
key; the vectors are ordered by (label, key), and each is compared with its ``WINDOW``
neighbours on. Two vectors at the threshold angle agree on a bit with
probability p = 1 - angle/pi. How many leading bits a pair must agree on to lie
within the window is read from the data: of each vector in each pass, the bits it shares
with those just outside its window, and one more (its depth d). Its pairs are missed in all passes
with probability prod(1 - p^d) at most, and a vector for which that is above 1 - ``RECALL`` goes on
to another round of passes, with only the vectors that are left (a pair is covered if one of
the two is). Vectors of a large label are centred for hashing, and p is then the least
that their distance to the centre allows. What is left of a label after a round, if
``ALL_PAIRS`` vectors or fewer, or after ``ROUNDS`` rounds in any number, is compared in full in tiles. So a
label whose vectors share a direction, or a dense region of one, costs more and loses no more
than any other. Verified pairs are united to components. A dense group has more links than a window shows, so links are counted
where it can be done in full: every pair within a component is compared exactly,
in tiles of bounded size; no partner is capped.

At scale: equal vectors are one class and never compared. A pass sorts rows of an
id and a key; vectors travel once for each pass, to the blocks of ``BLOCK`` places (with
the places around it that a window reaches as well). Blocks and tiles return rows in
proportion to their members, never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._components import components
from tidewater.llm._scratch import Tables, settle
from tidewater.llm._tiles import dealt, groups, roots, sides, tiles

THRESHOLD = 0.93
WINDOW = 64
BLOCK = 1024
RECALL = 0.999
LEAST_PASSES = 6
ROUNDS = 4
#: Vectors of a label that are compared in full rather than sorted again.
ALL_PAIRS = 2048
#: Labels from this size are centred, by a sample of about as many vectors.
CENTRED = 1024


def passes_for(largest: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes of a round: they find a pair at the threshold with the given probability in a group of ``largest`` evenly spread vectors."""
    p = (1 - math.acos(threshold) / math.pi) ** max(1.0, math.log2(max(2, largest) / window) + 1)
    return max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _matrix(column) -> np.ndarray:
    """Vectors of equal length as doubles."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = c.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(c), -1)


def _centres(left: DataFrame, sizes: DataFrame) -> DataFrame:
    """``place`` and ``centre``, the mean unit vector of a sample of each large place, where it is not about zero."""
    large = sizes.where(F.col("n") >= CENTRED).select("place", F.expr(f"n div {CENTRED}").alias("every"))

    def run(batches):
        for batch in batches:
            place = batch.column("place").to_numpy(zero_copy_only=False)
            for p in np.unique(place):
                x = _unit(_matrix(batch.column("v").take(pa.array(np.flatnonzero(place == p)))))
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([len(x)], pa.int64()), pa.array([x.sum(axis=0).tolist()], pa.list_(pa.float64()))],
                                                 ["place", "n", "x"])

    sums = (left.join(large, "place").where(F.pmod(F.xxhash64("node", F.lit(6)), F.col("every")) == 0).select("place", "v")
            .mapInArrow(run, "place string, n long, x array<double>"))
    mean = (sums.select("place", "n", F.posexplode("x")).groupBy("place", "pos").agg((F.sum("col") / F.sum("n")).alias("m"))
            .groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("centre")))
    return mean.where(F.aggregate("centre", F.lit(0.0), lambda a, x: a + x * x) >= 0.05)


def _keys(first: int, passes: int, threshold: float):
    """Each vector's key in each pass, as a signed number in the order of its bits, and the log of the least p of its pairs."""
    far = math.sqrt(max(0.0, 2 - 2 * threshold))  # between unit vectors at the threshold

    def run(batches):
        for batch in batches:
            places = batch.column("place").to_numpy(zero_copy_only=False)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                x = _unit(_matrix(batch.column("v").take(pa.array(mine))))
                angle = np.full(len(mine), math.acos(min(1.0, max(-1.0, threshold))))
                for p in np.unique(places[mine]):
                    at = places[mine] == p
                    centre = batch.column("centre")[int(mine[at][0])]
                    if centre.is_valid:
                        x[at] -= centre.values.to_numpy()
                        r = np.sqrt((x[at] * x[at]).sum(axis=1))
                        angle[at] = np.where(r > far, np.arcsin(np.minimum(1.0, far / np.maximum(r, 1e-300))), math.pi)
                agree = pa.array(np.log(np.maximum(1 - angle / math.pi, 1e-300)))
                node, place = batch.column("node").take(pa.array(mine)), batch.column("place").take(pa.array(mine))
                for k in range(first, first + passes):
                    planes = np.random.default_rng((91, int(dim), k)).standard_normal((int(dim), 64))
                    key = np.packbits(x @ planes >= 0, axis=1).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)
                    yield pa.RecordBatch.from_arrays([node, place, pa.array(np.full(len(mine), k, np.int32)), pa.array(key.view(np.int64)), agree],
                                                     ["node", "place", "pass", "key", "agree"])

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal leading bits of two keys."""
    x = a.view(np.uint64) ^ b.view(np.uint64)
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return 64 - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def _depths(place: np.ndarray, key: np.ndarray, reach: int) -> np.ndarray:
    """Leading bits that whoever shares them with a row lies less than ``reach`` places from it; 0 where its group ends before."""
    out = np.zeros(len(key), np.int64)
    if len(key) > reach:
        bits = np.where(place[reach:] == place[:-reach], _shared_bits(key[reach:], key[:-reach]) + 1, 0)
        out[:-reach] = bits
        out[reach:] = np.maximum(out[reach:], bits)
    return out


def _edges(threshold: float, window: int):
    """Blocks of places to an edge for each linked vector, to the first vector it reaches in the block (``a``, ``b``), and to
    the log of the probability that the pass misses a pair of a vector (``a``, ``miss``)."""

    def run(batches):
        for g in groups(batches, ["block"]):
            place = g.column("place").combine_chunks().dictionary_encode().indices.to_numpy()
            pos, node = g.column("pos").to_numpy(), g.column("node").combine_chunks()
            own = np.flatnonzero(pos // BLOCK == g.column("block")[0].as_py())
            if not len(own):
                continue
            depth = _depths(place, g.column("key").to_numpy(), window + 1)
            found = np.exp(g.column("agree").to_numpy() * depth)
            miss = np.log1p(-np.minimum(found, 1 - 1e-12))[own]
            none = pa.nulls(len(own), pa.string())
            yield pa.RecordBatch.from_arrays([node.take(pa.array(own)), none, pa.array(miss)], ["a", "b", "miss"])
            x = _unit_rows(g.column("v"))
            a: list = []
            b: list = []
            for lo in range(int(own[0]), len(x), 256):
                hi = min(len(x), lo + 256)
                end = min(len(x), hi + window)
                s = _similar(x, lo, hi, lo, end) >= threshold
                gap = pos[None, lo:end] - pos[lo:hi, None]
                s &= (gap > 0) & (gap <= window) & (place[None, lo:end] == place[lo:hi, None])
                i, j = np.nonzero(s)
                a.append(i + lo)
                b.append(j + lo)
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                root = roots(len(x), a, b)
                mine = np.flatnonzero(root != np.arange(len(x)))
                yield pa.RecordBatch.from_arrays([node.take(pa.array(mine)), node.take(pa.array(root[mine])), pa.nulls(len(mine), pa.float64())],
                                                 ["a", "b", "miss"])

    return run


def _all_pairs(threshold: float):
    """Tiles of a place to an edge for each linked vector, to the first vector it reaches in the tile."""

    def run(batches):
        for g in groups(batches, ["place", "ti", "tj"]):
            ti, tj = g.column("ti")[0].as_py(), g.column("tj")[0].as_py()
            a, b = sides(g.column("slot").to_numpy(), ti, tj)
            x = _unit(_matrix(g.column("v")))
            link = x[a] @ x[b].T >= threshold
            i, j = np.nonzero(np.triu(link, 1) if ti == tj else link)
            if len(i):
                root = roots(len(x), a[i], b[j])
                mine = np.flatnonzero(root != np.arange(len(x)))
                node = g.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(mine)), node.take(pa.array(root[mine]))], ["a", "b"])

    return run


def _unit_rows(column) -> list:
    """Unit vectors of a block; rows of unlike length (the border of two groups) stay apart as a list of runs."""
    c = column.combine_chunks()
    n = np.diff(c.offsets.to_numpy())
    width = int(n.max())
    if (n == width).all():
        return _unit(_matrix(c))
    out = np.zeros((len(c), width))
    flat = c.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[np.arange(width)[None, :] < n[:, None]] = flat
    return _unit(out)


def _similar(x, lo: int, hi: int, start: int, end: int) -> np.ndarray:
    return x[lo:hi] @ x[start:end].T


def _counts(threshold: float):
    """Tiles of a component to a row for each member: the vectors it links to, copies counted."""

    def run(batches):
        for g in groups(batches, ["component", "ti", "tj"]):
            ti, tj = g.column("ti")[0].as_py(), g.column("tj")[0].as_py()
            a, b = sides(g.column("slot").to_numpy(), ti, tj)
            x = _unit(_matrix(g.column("v")))
            copies = g.column("copies").to_numpy()
            link = (x[a] @ x[b].T >= threshold).astype(np.float64)
            if ti == tj:
                np.fill_diagonal(link, 0)
            total = np.zeros(len(g))
            total[a] += link @ copies[b]
            if ti != tj:
                total[b] += copies[a] @ link
            yield pa.RecordBatch.from_arrays([g.column("node").combine_chunks(), pa.array(total.astype(np.int64))], ["node", "links"])

    return run


def _placed(keys: DataFrame) -> DataFrame:
    """``keys`` with ``pos``, its rank by (pass, group, key) over all rows."""
    order = ["pass", "place", "key", "node"]
    rows = settle(keys.repartitionByRange(*order).sortWithinPartitions(*order))
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a number for each partition
    total, offsets = 0, []
    for r in sizes:
        offsets.append((r["part"], total))
        total += r["n"]
    table = keys.sparkSession.createDataFrame(offsets, "part int, before long")
    return rows.join(table, "part").select("node", "place", "pass", "key", "agree", (F.col("before") + F.col("at")).alias("pos"))


def _passes(left: DataFrame, first: int, passes: int, centres: DataFrame, threshold: float, window: int) -> DataFrame:
    """A round of passes over ``left``: rows of :func:`_edges`.

    The centres are a table of known size, which Spark sends to all tasks only if it is small.
    """
    placed = _placed(left.select("node", "place", "dim", "v").join(centres, "place", "left").mapInArrow(
        _keys(first, passes, threshold), "node string, place string, pass int, key long, agree double"))
    block, at = F.expr(f"pos div {BLOCK}"), F.col("pos") % BLOCK
    halo = F.array_compact(F.array(block, F.when((at <= window) & (block > 0), block - 1), F.when(at >= BLOCK - 1 - window, block + 1)))
    blocks = (placed.withColumn("place", F.concat_ws(":", F.col("pass").cast("string"), "place")).withColumn("block", F.explode(halo))
              .select("node", "place", "pos", "key", "agree", "block").join(left.select("node", "v"), "node"))
    return settle(blocks.repartition("block").sortWithinPartitions("block", "pos")
                  .mapInArrow(_edges(threshold, window), "a string, b string, miss double"))


def _linked(classes: DataFrame, threshold: float, window: int, recall: float) -> DataFrame:
    """Edges ``(a, b)`` that connect linked vectors: rounds of passes, then all pairs of what they leave open."""
    left = classes.select("node", "place", "dim", "v").withColumn("miss", F.lit(0.0))
    sizes = left.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    edges, first, tables = [], 0, Tables(classes.sparkSession, "centres")
    for k in range(ROUNDS):
        largest = sizes.agg(F.max("n").alias("n")).first()["n"]
        if not largest:
            break
        passes = passes_for(largest, threshold, window, recall)
        rows = _passes(left, first, passes, tables.put("centres", _centres(left, sizes)), threshold, window)
        tables.drop("centres")
        first += passes
        edges.append(rows.where("b IS NOT NULL").select("a", "b"))
        more = rows.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("miss").alias("more"))
        left = settle(left.join(more, "node").withColumn("miss", F.col("miss") + F.col("more")).drop("more")
                      .where(F.col("miss") > math.log(1 - recall)))
        sizes = left.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        few = sizes if k == ROUNDS - 1 else sizes.where(F.col("n") <= ALL_PAIRS)
        rest = tiles(left.join(few, "place").select("node", "place", "v", "n"), "place", "node", F.col("n")).drop("n")
        edges.append(dealt(rest, "place", "node").mapInArrow(_all_pairs(threshold), "a string, b string"))
        sizes = sizes.where(F.col("n") > ALL_PAIRS)
        left = left.join(sizes.select("place"), "place", "left_semi")
    out = classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    for e in edges:
        out = out.unionByName(e)
    return out


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> DataFrame:
    """Links and groups of near-equal vectors of one label.

    ``vectors(vec_id, embedding, label)`` to vec_id, n_links (other vectors with
    cosine of at least ``threshold``, copies among them), component_id (smallest vec_id reachable by
    links, itself included) and kept (whether it is that vector), a row for
    each row. A null label, a null or zero vector, null or non-finite components
    and null ids link with nothing; vectors of unlike length are not compared.
    Repeated rows link as copies do. An empty table gives no rows. Other columns are not read.
    """
    v, x = F.col("embedding"), F.col("embedding")
    fine = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & v.isNotNull()
            & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(x, lambda e: e != 0))
    node = F.concat(F.hex(F.xxhash64("label", "embedding")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "embedding", "label")))
    base = vectors.select("vec_id", "embedding", "label", F.when(F.coalesce(fine, F.lit(False)), node).alias("node"))
    classes = settle(base.where("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("v"),
        F.first("label").alias("label")).withColumn("dim", F.size("v"))
        .withColumn("place", F.concat_ws(":", F.col("label").cast("string"), F.col("dim").cast("string"))))
    found = components(_linked(classes, threshold, window, recall))
    # the smallest member of a component is one of its rows too
    members = settle(found.unionByName(found.select(F.col("component").alias("node"), "component").distinct()))
    size = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = (tiles(members.join(size, "component"), "component", "node", F.col("size")).drop("size")
            .join(classes.select("node", "v", "copies"), "node"))
    links = (dealt(rows.select("component", "ti", "tj", "slot", "node", "copies", "v"), "component", "node")
             .mapInArrow(_counts(threshold), "node string, links long").groupBy("node").agg(F.sum("links").alias("links")))
    first = (members.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id")))
    home = (classes.select("node", "rep", "copies").join(members, "node", "left").join(first, "component", "left").join(links, "node", "left")
            .select("node", F.coalesce("component_id", "rep").alias("component_id"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    home = settle(home)  # the join below can then split a large class's side
    own = F.coalesce("component_id", "vec_id")
    return (base.select("vec_id", "node").join(home, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                    F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept")))


def op6_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-equal vectors of each label."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: DuckDB: all pairs of a label by cosine, and the closure of their links.
SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.x = c.vec_id) AS n_links, component_id, component_id = vec_id AS kept FROM c
"""
