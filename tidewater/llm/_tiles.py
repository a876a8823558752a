"""Comparing the members of groups of any size in tiles of bounded size.

A group is dealt into slots of about ``SLOT_ROWS`` rows by a hash; a tile holds two
slots (or one), so each pair of members meets in exactly one tile and no task
ever holds a group. A group of up to a slot's size is one tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_ROWS = 1024


def tiles(rows: DataFrame, group: str, member: str, size: Column) -> DataFrame:
    """``rows`` with ``slot`` and, once for each tile of theirs, ``ti`` and ``tj``; ``size``: slots' worth of rows in the group."""
    n = F.greatest(F.lit(1), F.ceil(size / F.lit(SLOT_ROWS)).cast("int"))
    slot = F.pmod(F.xxhash64(member, group), n.cast("long")).cast("int")
    out = rows.withColumn("slots", n).withColumn("slot", slot)
    return (out.withColumn("other", F.explode(F.expr("sequence(0, slots - 1)")))
            .withColumn("ti", F.least("slot", "other")).withColumn("tj", F.greatest("slot", "other")).drop("slots", "other"))


def dealt(rows: DataFrame, group: str, member: str) -> DataFrame:
    """The tiles' rows, each tile's together and in order."""
    return rows.repartition(group, "ti", "tj").sortWithinPartitions(group, "ti", "tj", "slot", member)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The tables of equal keys in batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        new = np.zeros(len(batch), bool)
        for k in keys:
            c = batch.column(k)
            v = c.to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), len(batch)]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if hi == lo:
                continue
            key = tuple(batch.column(k)[lo].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def sides(slot: np.ndarray, ti: int, tj: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a tile's two sides; the same rows twice where the tile is one slot."""
    a = np.flatnonzero(slot == ti)
    return a, (a if ti == tj else np.flatnonzero(slot == tj))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches by the links ``a - b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
