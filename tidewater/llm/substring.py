"""Substring deduplication by anchored window matching, in place of a relative Lempel-Ziv parse (no longest match is searched).

Every document is parsed against all documents with a smaller id. The index has
a block for each place where a phrase may start: a window is ``WINDOW`` words, its
anchor the smallest hash of its ``ANCHOR``-word phrases, so equal windows have equal
anchors wherever they stand, and a run of windows with one anchor is a reference
block. Blocks meet by anchor; in a group, rows go by document id, so the first
document with a window is its reference. A document's consecutive windows with
the same reference are one factor. Factors are cut where blocks or references
change; each window belongs to one block, also one that crosses the end of a
factor, so no window at a factor's boundary escapes. A last pass goes through each document,
joins its factors (all at least ``WINDOW`` words long) to spans, and keeps the rest.

At scale: a block is one row with six bytes for each window (with the anchor's 64
bits, 112 bits decide). Tasks look through their own documents first: a window
that a smaller document of the same chunk has is a factor at once and is not
sent, so a phrase in a third of all documents is sent once by a chunk, not by a
document. Groups stream past in order of (anchor, id); what is kept of one is its
distinct windows. Texts are shuffled once, compressed, to meet their factors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._text import CHUNK_BYTES, Hashed, WordHashes, byte_texts, chunks, mix, windows

WINDOW = 13
ANCHOR = 6
_FP = 6  # bytes of a window's fingerprint
_MOST_RUN = 512
_ROW = ["h", "doc_id", "tag", "start", "n", "fps"]


def _anchors(words: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The smallest phrase hash in each window."""
    low = windows(words, anchor, salt=7)
    have, want = 1, window - anchor + 1
    while have < want:  # minima of doubling ranges
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _blocks(kind, window: int, anchor: int):
    """Documents to rows: blocks (``n`` windows) and factors found within a chunk (``-n`` windows)."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for lo, hi in chunks(sizes, CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                order = pc.sort_indices(part.column("doc_id"))
                part = part.take(order)
                ids = part.column("doc_id")
                # ranks stand for ids within the chunk, equal for equal ids
                rank = np.r_[0, np.cumsum(np.asarray(pc.not_equal(ids[1:], ids[:-1])))].astype(np.int64) if len(ids) else np.empty(0, np.int64)
                h = Hashed(byte_texts(part.column("text")), hashes)
                at = h.whole(window)
                if not len(at):
                    continue
                fp, low = windows(h.words, window)[at], _anchors(h.words, window, anchor)[at]
                doc, pos = h.doc[at], h.at[at]
                by = np.argsort(fp, kind="stable")
                first = _runs(fp[by])
                smallest = np.empty(len(by), np.int64)
                smallest[by] = np.repeat(rank[doc[by[first]]], np.diff(np.r_[first, len(by)]))
                dup = rank[doc] > smallest
                key = np.where(dup, np.uint64(0), low)
                brk = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (key[1:] != key[:-1])
                                           | (dup[1:] != dup[:-1]) | (~dup[1:] & (pos[1:] % _MOST_RUN == 0))])
                n = np.diff(np.r_[brk, len(at)])
                d = doc[brk]
                spread = mix(part.column("tag").to_numpy().astype(np.uint64))[d]
                anchors = np.where(dup[brk], spread, low[brk]).view(np.int64)
                width = np.where(dup[brk], 0, n * _FP)
                data = fp.view(np.uint8).reshape(-1, 8)[~dup, :_FP].tobytes()
                offsets = np.r_[0, np.cumsum(width)].astype(np.int32)
                fps = pa.Array.from_buffers(pa.binary(), len(brk), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                for a in range(0, len(brk), 20_000):
                    b = min(len(brk), a + 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors[a:b]), ids.take(pa.array(d[a:b])), part.column("tag").take(pa.array(d[a:b])),
                         pa.array(pos[brk[a:b]].astype(np.int32)), pa.array(np.where(dup[brk], -n, n)[a:b].astype(np.int32)),
                         fps.slice(a, b - a)], _ROW)

    return run


def _flat(fps: pa.Array, n: np.ndarray) -> np.ndarray:
    """All fingerprints of a column as integers."""
    offsets = np.frombuffer(fps.buffers()[1], np.int32)[fps.offset:fps.offset + len(fps) + 1]
    data = np.frombuffer(fps.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    out = np.zeros((len(data) // _FP, 8), np.uint8)
    out[:, :_FP] = data.reshape(-1, _FP)
    return out.view(np.uint64).ravel()


def _factors(window: int):
    """Blocks in order of (anchor, id) to factors ``doc_id, tag, start, end, ref``, in words."""

    def run(batches):
        last, seen_fp, seen_ref = None, np.empty(0, np.uint64), []
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if isinstance(batch, pa.RecordBatch) else batch
            h, n = batch.column("h").to_numpy(), batch.column("n").to_numpy()
            start, ids, tags = batch.column("start").to_numpy(), batch.column("doc_id"), batch.column("tag")
            own = np.flatnonzero(n < 0)
            if len(own):
                take = pa.array(own)
                yield _factor_rows(ids.take(take), tags.take(take), start[own], start[own] - n[own] + window - 1, ids.take(take), False)
            rows = np.flatnonzero(n > 0)
            if not len(rows):
                continue
            fp = _flat(batch.column("fps"), n)
            row = np.repeat(rows, n[rows])
            at = np.arange(len(row)) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows]) + start[row]
            # what is known of the anchor that the last batch ended with stands before this batch's windows
            old = len(seen_fp) if last is not None and h[rows[0]] == last else 0
            ref_ids = pa.concat_arrays([pa.array(seen_ref, ids.type), ids]) if old else ids
            shift = old
            key = mix(h[row].view(np.uint64)) ^ fp
            key_all = np.concatenate([mix(np.full(old, last, np.int64).view(np.uint64)) ^ seen_fp[:old], key]) if old else key
            who = np.concatenate([np.arange(old), row + shift])
            # equal ids have equal ranks, so repeated rows are not each other's reference
            rank = pc.rank(ref_ids, sort_keys="ascending", tiebreaker="min").to_numpy()
            by = np.argsort(key_all, kind="stable")
            first = _runs(key_all[by])
            size = np.diff(np.r_[first, len(by)])
            ref = np.empty(len(by), np.int64)
            ref[by] = np.repeat(who[by[first]], size)
            mine = np.arange(old, len(by))
            dup = rank[who[mine]] > rank[ref[mine]]
            hit = np.flatnonzero(dup)
            if len(hit):
                r, p, to = row[hit], at[hit], ref[mine][hit]
                brk = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1) | (to[1:] != to[:-1])])
                end = np.r_[brk[1:], len(hit)] - 1
                take = pa.array(r[brk])
                yield _factor_rows(ids.take(take), tags.take(take), p[brk], p[end] + window, ref_ids.take(pa.array(to[brk])), True)
            final = h[rows[-1]]
            keep = by[first]
            of_last = np.concatenate([np.full(old, last if old else 0, np.int64), h[row]])[keep] == final
            keep = keep[of_last]
            all_fp = np.concatenate([seen_fp[:old], fp]) if old else fp
            last, seen_fp, seen_ref = final, all_fp[keep], ref_ids.take(pa.array(who[keep])).to_pylist()

    return run


def _factor_rows(ids, tags, start, end, ref, known: bool) -> pa.RecordBatch:
    refs = ref if known else pa.nulls(len(ids), ids.type)
    return pa.RecordBatch.from_arrays([ids, tags, pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), refs],
                                      ["doc_id", "tag", "start", "end", "ref"])


def _tagged(docs: DataFrame) -> DataFrame:
    """Id, text, and a hash of the text that tells rows of equal ids apart."""
    return docs.select("doc_id", "text", F.hash(F.coalesce("text", F.lit(""))).alias("tag"))


def factors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The parse: doc_id, tag (hash of the text), start and end (words), and ref.

    ``ref`` is the smallest document with these words, null where the factor
    was found within a task's own chunk.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (_tagged(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
            .mapInArrow(_blocks(kind, window, anchor), f"h long, doc_id {kind}, tag int, start int, n int, fps binary"))
    return (rows.repartition("h").sortWithinPartitions("h", "doc_id")
            .mapInArrow(_factors(window), f"doc_id {kind}, tag int, start int, end int, ref {kind}"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The documents without words of windows that start in a document with a smaller id.

    ``docs(doc_id, text)`` to doc_id, n_words, spans (array of start and end, in
    words, joined), n_removed and kept_text (the words left, joined by one space).
    A null text has no words; texts under ``window`` words stay as they are. A
    document with a null id has no place in the order: it is kept whole and is no
    reference. Rows of equal ids are not smaller than each other. An empty table gives no
    rows. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = (factors(docs, window, anchor).groupBy("doc_id", "tag")
             .agg(F.collect_list(F.struct("start", "end")).alias("factors")))

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [None if t is None else press.compress(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(z, pa.binary())], ["doc_id", "tag", "z"])

    def parse(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            z, found = batch.column("z").to_pylist(), batch.column("factors").to_pylist()
            for lo in range(0, len(z), 500):
                n, gone, spans, kept = [], [], [], []
                for data, fs in zip(z[lo:lo + 500], found[lo:lo + 500], strict=True):
                    words = unpress.decompress(data).split() if data else []
                    joined: list[list[int]] = []
                    for a, b in sorted((f["start"], f["end"]) for f in fs or ()):
                        if joined and a <= joined[-1][1]:
                            joined[-1][1] = max(joined[-1][1], b)
                        else:
                            joined.append([a, b])
                    left, at = [], 0
                    for a, b in joined:
                        left += words[at:a]
                        at = b
                    left += words[at:]
                    n.append(len(words))
                    gone.append(len(words) - len(left))
                    spans.append([{"start": a, "end": b} for a, b in joined])
                    kept.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, 500), pa.array(n, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "spans", "n_removed", "kept_text"])

    texts = _tagged(docs).mapInArrow(pack, f"doc_id {kind}, tag int, z binary")
    return (texts.join(found.hint("merge"), ["doc_id", "tag"], "left").select("doc_id", "z", "factors")
            .mapInArrow(parse, f"doc_id {kind}, n_words long, spans array<struct<start:int,end:int>>, n_removed long, kept_text string"))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows of smaller documents."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB: all windows by their words, the smallest document of each, and the words they cover.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k FROM d, unnest(range(1, len(w) - 11)) t(i)),
low AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
cov AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN low USING (k), unnest(range(0, 13)) t(j) WHERE first < doc_id),
g AS (SELECT doc_id, list(p) AS p FROM cov GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: p IS NULL OR NOT list_contains(p, i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
