"""Language-model scores from a probabilistic suffix tree over words.

A node of the tree is a context, the up to ``CONTEXT`` words before a token; its parent is the context
without its first word, the root has none. A context's next-token
distribution keeps the tokens seen after it ``LEAST`` times or more, each less ``DISCOUNT``, and hands the rest of its mass to
its parent's distribution; the root's is the contract's additive one, so every distribution sums to one.
A context is retained if its distribution diverges from its parent's: if the
log-likelihood that it gains on the tokens after it (their number times the Kullback-Leibler divergence) is at least
``GAIN`` for each kept token. The contexts between a retained one and the root stay as well. A text's
score is the sum over its tokens of log10 of the probability at the longest suffix of the words before it that is retained.

Texts are chunks of numbers (``_numbers``). Words are counted by their text, so the base score is exact, and those that may be
kept get a number, by which chunks know them from then on. Grams of k tokens are counted level by level, by 64 bits of hash of context and token: a gram is sent
to be counted only if both its parts of k - 1 tokens may be kept, by a bit filter of fixed size. Hashes are built token by token, so
a gram's suffix follows from its context's suffix and its token, and no chunk is asked for it. The tree's levels are tables
joined by key. What a chunk sends to be counted or asked is cut by the high bits of the hashes into cells, a packed row for
each chunk and cell; there are as many cells as the number of keys asks for, so that a task holds about ``CELL`` at a time,
and a key of any frequency is once in a chunk's row. Answers are in the order of the question, which the chunk
can build again, and come back in one sort.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._numbers import BLOCK, answered, distinct, filter_of, gathered, grown, may_hold, near_order, order_of, pack, shrunk, starts_of, unpack
from tidewater.llm._scratch import Tables
from tidewater.llm._text import mix

CONTEXT = 3
LEAST = 3
DISCOUNT = 0.75
GAIN = 3.0
#: Bytes of text of a chunk, about: its grams of all lengths are in a task's memory at a time.
CHUNK_BYTES = 8 << 20
#: Groups of chunks that ask one after the other, so that their questions and answers are not on disk at once.
PARTS = 3
#: Keys of a cell, about.
CELL = 1 << 19
#: Bytes of the words of a cell, about, for texts without spaces.
CELL_BYTES = 1 << 26
#: Share of ids that are not learnt from: those whose crc32 is 1 modulo this.
FOLDS = 5
#: Number of the end of a text, and of words that no kept gram holds.
_END, _RARE = 0, -1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def held_out(doc_id):
    """Whether a document is not learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 1, F.lit(False))


def _stored(ids: pa.Array) -> bytes:
    """Ids of any type as bytes: long rows of plain bytes pass between Spark and Python much faster than arrays."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, pa.schema([("id", ids.type)])) as w:
        w.write_batch(pa.RecordBatch.from_arrays([ids], ["id"]))
    return out.getvalue().to_pybytes()


def _listed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large binary array."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def _array(offsets: np.ndarray, data) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def _lines(data: bytes) -> pa.Array:
    """Words, each with the line end that it has in ``data``."""
    return _array(np.r_[0, np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1], data)


def _bits(keys: int, cell: int) -> int:
    """High bits that number the cells of so many keys."""
    return max(0, (max(keys, 1) - 1).bit_length() - (cell - 1).bit_length())


def _cells(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """Number and range of each cell that some of the sorted keys are in."""
    if not len(keys):
        return []
    cell = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    return list(zip(cell[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True))


def _behind(sizes: list[int], values: np.ndarray) -> np.ndarray:
    """Keys that keep runs of such sizes and put the values of each in order, or nearly: equal ones behind each other pack better."""
    room, wide = 64 - len(sizes).bit_length(), int(values.max()).bit_length() if len(values) else 0
    run = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    return run << np.uint64(room) | values >> np.uint64(max(0, wide - room)) << np.uint64(max(0, room - wide))


def _by_cell(rows: DataFrame, *then) -> DataFrame:
    """Each cell's rows behind each other in one task."""
    return rows.repartition("cell").sortWithinPartitions("cell", *then)


def _gathered_cells(batches):
    """The rows of one cell at a time."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["cell"] != now:
                if held:
                    yield now, held
                now, held = row["cell"], []
            held.append(row)
    if held:
        yield now, held


def _words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words of texts, lower-cased, the place among them of each word, and the number of each text's words."""
    low = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_binary())
    ends, data = _listed(low)
    data, ends = data[ends[0]:ends[-1]], ends - ends[0]
    edge = np.zeros(len(data) + 1, bool)  # places that begin a text, and behind the last
    edge[ends] = True
    inside = ~_SPACE[data]
    before, behind = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    behind[:-1] |= ~inside[1:]
    first, last = np.flatnonzero(inside & before), np.flatnonzero(inside & behind)
    coded = _array(np.r_[0, np.cumsum(last - first + 1)], data[inside]).dictionary_encode()
    offsets, different = _listed(coded.dictionary)
    different, offsets = different.tobytes(), offsets.tolist()
    return ([different[lo:hi] for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)], coded.indices.to_numpy(),
            np.diff(np.searchsorted(first, ends)))


def _reader():
    """Chunks: dictionary with its counts in the texts that are learnt from, and by text id, fold, length and the words' places."""
    def run(batches):
        for table in gathered(batches, "text", CHUNK_BYTES):
            ids, held = table.column("doc_id").combine_chunks(), table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False)
            words, codes, lengths = _words(table.column("text").combine_chunks())
            counts = np.bincount(codes[np.repeat(~held, lengths)], minlength=len(words))
            joined = b"\n".join([*words, b""])
            hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([n], pa.int64()) for n in (len(counts), len(joined), int(counts.sum()), int((~held).sum()))),
                 *(pa.array([x], pa.binary()) for x in (shrunk(joined), pack(counts), _stored(ids), pack(held.view(np.uint8)),
                                                        pack(lengths), pack(codes), hashes.tobytes()))],
                ["n_entries", "n_bytes", "n_words", "n_texts", "words", "counts", "doc_ids", "held", "lengths", "codes", "hashes"])
    return run


def _word_rows(bits: int):
    """A chunk's words and their counts by cell, in order of hash."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts, keys = unpack(row["counts"], np.int64), np.frombuffer(row["hashes"], np.uint64)
                order = order_of(keys)
                found, counts = _cells(keys[order], bits), counts[order]
                offsets, words = _listed(_lines(grown(row["words"])).take(pa.array(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _, _ in found], pa.int64()), pa.array([row["chunk"]] * len(found), pa.int64()),
                     pa.array([shrunk(words[offsets[lo]:offsets[hi]]) for _, lo, hi in found], pa.binary()),
                     pa.array([pack(counts[lo:hi]) for _, lo, hi in found], pa.binary())],
                    ["cell", "chunk", "words", "counts"])
    return run


def _word_counts(least: int):
    """By cell: counts and numbers of each chunk's words, and, without a chunk, of the words that may be kept, and how many are known."""
    def run(batches):
        for cell, rows in _gathered_cells(batches):
            coded = _lines(b"".join(grown(row["words"]) for row in rows)).dictionary_encode()
            codes, n = coded.indices.to_numpy(), [unpack(row["counts"], np.int64) for row in rows]
            total = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(total, codes, np.concatenate(n))
            kept = np.flatnonzero(total >= max(least, 1))
            kept = kept[pc.sort_indices(pa.table({"n": total[kept], "word": coded.dictionary.take(pa.array(kept))}),
                                        [("n", "descending"), ("word", "ascending")]).to_numpy()]
            number = np.full(len(total), _RARE, np.int64)
            number[kept] = (cell << 24) + 1 + np.arange(len(kept))
            asked = [*np.split(codes, np.cumsum([len(x) for x in n])[:-1]), kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["chunk"] for r in rows] + [None], pa.int64()), pa.array([cell] * len(asked), pa.int64()),
                 pa.array([pack(total[x]) for x in asked], pa.binary()), pa.array([pack(number[x]) for x in asked], pa.binary()),
                 pa.array([0] * len(rows) + [int((total > 0).sum())], pa.int64())],
                ["chunk", "cell", "c", "ids", "known"])
    return run


def _numbered(head: dict, found: dict) -> pa.RecordBatch:
    """A chunk with the numbers and counts of its words in place of their hashes."""
    keys = np.frombuffer(head["hashes"], np.uint64)
    order = order_of(keys)
    values = {}
    for c in ("ids", "c"):
        values[c] = np.zeros(len(keys), np.int64)
        values[c][order] = np.concatenate([np.empty(0, np.int64), *(unpack(found[c][i], np.int64) for i in np.argsort(found["cell"]))])
    return pa.RecordBatch.from_arrays(
        [pa.array([head["chunk"]], pa.int64()), *(pa.array([x], pa.binary()) for x in (
            *(head[c] for c in ("doc_ids", "held", "lengths", "codes")), pack(values["ids"]), pack(values["c"])))],
        ["chunk", "doc_ids", "held", "lengths", "codes", "ids", "c"])


def _kept_words(batches):
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(mix(unpack(row["ids"], np.uint64)).view(np.int64)), pa.array(unpack(row["c"], np.int64))], ["gram", "c"])


def _longer(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hash of a context and the token behind it."""
    out = np.empty(len(context), np.uint64)
    for lo in range(0, len(out), BLOCK):
        out[lo:lo + BLOCK] = mix(context[lo:lo + BLOCK] * _ODD + token[lo:lo + BLOCK])
    return out


class _Tokens:
    """A chunk's tokens as numbers, an end behind each text, and the hashes of its grams by their first place."""

    def __init__(self, lengths: bytes, codes: bytes, ids: bytes):
        self.lengths, self.codes = unpack(lengths, np.int64), unpack(codes, np.int32)
        self.size = int(self.lengths.sum()) + len(self.lengths)
        self.word = np.ones(self.size, bool)
        self.word[np.cumsum(self.lengths + 1) - 1] = False
        tokens = np.full(self.size, _END, np.int64)
        tokens[self.word] = unpack(ids, np.int64)[self.codes]
        self.tokens, self.doc = tokens.view(np.uint64), np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths + 1)
        self._grams, self._whole = [mix(self.tokens)], [tokens != _RARE]

    def grams(self, k: int) -> np.ndarray:
        while len(self._grams) < k:
            self._grams.append(_longer(self._grams[-1][:-1], self.tokens[len(self._grams):]))
        return self._grams[k - 1]

    def whole(self, k: int) -> np.ndarray:
        """Whether the gram of k tokens that begins at a place stays inside one text and has no rare word."""
        while len(self._whole) < k:
            j = len(self._whole)
            self._whole.append(self._whole[-1][:-1] & self._whole[0][j:] & (self.doc[:max(0, self.size - j)] == self.doc[j:]))
        return self._whole[k - 1]


def _each(batch):
    for chunk, lengths, codes, ids in zip(*(batch.column(c) for c in ("chunk", "lengths", "codes", "ids")), strict=True):
        yield chunk.as_py(), _Tokens(lengths.as_py(), codes.as_py(), ids.as_py())


def _counted(k: int, cells, bits: int):
    """Context, token and count of the grams of k tokens in the texts that are learnt from, both parts of which may be kept, by cell.

    Contexts of one token go as its number, which packs better than its hash.
    """
    def run(batches):
        for batch in batches:
            for (_, t), held in zip(_each(batch), batch.column("held"), strict=True):
                parts = t.grams(k - 1)
                may = may_hold(cells.value, parts) if k > 2 else np.ones(len(parts), bool)
                at = np.flatnonzero(t.whole(k) & may[:-1] & may[1:] & (unpack(held.as_py(), np.uint8) == 0)[t.doc[:t.size - k + 1]]) if t.size >= k else np.empty(0, np.int64)
                gram = t.grams(k)[at]
                order = order_of(gram)
                first = np.flatnonzero(starts_of(gram[order]))
                n, at = np.diff(np.r_[first, len(order)]), at[order[first]]
                found = _cells(t.grams(k)[at], bits)
                context = (parts if k > 2 else t.tokens)[at]
                order = near_order(_behind([hi - lo for _, lo, hi in found], context))
                context, token, n = context[order], t.tokens[at + k - 1][order], n[order]
                rows = [(cell, *(pack(x[lo:hi]) for x in (context, token, n))) for cell, lo, hi in found]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2, 3))],
                                                 ["cell", "contexts", "tokens", "n"])
    return run


def _summed(k: int, least: int):
    """The grams of a cell that occur often enough in all chunks."""
    def run(batches):
        for _, rows in _gathered_cells(batches):
            context, token, n = (np.concatenate([unpack(r[c], kind) for r in rows]) for c, kind in (("contexts", np.uint64), ("tokens", np.uint64), ("n", np.int64)))
            if k == 2:
                context = mix(context)
            gram = _longer(context, token)
            order = order_of(gram)
            gram = gram[order]
            first = np.flatnonzero(starts_of(gram))
            n = np.add.reduceat(n[order], first)
            kept = n >= least
            one = order[first][kept]
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (gram[first][kept], context[one], token[one], n[kept])],
                                             ["gram", "context", "token", "n"])
    return run


def _suffixes(k: int):
    """All but the first token of a gram, from the same of its context (``inner``) and its token."""
    def run(batches):
        for batch in batches:
            token = batch.column("token").to_numpy().view(np.uint64)
            suffix = mix(token) if k == 2 else _longer(batch.column("inner").to_numpy().view(np.uint64), token)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("gram", "n", "context", "of")), pa.array(suffix.view(np.int64))],
                                             ["gram", "n", "context", "of", "suffix"])
    return run


def _may_know(t: _Tokens, k: int, cells) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a chunk's grams of k tokens that the tree may know."""
    grams = t.grams(k)
    at = np.flatnonzero(t.whole(k) & may_hold(cells.value, grams))
    return at, grams[at]


def _asked(t: _Tokens, longest: int, cells) -> np.ndarray:
    """The distinct grams of a chunk that the tree may know, in order."""
    return np.sort(np.concatenate([distinct(_may_know(t, k, cells)[1]) for k in range(1, longest + 1)]))


def _asked_by_place(t: _Tokens, longest: int, cells) -> tuple[np.ndarray, Callable]:
    """What a chunk asked; and by number of tokens, for each place, which of the asked grams begins there, or -1."""
    parts = []
    for k in range(1, longest + 1):
        at, grams = _may_know(t, k, cells)
        order = order_of(grams)
        grams = grams[order]
        first = starts_of(grams)
        parts.append((at[order].astype(np.int32), grams[first], np.cumsum(first, dtype=np.int32) - 1))
    asked = np.sort(np.concatenate([different for _, different, _ in parts]))

    def where(k: int) -> np.ndarray:
        at, different, number = parts[k - 1]
        out = np.full(len(t.grams(k)), -1, np.int32)
        out[at] = np.searchsorted(asked, different).astype(np.int32)[number]
        return out

    return asked, where


def _asking(longest: int, cells, bits: int):
    """What a chunk asks, by cell."""
    def run(batches):
        for batch in batches:
            for chunk, t in _each(batch):
                grams = _asked(t, longest, cells)
                found = _cells(grams, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _, _ in found], pa.int64()), pa.array([chunk] * len(found), pa.int64()),
                     pa.array([pack(grams[lo:hi]) for _, lo, hi in found], pa.binary())], ["cell", "chunk", "grams"])
    return run


def _tree_rows(bits: int):
    """The tree by cell, some batches at a time."""
    def packed(batches):
        table = pa.Table.from_batches(batches)
        grams, gamma, p = (table.column(c).to_numpy() for c in ("gram", "gamma", "p"))
        order = order_of(grams.view(np.uint64))
        found = _cells(grams.view(np.uint64)[order], bits)
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _, _ in found], pa.int64()),
             *(pa.array([pack(x[order[lo:hi]]) for _, lo, hi in found], pa.binary()) for x in (grams, gamma, p))], ["cell", "grams", "gamma", "p"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= 4 * CELL:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)
    return run


def _found(keys: np.ndarray, values: list[np.ndarray], grams: np.ndarray) -> list[np.ndarray]:
    """Values of the grams by sorted keys; NaN for those that are none."""
    if not len(keys):
        return [np.full(len(grams), np.nan) for _ in values]
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    there = keys[at] == grams
    return [np.where(there, v[at], np.nan) for v in values]


def _telling(batches):
    """Of a cell, the tree's rows first, then what the chunks ask, each answered in the order asked."""
    cell, parts, tables = None, [], None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["cell"] != cell:
                cell, parts, tables = row["cell"], [], None
            if row["chunk"] is None:
                parts.append([unpack(row["grams"], np.uint64), unpack(row["gamma"], np.float64), unpack(row["p"], np.float64)])
                continue
            if tables is None:
                grams, *values = [np.concatenate(x) if x else np.empty(0) for x in (zip(*parts, strict=True) if parts else [()] * 3)]
                order = order_of(grams) if parts else np.empty(0, np.int64)
                first = starts_of(grams[order])
                tables, number = [grams[order][first]], np.cumsum(first) - 1
                for v in values:  # a gram has a row as a context and one as a token at most
                    v, one = v[order], np.full(len(tables[0]), np.nan)
                    there = ~np.isnan(v)
                    one[number[there]] = v[there]
                    tables.append(one)
            asked = unpack(row["grams"], np.uint64)
            gamma, p = _found(tables[0], tables[1:], asked)
            flags = (~np.isnan(gamma)).astype(np.uint8) | (~np.isnan(p)).astype(np.uint8) << 1
            out.append((row["chunk"], cell, pack(flags), pack(gamma[flags & 1 != 0]), pack(p[flags & 2 != 0])))
        cols = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:2]), *(pa.array(c, pa.binary()) for c in cols[2:])],
                                         ["chunk", "cell", "flags", "gamma", "p"])


def _filter(spark, grams: DataFrame):
    return spark.sparkContext.broadcast(filter_of(grams, "gram"))


def _scorer(longest: int, cells, train_tokens: int, vocabulary: int, end_count: int):
    """The rows of a chunk from its tokens, its words' counts and what the tree says of its grams."""
    def run(head: dict, found: dict) -> pa.RecordBatch:
        t = _Tokens(head["lengths"], head["codes"], head["ids"])
        c = np.full(t.size, float(end_count))
        c[t.word] = unpack(head["c"], np.int64)[t.codes]
        base = (c + 0.5) / (train_tokens + 0.5 * (vocabulary + 1))
        grams, where = _asked_by_place(t, longest, cells)
        gamma, p = np.full(len(grams) + 1, np.nan), np.full(len(grams) + 1, np.nan)  # the last for places without a gram
        if len(grams):
            rows = np.argsort(found["cell"]).tolist()
            flags = np.concatenate([unpack(found["flags"][i], np.uint8) for i in rows])
            for bit, values, name in ((1, gamma, "gamma"), (2, p, "p")):
                values[:-1][flags & bit != 0] = np.concatenate([unpack(found[name][i], np.float64) for i in rows])
        prob = base.copy()
        inside = np.ones(t.size, bool)  # tokens whose contexts so far are all in the tree
        contexts = where(1)
        for k in range(2, longest + 1):
            if t.size < k:
                break
            at = np.flatnonzero(inside[k - 1:] & (t.doc[k - 1:] == t.doc[:t.size - k + 1]))
            rest, contexts = gamma[contexts[at]], where(k)
            known = ~np.isnan(rest)
            at, rest = at[known], rest[known]
            own = p[contexts[at]]
            last = at + k - 1
            prob[last] = np.where(np.isnan(own), 0.0, own) + rest * prob[last]
            inside[:] = False
            inside[last] = True
        n = len(t.lengths)

        def by_text(values):
            return np.bincount(t.doc, values, minlength=n)

        return pa.RecordBatch.from_arrays(
            [pa.ipc.open_stream(head["doc_ids"]).read_all().column("id").combine_chunks(), pa.array(unpack(head["held"], np.uint8) != 0), pa.array(t.lengths + 1),
             pa.array(by_text(c > 0).astype(np.int64)), pa.array(np.full(n, train_tokens, np.int64)),
             pa.array(by_text(np.log10(base))), pa.array(by_text(np.log10(prob)))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def _levels(texts: DataFrame, first: DataFrame, tables: Tables, longest: int, least: int, bits: int) -> tuple[dict, dict]:
    """Kept grams by their number of tokens, and the contexts that they follow by theirs.

    Grams: gram, c (occurrences), prob (after its context, handing on to every shorter one), and of two tokens or more
    context, suffix and p, its context's own part of prob. Contexts: gram, gamma (the mass handed on), gain, kept.
    """
    spark = texts.sparkSession
    grams, contexts = {1: first}, {}
    for k in range(2, longest + 1):
        shorter = grams[k - 1]
        cells = _filter(spark, shorter) if k > 2 else None
        counts = tables.put(f"counts{k}", _by_cell(texts.select("chunk", "lengths", "codes", "ids", "held").mapInArrow(
            _counted(k, cells, bits), "cell long, contexts binary, tokens binary, n binary"))
            .mapInArrow(_summed(k, least), "gram long, context long, token long, n long"))
        inner = shorter.select(F.col("gram").alias("context"), F.col("c").alias("of"), ("suffix" if k > 2 else F.lit(0).cast("long").alias("suffix")))
        events = (counts.join(inner.withColumnRenamed("suffix", "inner"), "context")
                  .mapInArrow(_suffixes(k), "gram long, n long, context long, of long, suffix long")
                  .join(shorter.select(F.col("gram").alias("suffix"), F.col("prob").alias("above")), "suffix"))
        events = tables.put(f"events{k}", events)
        if cells is not None:
            cells.unpersist()
        share = F.col("n") / F.col("of")
        found = events.groupBy("context").agg(
            F.max("of").alias("of"), F.sum("n").alias("n"), F.count("n").alias("kept"), F.sum("above").alias("above"),
            F.sum(F.col("n") * F.log(share / F.col("above"))).alias("gain"))
        rest = F.col("of") - F.col("n")
        gain = F.col("gain") + F.when(rest > 0, rest * F.log(rest / F.col("of") / F.greatest(1 - F.col("above"), F.lit(1e-12)))).otherwise(0.0)
        contexts[k - 1] = tables.put(f"contexts{k}", found.select(
            F.col("context").alias("gram"), "kept", gain.alias("gain"),
            (1 - (F.col("n") - F.lit(DISCOUNT) * F.col("kept")) / F.col("of")).alias("gamma")))
        own = (F.col("n") - F.lit(DISCOUNT)) / F.col("of")
        grams[k] = tables.put(f"grams{k}", events.join(contexts[k - 1].select(F.col("gram").alias("context"), "gamma"), "context").select(
            "gram", F.col("n").alias("c"), "context", "suffix", own.alias("p"), (own + F.col("gamma") * F.col("above")).alias("prob")))
        tables.drop(f"counts{k}", f"events{k}", "first")
        if k > 2:  # nothing longer asks for their probability again
            grams[k - 1] = tables.put(f"grams{k - 1}", shorter.select("gram", "context", "suffix", "p"))
    return grams, contexts


def _tree(grams: dict, contexts: dict, tables: Tables, gain: float) -> DataFrame:
    """``gram, gamma, p``: gamma of the retained contexts, p of the tokens that they keep."""
    inner, parts = None, []
    for j in sorted(contexts, reverse=True):
        tested = contexts[j].where(F.col("gain") >= F.lit(gain) * F.col("kept")).select("gram")
        names = tested if inner is None else tested.unionByName(inner).distinct()
        names = tables.put(f"retained{j}", names)
        parts.append(contexts[j].join(names, "gram").select("gram", "gamma", F.lit(None).cast("double").alias("p")))
        parts.append(grams[j + 1].join(names.withColumnRenamed("gram", "context"), "context", "left_semi")
                     .select("gram", F.lit(None).cast("double").alias("gamma"), "p"))
        if j > 1:
            inner = grams[j].join(names, "gram", "left_semi").select(F.col("suffix").alias("gram"))
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    # a gram is the key of one context and one token at most; the two rows meet where they are asked for
    return tables.put("tree", every)


def score_texts(docs: DataFrame, context: int = CONTEXT, least: int = LEAST, gain: float = GAIN, cell: int = CELL) -> DataFrame:
    """``docs(doc_id, text)`` to doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, a row for each.

    Learns from the texts that are not held out. A null or empty text is the end alone. Very long texts are a chunk of their
    own. Repeated rows have a row each and count as often as they occur; a null id is learnt from. Without a text to
    learn from every token has the probability of an unknown one. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    name = docs.schema["doc_id"].dataType.simpleString()
    tables = Tables(spark, "suffixtree")
    texts = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        _reader(), "n_entries long, n_bytes long, n_words long, n_texts long, words binary, counts binary, "
                   "doc_ids binary, held binary, lengths binary, codes binary, hashes binary")
    texts = tables.put("raw", texts.withColumn("chunk", F.monotonically_increasing_id()))
    sums = texts.agg(*[F.coalesce(F.sum(f"n_{c}"), F.lit(0)).alias(c) for c in ("entries", "bytes", "words", "texts")]).first()
    train_tokens = sums["words"] + sums["texts"]
    words = tables.put("words", _by_cell(texts.select("chunk", "words", "counts", "hashes").mapInArrow(
        _word_rows(max(_bits(sums["entries"], cell), _bits(sums["bytes"], CELL_BYTES))), "cell long, chunk long, words binary, counts binary"))
        .mapInArrow(_word_counts(least), "chunk long, cell long, c binary, ids binary, known long"))
    vocabulary = (words.agg(F.sum("known").alias("n")).first()["n"] or 0) + (1 if sums["texts"] else 0)
    texts = tables.put("texts", answered(
        texts.select("chunk", "doc_ids", "held", "lengths", "codes", "hashes"), words.where("chunk IS NOT NULL").select("chunk", "cell", "c", "ids"),
        _numbered, "chunk long, doc_ids binary, held binary, lengths binary, codes binary, ids binary, c binary"))
    tables.drop("raw")
    end = spark.createDataFrame([(int(mix(np.array([_END], np.uint64))[0]), sums["texts"])], "gram long, c long")
    first = (words.where("chunk IS NULL").select("ids", "c").mapInArrow(_kept_words, "gram long, c long").unionByName(end.where(F.col("c") >= least))
             .withColumn("prob", (F.col("c") + 0.5) / F.lit(train_tokens + 0.5 * (vocabulary + 1))))
    grams, contexts = _levels(texts, tables.put("first", first), tables, context + 1, least, _bits(train_tokens, cell))
    tree = _tree(grams, contexts, tables, gain)
    del grams, contexts
    tables.keep_only("texts", "tree")
    cells, bits = _filter(spark, tree.select("gram")), _bits(tree.count(), cell)
    nodes = tables.put("nodes", tree.mapInArrow(_tree_rows(bits), "cell long, grams binary, gamma binary, p binary")).withColumn("chunk", F.lit(None).cast("long"))
    tables.drop("tree")
    every = []
    for part in range(PARTS):
        some = texts.where(F.pmod(F.xxhash64("chunk"), F.lit(PARTS)) == part)
        asked = some.select("chunk", "lengths", "codes", "ids").mapInArrow(_asking(context + 1, cells, bits), "cell long, chunk long, grams binary")
        told = _by_cell(nodes.unionByName(asked, allowMissingColumns=True), F.asc_nulls_first("chunk")).mapInArrow(
            _telling, "chunk long, cell long, flags binary, gamma binary, p binary")
        every.append(tables.put(f"scores{part}", answered(
            some, told, _scorer(context + 1, cells, train_tokens, vocabulary, sums["texts"]),
            f"doc_id {name}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")))
    tables.keep_only(*[f"scores{part}" for part in range(PARTS)])
    scores = every[0]
    for x in every[1:]:
        scores = scores.unionByName(x)
    return scores


def op13_lm_score(spark, sf_dir: str) -> DataFrame:
    """The score of every document."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
