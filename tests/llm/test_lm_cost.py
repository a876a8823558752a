"""What op13's tasks do to a chunk: the steps that were too dear, against plain versions."""
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa

from tidewater.llm import _numbers, suffixtree


def _least(run):
    took = []
    for _ in range(7):
        at = time.process_time()
        run()
        took.append(time.process_time() - at)
    return min(took)


def test_order_of_hashes_is_stable_and_cheaper_than_moving_places():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 1 << 19).astype(np.uint64) * np.uint64(2)
    same_high = np.array([7, 5, 6, 5, 7, 4], np.uint64)  # differ in the low bits alone
    for x in (keys, np.repeat(keys[:3000], 5)[::-1].copy(), same_high, keys[:1], keys[:0], np.zeros(9, np.uint64), np.full(4, 2**64 - 1, np.uint64)):
        assert (_numbers.order_of(x) == np.argsort(x, kind="stable")).all()
        assert sorted(_numbers.near_order(x).tolist()) == list(range(len(x)))
        assert (np.sort(x)[_numbers.starts_of(np.sort(x))] == np.unique(x)).all()
    assert _least(lambda: _numbers.order_of(keys)) < _least(lambda: np.unique(keys, return_index=True))


def test_packed_numbers_and_filter_equal_plain_ones():
    rng = np.random.default_rng(2)
    for kind in (np.uint8, np.int32, np.int64, np.uint64, np.float64):
        for n in (0, 1, 1000):
            x = rng.integers(0, 200, n).astype(kind)
            assert (_numbers.unpack(_numbers.pack(x), kind) == x).all()
    cells = rng.integers(0, 1 << 62, 1 << (_numbers.FILTER_BITS - 6)).astype(np.uint64)
    keys = rng.integers(0, 1 << 62, 3 * _numbers.BLOCK + 5).astype(np.uint64)
    low = keys & np.uint64((1 << _numbers.FILTER_BITS) - 1)
    assert (_numbers.may_hold(cells, keys) == (cells[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1) != 0)).all()


def test_words_equal_plain_split():
    texts = [None, "", " \t\n", "One oNE", "two", " lead and trail \r", "", "ünï ß 日本語\x85b\x1cc\xa0d", "x" * 5000, None]
    for some in (texts, texts[3:5], [None, ""], [" "], []):
        array = pa.concat_arrays([pa.array(["cut off"]), pa.array(some, pa.string())]).slice(1)
        words, codes, lengths = suffixtree._words(array)
        plain = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in some]
        assert [words[c].decode() for c in codes] == [w for x in plain for w in x]
        assert lengths.tolist() == [len(x) for x in plain] and len(set(words)) == len(words)


def test_rows_of_a_chunk_are_few_and_hold_every_pair():
    """A corpus of 2^27 tokens: a chunk's grams go in 256 rows at most (1024 before), equal contexts behind each other."""
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 300, 2000))) for _ in range(20)]
    held = [i % 5 == 1 for i in range(20)]
    raw, = suffixtree._reader()(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(20)), "text": texts, "held_out": held})]))
    row = raw.to_pylist()[0]
    ids = np.arange(1, row["n_entries"] + 1)
    batch = pa.RecordBatch.from_pylist([{"chunk": 0, **{c: row[c] for c in ("lengths", "codes", "held")}, "ids": _numbers.pack(ids)}])
    bits = suffixtree._bits(1 << 27, suffixtree.CELL)
    sent, = suffixtree._counted(2, None, bits)(iter([batch]))
    assert 0 < len(sent) <= 256
    number = dict(zip(_numbers.grown(row["words"]).decode().split("\n"), ids.tolist(), strict=False)) | {None: suffixtree._END}
    train = [t.split() for t, h in zip(texts, held, strict=True) if not h]
    want = Counter(p for w in train for p in zip(w, [*w[1:], None], strict=True))
    got = Counter()
    for r in sent.to_pylist():
        context, token, n = (_numbers.unpack(r[c], np.int64).tolist() for c in ("contexts", "tokens", "n"))
        assert context == sorted(context)
        got.update(dict(zip(zip(context, token, strict=True), n, strict=True)))
    assert got == {(number[a], number[b]): n for (a, b), n in want.items()}
