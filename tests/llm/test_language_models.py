"""Collocations, ranked lexical search and language-model scores against SQL and plain versions."""
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import BASE, ROWS
from tests.llm.test_joins import SF, _same
from tidewater.llm import collocations, signatures, suffixtree


# ---- 11: collocations
@pytest.mark.parametrize("head", [3, collocations.HEAD])
def test_collocations_equal_sql(spark, head):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _same(collocations.collocations(docs, head=head), collocations.SQL)


def _phrases(rows, least, first):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        c = {g: a for g, a in c.items() if a >= least}
        inner = defaultdict(int)
        for g, a in c.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inner[g[i:i + k]] = max(inner[g[i:i + k]], a)
        rows = []
        for g, a in c.items():
            if len(g) > 1 and not (g in inner and 100 * inner[g] >= 80 * a):
                score, _, l, r = min((2_000_000 * a // (c[g[:k]] + c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))  # noqa: E741
                rows.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first])]
    return sorted(out)


@pytest.mark.parametrize("head", [2, 1000])
def test_collocations_edges(spark, odd, none, head):
    more = spark.createDataFrame([(t, "en") for t in ["A b, a B c. a b\tc", "b b b b b b", "...", "x\x0by z\x00 q", "a b c d e f g"] * 3]
                                 + [("a b c d", None), ("a b c d", "und")], "text string, lang string")
    docs = odd.select("text", "lang").unionByName(more)
    rows = [(r.lang, r.text) for r in docs.collect()]
    for least, first in ((1, 5), (2, 2000), (3, 4)):
        got = collocations.collocations(docs, least=least, first=first, head=head)
        assert sorted(tuple(r) for r in got.collect()) == _phrases(rows, least, first)
    assert collocations.collocations(none).count() == 0


def test_tiles_count_every_pair():
    rng = np.random.default_rng(3)
    a, b = (np.minimum(rng.zipf(1.3, 20_000), 300).astype(np.int64) for _ in range(2))
    want = Counter(zip(a.tolist(), b.tolist(), strict=True))
    for tile, dense in ((16, 1), (16, 200), (64, 10 ** 9)):
        x, y, n = collocations.tiled_counts(a, b, tile, dense)
        assert len(x) == len(want) and dict(zip(zip(x.tolist(), y.tolist(), strict=True), n.tolist(), strict=True)) == want


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([("en", b"a b", 9 * 10 ** 12, [9 * 10 ** 12 + 7], [10 ** 13])], "lang string, phrase binary, a long, heads array<long>, tails array<long>")
    r = collocations._scored(big, 2, None).first()
    assert r.score == 2_000_000 * r.a // (r.l + r.r)


# ---- 12: ranked lexical search
def _ranked(docs, items, first=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, c, sum(c.values())) for d, c in bags if c]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, c, _ in bags for w in c)
    out = []
    for item, text in set(items):
        rows = []
        for d, c, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in terms(text) if c[w])
            if s > 0:
                rows.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows)[:first])]
    return sorted(out, key=str)


def test_search_equals_sql(spark):
    _same(signatures.op12_lexical_search(spark, SF), signatures.SQL)


def test_search_edges(spark, odd, none):
    items = spark.createDataFrame([(1, BASE), (1, BASE), (2, "word two"), (3, None), (4, ""), (5, "zzz"), (None, "日本語 one"), (6, "a A ,lazy lazy")],
                                  "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    want = _ranked(docs, [(r.item_id, r.text) for r in items.collect()])
    for block in (3, signatures.BLOCK_TERMS):
        got = [tuple(r) for r in signatures.search(odd, items, block_terms=block).collect()]
        assert sorted(got, key=str) == want
    assert signatures.search(none, items).count() == 0 and signatures.search(odd, items.limit(0)).count() == 0


def test_bounds_are_never_below_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toArrow()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    index = list(signatures._index(docs.to_batches()))
    block = signatures.Block([signatures.terms(r.text.encode()) for r in items])
    n = [x for b in index for x in b.column("n")[0].as_py() if x]
    df = Counter(w for b in index for t in b.column("texts")[0].as_py() for w in set(signatures.terms(t)))
    block.weigh(len(n), sum(n), {i: df[w] for i, w in enumerate(block.words)})
    tight = 0
    for b in index:
        rows, raw, _, n, most, texts = (b.column(c)[0] for c in ("rows", "slices", "doc_ids", "n", "most", "texts"))
        n, most = n.values.to_numpy(), most.values.to_numpy()
        slices = np.frombuffer(raw.as_buffer(), np.uint8).reshape(rows.as_py(), -1)
        bags = [dict(Counter(signatures.terms(t))) for t in texts.as_py()]
        for item, bound in enumerate(block.bounds(slices, n, most)):
            exact = [block.score(item, c, int(k)) for c, k in zip(bags, n, strict=True)]
            assert (bound >= exact).all()
            tight += (bound <= 2 * np.array(exact) + 1).sum()
    assert tight > 1000


def test_search_rescores_few(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    tally = spark.sparkContext.accumulator(0)
    signatures.search(docs, items, tally=tally).count()
    assert 400 <= tally.value < 0.3 * docs.count() * items.count()


# ---- 13: suffix tree
def _scores(docs, context, least, gain):
    """Plain version: contexts as tuples, distributions as dictionaries."""
    end = None
    texts = [(d, d is not None and crc32(str(d).encode()) % 5 == 1, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [end])
             for d, t in docs]
    train = [w for _, h, w in texts if not h]
    c = {k: Counter(tuple(w[i:i + k]) for w in train for i in range(len(w) - k + 1)) for k in range(1, context + 2)}
    total, vocabulary = sum(c[1].values()), len(c[1])

    def base(w):
        return (c[1][(w,)] + 0.5) / (total + 0.5 * (vocabulary + 1))

    nodes = defaultdict(dict)
    for k in range(2, context + 2):
        for g, n in c[k].items():
            if n >= least:
                nodes[g[:-1]][g[-1]] = n

    def prob(ctx, w, kept=None):
        if not ctx:
            return base(w)
        if kept is not None and ctx not in kept:
            return prob(ctx[1:], w, kept)
        own, of = nodes.get(ctx, {}), c[len(ctx)][ctx]
        below = prob(ctx[1:], w, kept)
        if not own:
            return below
        return max(own.get(w, suffixtree.DISCOUNT) - suffixtree.DISCOUNT, 0) / of + (1 - sum(n - suffixtree.DISCOUNT for n in own.values()) / of) * below

    kept = set()
    for ctx, own in nodes.items():
        of = c[len(ctx)][ctx]
        above = {w: prob(ctx[1:], w) for w in own}
        rest = of - sum(own.values())
        g = sum(n * math.log(n / of / above[w]) for w, n in own.items())
        if rest:
            g += rest * math.log(rest / of / max(1 - sum(above.values()), 1e-12))
        if g >= gain * len(own):
            kept |= {ctx[i:] for i in range(len(ctx))}
    out = []
    for d, h, w in texts:
        score = 0.0
        for i, x in enumerate(w):
            ctx = ()
            for j in range(1, min(context, i) + 1):
                if tuple(w[i - j:i]) not in kept:
                    break
                ctx = tuple(w[i - j:i])
            score += math.log10(prob(ctx, x, kept))
        out.append((d, h, len(w), sum(c[1][(x,)] > 0 for x in w), total, sum(math.log10(base(x)) for x in w), score))
    return out, kept, prob, [x for (x,) in c[1]]


def _close(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


@pytest.mark.parametrize("context, least, gain", [(3, 3, 3.0), (2, 2, 0.5), (1, 2, 8.0)])
def test_suffix_tree_equals_plain_version(spark, context, least, gain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, kept, prob, words = _scores(rows, context, least, gain)
    assert len({len(k) for k in kept}) == context
    for ctx in sorted(kept, key=str)[:25]:  # each distribution sums to one over all tokens and the unknown one
        assert sum(prob(ctx, w, kept) for w in [*words, "\0unknown"]) == pytest.approx(1)
    _close(suffixtree.score_texts(docs, context, least, gain).collect(), want)


def test_suffix_tree_edges(spark, odd, none):
    want = _scores([(r.doc_id, r.text) for r in odd.collect()], 3, 3, 3.0)[0]
    _close(suffixtree.score_texts(odd).collect(), want)
    _close(suffixtree.score_texts(odd, cell=2).collect(), want)  # as many cells as a large corpus has
    assert suffixtree.score_texts(none).count() == 0
    lone = spark.createDataFrame([(i, "a b") for i in range(30) if crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, r.score) for r in suffixtree.score_texts(lone).collect()} == {(0, 0, 0.0)}


def test_suffix_tree_beats_the_base_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = suffixtree.score_texts(docs).toPandas()
    out = got[got.held_out]
    assert len(got) == docs.count() and len(out) > 100
    assert out.score.sum() > out.base_score.sum() * 0.98 and (out.score >= out.base_score).mean() > 0.8
    assert len(ROWS) > 10
