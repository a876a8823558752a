"""Operators that shuffle: mixing, substring dedup, chats, embeddings, Jaccard join, url filters, pipeline."""
import hashlib
import os
import re

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import ROWS
from tidewater.llm import _tiles, chat, forest, mixing, projections, substring, urlfilter
from tidewater.llm._components import components

SF = "/root/testdata/sf0.001"


def _same(df, sql):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    a, b = df.toPandas(), con.execute(sql).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = (x[cols].astype(str).sort_values(cols).reset_index(drop=True) for x in (a, b))
    assert a.equals(b)


@pytest.mark.parametrize("query, sql", [(mixing.op1_mix_sources, mixing.SQL), (substring.op4_substring_dedup, substring.SQL),
                                        (chat.op5_chat_format, chat.SQL), (urlfilter.op9_url_filter, urlfilter.SQL)])
def test_equals_sql(spark, query, sql):
    _same(query(spark, SF), sql)


def test_mixing_edges(spark, odd, none):
    got = mixing.mix_documents(odd, block_words=7).toPandas()
    assert len(got) == len(ROWS) and (got.taken <= 3 * got["size"]).all()
    for _, g in got.groupby(got.source.fillna("\U0010ffff")):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 0.5 and g.target.iloc[0] <= 3 * g.source_size.iloc[0]
    assert mixing.mix_documents(none).count() == 0


def test_schedule_is_low_discrepancy(spark):
    sizes = spark.createDataFrame([(i, "a" * i, f"{i}", 1000 * i, f"{i:03x}", f"{i:03x}") for i in range(1, 6)],
                                  "doc_id long, source string, skey string, size long, key string, bucket string")
    _, sources = mixing.placed(sizes, 10)
    slots = mixing.schedule_slots(sources).toPandas().sort_values("slot")
    assert (slots.groupby("s").cumcount() == slots["rank"]).all()
    share = slots.s.value_counts(normalize=True)
    for n in (100, 300, 700):
        assert (abs(slots.s.head(n).value_counts() - n * share) <= 12).all()


def _repeats(rows, window):
    first = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = {i + j for i in range(len(w) - window + 1) for j in range(window) if d is not None and first[tuple(w[i:i + window])] < d}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def test_substring_brute_force(spark, odd, none):
    def got(df):
        return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(df).collect()], key=str)

    assert got(odd) == _repeats([(r[0], r[1]) for r in ROWS], 13)
    assert got(none) == []
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 60)), " ".join(rng.choice(list("abc"), rng.integers(0, 60), p=[.9, .05, .05]))) for _ in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df.repartition(5)) == _repeats(rows, 13)


def test_chat_edges(spark):
    rows = [(1, 2, "assistant", "b<|im_end|>\n"), (1, 1, "user", None), (1, None, None, "s"), (None, 1, "assistant", "x"), (2, 1, "a\n\\<|r", "<\\|é😀"),
            (2, 1, "a\n\\<|r", "<\\|é😀"), (3, 1, "assistant", ""), *((4, i, "assistant", "long " * 5000) for i in range(80))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int")
    made = chat.format_chats(df)
    assert made.where("conv_id = 4").count() > 1  # a long conversation goes on in segments
    got = {r.conv_id: r for r in chat.chat_digests(made).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        text = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        x = got[conv]
        assert (x.n_turns, x.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (x.loss_chars, x.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in made.where("conv_id <> 4").collect():
        assert "".join(chat.unescape(r.formatted[a:a + n]) for a, n in zip(r.loss_start, r.loss_length, strict=True)) == \
            "".join(t for role, t in chat.read_back(r.formatted) if role == "assistant")
    assert chat.chat_digests(chat.format_chats(df.limit(0))).count() == 0


def test_components(spark):
    edges = [("a", "b"), ("c", "b"), ("d", "d"), ("x", "y"), ("a", "b"), *((f"n{i:03d}", f"n{i + 1:03d}") for i in range(60))]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got["b"] == got["c"] == "a" and got["y"] == "x" and "d" not in got and {got[f"n{i:03d}"] for i in range(1, 61)} == {"n000"}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_embedding_edges(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in base + 0.05 * rng.normal(size=16)], 1, i) for i in range(150)]  # more than a window
    rows += [(200, rows[0][1], 1, 0), (201, rows[0][1], 2, 0), (202, rows[0][1], None, 0), (203, [0.0] * 16, 1, 0), (204, None, 1, 0),
             (205, [float("nan")] * 16, 1, 0), (206, [None] * 16, 1, 0), (207, [float("inf")] + [0.0] * 15, 1, 0), (208, [1.0, 2.0], 1, 0),
             (None, rows[0][1], 1, 0), (209, [1e300] * 16, 3, 0), (209, [1e300] * 16, 3, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node int")
    got = projections.near_vectors(df, window=16).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    fine = [r for r in rows if r[0] is not None and r[0] <= 200]
    x = np.array([r[1] for r in fine])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert [by[r[0]].n_links for r in fine] == links.tolist() and {by[r[0]].component_id for r in fine} == {0}
    for i in (201, 202, 203, 204, 205, 206, 207, 208):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert by[209].n_links == 1
    assert projections.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["direction", "cluster"])
def test_embedding_uneven_label_brute_force(spark, shape):
    """Vectors that share a direction, or hold a dense topic below the threshold: hash bits agree far more often than for evenly spread ones."""
    rng = np.random.default_rng(3)
    n, d = 10_000, 32
    noise = rng.normal(size=(n, d)) / np.sqrt(d)
    share = np.where(np.arange(n) < (n if shape == "direction" else n // 2), np.sqrt(0.7 / 0.3), 0)
    x = noise + share[:, None] * np.eye(d)[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=(400, d))
    other -= (other * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    cos = 0.931
    x[1000:1400] = cos * x[:400] + np.sqrt(1 - cos * cos) * other / np.linalg.norm(other, axis=1, keepdims=True)  # pairs just linked
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    link = x @ x.T >= 0.93
    np.fill_diagonal(link, False)
    a, b = np.nonzero(link)
    first = _tiles.roots(n, a, b)
    got = {r.vec_id: (r.n_links, r.component_id) for r in projections.near_vectors(df).collect()}
    assert len(a) >= 800
    wrong = [i for i in range(n) if got[i] != (link[i].sum(), first[i])]
    assert len(wrong) <= 2, f"{len(wrong)} of {len(np.unique(a))} linked vectors"  # a lost pair is two vectors; 0.999 a pair at least


def test_jaccard_brute_force(spark, odd, none, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 400, 80)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(int(rng.integers(0, 3))):
            words[int(rng.integers(0, 80))] = f"z{rng.integers(0, 9)}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(_tiles, "SLOT_ROWS", 16)  # groups are dealt into several tiles
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(76)} for i, t in rows}
    got = {r.doc_id: r for r in forest.near_copies(df).collect()}
    near = {i: [j for j in sets if j != i and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8] for i in sets}
    assert sum(got[i].n_links for i in sets) >= 0.99 * sum(map(len, near.values()))
    assert all(got[i].n_links <= len(near[i]) for i in sets)
    out = forest.near_copies(odd).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(ROWS) and by[2].class_id == by[7].class_id == 1 and by[9].component_id == 8
    assert (by[1].n_links, by[4].n_links, by[None].n_links, by[None].kept) == (3, 0, 0, True)
    kept = forest.keep_first(odd)
    assert kept.schema == odd.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 10, 11, 12, 13, 14, 15]
    assert forest.near_copies(none).count() == 0 and forest.keep_first(none).count() == 0


def test_large_tiles_are_split(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k}" for k in range(200)) + f" end{i}") for i in range(40)]
    monkeypatch.setattr(forest, "SLOT_SHINGLES", 1000)
    got = forest.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(39, 0)}


def test_url_aliases(spark):
    pages = [(1, "http://a.com/x", '<link rel="canonical" href="http://q.example.net/fr/1">'), (2, "http://b.com/y?z", "<META content='0; URL=/w' http-equiv=refresh>"),
             (3, "https://B.com/w", "<link href='//a.com/x' rel=canonical>"), (4, None, None), (5, "nope", "x"), (7, "http://d.org/1", '<link rel="canonical" href="http://c.org/fr/1">'),
             (6, "http://c.org/fr/1", '<link rel="canonical" href="http://t.net/fr/1">'), (8, "http://net", ""), (8, "http://net", ""), (9, "http://x.net/#", None)]
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in urlfilter.judge_urls(spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, rule int")).collect()}
    assert got[1] == ("a.com", None, "block") and got[2] == ("b.com", None, "block") and got[3][2] == "block"
    assert got[4] == ("", None, "allow") and got[5] == ("", None, "allow") and got[6] == ("c.org", "org/fr/", "allow")
    assert got[7][2] == "allow" and got[8] == ("net", None, "allow") and got[9] == ("x.net", "net/", "block")
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_url_aliases_in_long_tags(spark):
    much = "x" * 5000
    rows = [(1, "http://a.com/1", f'<link data-a="{much}" rel="canonical" href="http://b.net/1">'), (2, "http://a.com/2", f'<link rel="canonical" href="http://b.net/2?{much}">'),
            (3, "http://a.com/3", f'<meta http-equiv="refresh" data-a="{much}" content="0; url=http://b.net/3">'), (4, "http://a.com/4", f'<link rel="canonical" href="http://b.net/4{much}')]
    got = {r.page_id: r.verdict for r in urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    out = corpus_pipeline.run(spark, SF).toPandas()
    bench = [t for t in spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text]
    text = dict(zip(docs.doc_id, docs.text, strict=True))
    sets = {i: frozenset(tuple(t.split()[k:k + 5]) for k in range(max(1, len(t.split()) - 4))) for i, t in text.items()}
    first = {}
    for i in sorted(sets):  # smallest id of each group of near copies
        near = [j for j in first if sets[i] & sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
        first[i] = min((first[j] for j in near), default=i)
    flat = {i: " ".join(t.split()) for i, t in text.items()}
    want = {i for i in text if first[i] == i and not any(" ".join(b.split()) in flat[i] for b in bench)}
    assert set(out.doc_id) == want and (out.taken <= 3 * out["size"]).all()
