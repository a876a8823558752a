"""Operators that map over documents: tokens, language, tiling, personal data."""
import re
import time
import unicodedata

import numpy as np
import pytest

from tests.llm.conftest import BASE, ROWS
from tidewater.llm import langid, pii, tiling, tokens
from tidewater.llm._text import WordHashes

P = pytest.importorskip("public_tokenizers")
VOCABULARY = P.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counter():
    return tokens.PrefixCounter(VOCABULARY)


def test_tokens_equal_the_library(spark, odd, none, counter):
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, VOCABULARY).collect()}
    for r in docs.collect():
        want = len(counter.library.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id, len((r.text or "").encode())] == (want, want > 2048)
    assert tokens.count_tokens(none, VOCABULARY).count() == 0


@pytest.mark.parametrize("text", ["don't we'LL 's !'s x're", "<|endoftext|>a<|startoftext|> <|end", "İSTANBUL Σίσυφος ﬁn ﬃ", "é 가 각 Å",
                                  "a\x85b\x1cc\xa0d", "²½ ªº 123", "日本語 😀👍🏽", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"])
def test_prefix_table_at_every_prefix(counter, text):
    def library(s):
        return len(counter.library.encode(s, add_special_tokens=False).ids)

    assert counter.total(text) == library(text)
    if not counter.odd.search(text) and not counter.special.search(text) and "'" not in text:
        every = [library(text[:k]) for k in range(len(text) + 1)]
        for limit in range(every[-1] + 1):
            assert counter.cut(text, limit) == max(k for k, n in enumerate(every) if n <= limit)


def test_prefix_counts_of_words(counter):
    for word in ("internationalization", "thonstly", "über", "..."):
        want = [len(counter.library.encode(word[:k], add_special_tokens=False).ids) for k in range(1, len(word) + 1)]
        assert counter.prefix_counts(word) == want


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert len(out) > 100 and (out.lang == out.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_edges(spark, odd, none):
    filters = langid.fit(odd)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, filters).collect()}
    for i in (4, 5, 6, 13, 15):
        assert got[i] == ("und", 0.0)
    assert got[8][0] in ("en", "de") and langid.identify(odd, filters).count() == len(ROWS)
    assert langid.identify(none, langid.fit(none)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(none)).collect()} == {"und"}
    kept = langid.keep_known(odd, filters, 0.3)
    assert kept.schema == odd.schema and {4, 5, 6, 13, 15}.isdisjoint(r.doc_id for r in kept.collect())


def test_bloom_masks_hold_every_learnt_gram():
    text = [b"hello world again"]
    h, doc = langid.grams(text)
    assert len(h) == len(doc) > 0 and not doc.any()
    cells = np.zeros((2, 1 << langid.CELL_BITS), np.uint64)
    for k in range(langid.PROBES):
        cells[1][((h >> np.uint64(21 * k)) & np.uint64((1 << langid.CELL_BITS) - 1))] |= np.uint64(1 << 3)
    f = langid.Filters([f"l{i:02d}" for i in range(70)], cells, np.full(70, 1e-6))
    assert f.predict([*text, b"zzz qqq", b""]) [0] == ["l67", "l00", "und"]


def test_tiling_finds_reordered_passages(spark):
    item = " ".join(f"w{i}" for i in range(40))
    words = item.split()
    moved = " ".join(["intro"] * 9 + words[20:40] + ["middle", "bit"] + words[:20] + ["end"])
    half = " ".join(words[:20])
    docs = spark.createDataFrame([(1, moved), (2, half), (3, item.upper().replace(" ", ", ")), (4, None), (5, "w1 w2 w3")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, ", ."), (9, None), (None, item)], "item_id long, text string")
    got = {r.doc_id: r for r in tiling.decontaminate(docs, bench).collect()}
    assert (got[1].contaminated, got[1].coverage, got[1].n_tiles, got[1].item_ids) == (True, 1.0, 2, [7])
    assert (got[2].contaminated, got[2].coverage) == (False, 0.5) and got[3].contaminated
    assert not got[4].contaminated and got[5].item_id is None
    sliced = {r.doc_id: (r.contaminated, r.coverage) for r in tiling.decontaminate(docs, bench, slice_words=10).collect()}
    assert sliced == {k: (r.contaminated, r.coverage) for k, r in got.items()}
    assert [r.doc_id for r in tiling.keep_clean(docs, bench).collect()] == [2, 4, 5]


def test_tiling_slices_change_no_row(spark, odd):
    """Repeated and null ids, several texts of one id and equal coverage: the same rows in one slice and in several."""
    more = spark.createDataFrame([(None, "clean words that no item has at all"), (2, "another text of the second id"), (7, None)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    bench = spark.createDataFrame([(9, BASE), (3, BASE + "."), (4, BASE.upper()), (5, BASE + "!"), (2, "word " * 60), (2, BASE + "?")], "item_id long, text string")

    def rows(n):
        return sorted(map(repr, tiling.decontaminate(docs, bench, slice_words=n).collect()))

    assert len(list(tiling._slices(bench, 10))) > 1
    assert len(rows(10)) == docs.count() and rows(10) == rows(tiling.SLICE_WORDS)


def test_tiling_matches_short_items_whole(spark):
    docs = spark.createDataFrame([(1, "so it is: Four score, and seven!"), (2, "four score and six"), (3, "score and seven four")], "doc_id long, text string")
    bench = spark.createDataFrame([("b", "four score and seven"), ("a", "")], "item_id string, text string")
    got = {r.doc_id: (r.contaminated, r.item_id, r.coverage, r.n_tiles) for r in tiling.decontaminate(docs, bench).collect()}
    assert got == {1: (True, "b", 1.0, 1), 2: (False, None, 0.0, 0), 3: (False, None, 0.0, 0)}


def _plain_tiles(t, i, least):
    """Greedy string tiling by its definition: all pairs of places, again and again."""
    free, out = [[True] * len(t), [True] * len(i)], []
    while True:
        best = (0, 0, 0)
        for a in range(len(t)):
            for b in range(len(i)):
                n = 0
                while a + n < len(t) and b + n < len(i) and t[a + n] == i[b + n] and free[0][a + n] and free[1][b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return out
        out.append((a, b, n))
        free[0][a:a + n], free[1][b:b + n] = [False] * n, [False] * n


@pytest.mark.parametrize("letters", [1, 2, 3, 7])
def test_tiles_equal_plain_greedy_tiling(letters):
    rng = np.random.default_rng(letters)
    for _ in range(60):
        least = int(rng.integers(1, 6))
        t, i = (rng.integers(1, letters + 1, rng.integers(least, n)).astype(np.uint64) * np.uint64(0xA24BAED4963EE407) for n in (40, 20))
        seeds = [np.lib.stride_tricks.sliding_window_view(x, least).tolist() for x in (t, i)]
        at = [np.array([k for k, x in enumerate(mine) if x in other], np.int64) for mine, other in (seeds, seeds[::-1])]
        assert tiling.tile(t, i, *at, least) == _plain_tiles(t.tolist(), i.tolist(), least)


def test_decontaminate_equals_plain_version(spark):
    """Coverage, item, tiles and items of every document, against all pairs of documents and items, in one slice and in many."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 4, rng.integers(0, 40))) for _ in range(60)]
    items = [(f"i{k % 20}", " ".join(f"w{x}" for x in rng.integers(0, 4, rng.integers(3, 30)))) for k in range(25)]
    items += [("copy", texts[5]), ("copied", texts[5]), ("parts", " ".join(texts[7].split()[::-1] + texts[8].split()))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = {}
    for d, text in enumerate(texts):
        best, hits = (0.0, None, 0), []
        for name, item in set(items):
            t, i = text.split(), item.split()
            tiles = _plain_tiles(t, i, min(5, len(i))) if i else []
            covered = sum(x[2] for x in tiles) / len(i) if i else 0.0
            if tiles and (best[1] is None or (-covered, name, len(tiles)) < (-best[0], best[1], best[2])):
                best = (covered, name, len(tiles))
            if covered >= tiling.THRESHOLD:
                hits.append(name)
        want[d] = (bool(hits), best[1], best[0], best[2], sorted(hits))
    assert min(sum(x[0] for x in want.values()), sum(not x[0] for x in want.values())) > 4
    for slice_words in (tiling.SLICE_WORDS, 60):
        got = tiling.decontaminate(docs, bench, slice_words).collect()
        assert {r.doc_id: (r.contaminated, r.item_id, r.coverage, r.n_tiles, r.item_ids) for r in got} == want
        assert {r.doc_id for r in tiling.keep_clean(docs, bench, slice_words).collect()} == {d for d, x in want.items() if not x[0]}
    assert len(list(tiling._slices(bench, 60))) > 2


def test_tiling_long_repetitive_text():
    """Text and item of one word, and of two: no pair of equal seeds is built."""
    two = np.random.default_rng(1).integers(0, 2, 200_000)
    for text, item in ((b"a " * 500_000, b"a " * 1000), (b" ".join([b"a", b"b"][x] for x in two), b" ".join([b"a", b"b"][x] for x in two[::-1][:1000]))):
        start = time.time()
        _, covered, _, hits = tiling._cover(tiling.Seeds([1], [item]), [text], WordHashes())[0]
        assert covered > 0.9 and hits == [0] and time.time() - start < 20


def test_tiling_edges(spark, odd, none):
    bench = spark.createDataFrame([(1, BASE), (2, "word " * 60)], "item_id long, text string")
    got = tiling.decontaminate(odd, bench).collect()
    assert len(got) == len(ROWS) and {1, 2, 7, 10} <= {r.doc_id for r in got if r.contaminated}
    assert tiling.decontaminate(none, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in tiling.decontaminate(odd, empty).collect())
    assert tiling.keep_clean(odd, bench).schema == odd.schema


def _base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (kind == 3 or pii.luhn(d)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans():
    rng = np.random.default_rng(5)
    letters = list("ab@.+-_ 0123456789()1234567890@..") + ["١", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(letters, rng.integers(0, 60)))
        assert pii.base_spans(text) == _base(text)
    assert pii.base_spans("1" * 100_000 + " a" * 1000 + "@") == []


def test_personal_data(spark, odd, none):
    docs = spark.createDataFrame([(1, "mail a.b@x.com now +1 (269) 555-3296 4111111111111111 and 10.0.0.1"), (2, None), (3, "version 1.2.3.4"),
                                  (3, "version 1.2.3.4"), (4, "")], "doc_id long, text string")
    model = pii.fit(docs.unionByName(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")))
    got = {r.doc_id: r for r in pii.find(docs, model).collect()}
    text = docs.first().text
    assert got[1].base == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in _base(text))
    assert set(got[1].base.split(",")) < set(got[1].spans.split(","))  # phone and card that the base patterns run together
    assert got[2].spans == got[4].spans == ""
    clean = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert clean[1] == "mail [EMAIL] now [PHONE] [CARD] and [IP]" and clean[2] is None
    assert pii.find(none, pii.fit(none)).count() == 0 and pii.find(odd, model).count() == len(ROWS)
    again = pii.redact(odd, model)
    assert again.schema == odd.schema and again.count() == len(ROWS)


def test_rejected_candidates_hide_none(spark):
    """A phone-shaped run, or a run of fours, in front of a card; patterns that fitting did not meet are scored."""
    seen = ["tel 030 1234 5678 90 or 0301 234 567", "card 4111-1111-1111-1111 and 4111 1111 1111 1111", "pay 5500 0000 0000 0004 now",
            "order 1234_5678_9012_3456 and 1234_5678_9012_3457", "order id 99 1111 2222 3333 4444 x"] * 20
    model = pii.fit(spark.createDataFrame([(t,) for t in seen], "text string"))
    for text in ("see 123 4111 1111 1111 1111 there", "see 1234 4111 1111 1111 1111 there", "visa 123 4111 1111 1111 1111 there"):
        at = text.index("4111")
        assert (at, 2, at + 19) in model.spans(text)[1], text
    unseen = "amex card 4111.1111.1111.1111"
    assert (10, 2, 29) in model.spans(unseen)[1]


def test_em_separates_two_classes():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.4
    v = np.where(rng.random((4000, 5)) < 0.85, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    p, table = pii.expectation_maximisation(v, np.ones(len(v)))
    assert ((p > 0.5) == truth).mean() > 0.95 and abs(table[1, :, 2].mean() - 0.85) < 0.03


def test_letters_are_unicode_letters():
    assert langid._letters()[ord("ß")] and not langid._letters()[ord("1")] and unicodedata.category("ß") == "Ll"
