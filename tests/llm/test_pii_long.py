"""Personal data: long texts in linear time, base spans equal to the plain patterns, and added spans against planted truth."""
import random
import re
import time

import pytest

from tidewater.llm import pii

_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def _quads(text):
    return [(m.start(), m.end()) for m in _IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]


def test_dotted_quads_equal_the_pattern():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("12250..  a-") for _ in range(rng.randint(0, 40)))
        assert pii.dotted_quads(text) == _quads(text)
    assert pii.dotted_quads("1.2.3.4.5.6.7.8.9") == [(0, 7), (8, 15)] and pii.dotted_quads("001.2.3.256 0001.2.3.4") == [(12, 22)]


def test_overlaps_by_search_equal_a_pass():
    rng = random.Random(6)
    for _ in range(500):
        spans = [(a, 0, a + rng.randint(1, 9)) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 9)))]
        taken = pii.Taken(spans)
        for a in range(70):
            c = (a, 1, a + rng.randint(1, 6))
            assert taken.apart(c) == all(c[2] <= x or c[0] >= y for x, _, y in spans)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.createDataFrame([(t,) for t in _planted(1)[0]], "text string"))


@pytest.mark.parametrize("text", ["1" * 1_000_000, "1." * 500_000, "1 " * 500_000, "+1(" * 300_000, "a" * 1_000_000 + "@", "a@" * 500_000,
                                  "call (030) 123 4567 now, " * 100_000, "card 4111 1111 1111 1112 x " * 40_000, "9" * 17 + " " + "4" * 500_000])
def test_long_texts_in_linear_time(model, text):
    t = time.process_time()
    base, every = model.spans(text)
    assert time.process_time() - t < 40 and set(base) <= set(every)
    assert pii.redacted(text, every) is not None


def _planted(seed, n=400):
    """Texts with spans that only the looser patterns see, true ones in their usual company and look-alikes in theirs."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    texts, truth = [], []

    def card(ok):
        while True:
            s = "4" + d(15)
            if pii.luhn(s) == ok:
                return s

    for _ in range(n):
        good = [("email", f"contact {rng.choice(['ana', 'bo'])}{d(2)} (at) mail{d(1)} (dot) com please", "contact ", " please"),
                ("phone", f"call (0{d(2)}) {d(3)} {d(4)} today", "call ", " today"),
                ("ip", f"server {rng.randint(1, 255)} . {rng.randint(0, 255)} . {rng.randint(0, 255)} . {rng.randint(0, 255)} up", "server ", " up")]
        c = card(True)
        good.append(("card", f"visa {c[:4]}/{c[4:8]}/{c[8:12]}/{c[12:]} paid", "visa ", " paid"))
        c = card(False)
        bad = [f"order 9{c[1:4]}/{c[4:8]}/{c[8:12]}/{c[12:]}", f"version 300 . {rng.randint(260, 999)} . 4 . 7", f"section 12 . 400 . {rng.randint(300, 999)} . 2",
               f"pages {d(2)}-{d(2)}-{d(2)}", f"chapter {d(3)}/{d(2)} {d(2)}"]
        kind, text, left, right = rng.choice(good)
        head, tail = f"some words {rng.choice(bad)} then ", f" and {rng.choice(bad)} end"
        texts.append(head + text + tail)
        truth.append((kind, len(head) + len(left), len(head) + len(text) - len(right)))
    return texts, truth


def test_added_spans_against_planted_truth(model):
    """Recall and precision of what the method adds, on texts that it was not fitted on."""
    texts, truth = _planted(2)
    hit, found = 0, 0
    for text, (kind, a, b) in zip(texts, truth, strict=True):
        base, every = model.spans(text)
        added = [(pii.KINDS[k], x, y) for x, k, y in every if (x, k, y) not in base]
        found += len(added)
        hit += any(k == kind and x < b and a < y for k, x, y in added)
    assert hit / len(truth) > 0.9 and hit / found > 0.85, (hit, found, len(truth))
