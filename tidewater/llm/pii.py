"""Personal data by weak supervision.

Candidate spans of four kinds come from the base patterns (a fixed contract) and
from looser ones: spelled-out e-mail addresses, digit groups shaped like phone
numbers, with or without a plus, and card numbers in one piece or in fours, also where
they run on into other digits so that the base pattern drops the whole match, and
spaced dotted quads. Labelers vote on every candidate, for, against or abstaining:
regex labelers on its shape, gazetteers of top-level domains and dialling codes,
a checksum, and context labelers on the words before it. Expectation-maximisation over
the counts of vote patterns estimates, for each kind, how often each labeler votes
each way on true and on false spans; the posteriors are soft labels for a logistic
span classifier over the votes and the span's form. Base spans always stay; a
looser candidate is added if the classifier gives it at least ``LEAST_P``, whether its pattern was
seen while fitting or not. Of accepted candidates that overlap the most probable stays, and a rejected one hides none.

Counts of (kind, votes, form) cover all documents: each task adds up its own,
Spark sums them, and the patterns, a few thousand at most by construction,
train the model on the driver. Finding spans is a map over the documents; nothing
is shuffled but those counts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._text import text_chunks

KINDS = ("email", "ip", "card", "phone")
LEAST_P = 0.5
EM_ROUNDS = 50

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")

_SPELLED = re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
                      r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63})+")
_SPELLED_HINT = re.compile(r"\(dot\)|\[dot\]| dot ")
_LOOSE_PHONE = re.compile(r"(?<![\w+.-])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\) ?)?|\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])"
                          r"[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![\w-])")
_LOOSE_CARD = re.compile(r"(?<![\w.])(?:[0-9]{13,19}|[0-9]{4}(?P<by>[ ._/-]|  )[0-9]{4}(?P=by)[0-9]{4}(?P=by)[0-9]{1,7})(?!\w)")
_LOOSE_IP = re.compile(r"(?<![\w.])[0-9]{1,3} ?\. ?[0-9]{1,3} ?\. ?[0-9]{1,3} ?\. ?[0-9]{1,3}(?![\w.])")

_LOOSE = ((0, _SPELLED, _SPELLED_HINT), (1, _LOOSE_IP, _DIGIT), (2, _LOOSE_CARD, _DIGIT), (3, _LOOSE_PHONE, _DIGIT))

#: Gazetteers and context words: fixed values.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch at be se no dk pl".split())
DIALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 62 63 64 65 66 81 82 84 86 90 91".split())
CUES = {
    "email": frozenset("email e-mail mail contact write address mailto reach correo courriel".split()),
    "ip": frozenset("ip address host server from client addr dirección adresse".split()),
    "card": frozenset("card visa mastercard amex credit debit payment pay tarjeta carte karte".split()),
    "phone": frozenset("phone tel telephone call fax mobile cell contact number teléfono téléphone telefon".split()),
}
COUNTER_CUES = frozenset("version v isbn issn page pages section chapter order id license licence release build step figure by-nc by-sa by".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern; from each ``@``, so long words cost no more than their length."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def dotted_quads(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of four numbers with dots between: a whole run of dotted numbers is taken at once and cut into fours,
    so no digit is looked at twice, however long the run."""
    out = []
    for m in _DOTTED.finditer(text):
        if "." in m[0]:
            parts, at = m[0].split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                end = at + sum(map(len, parts[k:k + 4])) + 3
                if all(map(_small, parts[k:k + 4])):
                    out.append((at, end))
                at = end + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(a, 1, b) for a, b in dotted_quads(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = _digits(m[0])
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


class Taken:
    """Spans in order of their start; whether another one overlaps any is a search, not a pass."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _, _ in spans]
        self.ends = list(accumulate((b for _, _, b in spans), max))  # the largest end so far

    def apart(self, c: tuple[int, int, int]) -> bool:
        k = bisect_left(self.starts, c[2])
        return not k or self.ends[k - 1] <= c[0]


def loose_spans(text: str, taken: list[tuple[int, int, int]], keep=lambda c: True) -> list[tuple[int, int, int]]:
    """Further candidates of each kind that overlap no ``taken`` span; those of unlike kinds may overlap each other.

    A card that is not kept is followed by the next match that starts behind its first character: the checksum tells them
    apart. The rest of a rejected phone number or address is none.
    """
    out, taken = [], Taken(taken)
    for kind, pattern, hint in _LOOSE:
        m = pattern.search(text) if hint.search(text) else None
        while m:
            c = (m.start(), kind, m.end())
            kept = taken.apart(c) and keep(c)
            if kept:
                out.append(c)
            m = pattern.search(text, c[0] + 1 if kind == 2 and not kept else c[2])
    return sorted(out)


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """One vote (-1, 0, 1) by each labeler: shape, gazetteer, checksum, repeated digits, cue before, counter-cue before, edges."""
    span, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - 60):start].lower().split()[-3:]
    words = {w.strip(".,;:()[]\"'=") for w in before}
    name = KINDS[kind]
    if kind == 0:
        shape = 1 if "@" in span else 0
        last = re.split(r"[.\s)\]]", span)[-1].lower()
        gazetteer, check = (1 if last in TOP_LEVEL else -1), 0
    elif kind == 1:
        parts = re.split(r" ?\. ?", span)
        shape, check = (1 if " " not in span else -1), (1 if all(map(_small, parts)) else -1)
        gazetteer = 1 if parts[0] in ("10", "127", "172", "192") else 0
    elif kind == 2:
        shape, check = (1 if 13 <= len(digits) <= 19 else -1), (1 if luhn(digits) else -1)
        gazetteer = 1 if digits[0] in "3456" else -1
    else:
        shape = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = (1 if any(digits.startswith(c) for c in DIALLING) else -1) if span[0] == "+" else 0
        check = 1 if "(" in span or span[0] == "+" else 0
    repeated = -1 if len(digits) >= 6 and len(set(digits)) <= 2 else 0
    cue = 1 if words & CUES[name] else 0
    counter = -1 if words & COUNTER_CUES else 0
    edge_l, edge_r = text[start - 1:start], text[end:end + 1]
    edges = -1 if edge_l.isalnum() or edge_r.isalnum() or edge_l in "/=#" and edge_l else 1
    return (shape, gazetteer, check, repeated, cue, counter, edges)


def _form(base: bool, text: str, start: int, end: int) -> tuple[int, ...]:
    span = text[start:end]
    return (int(base), min(3, (end - start) // 8), int(" " in span), int("-" in span or "." in span))


@dataclass
class SpanModel:
    """Labelers' reliabilities by kind and classifier weights by kind; a kind that fitting met no candidate of has none."""

    reliability: dict
    weights: dict
    scores: dict = field(default_factory=dict, repr=False, compare=False)

    def probability(self, text: str, c: tuple[int, int, int]) -> float:
        """The classifier's probability of a looser candidate."""
        start, kind, end = c
        if KINDS[kind] not in self.weights:
            return 0.0
        pattern = (kind, *votes(text, *c), *_form(False, text, start, end))
        if pattern not in self.scores:
            v, form = np.array([pattern[1:1 + _N_VOTES]]), np.array([pattern[1 + _N_VOTES:]])
            self.scores[pattern] = float(_classified(np.c_[_one_hot(v), form[:, 1:]], self.weights[KINDS[kind]])[0])
        return self.scores[pattern]

    def spans(self, text: str) -> tuple[list, list]:
        """Base spans, and all spans: base and accepted ones in order."""
        base, added, lost = base_spans(text), [], True
        while lost:  # one that lost to a more probable one may have hidden others of its kind
            p: dict = {}

            def keep(c, p=p):
                p[c] = self.probability(text, c)
                return p[c] >= LEAST_P

            lost, starts, ends = False, [], []  # of the spans added in this round, which do not overlap
            for c in sorted(loose_spans(text, [*base, *added], keep), key=lambda c: (-p[c], c[0], -c[2], c[1])):
                k = bisect_left(starts, c[2])
                if not k or ends[k - 1] <= c[0]:
                    starts.insert(k, c[0])
                    ends.insert(k, c[2])
                    added.append(c)
                else:
                    lost = True
        return base, sorted([*base, *added])


def _one_hot(v: np.ndarray) -> np.ndarray:
    """Votes -1, 0, 1 as three columns each."""
    return np.concatenate([(v == k).astype(float) for k in (-1, 0, 1)], axis=1)


def expectation_maximisation(v: np.ndarray, n: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of patterns ``v`` seen ``n`` times, and P(vote | class) by labeler; starts from the vote's majority."""
    p = 1 / (1 + np.exp(-1.5 * v.sum(axis=1)))
    table = np.zeros((2, v.shape[1], 3))
    for _ in range(rounds):
        for c, w in enumerate((n * (1 - p), n * p)):
            for k in (-1, 0, 1):
                table[c, :, k + 1] = ((v == k) * w[:, None]).sum(axis=0) + 0.5
            table[c] /= table[c].sum(axis=1, keepdims=True)
        prior = np.clip((n * p).sum() / n.sum(), 0.01, 0.99)
        logit = np.log(prior / (1 - prior))
        for j in range(v.shape[1]):
            logit = logit + np.log(table[1, j, v[:, j] + 1] / table[0, j, v[:, j] + 1])
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p, table


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic classifier on soft labels, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - p)) - ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _classified(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), x] @ w, -30, 30)))


_N_VOTES, _N_FORM = 7, 4


def _patterns(batches):
    for batch in batches:
        counts: Counter = Counter()
        for _, texts in text_chunks(batch):
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                base = base_spans(text)
                for c in base:
                    counts[(c[1], *votes(text, *c), *_form(True, text, c[0], c[2]))] += 1
                for c in loose_spans(text, base):
                    counts[(c[1], *votes(text, *c), *_form(False, text, c[0], c[2]))] += 1
        keys = [",".join(map(str, k)) for k in counts]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])


def fit(docs: DataFrame) -> SpanModel:
    """Labeler reliabilities and the span classifier from all candidates of ``docs(text)``."""
    rows = (docs.select("text").mapInArrow(_patterns, "pattern string, n long")
            .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect())
    every = np.array([[int(x) for x in r["pattern"].split(",")] for r in rows], int).reshape(-1, 1 + _N_VOTES + _N_FORM)
    count = np.array([r["n"] for r in rows], float)
    reliability, weights = {}, {}
    for kind, name in enumerate(KINDS):
        mine = every[:, 0] == kind
        if not mine.any():
            continue
        v, form, n = every[mine, 1:1 + _N_VOTES], every[mine, 1 + _N_VOTES:], count[mine]
        p, reliability[name] = expectation_maximisation(v, n)
        p = np.where(form[:, 0] == 1, np.maximum(p, 0.9), p)  # base spans are personal data by contract
        x = np.c_[_one_hot(v), form[:, 1:]]
        weights[name] = _logistic(x, p, n)
    return SpanModel(reliability, weights)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs(doc_id, text)`` to doc_id, n_email, n_ip, n_card, n_phone, base and spans, a row for each.

    ``base`` has the base spans and ``spans`` all of them, as ``kind:start:end`` by
    start, then kind (code points, end exclusive). A null text counts as empty.
    Repeated rows have a row each; an empty table gives no rows. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part, texts in text_chunks(batch):
                base, every, n = [], [], []
                for raw in texts:
                    b, e = model.spans(raw.decode("utf-8", "replace"))
                    base.append(_joined(b))
                    every.append(_joined(e))
                    n.append([sum(s[1] == k for s in b) for k in range(4)])
                counts = np.array(n, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(counts[:, k]) for k in range(4)), pa.array(base, pa.string()), pa.array(every, pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string")


def redacted(text: str, spans: list) -> str:
    """The text with each span as its kind in brackets; of overlapping spans the first one's kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """The documents, all columns, without their personal data; ``n_chars``, if there, follows the text."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            for part, texts in text_chunks(batch):
                new = []
                for raw, old in zip(texts, part.column("text").is_null().to_pylist(), strict=True):
                    text = raw.decode("utf-8", "replace")
                    spans = model.spans(text)[1]
                    new.append(None if old else redacted(text, spans) if spans else text)
                cols = dict(zip(names, part.columns, strict=True))
                cols["text"] = pa.array(new, part.schema.field("text").type)
                if "n_chars" in cols:
                    had = part.column("n_chars").to_pylist()
                    cols["n_chars"] = pa.array([h if t is None or h is None else len(t) for h, t in zip(had, new, strict=True)],
                                               part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)

    return docs.mapInArrow(run, docs.schema)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find(docs, fit(docs)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
