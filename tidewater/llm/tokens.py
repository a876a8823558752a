"""Token counts by a dynamic programme over the prefixes of a text.

The vocabulary is BPE over words: the text is cut into words, each word into
merged pieces, the last of which carries the end-of-word mark. For each prefix
of a word the programme keeps the last piece of the prefix's encoding and the
number of pieces. A piece that ends at the prefix is its last one if it fits
the last piece of the prefix before it, that is, if merging the two together
would keep them apart; whether two pieces fit is decided by undoing their
merges from the boundary (:meth:`Pieces.fits`). Two tables are kept: open
prefixes (the word goes on) and closed ones (the text ends here), so the count
is exact at every prefix of the text, and truncation and budget questions are
looked up, not encoded again.

Texts of Latin letters, digits and signs are cut by one regular expression
built from the same classes as the tokenizer's; a text with any other
character is cut by the library's own normalizer and pre-tokenizer. Work is
by document within Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._text import text_chunks

LIMIT_TOKENS = 2048
#: Words whose counts a worker keeps; all are forgotten when full.
KEPT_WORDS = 300_000
#: Characters that every Unicode version classes alike and that normalising leaves alone but for case.
_PLAIN_END = 0x0250
_NOT_PLAIN = "\x1c\x1d\x1e\x1f\x85İ"
_SPACE = "\t\n\x0b\x0c\r \xa0"
#: The contractions that the tokenizer's pattern names.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    printable = [b for r in ((33, 126), (161, 172), (174, 255)) for b in range(r[0], r[1] + 1)]
    others = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(printable))}
    return [others.get(b, chr(b)) for b in range(256)]


def _class_of(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN_END) if unicodedata.category(chr(c))[0] == kind)


class Pieces:
    """The vocabulary: pieces, their merges, and which may stand next to each other."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.parts: dict[str, tuple[int, str, str]] = {}
        for i, (a, b) in enumerate(merges):
            self.parts.setdefault(a + b, (i, a, b))
        self.vocab = model["vocab"]
        self.longest = max(map(len, self.vocab))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._fit: dict[tuple[str, str], bool] = {}
        reached = {p: self._reached(p) for p in sorted(self.parts, key=lambda p: self.parts[p][0])}
        #: Pieces that their own symbols encode to; others never come out.
        self.whole = {p for p in self.vocab if reached.get(p, True)}
        self.longest = max(map(len, self.whole))

    def _apart(self, left: str, right: str, before: float) -> bool:
        """Whether two pieces stay apart until merge number ``before``.

        Looks at the pieces' merges from the last back to the first: whenever
        the pieces then at the boundary could have merged before the one
        undone, they would have.
        """
        while True:
            r = self.rank.get((left, right))
            if r is not None and r < before:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] > b[0]:
                before, left = a[0], a[2]
            else:
                before, right = b[0] + 1, b[1]  # of equal merges the left one comes first

    def _reached(self, piece: str) -> bool:
        at, left, right = self.parts[piece]
        return self._apart(left, right, at)

    def fits(self, left: str, right: str) -> bool:
        """Whether encoding the two pieces' symbols together gives just these two."""
        if len(self._fit) > 500_000:
            self._fit.clear()
        out = self._fit[left, right] = self._apart(left, right, float("inf"))
        return out

    def open_table(self, letters: str) -> tuple[list[str], list[int]]:
        """Last piece and number of pieces of each prefix of a word that goes on."""
        n, longest, whole, known = len(letters), self.longest, self.whole, self._fit
        last, count = [""] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):  # the longest piece first
                s = letters[start:end]
                if s in whole:
                    if start:
                        fit = known.get((last[start], s))
                        if not (self.fits(last[start], s) if fit is None else fit):
                            continue
                    last[end], count[end] = s, count[start] + 1
                    break
            else:
                raise ValueError(f"the vocabulary has no pieces for {letters[:end]!r}")
        return last, count

    def closed(self, letters: str, end: int, last: list[str], count: list[int]) -> int:
        """Number of pieces if the word ends at ``end``."""
        mark, whole, known = self.mark, self.whole, self._fit
        for start in range(max(0, end - self.longest), end):
            s = letters[start:end] + mark
            if s in whole:
                if start:
                    fit = known.get((last[start], s))
                    if not (self.fits(last[start], s) if fit is None else fit):
                        continue
                return count[start] + 1
        raise ValueError(f"the vocabulary has no pieces for {letters[:end]!r}")

    def total(self, letters: str) -> int:
        return self.closed(letters, len(letters), *self.open_table(letters[:-1]))

    def prefix_counts(self, letters: str) -> list[int]:
        """Tokens of each prefix of a word, the prefix taken as a whole word."""
        last, count = self.open_table(letters[:-1])
        return [self.closed(letters, end, last, count) for end in range(1, len(letters) + 1)]


class PrefixCounter(dict):
    """Counts of texts; as a dict, tokens by word as the pre-tokenizer cuts it."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.pieces = Pieces(path)
        self.library = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        plain = "".join(re.escape(chr(c)) for c in range(_PLAIN_END) if chr(c) not in _NOT_PLAIN)
        self.odd = re.compile(f"[^{plain}]")
        letter, number = _class_of("L"), _class_of("N")
        space = "".join(map(re.escape, _SPACE))
        self.words = re.compile(f"{_CONTRACTIONS}|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")
        self.special = re.compile("|".join(map(re.escape, self.pieces.special)) or r"(?!)")

    def _spelled(self, word: str) -> str:
        """A word in byte letters."""
        if word.isascii() and word.isprintable():
            return word
        return "".join(self.letters[b] for b in word.encode("utf-8", "surrogateescape"))

    def __missing__(self, word: str) -> int:
        n = self.pieces.total(self._spelled(word))
        if len(word) <= 40:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = n
        return n

    def prefix_counts(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, by characters."""
        ends = accumulate(len(c.encode("utf-8", "surrogateescape")) for c in word)
        counts = self.pieces.prefix_counts(self._spelled(word))
        return [counts[e - 1] for e in ends]

    def _library_words(self, text: str) -> Iterator[tuple[str, int, int]]:
        """Words of a text with other characters, with their places in the text."""
        from tokenizers import PreTokenizedString

        cut = PreTokenizedString(text)
        if self.library.normalizer is not None:
            cut.normalize(self.library.normalizer.normalize)
        self.library.pre_tokenizer.pre_tokenize(cut)
        back = {c: b for b, c in enumerate(self.letters)}
        for word, (start, end), _ in cut.get_splits(offset_referential="original", offset_type="char"):
            yield bytes(back[c] for c in word).decode("utf-8", "surrogateescape"), start, end

    def segments(self, text: str) -> Iterator[tuple[int, str, bool]]:
        """The text between special tokens, and these, each with its place."""
        at = 0
        for m in self.special.finditer(text):
            if m.start() > at:
                yield at, text[at:m.start()], False
            yield m.start(), m[0], True
            at = m.end()
        if at < len(text):
            yield at, text[at:], False

    def table(self, text: str) -> tuple[list[int], list]:
        """Running token count behind each word of the text, and what :meth:`cut` needs of the words."""
        counts: list[int] = []
        words: list = []
        for at, part, special in self.segments(text):
            if special:
                counts.append(1)
                words.append((at, part, None))
            elif self.odd.search(part):
                for w, start, end in self._library_words(part):
                    counts.append(self[w])
                    words.append((at + start, w, end - start))
            else:
                found = self.words.findall(part.lower())
                counts += map(self.__getitem__, found)
                words.append((at, part, found))
        return list(accumulate(counts)), words

    def total(self, text: str) -> int:
        running, _ = self.table(text)
        return running[-1] if running else 0

    def cut(self, text: str, limit: int, table=None) -> int:
        """Length of the longest prefix of the text that has at most ``limit`` tokens.

        A special token or a word with characters that normalising changes is kept or cut whole.
        """
        running, words = table or self.table(text)
        if not running or running[-1] <= limit:
            return len(text)
        i = 0
        for at, part, found in words:
            if not isinstance(found, list):
                before = running[i - 1] if i else 0
                if running[i] > limit:
                    return at
                i += 1
                continue
            hit = next((k for k in range(len(found)) if running[i + k] > limit), None)
            if hit is None:
                i += len(found)
                continue
            before = running[i + hit - 1] if i + hit else 0
            for k, m in enumerate(self.words.finditer(part.lower())):
                if k < hit:
                    continue
                fit = [j for j, c in enumerate(self.prefix_counts(m[0]), 1) if before + c <= limit]
                return at + m.start() + (fit[-1] if fit else 0)
        return len(text)


#: One counter a worker and vocabulary; reading a vocabulary takes a second.
_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT_TOKENS) -> DataFrame:
    """Exact token counts of whole texts.

    ``docs(doc_id, text)`` to doc_id, n_bytes (UTF-8), n_tokens, over_limit
    (more than ``limit`` tokens) and cut_chars (characters of the longest prefix
    within the limit, from the prefix table). A null text counts as empty: 0
    tokens. Each row has a row in the result, repeated ones too; an empty table
    gives no rows. Other columns are not read. ``vocabulary`` is the place of a
    ``tokenizers`` file that every executor has.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            for part, texts in text_chunks(batch):
                n, cuts = [], []
                for raw in texts:
                    text = raw.decode("utf-8", "replace")
                    table = counter.table(text)
                    n.append(table[0][-1] if table[0] else 0)
                    cuts.append(counter.cut(text, limit, table))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_()), pa.array(cuts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    return docs.select("doc_id", F.col("text")).mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents in the word-BPE vocabulary of 49k pieces."""
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
