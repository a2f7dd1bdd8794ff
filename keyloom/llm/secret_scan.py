"""Secrets in text: fixed patterns, and values in a credential context that are hard to guess.

How hard a value is to guess is the cheapest way to compose it of words,
dates, repeats, keyboard walks and spans tried by brute force, found by dynamic
programming over its positions. Costs are powers of ten of the number of guesses.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import col

# Patterns of the base spans, in the order in which spans of one start are listed.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs are maximal, so shorter ones need not be matched and dropped
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
GUESS = "guess"
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

# A value after one of these, an assignment and perhaps a quote is taken for a credential. The name may go on: as it likes after
# words that begin no others, else from _, -, a digit or a new capital ("token_2", "secretId", but not "author").
# A name without a value matches too, so that none is read twice, and blanks are never given back: work is linear.
CONTEXT = re.compile(
    r"""(?:(?i:pass(?:word|wd|phrase|code)|pwd|(?:api|private|access|secret|signing|encryption)[_-]?key)[A-Za-z0-9_-]*+"""
    r"""|(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:pass|secret|token|credential|auth|login)s?(?:(?:[0-9_-]|(?<=[a-z])[A-Z])[A-Za-z0-9_-]*+)?)"""
    r"""(?:["']?(?:\s*+(?::=|=>|[:=])|\s++is\s)\s*+(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"'<>,;]{6,})))?""",
    re.ASCII,
)
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "login")

COMMON = 50_000  # words of the corpus that are known to a guesser: at most 1 MB
_DISTINCT = 300_000  # different words that a task counts before it hands them on
_WORD = re.compile(r"[^\W\d_]{3,24}")

MIN_COST = 9.0  # a value that needs fewer than a thousand million guesses is no secret

# Frequent parts of passwords, most frequent first: the rank is the number of guesses.
WORDS = (
    "password pass admin welcome login master secret token letmein dragon monkey shadow sunshine princess football "
    "baseball superman batman trustno hello freedom whatever test guest user root default change changeme example "
    "sample demo temp public private access server system manager service account summer winter spring autumn "
    "january february march april june july august september october november december monday tuesday wednesday "
    "thursday friday saturday sunday love angel star money happy lucky blue green orange purple black white "
    "apple banana cookie coffee computer internet google hunter soccer hockey tiger eagle falcon phoenix the and "
    "that your this with from null none true false string value placeholder redacted todo your_password"
).split()
# Rows of keys, as walked along in either direction.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "qwertzuiopü", "azertyuiop", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p", "abcdefghijklmnopqrstuvwxyz")
# Letters often written as other characters.
LEET = str.maketrans("4@310$57!", "aaeiossti")
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
_DATE_COST = {4: math.log10(130), 8: math.log10(130 * 366), 10: math.log10(130 * 366 * 5)}


class GuessCost:
    """The cost of values, as log10 of the guesses."""

    def __init__(self, words: Sequence[str] = WORDS, common: Sequence[str] = ()):
        """``words`` and ``common`` are each in order of frequency; a word in both has the better rank."""
        self.rank: dict[str, int] = {}
        for listed in (words, common):
            for i, w in enumerate(listed, 1):
                self.rank[w] = min(i, self.rank.get(w, i))
        self.longest = max(map(len, self.rank))
        self.rows = KEY_ROWS + tuple(r[::-1] for r in KEY_ROWS)
        self.next_key = {r: {a: b for a, b in zip(r, r[1:], strict=False)} for r in self.rows}

    @staticmethod
    def character_cost(c: str) -> float:
        if c.isdigit():
            return 1.0
        if c.isascii() and c.isalpha():
            return math.log10(26) if c.islower() else math.log10(36)
        return math.log10(33) if c.isascii() else 2.0

    def spans(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Words, dates, repeats and walks in ``value``: start, end, cost."""
        low, n = value.lower(), len(value)
        if len(low) != n:  # some letters change their length; compare what keeps positions
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        plain = low.translate(LEET)
        for text, extra in ((low, 0.0), (plain, 0.5)) if plain != low else ((low, 0.0),):
            for i in range(n):
                for j in range(i + 3, min(n, i + self.longest) + 1):
                    rank = self.rank.get(text[i:j])
                    if rank:
                        cased = 0.0 if value[i:j] == low[i:j] else 0.3 if value[i:j].istitle() or value[i:j].isupper() else 1.0
                        yield i, j, math.log10(rank + 1) + extra + cased
        for i in range(n):
            m = _DATE.match(value, i)
            if m:
                yield i, m.end(), _DATE_COST[m.end() - i]
        i = 0
        while i < n:  # runs of one character
            j = i + 1
            while j < n and value[j] == value[i]:
                j += 1
            if j - i >= 3:
                yield i, j, self.character_cost(value[i]) + math.log10(j - i)
            i = j
        for size in (2, 3, 4):  # repeats of a short group
            i = 0
            while i + 2 * size <= n:
                j = i + size
                while j < n and value[j] == value[j - size]:
                    j += 1
                if j - i >= 2 * size and len(set(value[i : i + size])) > 1:
                    yield i, j, sum(map(self.character_cost, value[i : i + size])) + math.log10((j - i) / size)
                    i = j - size + 1
                else:
                    i += 1
        for row in self.rows:
            step, i = self.next_key[row], 0
            while i < n:
                j = i + 1
                while j < n and step.get(low[j - 1]) == low[j]:
                    j += 1
                if j - i >= 3:
                    yield i, j, math.log10(len(row) * len(self.rows)) + math.log10(j - i)
                i = j

    def cost(self, value: str) -> float:
        """Cheapest composition of the whole ``value``."""
        ends: dict[int, list[tuple[int, float]]] = {}
        for i, j, c in self.spans(value):
            ends.setdefault(j, []).append((i, c))
        best = [0.0]
        for j, c in enumerate(value, 1):
            cheapest = best[j - 1] + self.character_cost(c)
            for i, span in ends.get(j, ()):
                cheapest = min(cheapest, best[i] + span)
            best.append(cheapest)
        return best[-1]


def base_spans(text: str, low: str) -> list[tuple[str, int, int]]:
    found = []
    if any(h in low for h in _ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def guess_spans(text: str, low: str, costs: GuessCost, least: float) -> list[tuple[str, int, int]]:
    if not any(h in low for h in _CONTEXT_HINTS):
        return []
    found = []
    for m in CONTEXT.finditer(text):
        group = m.lastindex
        if group and costs.cost(m[group]) >= least:
            found.append((GUESS, m.start(group), m.end(group)))
    return found


def common_words(df: DataFrame, text: str = "text", most: int = COMMON) -> list[str]:
    """The ``most`` most frequent words of all texts, of 3 to 24 letters, in lower case; of equals the first in order.

    Values in credential contexts do not count, so that a secret in many copies of a text is no common
    word. Nulls, empty texts and an empty table have none.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def handed_on():
            batch = pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])
            found.clear()
            return batch

        for batch in batches:
            for told in batch.column(0):
                said = told.as_py() or ""
                low = said.lower()
                if any(h in low for h in _CONTEXT_HINTS):
                    low = CONTEXT.sub(" ", said).lower()
                found.update(_WORD.findall(low))
                if len(found) >= _DISTINCT:
                    yield handed_on()
        yield handed_on()

    words = df.select(col(text).alias("text")).mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.orderBy(F.desc("n"), "word").limit(most).select("word").toArrow().column(0).to_pylist()


def find_secrets(df: DataFrame, text: str = "text", into: str = "secrets", words: Sequence[str] = WORDS, least: float = MIN_COST, common: Sequence[str] = ()) -> DataFrame:
    """``df`` with an array of the secrets in ``text``: kind, start, end (code points, end exclusive).

    Kinds are ``assign``, ``access`` and ``hex`` (fixed patterns; matches of one kind do
    not overlap) and ``guess`` (the value alone, in a credential context, at
    least 10**``least`` guesses, for a guesser who knows ``words`` and ``common``, see :func:`common_words`). Ordered by start, then kind as listed. Null and
    empty texts give an empty array. A column named ``into`` is replaced, all others
    and repeated rows stay; an empty table gives no rows. No shuffle; work per text is linear in its length.
    """
    order = {k: i for i, k in enumerate((*BASE_KINDS, GUESS))}
    sent = df.sparkSession.sparkContext.broadcast((list(words), list(common)))

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        costs = GuessCost(*sent.value)

        def scan(text):
            if not text:
                return []
            low = text.lower()
            spans = base_spans(text, low) + guess_spans(text, low, costs, least)
            return [{"kind": k, "start": i, "end": j} for k, i, j in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))]

        for texts in batches:
            yield pd.Series(list(map(scan, texts)), dtype=object)

    return df.withColumn(into, found(col(text)))


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]", words: Sequence[str] = WORDS, least: float = MIN_COST, common: Sequence[str] = ()) -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mark``; touching and overlapping spans become one mark. Null stays null."""
    sent = df.sparkSession.sparkContext.broadcast((list(words), list(common)))

    @F.pandas_udf("string")
    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        costs = GuessCost(*sent.value)

        def clean(text):
            if not text:
                return text
            low = text.lower()
            spans = sorted((i, j) for _, i, j in base_spans(text, low) + guess_spans(text, low, costs, least))
            out, at = [], 0
            for i, j in spans:
                if i > at or not out:
                    out += [text[at:i], mark]
                at = max(at, j)
            return "".join([*out, text[at:]])

        for texts in batches:
            yield pd.Series(list(map(clean, texts)), dtype=object)

    return df.withColumn(text, redacted(col(text)))
