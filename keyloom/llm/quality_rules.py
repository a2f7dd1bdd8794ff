"""Line-first cleaning: bad lines go, then documents that lost too much.

Rules look at one line at a time: punctuation, symbols, shouting, navigation and
boilerplate. A document is rejected by figures of its whole text first (too
few words, too much repeated), else by the share of its characters that its removed
lines held.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import col

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"

_SHORT_LINE = 10  # words; a shorter line must end like a sentence
# What ends a sentence in any script, and what else may end a line of prose.
_SENTENCE_END = frozenset(regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))))
_TERMINAL = _SENTENCE_END | set("…:;")
_CLOSING = "\"')]}”’»* "
_SEPARATORS = re.compile(r"[|»›·•>]")
_BOILERPLATE_PERCENT = 15  # of a line that is not short
_ENGLISH = (
    r"all rights reserved|copyright\s*\d{4}|licen[sc]ed under|privacy policy|cookie policy|we use cookies|accept cookies|"
    r"terms of (?:use|service)|terms and conditions|enable javascript|javascript is (?:disabled|required)|click here|read more|"
    r"sign (?:in|up) (?:to|for)|log in to|subscribe to|share (?:on|this)|follow us|powered by|lorem ipsum|skip to content"
)
_GERMAN = (
    r"alle rechte vorbehalten|datenschutz(?:erklärung|bestimmungen|hinweise)?|impressum|wir verwenden cookies|cookies (?:akzeptieren|zulassen)|"
    r"nutzungsbedingungen|allgemeine geschäftsbedingungen|javascript aktivieren|hier klicken|klicken sie hier|mehr lesen|weiterlesen|"
    r"newsletter abonnieren|teilen auf|folgen sie uns|zum inhalt springen"
)
_FRENCH = (
    r"tous droits réservés|politique de confidentialité|nous utilisons des cookies|accepter les cookies|conditions (?:générales )?d['’]utilisation|"
    r"mentions légales|activer javascript|cliquez ici|lire la suite|en savoir plus|abonnez-vous à|partager sur|suivez-nous|propulsé par|aller au contenu"
)
_SPANISH = (
    r"todos los derechos reservados|política de (?:privacidad|cookies)|utilizamos cookies|aceptar (?:las )?cookies|términos (?:de uso|y condiciones)|"
    r"aviso legal|activar javascript|haga clic aquí|haz clic aquí|leer más|seguir leyendo|suscríb(?:ase|ete) a|compartir en|síg(?:uenos|anos)|ir al contenido"
)


def _by_letter(phrases: str) -> str:
    """The alternatives at the bars outside of brackets, grouped by their first letter, so that most words are passed over at once."""
    groups: dict[str, list[str]] = {}
    for phrase in re.findall(r"(?:\([^)]*\)\??|[^|(])+", phrases):
        groups.setdefault(phrase[0], []).append(phrase[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(groups.items()))


_PHRASES = _by_letter("|".join((_ENGLISH, _GERMAN, _FRENCH, _SPANISH)))
_BOILERPLATE = re.compile(rf"(?i)\b(?:copyright\s*(?:\(c\)|©)|(?:{_PHRASES})\b)")


def is_boilerplate(line: str, n: int) -> bool:
    """Whether ``line`` of ``n`` words has a phrase, and is short or made of phrases to a good part. Prose may hold one."""
    found = sum(m.end() - m.start() for m in _BOILERPLATE.finditer(line))
    return found > 0 and (n < _SHORT_LINE or 100 * found >= _BOILERPLATE_PERCENT * len(line.strip()))


def line_fault(line: str) -> str | None:
    """The rule that ``line`` fails, or None. A line without words fails none."""
    words = line.split()
    n = len(words)
    if not n:
        return None
    if is_boilerplate(line, n):
        return "boilerplate"
    if 4 * len(_SEPARATORS.findall(line)) >= n and (n >= 4 or "|" in line):
        return "navigation"
    if 4 * sum(map(line.count, SYMBOLS)) > n:
        return "symbols"
    if n >= 5 and (3 * line.count("!") > n or 10 * sum(w.isupper() and len(w) > 1 for w in words) > 6 * n):
        return "shouting"
    last = line.rstrip(_CLOSING)[-1:]
    ended = not last or last in _TERMINAL
    if not ended and (n < _SHORT_LINE or _SENTENCE_END.isdisjoint(line)):
        return "punctuation"
    return None


def repeated_words(words: list) -> int:
    """Words in windows of three that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = 1
    return sum(covered)


def judge(text: str) -> tuple:
    """All figures of one text, in the order of :data:`RESULT`."""
    words = text.encode("utf-8").split()  # at the six ASCII white space characters
    n_words = len(words)
    spaces = sum(map(text.count, _SPACES))
    lines = text.split("\n")
    seen, n_dup_lines, kept, lost, failed = set(), 0, [], 0, 0
    for line in lines:
        if line.strip(_SPACES):
            n_dup_lines += line in seen
            seen.add(line)
        if line_fault(line):
            failed += 1
            lost += len(line)
        else:
            kept.append(line)
    n_repeat_words = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words
    cleaned = "\n".join(kept)
    ok = not base_failed and bool(cleaned.strip()) and 100 * lost <= MAX_LOST_PERCENT * len(text)
    return n_words, len(text) - spaces, sum(map(text.count, SYMBOLS)), n_dup_lines, n_repeat_words, base_failed, ok, failed, lost, cleaned


RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_failed_lines bigint, lost_chars bigint, cleaned string"
)


def clean_lines(df: DataFrame, text: str = "text", into: str = "rules") -> DataFrame:
    """``df`` with a struct of the figures and verdicts of ``text`` and its cleaned text (:data:`RESULT`).

    Null and empty texts have no words, so they fail. Repeated rows get the same
    result each. A column named ``into`` is replaced, all others stay. No shuffle.
    """

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in RESULT.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(t or "") for t in texts], columns=names)

    # Marked so that a filter on the verdict does not run the rules a second time.
    return df.withColumn(into, judged.asNondeterministic()(col(text)))
