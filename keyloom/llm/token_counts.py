"""Token counts by the whole-token shortcut.

Most parts of ordinary text that the merges start from are in the vocabulary
themselves. For these no merge has to be run, if it is proved beforehand that the
merges turn them into that one token. The proof runs once, on the driver, over the
vocabulary; tasks then count such parts at once and merge only the rest.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.bpe_file import JSON_PATH, PATTERN, LibraryTokenizer, byte_alphabet
from keyloom.llm.common import col
from keyloom.llm.pretokens import Memo, Splitter

_KEPT = 200_000  # merged parts a task remembers


def prove_whole_tokens(tokenizer: LibraryTokenizer, splitter: Splitter) -> frozenset[str]:
    """Vocabulary strings that are one part of the split and that the merges make one token."""
    alphabet, candidates = byte_alphabet(), []
    for token in tokenizer.library.get_vocab(with_added_tokens=False):
        if not all(c in alphabet for c in token):
            continue
        try:
            text = bytes(alphabet[c] for c in token).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if splitter.findall(text) == [text] and not tokenizer.has_special(text):
            candidates.append(text)
    return frozenset(t for t, ids in zip(candidates, tokenizer.ids(candidates), strict=True) if len(ids) == 1)


class TokenCounter:
    """Counts tokens of texts; made in each task from what the driver sent."""

    def __init__(self, tokenizer: LibraryTokenizer, splitter: Splitter, whole: frozenset[str], pattern: str = PATTERN):
        self.tokenizer, self.splitter, self.whole = tokenizer, splitter, whole
        merge = tokenizer.fast(pattern).encode_ordinary
        self.merged = Memo(lambda part: len(merge(part)), _KEPT)

    def count(self, text: str) -> int:
        if self.tokenizer.has_special(text):
            return len(self.tokenizer.ids([text])[0])
        parts, whole = self.splitter.findall(text), self.whole
        rest = [p for p in parts if p not in whole]
        return len(parts) - len(rest) + sum(map(self.merged.__getitem__, rest))


def count_tokens(df: DataFrame, text: str = "text", into: str = "n_tokens", path: str = JSON_PATH, pattern: str = PATTERN) -> DataFrame:
    """``df`` with the number of tokens of ``text`` as the library gives it, a long.

    Special strings inside texts count as their special token, nothing is added,
    truncated or padded. Null and empty texts have 0 tokens. A column of the name
    ``into`` is replaced; all other columns, also repeated rows, stay as they are.
    No shuffle. What is sent to the tasks is bounded by the vocabulary file.
    """
    tokenizer, splitter = LibraryTokenizer.read(path), Splitter(pattern)
    sent = df.sparkSession.sparkContext.broadcast((tokenizer, splitter, prove_whole_tokens(tokenizer, splitter)))

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = TokenCounter(*sent.value)
        for texts in batches:
            yield pd.Series([0 if t is None else counter.count(t) for t in texts], dtype="int64")

    return df.withColumn(into, counted(col(text)))
