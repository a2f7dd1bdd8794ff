"""Byte-level BPE as a monoid: halves are encoded recursively and joined.

Two encoded neighbours are joined by encoding again only a window of tokens
around their boundary. The window grows until the tokens on both of its edges
provably stay: a token sequence is the encoding of its bytes exactly if each two
neighbours in it are the encoding of their own bytes. (The merges of the whole, up to the
first that would cross a token boundary, are on either side those of the pair
alone, which does not cross it.) Decoding concatenates up a tree of halves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.bpe_file import PATTERN, RANKS_PATH, read_ranks
from keyloom.llm.common import col
from keyloom.llm.pretokens import Memo, Splitter

_LEAF = 8  # bytes that are merged directly
_RUN = 1024  # ids that are a leaf of the decoding tree
_RANK_BITS = 32
_LONG_MATCH = 64  # characters of a match beyond which it is not remembered
_KEPT_MATCHES = 300_000  # encoded matches, and small parts and pairs of tokens, that a task remembers
_KEPT = 100_000
_ROWS = 256  # texts whose ids are held at once


def _parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The rows of ``batches``, fewer at a time, so that the results of a batch of any size are handed on in parts."""
    for batch in batches:
        for at in range(0, len(batch), _ROWS):
            yield batch.iloc[at : at + _ROWS]


class TreeBpe:
    """Encodes byte strings by ranks; the lowest-ranked pair merges first, of equals the leftmost.

    The library merges parts of a few bytes and the windows around boundaries; all else is joined.
    """

    def __init__(self, ranks: dict[bytes, int], leaf: int = _LEAF):
        self.leaf, self.word = leaf, {rank: token for token, rank in ranks.items()}
        self.merged = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.leaves = Memo(self.merged, _KEPT)
        self.pairs = Memo(self._pair, _KEPT)

    def encode(self, data: bytes) -> list[int]:
        """Tokens of ``data``: small parts directly, larger ones as two joined halves."""
        if len(data) <= self.leaf:
            return self.leaves[data] if data else []
        middle = len(data) // 2
        return self.join(self.encode(data[:middle]), self.encode(data[middle:]))

    def _pair(self, pair: int) -> list[int] | None:
        """The encoding of two tokens, packed in one number, or None where it is the two."""
        left, right = pair >> _RANK_BITS, pair & (1 << _RANK_BITS) - 1
        found = self.merged(self.word[left] + self.word[right])
        return None if found == [left, right] else found

    def stays(self, left: int, right: int) -> bool:
        """True if no merge crosses the boundary of these two neighbours."""
        return self.pairs[left << _RANK_BITS | right] is None

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours that are encoded themselves."""
        if not left or not right:
            return left or right
        window = self.pairs[left[-1] << _RANK_BITS | right[0]]
        if window is None:
            return left + right
        before = after = 1
        while True:
            left_stays = before == len(left) or self.stays(left[-before - 1], window[0])
            right_stays = after == len(right) or self.stays(window[-1], right[after])
            if left_stays and right_stays:
                return left[: len(left) - before] + window + right[after:]
            before = min(before * (1 if left_stays else 2), len(left))
            after = min(after * (1 if right_stays else 2), len(right))
            window = self.merged(b"".join(map(self.word.__getitem__, left[-before:] + right[:after])))


class TextEncoder:
    """Ids of whole texts; each match of the pattern is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], splitter: Splitter):
        self.bpe, self.splitter = TreeBpe(ranks), splitter
        self.ranks, self.packed = ranks, {rank: rank.to_bytes(4, "little") for rank in ranks.values()}
        self.short = Memo(self._match, _KEPT_MATCHES)

    def _match(self, match: str) -> bytes:
        data = match.encode()
        rank = self.ranks.get(data)  # a match that is a token is that token
        if rank is not None:
            return self.packed[rank]
        return b"".join(map(self.packed.__getitem__, self.bpe.encode(data)))

    def encode(self, text: str) -> np.ndarray:
        matches = self.splitter.findall(text)
        if max(map(len, matches), default=0) > _LONG_MATCH:
            return np.frombuffer(b"".join(self._match(m) if len(m) > _LONG_MATCH else self.short[m] for m in matches), dtype="<i4")
        return np.frombuffer(b"".join(map(self.short.__getitem__, matches)), dtype="<i4")


def encode(df: DataFrame, text: str = "text", into: str = "ids", path: str = RANKS_PATH, pattern: str = PATTERN) -> DataFrame:
    """``df`` with the token ids of ``text``, an array of ints, without special tokens.

    Null and empty texts give an empty array. A column named ``into`` is replaced,
    all other columns and repeated rows stay. No shuffle; the ranks sent to the
    tasks are bounded by the vocabulary file.
    """
    sent = df.sparkSession.sparkContext.broadcast((read_ranks(path), Splitter(pattern)))

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = TextEncoder(*sent.value)
        for texts in _parts(batches):
            yield pd.Series([encoder.encode(t or "") for t in texts], dtype=object)

    return df.withColumn(into, encoded(col(text)))


def _decoder(ranks: dict[bytes, int]):
    word = {rank: token for token, rank in ranks.items()}.__getitem__

    def concatenated(ids: np.ndarray) -> bytes:
        if len(ids) <= _RUN:
            return b"".join(map(word, ids.tolist()))
        middle = len(ids) // 2
        return concatenated(ids[:middle]) + concatenated(ids[middle:])

    return concatenated


def decode(df: DataFrame, ids: str = "ids", into: str = "decoded", path: str = RANKS_PATH) -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for, as binary; null for null ids. Unknown ids are an error."""
    sent = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bytes_of = _decoder(sent.value)
        for batch in _parts(batches):
            yield pd.Series([None if a is None else bytes_of(a) for a in batch], dtype=object)

    return df.withColumn(into, decoded(col(ids)))


def round_trip(df: DataFrame, text: str = "text", into: str = "coded", path: str = RANKS_PATH, pattern: str = PATTERN) -> DataFrame:
    """``df`` with a struct of the ``ids`` of ``text`` and the bytes ``decoded`` from them, made in one pass.

    The same as :func:`encode` and :func:`decode` one after the other, with one Python worker a task instead of two.
    """
    sent = df.sparkSession.sparkContext.broadcast((read_ranks(path), Splitter(pattern)))

    @F.pandas_udf("ids array<int>, decoded binary")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, bytes_of = TextEncoder(*sent.value), _decoder(sent.value[0])
        for texts in _parts(batches):
            ids = [encoder.encode(t or "") for t in texts]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(list(map(bytes_of, ids)), dtype=object)})

    return df.withColumn(into, coded(col(text)))
