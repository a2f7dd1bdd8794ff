"""Packing documents into windows of a fixed number of tokens, online, by sum of squares.

Each piece goes into the fill level that leaves the smallest sum over levels of the
squared number of windows partly filled to that level. The counts by level are all
the state that the choice needs. This keeps few windows open, whatever the
sizes; what is open at the end of a partition is closed by cutting pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keyloom.llm.bpe_file import JSON_PATH, PATTERN, SINGLE_SPACE_PATTERN, LibraryTokenizer
from keyloom.llm.common import col

WINDOW = 2048
END_ID = 1
OPEN_LIMIT = 8192  # open windows that a task holds, 64 MB of ids at most; each beyond makes it fill one by cutting
_ROWS = 4096  # pieces in a batch

PIECES = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


class Encoder:
    """Token ids of texts as the ``tokenizers`` library gives them."""

    def __init__(self, tokenizer: LibraryTokenizer):
        self.tokenizer = tokenizer
        self.any_space = tokenizer.fast(PATTERN).encode_ordinary
        self.single_space = tokenizer.fast(SINGLE_SPACE_PATTERN).encode_ordinary

    def encode(self, text: str) -> list[int]:
        if self.tokenizer.has_special(text):
            return self.tokenizer.ids([text])[0]
        single = len(" ".join(text.split())) == len(text)
        return (self.single_space if single else self.any_space)(text)


class SumOfSquaresPacker:
    """Packs pieces ``(document, start, ids)``; closed windows are lists of such pieces."""

    def __init__(self, window: int = WINDOW, open_limit: int = OPEN_LIMIT):
        self.window, self.open_limit = window, open_limit
        self.level = np.zeros(window + 1, dtype=np.int64)  # open windows by fill; 0 and `window` stay 0
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0

    def choose(self, size: int) -> int:
        """The fill level that a piece of ``size`` tokens is added to; 0 opens a window."""
        grown = 2 * self.level[size:] + 1
        grown[-1] = 0  # a full window is no longer partly filled
        here = self.level[: self.window - size + 1]
        cost = grown - np.where(here > 0, 2 * here - 1, np.iinfo(np.int64).min // 2)
        cost[0] = grown[0]
        return len(cost) - 1 - int(np.argmin(cost[::-1]))  # of equals, the fullest

    def add(self, document: int, ids: np.ndarray) -> list[list[tuple]]:
        """Places a document; returns the windows that this closes."""
        whole = len(ids) // self.window * self.window
        closed = [[(document, at, ids[at : at + self.window])] for at in range(0, whole, self.window)]
        if size := len(ids) - whole:
            at = self.choose(size)
            held = self.open[at].pop() if at else []
            held.append((document, whole, ids[whole:].copy()))  # not a view, which would hold a long document
            self.level[at] -= at > 0
            self.n_open += (at == 0) - (at + size == self.window)
            if at + size == self.window:
                closed.append(held)
            else:
                self.open[at + size].append(held)
                self.level[at + size] += 1
        while self.n_open > self.open_limit:
            closed.append(self._fill_one())
        return closed

    def _fill_one(self) -> list[tuple]:
        """The fullest open window, filled with tokens of the emptiest ones."""
        fill = int(np.flatnonzero(self.level)[-1])
        held = self._drop(fill)
        while fill < self.window and self.n_open:
            left = int(np.flatnonzero(self.level)[0])
            taken, rest = self._take(self._drop(left), self.window - fill)
            held.extend(taken)
            got = sum(len(p[2]) for p in taken)
            fill += got
            if rest:
                self.open[left - got].append(rest)
                self.level[left - got] += 1
                self.n_open += 1
        return held

    def _drop(self, fill: int) -> list[tuple]:
        self.level[fill] -= 1
        self.n_open -= 1
        return self.open[fill].pop()

    def close(self) -> list[list[tuple]]:
        """All open windows, filled by cutting pieces of the emptiest into the fullest.

        The last is cut into windows whose sizes are powers of two, so nothing is padded.
        """
        windows = [(fill, held) for fill in range(self.window - 1, 0, -1) for held in self.open[fill]]
        self.level[:], self.n_open = 0, 0
        self.open = [[] for _ in range(self.window)]
        closed, first, last = [], 0, len(windows) - 1
        while first < last:
            fill, held = windows[first]
            left, giving = windows[last]
            taken, rest = self._take(giving, self.window - fill)
            held.extend(taken)
            got = sum(len(p[2]) for p in taken)
            windows[first], windows[last] = (fill + got, held), (left - got, rest)
            if not rest:
                last -= 1
            if fill + got == self.window:
                closed.append(held)
                first += 1
        if windows and first == last:
            fill, held = windows[first]
            while fill:
                size = 1 << (fill.bit_length() - 1)
                taken, held = self._take(held, size)
                closed.append(taken)
                fill -= size
        return closed

    @staticmethod
    def _take(pieces: list[tuple], most: int) -> tuple[list[tuple], list[tuple]]:
        """The last ``most`` tokens of ``pieces`` at most, cut where they must be, and what is left."""
        rest, taken = list(pieces), []
        while rest and most:
            document, start, ids = rest.pop()
            if len(ids) > most:
                at = len(ids) - most
                rest.append((document, start, ids[:at]))
                start, ids = start + at, ids[at:]
            taken.append((document, start, ids))
            most -= len(ids)
        return taken, rest


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, path: str = JSON_PATH, open_limit: int = OPEN_LIMIT) -> DataFrame:
    """One row per piece of a document: ``key``, start, length, ids, doc_tokens, sequence_id, offset.

    A document is the ids of its text, then ``end_id``; null and empty texts are
    that id alone. ``ids`` holds little-endian unsigned 32-bit integers. Sequences
    hold ``window`` ids, but for the last of a partition, whose sizes are powers of
    two: nothing is padded. Documents longer than a window are cut at its multiples,
    others where the last open windows of a partition are filled, and where one is filled
    because more than ``open_limit`` are open. Memory is bounded by that: a larger limit cuts fewer
    documents in the course of a partition, and as many more at its end.

    Each partition packs its own rows in one pass, with no shuffle: a window belongs
    to one task, and a task that is run again gives the same sequences. Repeated
    rows and null keys are packed like others. An empty table gives no rows. Extra
    columns of ``df`` play no part. ``sequence_id`` is unique, ``offset`` gapless from 0.
    """
    sent = df.sparkSession.sparkContext.broadcast(LibraryTokenizer.read(path))
    source = df.select(col(key).alias("key"), col(text).alias("text"))
    schema = T.StructType([T.StructField("key", source.schema["key"].dataType), *PIECES.fields])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, packer = Encoder(sent.value), SumOfSquaresPacker(window, open_limit)
        base, n_sequences = TaskContext.get().partitionId() << 40, 0
        documents: dict[int, list] = {}  # key, tokens and tokens not yet given out, by number
        number, rows, kind = 0, [], None

        def batch(rows):
            columns = list(zip(*rows, strict=True))
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema.names)

        def emit(windows):
            nonlocal n_sequences
            for held in windows:
                offset = 0
                for document, start, ids in held:
                    known = documents[document]
                    rows.append((known[0], start, len(ids), ids.tobytes(), known[1], base + n_sequences, offset))
                    offset += len(ids)
                    known[2] -= len(ids)
                    if not known[2]:
                        del documents[document]
                n_sequences += 1

        for got in batches:
            kind = got.column(0).type
            for key_, text_ in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
                ids = np.array([*encoder.encode(text_ or ""), end_id], dtype="<u4")
                documents[number] = [key_, len(ids), len(ids)]
                emit(packer.add(number, ids))
                number += 1
                if len(rows) >= _ROWS:
                    yield batch(rows)
                    rows.clear()
        emit(packer.close())
        if rows:
            yield batch(rows)

    return source.mapInArrow(packed, schema).withColumnRenamed("key", key)
