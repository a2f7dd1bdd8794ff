"""A bitmap of a dimension's keys, to keep main rows that match nothing out of a shuffle.

Every key sets one bit of 2**27, so the bitmap never takes more than 16 MB, whatever the
dimension. A key whose bit is not set is surely unknown; one whose bit is set by another key
goes the long way and finds nothing there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import free_name, has_key, named, text_key

FILTER_BITS = 27
# Share of set bits from which the bitmap tells too little to be worth a second read.
FULL_SHARE = 0.5
# Share of main rows without a match from which a second read of main costs less than shuffling them.
UNKNOWN_SHARE = 0.3
_PART_BITS = 15  # 32768 bits, 4 KB, to a row


def _place(key: Column, bits: int) -> Column:
    return F.xxhash64(text_key(key)).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


@dataclass(frozen=True)
class KeyFilter:
    """Rows ``(part, words)`` of 64-bit words, 4096 at most, and the share of set bits."""

    parts: DataFrame
    bits: int
    filled: float

    def mark(self, df: DataFrame, key: str, into: str) -> DataFrame:
        """``df`` with ``into``: false where ``key`` is surely not in the dimension. One broadcast join, no shuffle."""
        part, words = (free_name([*df.columns, into], n) for n in ("key_part", "key_words"))
        parts = F.broadcast(self.parts.select(F.col("part").alias(part), F.col("words").alias(words)))
        place = _place(named(key), self.bits)
        at = place.bitwiseAND(F.lit((1 << _PART_BITS) - 1).cast("bigint")).cast("int")
        # A word is eight bytes, the first of them highest; within a byte the first bit is lowest.
        byte, bit = F.shiftright(at, 3), at.bitwiseAND(F.lit(7))
        told = F.getbit(F.element_at(F.col(words), F.shiftright(at, 6) + 1), (7 - byte.bitwiseAND(F.lit(7))) * 8 + bit) == 1
        known = has_key(named(key)) & F.coalesce(told, F.lit(False))
        both = df.join(parts, F.shiftright(place, _PART_BITS) == F.col(part), "left")
        return both.select(*map(named, df.columns), known.alias(into))

    def unknown_share(self, df: DataFrame, key: str) -> float:
        """Share of the rows whose key is surely not in the dimension: one job that reads the key column."""
        marked = self.mark(df.select(named(key).alias("key")), "key", "known")
        return marked.agg(F.avg(F.when(F.col("known"), 0.0).otherwise(1.0))).first()[0] or 0.0


def key_filter(dim: DataFrame, rowkey: str, bits: int = FILTER_BITS) -> KeyFilter:
    """The bitmap of the keys of ``dim``: one job that reads the key column, 16 MB at most to the driver."""
    if not _PART_BITS <= bits <= FILTER_BITS:
        raise ValueError(f"bits must be in [{_PART_BITS}, {FILTER_BITS}], got {bits}")
    place = dim.where(has_key(named(rowkey))).select(_place(named(rowkey), bits).alias("at"))
    maps = place.groupBy(F.shiftright("at", _PART_BITS).alias("part")).agg(F.expr(f"bitmap_construct_agg(at & {(1 << _PART_BITS) - 1})").alias("bitmap"))
    held = maps.select("part", "bitmap", F.bitmap_count("bitmap").alias("n")).toArrow()
    filled = sum(held.column("n").to_pylist()) / (1 << bits)
    words = [np.frombuffer(bitmap, ">i8") for bitmap in held.column("bitmap").to_pylist()]
    offsets = np.arange(len(words) + 1, dtype=np.int32) * ((1 << _PART_BITS) // 64)
    flat = np.concatenate(words).astype(np.int64) if words else np.zeros(0, np.int64)
    parts = pa.table({"part": held.column("part"), "words": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})
    return KeyFilter(dim.sparkSession.createDataFrame(parts), bits, filled)
