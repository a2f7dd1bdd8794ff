"""How the rows of a table are spread over its lookup keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.keys import named, nullif_empty, text_key

# Default share of the keyed rows from which a key counts as hot.
HOT_SHARE = 0.002
# Least share that can be asked for; its inverse bounds the number of hot keys.
LEAST_SHARE = 1e-4

# Sketches merge in two steps, so no single task has to read one per scan task.
_MERGE_GROUPS = 256


@dataclass(frozen=True)
class KeyShares:
    """``hot_keys`` hold the asked-for share of the keyed rows each, and together about ``hot`` of all rows; ``keyless`` is the share of rows without a key.

    ``shares`` has the hot keys with about the share of all rows that each holds.
    """

    hot_keys: list[str] = field(default_factory=list)
    keyless: float = 0.0
    hot: float = 0.0
    shares: dict[str, float] = field(default_factory=dict)


def key_shares(df: DataFrame, key: str, share: float = HOT_SHARE) -> KeyShares:
    """Hot keys by a frequent-items sketch, and the exact share of keyless rows.

    One job that reads the key column only and shuffles sketches, not keys. At
    most ``1 / share`` keys can qualify, which bounds the returned list. The
    answer steers the plan alone: a key missed or named needlessly changes no
    result.
    """
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share must be in [0.0001, 1], got {share}")
    most = int(1 / share)
    tracked = 8 * most  # keeps the sketch error well below one share
    found = (
        df.select(
            nullif_empty(text_key(named(key))).alias("item"),
            F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("grp"),
        )
        .groupBy("grp")
        .agg(
            F.expr(f"approx_top_k_accumulate(item, {tracked}) FILTER (WHERE item IS NOT NULL)").alias("sketch"),
            F.count("*").alias("n_rows"),
            F.count("item").alias("n_keyed"),
        )
        .groupBy(F.lit("all"))  # a grouped merge gives no row, not an error, where there are no rows
        .agg(
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_keyed").alias("n_keyed"),
        )
        .select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top"), "n_rows", "n_keyed")
        .first()
    )
    if found is None:
        return KeyShares()
    hot = {t["item"]: t["count"] for t in found["top"] if t["count"] >= share * found["n_keyed"]}
    n_rows = found["n_rows"]
    return KeyShares(sorted(hot), (n_rows - found["n_keyed"]) / n_rows, sum(hot.values()) / n_rows, {k: n / n_rows for k, n in hot.items()})


def find_hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list[str]:
    """Keys that hold at least ``share`` of the keyed rows; see :func:`key_shares`."""
    return key_shares(df, key, share).hot_keys
