"""The lookup left outer join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.codec import as_text
from keyloom.functions.keys import free_name, named
from keyloom.operators.keyjoin import StoredSalt, join_by_key

Field = str | tuple[str, str]


def _pairs(fields: Sequence[Field]) -> list[tuple[str, str]]:
    return [(f, f) if isinstance(f, str) else (f[0], f[1]) for f in fields]


def latest_rows(df: DataFrame, rowkey: str, version: str) -> DataFrame:
    """One row per key, the one with the greatest ``version``.

    An aggregate rather than a window: the map side already reduces each key to
    one row, so a key with very many versions costs its reducer little. Equal
    versions are settled by the other values, so a rerun gives the same row.
    """
    rest = [c for c in df.columns if c not in (rowkey, version)]
    row = free_name(df.columns, "__row")
    return (
        df.groupBy(named(rowkey))
        .agg(F.max(F.struct(named(version), *map(named, rest))).alias(row))
        .select(named(rowkey), *[F.col(row)[c].alias(c) for c in df.columns if c != rowkey])
    )


def duplicate_keys(dim: DataFrame, rowkey: str = "rowkey") -> DataFrame:
    """Keys held by more than one row. Empty means a lookup cannot multiply main rows."""
    return dim.groupBy(named(rowkey)).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def lookup_enrich(
    main: DataFrame,
    dim: DataFrame,
    key: str,
    fields: Sequence[Field],
    *,
    rowkey: str = "rowkey",
    require: Sequence[str] = (),
    order_by_version: str | None = None,
    partitions: int | None = None,
    broadcast_limit: int | None = None,
    split_null_keys: bool = False,
    hot_keys: Sequence[str] = (),
    hot_share: float | None = None,
    unknown_share: float | None = None,
    stored_salt: StoredSalt | None = None,
) -> DataFrame:
    """Append columns of a keyed dimension to ``main``.

    Every main row comes out once. A null, empty or unknown key gives null
    dimension columns. Output columns: those of ``main`` without ``key``, then
    one nullable string per field, in the order asked for.

    :param fields: ``field`` or ``(field, alias)``; a field may appear twice.
    :param require: aliases that must not be null; other rows are left out.
    :param order_by_version: column of ``dim`` to take the latest row per key
        by. Without it the caller vouches for unique keys (see
        :func:`duplicate_keys`).
    :param partitions: co-locate the keyed main rows in this many partitions.

    The other options and their plans are those of :func:`~keyloom.operators.keyjoin.join_by_key`.
    """
    pairs = _pairs(fields)
    main_columns = [c for c in main.columns if c != key and not (stored_salt and c == stored_salt.column)]
    aliases = [a for _, a in pairs]
    same = str if main.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    taken = [same(c) for c in [*main_columns, *aliases]]
    clash = {a for a in aliases if taken.count(same(a)) > 1}
    if clash:
        raise ValueError(f"output columns named twice: {sorted(clash)}")
    unknown = set(require) - set(aliases)
    if unknown:
        raise ValueError(f"require names no output column: {sorted(unknown)}")

    if not pairs:
        return main.select(*map(named, main_columns))
    names = list(dict.fromkeys(f for f, _ in pairs))
    types = dict(dim.dtypes)
    row_name, version = free_name(main.columns, "__rowkey"), free_name(main.columns, "__version")
    held = {f: free_name(main.columns, f"__dim_{i}") for i, f in enumerate(names)}
    row = as_text(named(rowkey), types[rowkey]).alias(row_name)
    values = [as_text(named(f), types[f]).alias(held[f]) for f in names]
    copies = []
    if stored_salt and stored_salt.right:
        if order_by_version is not None:
            raise ValueError("rows that were copied to their salts have no versions")
        held_salt = free_name(main.columns, "__dim_salt")
        copies = [named(stored_salt.right).alias(held_salt)]
        stored_salt = replace(stored_salt, right=held_salt)
    right = every = dim.select(row, *values, *copies)
    if order_by_version is not None:
        # Keys are text before they are grouped: the join then reuses that shuffle.
        versions = dim.select(row, *values, named(order_by_version).alias(version))
        right = latest_rows(versions, row_name, version).drop(version)
    key_type = dict(main.dtypes)[key]
    if key_type != "string":
        main = main.withColumn(key, as_text(named(key), key_type))
    joined = join_by_key(
        main,
        key,
        right,
        row_name,
        hot_keys=hot_keys,
        hot_share=hot_share,
        split_null_keys=split_null_keys,
        partitions=partitions,
        broadcast_limit=broadcast_limit,
        unknown_share=unknown_share,
        measured=every,  # an upper bound that needs no reduction of versions
        stored_salt=stored_salt,
    )
    out = joined.select(
        *map(named, main_columns),
        *[F.col(held[f]).alias(a) for f, a in pairs],
    )
    for alias in require:
        out = out.where(named(alias).isNotNull())
    return out


def lookup_select(main: DataFrame, dim: DataFrame, key: str, items: Sequence[tuple[str, str, str]], **options) -> DataFrame:
    """:func:`lookup_enrich` for one list of items ``(side, column, alias)``, of either side in any order.

    ``side`` is ``"main"`` or ``"dim"``. Output columns: the main items, then the
    dimension items, each in the order asked for. ``options`` are those of the lookup.
    """
    sides = {side for side, _, _ in items}
    if not sides <= {"main", "dim"}:
        raise ValueError(f"sides are main and dim, got {sorted(sides)}")
    asked = {s: [(column, alias) for side, column, alias in items if side == s] for s in ("main", "dim")}
    held = free_name([alias for _, _, alias in items], "__lookup_key")
    rows = main.select(*(named(c).alias(a) for c, a in asked["main"]), named(key).alias(held))
    return lookup_enrich(rows, dim, held, asked["dim"], **options)
