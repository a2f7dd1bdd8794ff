"""Result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from keyloom.functions.keys import named


RUN = "run_id"


def append(df: DataFrame, table: str, *, by_name: bool = False, even_files: bool = False, run_id: str | None = None) -> None:
    """Append to an existing table of any format, by column position or by column name.

    A table that does not exist is an error.

    A second run appends the rows a second time, unless it has a ``run_id``: the table must then be
    partitioned by a last column ``run_id``, and rows of an earlier run of that id, complete or not, are replaced by
    these. Lost executors are covered: the write commits as a whole, and retried tasks leave nothing behind.

    ``even_files`` rebalances the rows before they are written: one more shuffle, after which
    adaptive execution splits large output partitions and joins small ones.
    """
    if run_id is not None:
        if df.sparkSession.table(table).columns[-1] != RUN:
            raise ValueError(f"{table} is not partitioned by {RUN}")
        _replace_run(df.hint("rebalance") if even_files else df, table, by_name, run_id)
        return
    if even_files:
        df = df.hint("rebalance")
    if by_name:
        df.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=df)
    else:
        df.write.insertInto(table)


def _replace_run(df: DataFrame, table: str, by_name: bool, run_id: str) -> None:
    spark = df.sparkSession
    names = spark.table(table).columns[:-1]
    rows = df.select(*map(named, names)) if by_name else df
    if len(rows.columns) != len(names):
        raise ValueError(f"{table} has {len(names)} columns besides {RUN}, the rows {len(rows.columns)}")
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({RUN} = :run) SELECT * FROM {{rows}}", args={"run": run_id}, rows=rows)


def create_table_as(df: DataFrame, table: str, *, path: str | None = None) -> None:
    """Create ``table`` from ``df``; an error if it exists."""
    _writer(df, path).mode("errorifexists").saveAsTable(table)


def recreate_table(df: DataFrame, table: str, *, path: str | None = None) -> None:
    """Drop ``table`` if it exists and create it anew from ``df``, which must not read from it."""
    _writer(df, path).mode("overwrite").saveAsTable(table)


def _writer(df: DataFrame, path: str | None):
    writer = df.write.format("parquet")
    return writer if path is None else writer.option("path", path)
