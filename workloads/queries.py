"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import keyloom as kl
from keyloom.functions import decode_text, encode_text, format_datetime, nullif_empty
from keyloom.plans import BROADCAST_LIMIT, HOT_SHARE, UNKNOWN_SHARE
from workloads import fixtures as fx
from workloads.scratch import new_table, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

MAIN_COLUMNS = [("o_orderkey", "order_code"), "o_totalprice"]
DIM_FIELDS = [("c_name", "nm"), ("c_mktsegment", "seg")]
SINK_COLUMNS = "order_code BIGINT, o_totalprice DOUBLE, nm STRING, seg STRING"
PLACEMENT_SHARE = 0.1

# Plan by measurement: broadcast a small dimension, else keep keyless, hot and many unknown rows out of the shuffle.
MEASURED = {"broadcast_limit": BROADCAST_LIMIT, "split_null_keys": True, "hot_share": HOT_SHARE, "unknown_share": UNKNOWN_SHARE}
# For dimensions that are themselves aggregates: no measuring run, adaptive execution broadcasts.
SPLIT = {"split_null_keys": True, "hot_share": HOT_SHARE}

SQL_TEXT = """
    SELECT orders.o_orderkey AS order_code,
           orders.o_totalprice,
           date_format(orders.o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS ordered_at,
           customers.c_name AS nm,
           customers.c_mktsegment AS seg
    FROM keyloom_orders orders
    LEFT JOIN keyloom_customers customers
           ON orders.customer_index_rowkey_id = customers.rowkey
    WHERE customers.c_mktsegment IS NOT NULL
"""


def _main(spark, sf_dir, columns=MAIN_COLUMNS):
    return kl.project_main(fx.main_m(spark, sf_dir), columns, fx.KEY)


def main_projection(spark, sf_dir):
    return kl.project_main(fx.table(spark, sf_dir, "orders"), [*MAIN_COLUMNS, "o_orderpriority"])


def lookup_left(spark, sf_dir):
    """Flagship. The plan follows the measured size of the dimension."""
    return kl.lookup_enrich(_main(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, **MEASURED)


def lookup_not_null(spark, sf_dir):
    return kl.lookup_enrich(_main(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, require=["seg"], **MEASURED)


def lookup_two_aliases(spark, sf_dir):
    return kl.lookup_enrich(
        _main(spark, sf_dir),
        fx.dim_k(spark, sf_dir),
        fx.KEY,
        [("c_name", "a"), ("c_name", "b")],
        **MEASURED,
    )


def lookup_no_fields(spark, sf_dir):
    return kl.lookup_enrich(_main(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, [])


def lookup_column_order(spark, sf_dir):
    """One list that mixes the two sides; main columns come first all the same."""
    items = [("main", "o_orderkey", "order_code"), ("dim", "c_name", "nm"), ("main", "o_totalprice", "price"), ("dim", "c_mktsegment", "seg")]
    return kl.lookup_select(fx.main_m(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, items, **MEASURED)


def lookup_string_typed(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer")
    return kl.lookup_enrich(
        _main(spark, sf_dir), customers, fx.KEY, [("c_nationkey", "n")], rowkey="c_custkey", **MEASURED
    )


def lookup_sql(spark, sf_dir):
    fx.main_m(spark, sf_dir).createOrReplaceTempView("keyloom_orders")
    kl.register_dimension(fx.dim_k(spark, sf_dir), "keyloom_customers")
    return spark.sql(SQL_TEXT)


def lookup_date_format(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fx.text("l_orderkey").alias("order_index_rowkey_id")
    )
    raw = kl.lookup_enrich(
        lines, fx.dim_d(spark, sf_dir), "order_index_rowkey_id", [("submit_time", "raw_time")], **MEASURED
    )
    return raw.withColumn("review_time", format_datetime(F.col("raw_time")))


def lookup_skew_split(spark, sf_dir):
    return kl.lookup_enrich(
        _main(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, split_null_keys=True, partitions=int(spark.conf.get("spark.sql.shuffle.partitions"))
    )


def lookup_hot_key(spark, sf_dir):
    main = kl.project_main(fx.main_h(spark, sf_dir), MAIN_COLUMNS, fx.KEY)
    return kl.lookup_enrich(
        main, fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, split_null_keys=True, hot_share=0.01
    )


def lookup_versioned(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", fx.text("c_custkey").alias("orders_index_rowkey_id")
    )
    return kl.lookup_enrich(
        customers,
        fx.table(spark, sf_dir, "orders"),
        "orders_index_rowkey_id",
        [("o_orderstatus", "last_status"), ("o_orderpriority", "last_priority")],
        rowkey="o_custkey",
        order_by_version="o_orderdate",
        **SPLIT,
    )


def lookup_cells_dimension(spark, sf_dir):
    """The dimension is a versioned cell table; its shuffle by row key serves the join as well."""
    dim = kl.cells_to_wide(fx.cells_e(spark, sf_dir), ["click", "purchase"])
    return kl.lookup_enrich(
        _main(spark, sf_dir), dim, fx.KEY, [("click", "last_click"), ("purchase", "last_purchase")], **SPLIT
    )


def _placement(spark, main):
    """Rows and partitions per key; keyless rows and hot keys are spread on purpose and count 0 partitions."""
    counts = main.select(nullif_empty(F.col(fx.KEY)).alias("key")).where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    keyed = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = [r["key"] for r in counts.where(F.col("n") >= PLACEMENT_SHARE * keyed).collect()]  # at most 1 / share keys
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = kl.repartition_by_key(main, fx.KEY, partitions, hot)
    key = F.col("key")
    together = key.isNotNull() & ~key.isin(hot)
    return (
        placed.select(nullif_empty(F.col(fx.KEY)).alias("key"), F.spark_partition_id().alias("part"))
        .groupBy("key", "part")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.sum("n").alias("n_rows"), F.count(F.when(together, F.col("part"))).alias("n_parts"))
    )


def repartition_by_key(spark, sf_dir):
    return _placement(spark, fx.main_m(spark, sf_dir))


def repartition_hot_key(spark, sf_dir):
    return _placement(spark, fx.main_h(spark, sf_dir))


def get_row(spark, sf_dir):
    """By a native string key, so that the equality reaches the scan."""
    return kl.get_row(fx.named_customers(spark, sf_dir), "Customer#000000017")


def get_row_latest(spark, sf_dir):
    """By a native string key, so that the equality reaches the scan."""
    return kl.latest_cells(kl.get_row(fx.cells_t(spark, sf_dir), "click"))


def get_cells(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "supplier").select(fx.text("s_suppkey").alias("rowkey"))
    return kl.get_cells(
        fx.dim_k(spark, sf_dir), keys, ["c_name", "c_mktsegment"], broadcast_limit=BROADCAST_LIMIT
    )


def get_latest_cells(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "supplier").select(fx.text("s_suppkey").alias("rowkey"))
    return kl.get_latest_cells(fx.cells_e(spark, sf_dir), keys, ["click", "purchase"], broadcast_limit=BROADCAST_LIMIT)


def multi_get(spark, sf_dir):
    requests = fx.main_m(spark, sf_dir).select(F.col("o_orderkey").alias("pos"), F.col(fx.KEY).alias("rowkey"))
    return kl.multi_get(requests, fx.dim_k(spark, sf_dir), **MEASURED)


def range_scan(spark, sf_dir):
    """By a native string key, so that both bounds reach the scan."""
    return kl.range_scan(fx.branded_parts(spark, sf_dir), *fx.BRAND_RANGE)


def range_scan_family(spark, sf_dir):
    return kl.range_scan_family(fx.cells_b(spark, sf_dir), "f2", *fx.BRAND_RANGE)


def cells_latest(spark, sf_dir):
    return kl.latest_cells(fx.cells_e(spark, sf_dir))


def cells_to_wide(spark, sf_dir):
    return kl.cells_to_wide(fx.cells_e(spark, sf_dir), ["click", "error", "purchase", "signup", "view"])


def cell_decode(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", encode_text(F.col("text")).alias("bytes"))
    return documents.select("doc_id", decode_text(F.col("bytes")).alias("text"))


def cells_decode(spark, sf_dir):
    cells = fx.cells_e(spark, sf_dir)
    held = cells.select(*[encode_text(F.col(c)).alias(c) if t == "string" else c for c, t in cells.dtypes])
    return kl.decode_cells(held)


def upsert_column(spark, sf_dir):
    return kl.upsert_column(fx.dim_k(spark, sf_dir), fx.puts_p(spark, sf_dir), "c_mktsegment")


def upsert_column_small(spark, sf_dir):
    """Same upsert, planned without a shuffle of the base when the puts are measured small."""
    return kl.upsert_column(
        fx.dim_k(spark, sf_dir), fx.puts_p(spark, sf_dir), "c_mktsegment", broadcast_limit=BROADCAST_LIMIT
    )


def upsert_arrays(spark, sf_dir):
    return kl.upsert_arrays(fx.cells_c(spark, sf_dir), fx.puts_a(spark, sf_dir), "f1").drop("ts")


def upsert_arrays_rejected(spark, sf_dir):
    return kl.rejected_puts(fx.puts_a(spark, sf_dir)).select("rowkey", F.size("values").alias("n_values"))


def upsert_cells(spark, sf_dir):
    return kl.upsert_cells(fx.cells_c(spark, sf_dir), fx.puts_p_cells(spark, sf_dir)).drop("ts")


def upsert_cells_latest(spark, sf_dir):
    """Same upsert on a base that holds one version per cell: a join by cell."""
    return kl.upsert_cells(fx.cells_c(spark, sf_dir), fx.puts_p_cells(spark, sf_dir), base_is_latest=True).drop("ts")


def upsert_cells_small(spark, sf_dir):
    """Same upsert, planned without a shuffle of untouched cells when the puts are measured small."""
    return kl.upsert_cells(
        fx.cells_c(spark, sf_dir),
        fx.puts_p_cells(spark, sf_dir),
        base_is_latest=True,
        broadcast_limit=BROADCAST_LIMIT,
    ).drop("ts")


def delete_rows(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "supplier").select(fx.text("s_suppkey").alias("rowkey"))
    return kl.delete_rows(fx.dim_k(spark, sf_dir), keys, broadcast_limit=BROADCAST_LIMIT)


def delete_rows_cells(spark, sf_dir):
    keys = fx.table(spark, sf_dir, "supplier").select(fx.text("s_suppkey").alias("rowkey"))
    return kl.delete_rows(fx.cells_e(spark, sf_dir), keys, broadcast_limit=BROADCAST_LIMIT, hot_share=HOT_SHARE)


def put_cell(spark, sf_dir):
    return kl.put_cell(fx.cells_c(spark, sf_dir), "7", "f2", "c_mktsegment", "VIP", fx.PUT_TS).drop("ts")


def delete_row(spark, sf_dir):
    return kl.delete_row(fx.dim_k(spark, sf_dir), "7")


def get_latest_cells_shuffled(spark, sf_dir):
    """Same read, planned for keys that are not measured: one shuffle of the cells."""
    keys = fx.table(spark, sf_dir, "supplier").select(fx.text("s_suppkey").alias("rowkey"))
    return kl.get_latest_cells(fx.cells_e(spark, sf_dir), keys, ["click", "purchase"])


def write_keyed_read(spark, sf_dir):
    """Parts written in key order, and a key range read from there."""
    path = f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}"
    kl.write_keyed(fx.branded_parts(spark, sf_dir), path)
    return kl.range_scan(spark.read.parquet(path), *fx.BRAND_RANGE)


def read_key_range(spark, sf_dir):
    """The same range by the manifest: files without such keys are not opened."""
    path = f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}"
    kl.write_keyed(fx.branded_parts(spark, sf_dir), path, partitions=8)
    return kl.read_key_range(spark, path, *fx.BRAND_RANGE)


def multi_get_few(spark, sf_dir):
    """Few requests of a table without order: its Bloom filters tell which row groups to read."""
    path = f"{shared_dir(spark)}/bloom-{uuid.uuid4().hex}"
    kl.write_keyed(fx.named_customers(spark, sf_dir), path, sort=False, keys_per_file=100_000)
    return kl.multi_get(fx.requests_q(spark, sf_dir), spark.read.parquet(path), few_keys=100)


def lookup_unknown_keys(spark, sf_dir):
    """Main rows that a bitmap of the dimension's keys shows to be unknown stay out of the join."""
    return kl.lookup_enrich(_main(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, unknown_share=0.1)


def lookup_unknown_not_null(spark, sf_dir):
    """The same with a required field: such rows are dropped before the join."""
    return kl.lookup_enrich(_main(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, require=["seg"], unknown_share=0.1)


def lookup_view_sql(spark, sf_dir):
    """SQL text on a view that holds the salted lookup of a versioned dimension."""
    main = kl.project_main(fx.main_h(spark, sf_dir), MAIN_COLUMNS, fx.KEY)
    orders = fx.table(spark, sf_dir, "orders").select(fx.text("o_custkey").alias("rowkey"), "o_orderdate", "o_orderpriority")
    kl.register_lookup(main, orders, "keyloom_view", fx.KEY, [("o_orderpriority", "last_priority")], order_by_version="o_orderdate", split_null_keys=True, hot_share=0.01)
    return spark.sql("SELECT order_code, upper(last_priority) AS priority, o_totalprice FROM keyloom_view WHERE last_priority IS NOT NULL AND o_totalprice > 1000")


def ranged_upsert(spark, sf_dir):
    """Cells in key ranges: an upsert and a delete in place, each of the ranges it touches, then all cells."""
    name, path = new_table(spark, "ranged")
    kl.save_ranged(fx.cells_c(spark, sf_dir), name, 8, path=path)
    kl.upsert_ranged_cells(spark, name, fx.puts_p_cells(spark, sf_dir))
    gone = fx.table(spark, sf_dir, "supplier").select(fx.text("s_suppkey").alias("rowkey"))
    kl.delete_ranged(spark, name, gone)
    return kl.ranged_rows(spark, name).drop("ts")


def _salted(spark, sf_dir):
    """The main table with a hot key, stored with its salts: name, buckets."""
    name, path = new_table(spark, "salted")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kl.save_salted(kl.project_main(fx.main_h(spark, sf_dir), MAIN_COLUMNS, fx.KEY), name, buckets, fx.KEY, path=path)
    return name, buckets


def lookup_salted(spark, sf_dir):
    """A main table stored by key and salt meets the dimension without being shuffled."""
    name, _ = _salted(spark, sf_dir)
    return kl.lookup_salted(spark, name, fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS)


def lookup_salted_both(spark, sf_dir):
    """The dimension stored to match as well: neither side is shuffled."""
    name, buckets = _salted(spark, sf_dir)
    dim, path = new_table(spark, "salted_dim")
    kl.save_salted_dimension(fx.dim_k(spark, sf_dir), dim, name, buckets, path=path)
    return kl.lookup_salted(spark, name, spark.table(dim), fx.KEY, DIM_FIELDS, require=["seg"])


def _compacted(spark, cells):
    name, path = new_table(spark, "compact")
    kl.compact_cells(cells, name, int(spark.conf.get("spark.sql.shuffle.partitions")), path=path)
    return name


def cells_compacted(spark, sf_dir):
    """The latest cells, read from a compacted table by a plain scan."""
    return kl.compacted_cells(spark, _compacted(spark, fx.cells_e(spark, sf_dir)))


def cells_compacted_wide(spark, sf_dir):
    """Columns made of the rows of a compacted table, where they are."""
    cells = kl.compacted_cells(spark, _compacted(spark, fx.cells_e(spark, sf_dir)))
    return kl.cells_to_wide(cells, ["click", "error", "purchase", "signup", "view"])


def cells_compacted_delta(spark, sf_dir):
    """Puts merged with a compacted table as it is read."""
    name = _compacted(spark, fx.cells_c(spark, sf_dir))
    return kl.compacted_cells(spark, name, fx.puts_p_cells(spark, sf_dir)).drop("ts")


def _empty_sink(spark, kind):
    name, path = new_table(spark, kind)
    spark.sql(f"CREATE TABLE {name} ({SINK_COLUMNS}) USING parquet LOCATION '{path}'")
    return name


def sink_append(spark, sf_dir):
    sink = _empty_sink(spark, "append")
    rows = lookup_left(spark, sf_dir)
    kl.append(rows, sink)
    kl.append(rows, sink)
    return spark.table(sink)


def sink_append_by_name(spark, sf_dir):
    sink = _empty_sink(spark, "by_name")
    kl.append(lookup_not_null(spark, sf_dir).select("seg", "nm", "o_totalprice", "order_code"), sink, by_name=True)
    return spark.table(sink)


def sink_ctas(spark, sf_dir):
    name, path = new_table(spark, "ctas")
    kl.create_table_as(lookup_not_null(spark, sf_dir), name, path=path)
    return spark.table(name)


def sink_recreate(spark, sf_dir):
    name, path = new_table(spark, "recreate")
    kl.create_table_as(main_projection(spark, sf_dir), name, path=path)
    kl.recreate_table(lookup_not_null(spark, sf_dir), name, path=path)
    return spark.table(name)


def job_end_to_end(spark, sf_dir):
    sink = _empty_sink(spark, "job")
    kl.run_enrichment(
        spark,
        fx.main_m(spark, sf_dir),
        fx.dim_k(spark, sf_dir),
        fx.KEY,
        DIM_FIELDS,
        columns=MAIN_COLUMNS,
        require=["seg"],
        sink=sink,
    )
    return spark.table(sink)


def sink_append_even(spark, sf_dir):
    sink = _empty_sink(spark, "even")
    kl.append(lookup_left(spark, sf_dir), sink, even_files=True)
    return spark.table(sink)


def job_run_id(spark, sf_dir):
    """The job run twice under one id leaves its rows once."""
    name, path = new_table(spark, "runs")
    spark.sql(f"CREATE TABLE {name} ({SINK_COLUMNS}, run_id STRING) USING parquet PARTITIONED BY (run_id) LOCATION '{path}'")
    for _ in range(2):
        kl.run_enrichment(
            spark, fx.main_m(spark, sf_dir), fx.dim_k(spark, sf_dir), fx.KEY, DIM_FIELDS, columns=MAIN_COLUMNS, require=["seg"], sink=name, run_id="first"
        )
    return spark.table(name)


def job_sql(spark, sf_dir):
    sink = _empty_sink(spark, "job_sql")
    fx.main_m(spark, sf_dir).createOrReplaceTempView("keyloom_orders")
    kl.register_dimension(fx.dim_k(spark, sf_dir), "keyloom_customers")
    text = """
        SELECT orders.o_orderkey AS order_code, orders.o_totalprice, customers.c_name AS nm, customers.c_mktsegment AS seg
        FROM keyloom_orders orders
        LEFT JOIN keyloom_customers customers ON orders.customer_index_rowkey_id = customers.rowkey
        WHERE customers.c_mktsegment IS NOT NULL
    """
    kl.run_sql_enrichment(spark, text, sink=sink)
    return spark.table(sink)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        main_projection,
        lookup_left,
        lookup_not_null,
        lookup_two_aliases,
        lookup_no_fields,
        lookup_column_order,
        lookup_string_typed,
        lookup_sql,
        lookup_date_format,
        lookup_skew_split,
        lookup_hot_key,
        lookup_versioned,
        lookup_cells_dimension,
        repartition_by_key,
        repartition_hot_key,
        get_row,
        get_row_latest,
        get_cells,
        get_latest_cells,
        multi_get,
        range_scan,
        range_scan_family,
        cells_latest,
        cells_to_wide,
        cell_decode,
        cells_decode,
        upsert_column,
        upsert_column_small,
        upsert_arrays,
        upsert_arrays_rejected,
        upsert_cells,
        upsert_cells_latest,
        upsert_cells_small,
        put_cell,
        delete_row,
        get_latest_cells_shuffled,
        write_keyed_read,
        read_key_range,
        multi_get_few,
        lookup_unknown_keys,
        lookup_unknown_not_null,
        lookup_view_sql,
        ranged_upsert,
        lookup_salted,
        lookup_salted_both,
        cells_compacted,
        cells_compacted_wide,
        cells_compacted_delta,
        sink_append_even,
        job_run_id,
        delete_rows,
        delete_rows_cells,
        sink_append,
        sink_append_by_name,
        sink_ctas,
        sink_recreate,
        job_end_to_end,
        job_sql,
    )
}
