"""Inputs of the registered queries, derived from the given tables (see FIXTURES.md).

Each fixture is a DataFrame here and the same rows as SQL text in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom import wide_to_cells

KEY = "customer_index_rowkey_id"
CELL_FAMILIES = {"c_name": "f1", "c_mktsegment": "f2"}
NAMED = "select c_name as rowkey, c_acctbal, c_mktsegment from customer"
BRANDED = "select p_brand as rowkey, p_partkey, p_name, p_type from part"
BRAND_RANGE = ("Brand#12", "Brand#13")  # two of 25 brands, whatever the scale
BRAND_FAMILIES = {"p_name": "f1", "p_type": "f2"}
BASE_TS = "2024-01-01 00:00:00"
PUT_TS = "2024-02-01 00:00:00"

SQL = {
    # Main table: keys null, empty, unknown and known.
    "M": """
        select o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
               case when o_orderkey % 10 = 0 then null
                    when o_orderkey % 10 = 1 then ''
                    when o_orderkey % 10 = 2 then concat('missing-', cast(o_custkey as varchar))
                    else cast(o_custkey as varchar) end as customer_index_rowkey_id
        from orders""",
    # Main table with a hot key: a third of all rows ask for key '7'.
    "H": """
        select o_orderkey, o_totalprice,
               case when o_orderstatus = 'F' then '7'
                    when o_orderpriority = '1-URGENT' then null
                    when o_orderpriority = '2-HIGH' then ''
                    else cast(o_custkey as varchar) end as customer_index_rowkey_id
        from orders""",
    # Keyed dimension: empty names for nation 0, no segment for HOUSEHOLD.
    "K": """
        select cast(c_custkey as varchar) as rowkey,
               case when c_nationkey = 0 then '' else c_name end as c_name,
               nullif(c_mktsegment, 'HOUSEHOLD') as c_mktsegment
        from customer""",
    # Dimension with date text, unreadable for pending orders.
    "D": """
        select cast(o_orderkey as varchar) as rowkey,
               case when o_orderstatus = 'P' then 'n/a'
                    else cast(cast(o_orderdate as date) as varchar) end as submit_time
        from orders""",
    # Versioned cells: one cell per user and event type, one version per event.
    "E": """
        select cast(user_id as varchar) as rowkey, 'f1' as family, event_type as qualifier, ts, props as value
        from events""",
    # Versioned cells by event type, a native string key: one cell per user.
    "T": """
        select event_type as rowkey, 'f1' as family, cast(user_id as varchar) as qualifier, ts, props as value
        from events""",
    # Cells of parts by brand, a native string key, in two families.
    "B": f"""
        select p_brand as rowkey, 'f1' as family, 'p_name' as qualifier, timestamp '{BASE_TS}' as ts, p_name as value
        from part where p_name is not null
        union all
        select p_brand, 'f2', 'p_type', timestamp '{BASE_TS}', p_type from part where p_type is not null""",
    # Requests for one customer by name for each nation.
    "Q": """
        select n_nationkey as pos, concat('Customer#', right(concat('00000000', cast(n_nationkey as varchar)), 9)) as rowkey
        from nation""",
    # Cells of K, in two families.
    "C": f"""
        select rowkey, 'f1' as family, 'c_name' as qualifier, timestamp '{BASE_TS}' as ts, c_name as value
        from K where c_name is not null
        union all
        select rowkey, 'f2', 'c_mktsegment', timestamp '{BASE_TS}', c_mktsegment
        from K where c_mktsegment is not null""",
    # Puts: overdrawn customers become VIP, suppliers are new keys.
    "P": """
        select cast(c_custkey as varchar) as rowkey, 'VIP' as c_mktsegment from customer where c_acctbal < 0
        union all
        select concat('s-', cast(s_suppkey as varchar)), s_name from supplier""",
    # Array puts: the arrays of overdrawn suppliers differ in length.
    "A": f"""
        select cast(s_suppkey as varchar) as rowkey, ['c_name', 'c_mktsegment'] as columns,
               case when s_acctbal < 0 then [s_name] else [s_name, 'VIP'] end as values,
               timestamp '{PUT_TS}' as ts
        from supplier""",
}


def with_sql(*names: str) -> str:
    """``WITH`` clause that defines the named fixtures."""
    return "with " + ",\n".join(f"{name} as ({SQL[name]})" for name in names) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str):
    return F.col(column).cast("string")


def ntz(value: str):
    return F.lit(value).cast("timestamp_ntz")


def main_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.col("o_orderkey") % 10
    key = (
        F.when(last == 0, None)
        .when(last == 1, "")
        .when(last == 2, F.concat(F.lit("missing-"), text("o_custkey")))
        .otherwise(text("o_custkey"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", key.alias(KEY)
    )


def main_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (
        F.when(F.col("o_orderstatus") == "F", "7")
        .when(F.col("o_orderpriority") == "1-URGENT", None)
        .when(F.col("o_orderpriority") == "2-HIGH", "")
        .otherwise(text("o_custkey"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", key.alias(KEY))


def dim_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("rowkey"),
        F.when(F.col("c_nationkey") == 0, "").otherwise(F.col("c_name")).alias("c_name"),
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("c_mktsegment"),
    )


def dim_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date").cast("string")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("rowkey"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(day).alias("submit_time"),
    )


def cells_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("rowkey"),
        F.lit("f1").alias("family"),
        F.col("event_type").alias("qualifier"),
        "ts",
        F.col("props").alias("value"),
    )


def cells_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_cells(dim_k(spark, sf_dir).withColumn("ts", ntz(BASE_TS)), CELL_FAMILIES, ts="ts")


def puts_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    vip = (
        table(spark, sf_dir, "customer")
        .where("c_acctbal < 0")
        .select(text("c_custkey").alias("rowkey"), F.lit("VIP").alias("c_mktsegment"))
    )
    new = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s-"), text("s_suppkey")).alias("rowkey"), F.col("s_name").alias("c_mktsegment")
    )
    return vip.unionByName(new)


def puts_p_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return puts_p(spark, sf_dir).select(
        "rowkey",
        F.lit("f2").alias("family"),
        F.lit("c_mktsegment").alias("qualifier"),
        ntz(PUT_TS).alias("ts"),
        F.col("c_mktsegment").alias("value"),
    )


def puts_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("rowkey"),
        F.array(F.lit("c_name"), F.lit("c_mktsegment")).alias("columns"),
        F.when(F.col("s_acctbal") < 0, F.array("s_name"))
        .otherwise(F.array(F.col("s_name"), F.lit("VIP")))
        .alias("values"),
        ntz(PUT_TS).alias("ts"),
    )


def named_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by name, a native string key; ``NAMED`` as SQL."""
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("rowkey"), "c_acctbal", "c_mktsegment")


def cells_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("rowkey"),
        F.lit("f1").alias("family"),
        text("user_id").alias("qualifier"),
        "ts",
        F.col("props").alias("value"),
    )


def branded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by brand, a native string key; ``BRANDED`` as SQL."""
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("rowkey"), "p_partkey", "p_name", "p_type")


def cells_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_cells(branded_parts(spark, sf_dir).withColumn("ts", ntz(BASE_TS)), BRAND_FAMILIES, ts="ts")


def requests_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr("right(concat('00000000', cast(n_nationkey as string)), 9)")
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), F.concat(F.lit("Customer#"), number).alias("rowkey"))
