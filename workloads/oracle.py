"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from workloads.fixtures import BRAND_RANGE, BRANDED, NAMED, PUT_TS, with_sql

_IN_RANGE = f"rowkey >= '{BRAND_RANGE[0]}' and rowkey < '{BRAND_RANGE[1]}' || '0'"
_MATCH = "left join K on nullif(M.customer_index_rowkey_id, '') = K.rowkey"
_MK = with_sql("M", "K")

_LEFT_BODY = f"""
    select M.o_orderkey as order_code, M.o_totalprice, K.c_name as nm, K.c_mktsegment as seg
    from M {_MATCH}"""
_LEFT = _MK + _LEFT_BODY
_NOT_NULL = _LEFT + " where K.c_mktsegment is not null"

_UPSERT_COLUMN = (
    with_sql("K", "P")
    + """
    select coalesce(K.rowkey, P.rowkey) as rowkey, K.c_name, coalesce(P.c_mktsegment, K.c_mktsegment) as c_mktsegment
    from K full join P on K.rowkey = P.rowkey"""
)


def _latest(source: str) -> str:
    return f"""
    select rowkey, family, qualifier, value from ({source})
    qualify row_number() over (partition by rowkey, family, qualifier order by ts desc) = 1"""


_UPSERT_CELLS = with_sql("K", "C", "P") + _latest(
    f"""select * from C
        union all
        select rowkey, 'f2', 'c_mktsegment', timestamp '{PUT_TS}', c_mktsegment from P"""
)

_UPSERT_ARRAYS = with_sql("K", "C", "A") + _latest(
    """select * from C
       union all
       select rowkey, 'f1', columns[i], ts, "values"[i]
       from A, lateral (select unnest(range(1, len(columns) + 1)) as i)
       where len(columns) = len("values")"""
)


def _last(event_type: str, alias: str) -> str:
    return f"arg_max(value, ts) filter (where qualifier = '{event_type}') as {alias}"


def _placement(main: str) -> str:
    """Keyed rows sit in one partition, unless the key has a tenth of them."""
    return (
        with_sql(main)
        + f""", counts as (
            select nullif(customer_index_rowkey_id, '') as key, count(*)::bigint as n_rows from {main} group by 1)
         select key, n_rows,
                (case when key is null or n_rows >= 0.1 * (select sum(n_rows) from counts where key is not null)
                      then 0 else 1 end)::bigint as n_parts
         from counts"""
    )


ORACLE: dict[str, str] = {
    "main_projection": "select o_orderkey as order_code, o_totalprice, o_orderpriority from orders",
    "lookup_left": _LEFT,
    "lookup_not_null": _NOT_NULL,
    "lookup_two_aliases": _MK
    + f"select M.o_orderkey as order_code, M.o_totalprice, K.c_name as a, K.c_name as b from M {_MATCH}",
    "lookup_no_fields": with_sql("M") + "select o_orderkey as order_code, o_totalprice from M",
    "lookup_column_order": _MK
    + f"""select M.o_orderkey as order_code, M.o_totalprice as price, K.c_name as nm, K.c_mktsegment as seg
          from M {_MATCH}""",
    "lookup_string_typed": with_sql("M")
    + """select M.o_orderkey as order_code, M.o_totalprice, cast(c_nationkey as varchar) as n
         from M left join customer on nullif(M.customer_index_rowkey_id, '') = cast(c_custkey as varchar)""",
    "lookup_sql": _MK
    + f"""select M.o_orderkey as order_code, M.o_totalprice,
                 strftime(M.o_orderdate, '%Y-%m-%d %H:%M:%S') as ordered_at, K.c_name as nm, K.c_mktsegment as seg
          from M {_MATCH} where K.c_mktsegment is not null""",
    "lookup_date_format": with_sql("D")
    + """select l_orderkey, l_linenumber, D.submit_time as raw_time,
                strftime(try_cast(D.submit_time as timestamp), '%Y-%m-%d %H:%M:%S') as review_time
         from lineitem left join D on cast(l_orderkey as varchar) = D.rowkey""",
    "lookup_skew_split": _LEFT,
    "lookup_hot_key": with_sql("H", "K")
    + """select H.o_orderkey as order_code, H.o_totalprice, K.c_name as nm, K.c_mktsegment as seg
         from H left join K on nullif(H.customer_index_rowkey_id, '') = K.rowkey""",
    "lookup_versioned": """
        with latest as (
            select o_custkey, o_orderstatus, o_orderpriority from orders
            qualify row_number() over (partition by o_custkey
                                       order by o_orderdate desc, o_orderstatus desc, o_orderpriority desc) = 1)
        select c_custkey, c_name, o_orderstatus as last_status, o_orderpriority as last_priority
        from customer left join latest on c_custkey = o_custkey""",
    "lookup_cells_dimension": with_sql("M", "E")
    + f""", W as (
            select rowkey, {_last("click", "click")}, {_last("purchase", "purchase")} from E group by rowkey)
         select M.o_orderkey as order_code, M.o_totalprice, W.click as last_click, W.purchase as last_purchase
         from M left join W on nullif(M.customer_index_rowkey_id, '') = W.rowkey""",
    "repartition_by_key": _placement("M"),
    "repartition_hot_key": _placement("H"),
    "get_row": f"select * from ({NAMED}) where rowkey = 'Customer#000000017'",
    "get_row_latest": with_sql("T")
    + """select * from T where rowkey = 'click'
         qualify row_number() over (partition by rowkey, family, qualifier order by ts desc, value desc) = 1""",
    "get_cells": with_sql("K")
    + """, keys as (select cast(s_suppkey as varchar) as k from supplier)
         select rowkey, 'c_name' as qualifier, c_name as value from K
         where rowkey in (select k from keys) and c_name is not null
         union all
         select rowkey, 'c_mktsegment', c_mktsegment from K
         where rowkey in (select k from keys) and c_mktsegment is not null""",
    "get_latest_cells": with_sql("E")
    + """select * from E
         where qualifier in ('click', 'purchase') and rowkey in (select cast(s_suppkey as varchar) from supplier)
         qualify row_number() over (partition by rowkey, family, qualifier order by ts desc, value desc) = 1""",
    "multi_get": _MK
    + f"""select M.o_orderkey as pos, M.customer_index_rowkey_id as rowkey, K.c_name, K.c_mktsegment
          from M {_MATCH}""",
    "range_scan": f"select * from ({BRANDED}) where {_IN_RANGE}",
    "range_scan_family": with_sql("B") + f"select * from B where family = 'f2' and {_IN_RANGE}",
    "cells_latest": with_sql("E")
    + """select * from E
         qualify row_number() over (partition by rowkey, family, qualifier order by ts desc, value desc) = 1""",
    "cells_to_wide": with_sql("E")
    + f"""select rowkey, {", ".join(_last(e, e) for e in ("click", "error", "purchase", "signup", "view"))}
          from E group by rowkey""",
    "cell_decode": "select doc_id, decode(encode(text)) as text from documents",
    "cells_decode": with_sql("E") + "select * from E",
    "upsert_column": _UPSERT_COLUMN,
    "upsert_column_small": _UPSERT_COLUMN,
    "upsert_arrays": _UPSERT_ARRAYS,
    "upsert_arrays_rejected": with_sql("A")
    + """select rowkey, len("values")::integer as n_values from A where len(columns) <> len("values")""",
    "upsert_cells": _UPSERT_CELLS,
    "upsert_cells_latest": _UPSERT_CELLS,
    "upsert_cells_small": _UPSERT_CELLS,
    "delete_rows": with_sql("K")
    + "select * from K where rowkey not in (select cast(s_suppkey as varchar) from supplier)",
    "delete_rows_cells": with_sql("E")
    + "select * from E where rowkey not in (select cast(s_suppkey as varchar) from supplier)",
    "sink_append": _MK + f"select * from ({_LEFT_BODY}) union all select * from ({_LEFT_BODY})",
    "sink_append_by_name": _NOT_NULL,
    "sink_ctas": _NOT_NULL,
    "sink_recreate": _NOT_NULL,
    "job_end_to_end": _NOT_NULL,
    "job_sql": _NOT_NULL,
}
ORACLE |= {
    "put_cell": with_sql("K", "C")
    + _latest(f"select * from C union all select '7', 'f2', 'c_mktsegment', timestamp '{PUT_TS}', 'VIP'"),
    "delete_row": with_sql("K") + "select * from K where rowkey is distinct from '7'",
    "get_latest_cells_shuffled": ORACLE["get_latest_cells"],
    "write_keyed_read": ORACLE["range_scan"],
    "read_key_range": ORACLE["range_scan"],
    "multi_get_few": with_sql("Q") + f"select Q.pos, Q.rowkey, N.c_acctbal, N.c_mktsegment from Q left join ({NAMED}) N on Q.rowkey = N.rowkey",
    "lookup_unknown_keys": _LEFT,
    "lookup_unknown_not_null": _NOT_NULL,
    "lookup_view_sql": with_sql("H")
    + """, latest as (
            select cast(o_custkey as varchar) as rowkey, o_orderpriority from orders
            qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderpriority desc) = 1)
         select H.o_orderkey as order_code, upper(latest.o_orderpriority) as priority, H.o_totalprice
         from H join latest on nullif(H.customer_index_rowkey_id, '') = latest.rowkey
         where latest.o_orderpriority is not null and H.o_totalprice > 1000""",
    "ranged_upsert": f"select * from ({_UPSERT_CELLS}) where rowkey not in (select cast(s_suppkey as varchar) from supplier)",
    "lookup_salted": ORACLE["lookup_hot_key"],
    "lookup_salted_both": f"select * from ({ORACLE['lookup_hot_key']}) where seg is not null",
    "cells_compacted": ORACLE["cells_latest"],
    "cells_compacted_wide": ORACLE["cells_to_wide"],
    "cells_compacted_delta": _UPSERT_CELLS,
    "sink_append_even": _LEFT,
    "job_run_id": _MK + f"select *, 'first' as run_id from ({_LEFT_BODY} where K.c_mktsegment is not null)",
}
