from keyloom.operators.cells import cells_to_wide, decode_cells, empty_cells, latest_cells, wide_to_cells
from keyloom.operators.keyjoin import join_by_key
from keyloom.operators.lookup import duplicate_keys, lookup_enrich, lookup_select
from keyloom.operators.mutate import (
    array_puts,
    delete_row,
    delete_rows,
    put_cell,
    rejected_puts,
    upsert_arrays,
    upsert_cells,
    upsert_column,
)
from keyloom.operators.partition import repartition_by_key, split_by_key
from keyloom.operators.reads import get_cells, get_latest_cells, get_row, get_rows, multi_get, range_scan, range_scan_family, requested

__all__ = [
    "array_puts",
    "cells_to_wide",
    "decode_cells",
    "delete_row",
    "delete_rows",
    "duplicate_keys",
    "empty_cells",
    "get_cells",
    "get_latest_cells",
    "get_row",
    "get_rows",
    "join_by_key",
    "latest_cells",
    "lookup_enrich",
    "lookup_select",
    "multi_get",
    "put_cell",
    "range_scan",
    "range_scan_family",
    "rejected_puts",
    "repartition_by_key",
    "requested",
    "split_by_key",
    "upsert_arrays",
    "upsert_cells",
    "upsert_column",
    "wide_to_cells",
]
