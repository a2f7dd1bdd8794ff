from keyloom.sinks.compact import compact_cells, compacted_cells, versions_left
from keyloom.sinks.keyed import read_key_range, save_bucketed, write_keyed, write_manifest
from keyloom.sinks.ranged import delete_ranged, ranged_rows, ranged_scan, rewrite_ranges, save_ranged, upsert_ranged_cells, upsert_ranged_column
from keyloom.sinks.salted import lookup_salted, save_salted, save_salted_dimension
from keyloom.sinks.tables import append, create_table_as, recreate_table

__all__ = [
    "append",
    "compact_cells",
    "compacted_cells",
    "create_table_as",
    "delete_ranged",
    "lookup_salted",
    "ranged_rows",
    "ranged_scan",
    "read_key_range",
    "recreate_table",
    "rewrite_ranges",
    "save_bucketed",
    "save_ranged",
    "save_salted",
    "save_salted_dimension",
    "upsert_ranged_cells",
    "upsert_ranged_column",
    "versions_left",
    "write_keyed",
    "write_manifest",
]
