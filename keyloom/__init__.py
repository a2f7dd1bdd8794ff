"""Keyed enrichment on Spark: lookup joins, keyed cell tables, upserts and deletes."""

from keyloom.operators import *  # noqa: F403
from keyloom.operators import __all__ as _operators
from keyloom.plans import apply_settings, find_hot_keys, fits_in_broadcast, key_shares, measured_bytes
from keyloom.plans.job import run_enrichment, run_sql_enrichment
from keyloom.sinks import *  # noqa: F403
from keyloom.sinks import __all__ as _sinks
from keyloom.sources import project_main, register_dimension, register_lookup

__all__ = [
    *_operators,
    *_sinks,
    "apply_settings",
    "find_hot_keys",
    "fits_in_broadcast",
    "key_shares",
    "measured_bytes",
    "project_main",
    "register_dimension",
    "register_lookup",
    "run_enrichment",
    "run_sql_enrichment",
]
