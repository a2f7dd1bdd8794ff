from keyloom.plans.keyfilter import UNKNOWN_SHARE, KeyFilter, key_filter
from keyloom.plans.settings import SETTINGS, apply_settings
from keyloom.plans.sizing import BROADCAST_LIMIT, fits_in_broadcast, measured_bytes, surely_larger
from keyloom.plans.skew import HOT_SHARE, KeyShares, find_hot_keys, key_shares

__all__ = [
    "BROADCAST_LIMIT",
    "HOT_SHARE",
    "SETTINGS",
    "UNKNOWN_SHARE",
    "KeyFilter",
    "KeyShares",
    "apply_settings",
    "find_hot_keys",
    "fits_in_broadcast",
    "key_filter",
    "key_shares",
    "measured_bytes",
    "surely_larger",
]
