from keyloom.functions.codec import DATETIME_FORMAT, as_text, decode_text, encode_text, format_datetime
from keyloom.functions.keys import has_key, no_key, nullif_empty, text_key

__all__ = [
    "DATETIME_FORMAT",
    "as_text",
    "decode_text",
    "encode_text",
    "format_datetime",
    "has_key",
    "no_key",
    "nullif_empty",
    "text_key",
]
