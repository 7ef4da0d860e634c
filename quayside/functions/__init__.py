"""Column expressions; every one is a composition of built-in Spark functions."""

from quayside.functions.scalar import (
    bits,
    convert,
    date_from,
    delimited,
    digest,
    epoch_nanos,
    hex_draw,
    hmac_pads,
    id_text,
    keyed_digest,
    month_text,
    named,
    pick,
)

__all__ = [
    "bits",
    "convert",
    "date_from",
    "delimited",
    "digest",
    "epoch_nanos",
    "hex_draw",
    "hmac_pads",
    "id_text",
    "keyed_digest",
    "month_text",
    "named",
    "pick",
]
