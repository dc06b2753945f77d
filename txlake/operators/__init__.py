"""DataFrame -> DataFrame operators; each works on batch and streaming frames
unless its docstring says it is batch only."""

from txlake.operators.envelope import (
    decode_envelopes,
    encode_currencies,
    encode_transactions,
    normalize_messages,
    split_rejects,
)
from txlake.operators.route import (
    clean_currencies,
    clean_transactions,
    route_by_type,
    stamp_ingest_metadata,
)
from txlake.operators.dedup import dedup_exact, late_arrivals
from txlake.operators.explore import (
    deep_groups,
    deep_keys,
    exclude_values,
    exclude_sentinel,
    head_k,
    point_lookup,
    semi_filter,
    sequence_number,
    top_k,
)
from txlake.operators.metrics import distinct_values, shape

__all__ = [
    "decode_envelopes",
    "encode_currencies",
    "encode_transactions",
    "normalize_messages",
    "split_rejects",
    "clean_currencies",
    "clean_transactions",
    "route_by_type",
    "stamp_ingest_metadata",
    "dedup_exact",
    "late_arrivals",
    "deep_groups",
    "deep_keys",
    "exclude_values",
    "exclude_sentinel",
    "head_k",
    "point_lookup",
    "semi_filter",
    "sequence_number",
    "top_k",
    "distinct_values",
    "shape",
]
