from seriesloom.functions.identity import channel_or_default, tag_map, tags_from_key, tags_key
from seriesloom.functions.time import (
    to_ts_ns,
    ts_from_datetime,
    ts_from_interval,
    ts_from_iso,
    ts_recombine,
    ts_split_euclid,
    ts_split_trunc,
)
from seriesloom.functions.values import (
    checked_uint64,
    kind_of_array,
    kind_of_scalar,
    same_length,
    struct_to_json,
    u64_wrap,
)

__all__ = [
    "channel_or_default", "tag_map", "tags_from_key", "tags_key",
    "to_ts_ns", "ts_from_datetime", "ts_from_interval", "ts_from_iso", "ts_recombine",
    "ts_split_euclid", "ts_split_trunc",
    "checked_uint64", "kind_of_array", "kind_of_scalar", "same_length", "struct_to_json", "u64_wrap",
]
