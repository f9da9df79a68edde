from parcelhouse.functions.identifiers import (
    bare_code,
    bids_entities,
    legacy_code,
    pad_zeros,
    session_id,
    subject_code,
)
from parcelhouse.functions.naming import (
    parse_feature_name,
    prefixed,
    strip_dataset_prefix,
)
from parcelhouse.functions.values import (
    adjusted_volume,
    measured_value,
    missing_to_null,
    needed_sources,
    numeric_or_null,
)

__all__ = [
    "adjusted_volume", "bare_code", "bids_entities", "legacy_code", "measured_value",
    "missing_to_null", "needed_sources", "numeric_or_null", "pad_zeros",
    "parse_feature_name", "prefixed", "session_id", "strip_dataset_prefix", "subject_code",
]
