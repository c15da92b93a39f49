"""Column-returning helpers; everything here stays inside Spark expressions unless noted."""

from spanweave.functions.canonical import (
    canonical_object,
    json_string,
    pairs_json,
    sha256_hex,
    unwrap_record,
)
from spanweave.functions.geometry import box_area, box_iou, point_in_box
from spanweave.functions.redaction import detect_token, redact, redact_count
from spanweave.functions.timecode import (
    fmt_ms,
    ms_to_samples,
    pct,
    samples_to_ms,
    seconds_to_ms,
    ticks_to_ms,
    utc_stamp,
)
from spanweave.functions.vectors import (
    cosine,
    dot,
    feature_frames,
    is_target,
    l2_norm,
    l2_normalize,
    masked_mean,
    vector_sha256,
)

__all__ = [
    "box_area", "box_iou", "canonical_object", "cosine", "detect_token", "dot", "feature_frames",
    "fmt_ms", "is_target", "json_string", "l2_norm", "l2_normalize", "masked_mean",
    "ms_to_samples", "pairs_json", "pct", "point_in_box", "redact", "redact_count",
    "samples_to_ms", "seconds_to_ms", "sha256_hex", "ticks_to_ms", "unwrap_record", "utc_stamp",
    "vector_sha256",
]
