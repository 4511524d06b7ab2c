from sensormill.functions.canonical import (
    digest_by,
    encode_row,
    encode_value,
    fingerprint,
    row_hash,
    with_row_hash,
)
from sensormill.functions.paths import (
    folder_name,
    is_log_id,
    is_numbered_file,
    relative_to,
    stamp_ns,
    strip_scheme,
)
from sensormill.functions.text import format_number
from sensormill.functions.timing import epoch_ns, ns_to_ms

__all__ = [
    "digest_by",
    "encode_row",
    "encode_value",
    "epoch_ns",
    "fingerprint",
    "folder_name",
    "format_number",
    "is_log_id",
    "is_numbered_file",
    "ns_to_ms",
    "relative_to",
    "row_hash",
    "stamp_ns",
    "strip_scheme",
    "with_row_hash",
]
