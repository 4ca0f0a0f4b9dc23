"""Column helpers (built-in expressions only: they stay inside whole-stage codegen)."""

from changelake.functions.hashing import (
    hash_id,
    hash_pk,
    hash_record,
    null_as_text,
    sha256_hex,
)
from changelake.functions.jsoncols import (
    as_variant,
    json_field,
    money,
    row_json,
    values_text,
    with_default,
)
from changelake.functions.timecols import (
    date_parts,
    date_text,
    epoch_millis,
    epoch_seconds,
    ntz_from_epoch,
    ntz_from_millis,
    processing_time,
    seconds_text,
    wall_clock,
)

__all__ = [
    "as_variant",
    "date_parts",
    "date_text",
    "epoch_millis",
    "epoch_seconds",
    "hash_id",
    "hash_pk",
    "hash_record",
    "json_field",
    "money",
    "ntz_from_epoch",
    "ntz_from_millis",
    "null_as_text",
    "processing_time",
    "row_json",
    "seconds_text",
    "sha256_hex",
    "values_text",
    "wall_clock",
    "with_default",
]
