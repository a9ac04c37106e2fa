from tabwright.functions.scalars import (
    as_number,
    col_of,
    guarded_ratio,
    hash_bucket,
    hash_uniform,
    is_missing,
    logistic,
    sanitize_identifier,
    seconds_of,
)

__all__ = [
    "as_number",
    "col_of",
    "guarded_ratio",
    "hash_bucket",
    "hash_uniform",
    "is_missing",
    "logistic",
    "sanitize_identifier",
    "seconds_of",
]
