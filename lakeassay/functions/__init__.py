from lakeassay.functions.rows import (
    active_rows,
    business_columns,
    key_of,
    key_text,
    latest_per_key,
    quoted,
    row_hash,
    with_row_hash,
)

__all__ = [
    "active_rows",
    "business_columns",
    "key_of",
    "key_text",
    "latest_per_key",
    "quoted",
    "row_hash",
    "with_row_hash",
]
