"""Column -> Column functions (all JVM-side built-ins, no Python UDFs)."""

from threadloom.functions.text import (  # noqa: F401
    PY_WHITESPACE, normalize_ws, strip_ws, token_count, length_code,
    hash_bucket_hex,
)
