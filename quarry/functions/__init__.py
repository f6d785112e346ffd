"""Column-level helpers (pure expressions; no jobs, no UDFs)."""

from quarry.functions.scalars import (  # noqa: F401
    character_key,
    first_digits_int,
    first_value,
    flag,
    iso_instant,
    json_int,
    json_long,
    links,
    percentage,
)
