"""Column expressions; all are built-in Spark expressions, no Python runs per row."""

from rankmatch.functions.names import (
    blank_as_null,
    category,
    first_token,
    null_as_blank,
    strip_markup,
    trim_blanks,
)
from rankmatch.functions.ranks import lowest_name, lowest_rank, presence_mask

__all__ = [
    "blank_as_null",
    "category",
    "first_token",
    "lowest_name",
    "lowest_rank",
    "null_as_blank",
    "presence_mask",
    "strip_markup",
    "trim_blanks",
]
