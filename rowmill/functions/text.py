"""String columns (STR1-STR6) and whitespace tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = "[ \\t\\n\\r\\f]+"  # fixed value: the delimiters of a default word-count tokenizer


def repair_coordinate(value: Column, int_chars: int = 2, limit: float = 180.0) -> Column:
    """STR2: drop every dot, put one back after ``int_chars`` characters, read as a double.

    Text that still is no number, or one beyond ``limit`` degrees either way, gives NULL instead of
    failing the job.
    """
    digits = F.regexp_replace(value, "\\.", "")
    repaired = F.concat(
        F.substring(digits, 1, int_chars), F.lit("."), F.substr(digits, F.lit(int_chars + 1))
    )
    degrees = repaired.try_cast("double")
    return F.when(F.abs(degrees) <= limit, degrees)


def pair_key(first: Column, second: Column, sep: str = "-") -> Column:
    """STR4: the same key for (a, b) and (b, a).

    A NULL end makes the comparison unknown, which takes the second branch; ``concat_ws`` then
    skips the NULL, so the other end alone is the key.
    """
    return F.when(first < second, F.concat_ws(sep, first, second)).otherwise(
        F.concat_ws(sep, second, first)
    )


def words(value: Column) -> Column:
    """Whitespace tokens without empty ones."""
    return F.filter(F.split(value, WHITESPACE), lambda token: token != "")


def space_tokens(value: Column) -> Column:
    """Split on every single space; neighbouring spaces give empty tokens."""
    return F.split(value, " ")
