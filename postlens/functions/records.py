"""Column expressions on nested status records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of a created_at string after its weekday, as in "Sat Mar 09 05:06:07 +0000 2019".
CREATED_AT = "MMM d HH:mm:ss Z yyyy"


def created_timestamp(created_at: Column) -> Column:
    """Time of a created_at string, or null where it cannot be parsed. The offset in the string is honoured."""
    return F.try_to_timestamp(F.substring(created_at, F.lit(5), F.length(created_at)), F.lit(CREATED_AT))


def created_epoch(created_at: Column) -> Column:
    """Epoch seconds of a created_at string, or null."""
    return F.unix_timestamp(created_timestamp(created_at))


def names_of(entities: Column) -> Column:
    """An optional array field as an array that is never null."""
    return F.coalesce(entities, F.array().cast("array<string>"))


def original_text(own: Column, reshared: Column) -> Column:
    """The text of the original where a row is a re-share, else its own."""
    return F.coalesce(reshared, own)


def true_flags(names: Iterable[str]) -> Column:
    """Names of the flag columns that are set, in the given order; a null flag counts as not set."""
    return F.array_compact(F.array(*[F.when(flag(F.col(name)), F.lit(name)) for name in names]))


def flag(value: Column) -> Column:
    """A 0/1 or boolean column as a boolean; null is false."""
    return F.coalesce(value.cast("boolean"), F.lit(False))


# Words that people write for a flag.
TRUE_WORDS = ("true", "t", "yes", "y")
FALSE_WORDS = ("false", "f", "no", "n")


def flag_number(value: Column) -> Column:
    """A flag as a whole number, from ``1``, ``1.0``, ``True``, ``yes`` and the like; null where it can't be read."""
    word = F.lower(F.trim(value))
    number = word.try_cast("double")
    whole = F.when(~F.isnan(number) & (F.abs(number) < 1e9) & (number == F.floor(number)), number.cast("int"))
    return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0).otherwise(whole)
