"""Identifier checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def int_id(name: str) -> Column:
    """``name`` as INT; a value that does not fit fails the job, also without ANSI mode."""
    col = F.col(name)
    fits = col.between(INT_MIN, INT_MAX) | col.isNull()
    message = F.concat(F.lit(f"{name} does not fit INT: "), col.cast("string"))
    return F.when(fits, col).otherwise(F.raise_error(message)).cast("int").alias(name)
