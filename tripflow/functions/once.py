"""Evaluation of costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add (or replace) columns through a generator of one row.

    A filter on a plain projected column is pushed below the projection, where every condition
    repeats the parsing it depends on. It is not pushed below a generator, so regular expressions,
    casts and JSON parsing inside ``columns`` run once per row whatever is filtered later.

    The values are made by a projection below the generator: a generator whose stage is too large to be compiled
    evaluates its input expression by expression, a projection is always compiled.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in columns]
    once = "_once"
    while once in kept:
        once = f"_{once}"
    packed = F.struct(*[column.alias(name) for name, column in columns.items()]).alias(once)
    return df.select(*kept, packed).select(*kept, F.inline(F.array(once)))
