"""Columns that are worked out once, however often later steps filter on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that filters are not pushed through.

    Catalyst moves a filter below a projection by writing the column's whole
    definition into it, once per mention. For a cheap column that is welcome.
    For a long one it makes plans of a hundred thousand characters, and the work
    is then done twice. A generator of exactly one row is not moved past.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
