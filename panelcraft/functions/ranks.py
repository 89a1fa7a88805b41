"""Ranks with averaged ties."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def average_rank(column: str, by: list[str] | None = None, ascending: bool = True,
                 nulls: str = "keep") -> Column:
    """Rank 1..n with ties averaged. ``nulls='keep'`` leaves nulls unranked, ``'bottom'`` ranks them last.

    Meant for report tables (runs, features), whose size is that of a parameter grid.
    """
    key = F.col(column)
    order = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    group = list(by or [])
    spread = Window.partitionBy(*group)
    ties = Window.partitionBy(*group, key)
    rank = F.rank().over(spread.orderBy(order)) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    return rank if nulls == "bottom" else F.when(key.isNotNull(), rank)
