"""Building the equity universe from ranked ticker lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.combine import priority_union


def build_universe(lists: list[DataFrame], col: str = "ticker", pos: str = "pos") -> DataFrame:
    """Lists in priority order to ``dataSymbol``, ``instrumentType`` and their place in the union."""
    return priority_union(lists, col, pos).select(
        F.col("ticker").alias("dataSymbol"), F.lit("EQUITY").alias("instrumentType"), "priority", "pos"
    )
