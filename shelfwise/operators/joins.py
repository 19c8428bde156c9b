"""Join helpers with explicit size discipline.

Spark already chooses broadcast joins from plan statistics and, with AQE,
from measured shuffle sizes.  The helper here is for the case where the caller
knows more than the statistics: a side that is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def semi_join_top(big: DataFrame, top: DataFrame, on, how: str = "left_semi") -> DataFrame:
    """Semi/anti join against a result bounded by construction (``limit k``).

    ``top`` must come from ``orderBy(...).limit(k)`` or another operator that
    caps its size, so broadcasting it needs no check.
    """
    return big.join(F.broadcast(top), on, how)
