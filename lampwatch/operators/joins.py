"""Joins against configuration-sized tables (rules, rule keys, sensor
dimension).

Such a table is broadcast only after its row count was checked against a
bound; beyond the bound the join is left to a shuffle join (with AQE's
skew-join split).  The check is one count over a config-sized input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of a small side that may be broadcast; a rule-key or dimension row is
# well under 100 bytes, so this keeps a broadcast below ~50 MB
MAX_BROADCAST_ROWS = 500_000


def fits_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``small`` has at most ``max_rows`` rows.  Counted anew each time
    (files under a path may have changed), and only up to the bound."""
    return small.limit(max_rows + 1).count() <= max_rows


def small_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    side = F.broadcast(small) if fits_broadcast(small, max_rows) else small
    return big.join(side, on=on, how=how)
