"""Snapshot-then-changes source.

A keyed store holds the current value of every sensor; a log carries the
changes after it.  Batch form: latest row per key (the snapshot), then every
change at or after the cut.  Streaming form (``streaming/job.py:
seed_from_snapshot``): the snapshot seeds the state of the stateful operator
(``initialState``) and the log is read with ``readStream`` -- file or Kafka
offsets close the gap the original subscribe-after-read left open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str = "key", order: tuple[str, ...] = ("ts", "id")
                   ) -> DataFrame:
    """Latest row per key by ``order``.  A ``max`` over a struct is a
    partial aggregate: each task keeps one row per key before the shuffle,
    so a hot key costs no more than a cold one."""
    others = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others]))
    return df.groupBy(key).agg(best.alias("_m")).select(key, "_m.*")


def snapshot_then_changes(history: DataFrame, cut, key: str = "key",
                          order: tuple[str, ...] = ("ts", "id"), ts: str = "ts") -> DataFrame:
    """Snapshot of ``history`` strictly before ``cut`` (wall-clock text
    or a literal of the column's type) followed by the changes at or after
    it, tagged by ``origin``."""
    at = F.lit(cut).cast("timestamp_ntz") if isinstance(cut, str) else F.lit(cut)
    before = history.where(F.col(ts) < at)
    after = history.where(F.col(ts) >= at)
    snap = latest_per_key(before, key, order).select(*history.columns)
    return (snap.withColumn("origin", F.lit("snapshot"))
            .unionByName(after.withColumn("origin", F.lit("change"))))
