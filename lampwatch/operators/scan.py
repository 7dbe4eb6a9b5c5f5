"""Skew-safe running scans (last value / running max) per key.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; a key holding a third of the data would then run alone.  Here
each key's timeline is cut into chunks (``chunk`` column, see
:func:`cut_chunks`).  A chunk's effect on a scan is summed up in one value
(the last value, or the maximum, that it holds), and these compose: what a
chunk starts from is the composition of all chunks before it, its *carry*.
The window runs per ``(key, chunk)`` and the carry is filled in beside it, so
the rows themselves are dealt and sorted once, whatever the number of scans.
Results equal the single-partition scan exactly; only the parallelism differs.

Cost: one exchange and sort of the rows by ``(key, chunk)``, which all scans
over them share; per scan one partial aggregate over the dealt rows, one small
window over a row per chunk, and a join of the carries, which are as many as
the cut keys have pieces and broadcast only while that number is in bounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lampwatch.functions.timefns import micros
from lampwatch.operators.joins import MAX_BROADCAST_ROWS, small_join
from lampwatch.session import staged


@dataclass(frozen=True)
class Scan:
    """One running scan.

    kind ``last``: latest non-null ``value`` in scan order (value may be a
    struct).  kind ``max``: running maximum of ``value``.  ``inclusive``
    says whether the current row takes part in its own result."""

    name: str
    kind: str
    value: Column
    inclusive: bool = True


def _contribution(scan: Scan, order: list[str]) -> Column:
    if scan.kind == "last":
        return F.when(scan.value.isNotNull(),
                      F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                               scan.value.alias("v")))
    if scan.kind == "max":
        return scan.value
    raise ValueError(f"unknown scan kind {scan.kind!r}")


def _result(scan: Scan, acc: Column) -> Column:
    return acc.getField("v") if scan.kind == "last" else acc


def join_chunks(df: DataFrame, small: DataFrame, on: list[str], chunked: int, copies: int = 1) -> DataFrame:
    """``df`` left-joined with a table of at most one row per piece of a cut
    key (``chunked`` pieces, ``copies`` of each): broadcast while that bound
    allows it, which leaves ``df`` where it is."""
    side = F.broadcast(small) if chunked * copies <= MAX_BROADCAST_ROWS else small
    return df.join(side, on=on, how="left")


def carry_scan(df: DataFrame, keys: list[str], chunk: str, order: list[str],
               scans: list[Scan], chunked: int = 1, copies: int = 1) -> DataFrame:
    """Adds one column per scan.  ``order`` must start with the column the
    chunks were cut on, so that chunk order agrees with scan order, and the
    order columns of data rows must be non-null.

    ``chunked`` is the number of pieces of all cut keys; 0 (no key was cut,
    every ``chunk`` is 0) skips the carry: plain running windows over
    ``(keys, chunk)``.  ``copies`` bounds the copies of a key's rows under
    different ``keys``.  Either way the window spec is ``partitionBy(keys,
    chunk).orderBy(order)``, so later windows with that spec reuse the
    exchange and the sort."""
    base = Window.partitionBy(*keys, chunk).orderBy(*order)
    incl = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excl = base.rowsBetween(Window.unboundedPreceding, -1)
    if not chunked:
        return df.select(
            "*", *[_result(s, F.max(_contribution(s, order)).over(incl if s.inclusive else excl))
                   .alias(s.name) for s in scans])

    # one summary row per chunk: the state the chunk leaves behind
    tmp = {s.name: f"_s_{s.name}" for s in scans}
    summary = df.groupBy(*keys, chunk).agg(*[F.max(_contribution(s, order)).alias(tmp[s.name]) for s in scans])
    before = (Window.partitionBy(*keys).orderBy(chunk)
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = summary.select(*keys, chunk, *[F.max(tmp[s.name]).over(before).alias(tmp[s.name]) for s in scans])
    # a key that was not cut has no earlier chunk, and no row here
    carry = carry.where(" OR ".join(f"`{c}` IS NOT NULL" for c in tmp.values()))

    local = df.select("*", *[F.max(_contribution(s, order)).over(incl if s.inclusive else excl).alias(s.name)
                             for s in scans])
    out = join_chunks(local, carry, [*keys, chunk], chunked, copies)

    def met(s: Scan) -> Column:
        # what a chunk itself has is later than what it started from
        pick = F.coalesce if s.kind == "last" else F.greatest
        return _result(s, pick(F.col(s.name), F.col(tmp[s.name]))).alias(s.name)
    return out.select(*df.columns, *[met(s) for s in scans])


# rows of one key a window partition holds before the key is cut into time
# chunks (read at call time, so a test can force the chunked path)
ROWS_PER_CHUNK = 1_000_000
# pieces a chunk is cut into at a time
PIECES = 64


def hot_keys(df: DataFrame, key: str, rows_per_chunk: int) -> DataFrame:
    """Keys with more than ``rows_per_chunk`` rows: a partial aggregate, one
    row per key and task before the shuffle."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > rows_per_chunk).select(key))


def assign_chunks(df: DataFrame, key: str, ts: str, rows_per_chunk: int | None = None,
                  out: str = "chunk") -> tuple[DataFrame, bool]:
    """:func:`cut_chunks`, and whether any key was cut."""
    rows, pieces = cut_chunks(df, key, ts, rows_per_chunk, out)
    return rows, pieces > 0


def cut_chunks(df: DataFrame, key: str, ts: str, rows_per_chunk: int | None = None,
               out: str = "chunk") -> tuple[DataFrame, int]:
    """Adds ``out``: 0 for ordinary keys; for hot keys (see :func:`hot_keys`)
    the number of the row's piece of the key's timeline, rising in time.
    Returns the frame and the number of pieces of all hot keys (0: none is hot).

    Pieces are cut at quantiles of the rows, not at equal widths, so a burst
    is cut as finely as its rows need.  Pieces with over twice the target are
    cut again, until none is left that can be cut: only rows that share one
    timestamp stay together whatever their number.  The pieces of round r are
    digits in base ``PIECES + 1``, so numbers of different rounds never meet.

    Whether a key is hot is asked of the data each time (files under a path
    may change): first by a count that stops at the target, which answers for
    small inputs, then by one aggregate.  The cut points are written to the
    shared folder; they are as many as the hot rows have pieces, and joined
    by broadcast only while their count is in bounds."""
    target = rows_per_chunk or ROWS_PER_CHUNK
    plain = df.withColumn(out, F.lit(0).cast("bigint"))
    if df.limit(target + 1).count() <= target:
        return plain, 0
    hot = staged(hot_keys(df, key, target).withColumn("_hot", F.lit(True)), "hot-keys")
    pieces = hot.count()
    if not pieces:
        return plain, 0
    rows = small_join(plain, hot, key, "left")
    us = micros(ts)
    steps = [i / PIECES for i in range(1, PIECES)]
    while True:
        cuts = (rows.where(F.col("_hot")).groupBy(key, out)
                .agg(F.count(F.lit(1)).alias("_n"), F.min(us).alias("_a"), F.max(us).alias("_b"),
                     F.percentile_approx(us, steps, 10 * PIECES).alias("_q"))
                .where((F.col("_n") > 2 * target) & (F.col("_a") < F.col("_b")))
                .select(key, out, F.array_distinct(F.filter("_q", lambda q: q > F.col("_a"))).alias("_q"),
                        "_b"))
        # where one timestamp holds most rows all quantiles may fall on the first: cut off the last
        cuts = cuts.select(key, out, F.when(F.size("_q") > 0, F.col("_q"))
                           .otherwise(F.array("_b")).alias("_q"))
        cuts = staged(cuts, "cuts")
        more = cuts.agg(F.sum(F.size("_q"))).first()[0]
        if not more:
            return rows.drop("_hot"), pieces
        pieces += more
        piece = F.coalesce(F.size(F.filter("_q", lambda q: q <= us)), F.lit(0))
        rows = (small_join(rows, cuts, [key, out], "left")
                .withColumn(out, F.col(out) * (PIECES + 1)
                            + F.when(F.col("_q").isNull(), 0).otherwise(piece)).drop("_q"))

