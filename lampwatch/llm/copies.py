"""Exact dedup with a heavy-hitter split (operator 5, JVM functions only).

Texts are equal when identical after deleting the white space of
``common.SPACE_CLASS``; equality is tested on the SHA-256 of what is left.
Of equal texts the one with the most code points stays, then the smallest
id, then (rows that repeat id and text) the first staged row.

1. One pass over the texts stages a slim row per document: id, digest,
   length.  Texts are read once and never shuffled.
2. A mergeable Misra-Gries frequent-items sketch (``approx_top_k``; bounded
   counters per task, merged on the reduce side) names candidate digests.
   A digest holding more than a 1/``HEAVY_SHARE`` share of the rows is always
   among them: the sketch's error is at most 3.5/``COUNTERS`` of the rows.
3. The candidates (at most ``COUNTERS`` rows of 64 characters, the bound that
   makes broadcasting them safe) are counted exactly and their winners chosen
   with map-side combining; those verified winners are broadcast, and rows of
   frequent digests are resolved where they are read, without a shuffle.
4. All other digests hold at most 1/``HEAVY_SHARE`` of the rows each; they
   are shuffled by digest, and one window gives winner and group size.

Nulls: a null text counts as empty, a null id sorts first.  Empty texts are
one group.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lampwatch.llm.common import SPACE_CLASS, stage

#: counters of the frequent-items sketch, and so the most digests broadcast
COUNTERS = 16384
#: a digest with more than one row in so many goes the broadcast way
HEAVY_SHARE = 2048


def slim_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.regexp_replace(text, SPACE_CLASS, "")
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(bare, 256)).alias("digest"),
                       F.length(text).cast("long").alias("points"),
                       F.monotonically_increasing_id().alias("row"))


def frequent_digests(slim: DataFrame) -> DataFrame:
    """Digests that the sketch puts over a 1/HEAVY_SHARE share of the rows."""
    top = slim.agg(F.expr(f"approx_top_k(hex(digest), {COUNTERS}, {COUNTERS})").alias("top"),
                   F.count("*").alias("n"))
    return (top.select("n", F.inline("top"))
            .where(F.col("count") * HEAVY_SHARE + F.col("n") * 3.5 * HEAVY_SHARE / COUNTERS
                   >= F.col("n"))
            .where("count >= 2")
            .select(F.unhex("item").alias("digest")))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``."""
    slim = stage(slim_rows(docs, id_col, text_col), "copies")
    first = F.min(F.struct((-F.col("points")).alias("p"), "doc_id", "row"))
    frequent = F.broadcast(frequent_digests(slim))
    winners = stage(slim.join(frequent, "digest", "left_semi").groupBy("digest")
                    .agg(first.alias("win"), F.count("*").alias("group_size")), "copies-frequent")
    hot = slim.join(F.broadcast(winners), "digest")
    rest = slim.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    own = Window.partitionBy("digest")
    rest = (rest.withColumn("win", first.over(own))
            .withColumn("group_size", F.count("*").over(own)))
    cols = ["doc_id", F.col("win.doc_id").alias("keep_id"), F.col("group_size").cast("long"),
            (F.col("win.row") == F.col("row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256")]
    return hot.select(*cols).unionByName(rest.select(*cols))
