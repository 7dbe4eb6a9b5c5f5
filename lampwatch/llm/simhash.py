"""SimHash near-dedup over a byte-position inverted index (operator 7).

Fingerprint: lower-cased (A-Z) words, shingles of ``shingle`` words with
repeats, XXH64 (seed 42) of each; a bit is set when over half the hashes set
it.  No words: fingerprint 0.

Links (``MAX_BITS`` or fewer differing bits), over *distinct* fingerprints,
so copies cost nothing:

* A fingerprint is eight positional bytes.  Two that differ in at most two
  bits share at least six of them: the guaranteed minimum of the count
  filter.  One byte alone is a posting list of n/256 entries, whose pairs
  grow with the square of n, so a posting is keyed by the bytes of *four*
  positions: the eight positions form four two-byte blocks, at most two of
  them are hit, and the other two are one of the six block pairs.  Every
  fingerprint enters six postings; every qualifying pair meets in one.
* Each pair met has its shared positional bytes tallied (zero bytes of the
  XOR); pairs under the minimum are dropped, the others verified bit by bit.
* A posting with more than ``PAIRED`` fingerprints emits no pairs.  Its
  members are linked exactly another way: each emits itself and its 64
  one-bit neighbours, and two fingerprints are within two bits exactly when
  those sets meet.  A meeting point has at most 65 visitors, each linked to
  the smallest.  Work is linear in the members, and no link is lost: a pair
  meets in a small posting, or both its ends are members of a large one.

Components come from ``common.connected``.  Fingerprint 0 links like any
other.  Null texts count as empty; null ids never become the component id
unless the component holds nothing else; rows that repeat keep one output
row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampwatch.llm.common import connected, stage

#: most differing bits of a link; the six postings and the one-bit meeting
#: points are built for this distance
MAX_BITS = 2
#: postings up to this size are paired directly
PAIRED = 32
#: shingles hashed at a time, which bounds a task's memory on very long texts
CHUNK = 65536


def fingerprint(text: str | None, shingle: int = 3) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    votes = np.zeros(64, dtype=np.int64)
    for a in range(0, n, CHUNK):
        grams = (b" ".join(words[i:i + shingle]) for i in range(a, min(a + CHUNK, n)))
        h = np.array([xxh64_intdigest(g, 42) for g in grams], dtype=">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, row: Column | None = None) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) per row, and ``row`` if one is given;
    Arrow batches in and out."""
    def run(batches):
        import pyarrow as pa

        from lampwatch.llm.simhash import fingerprint
        for b in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"), *([] if row is None else [row.alias("row")]))
    out = T.StructType([slim.schema["doc_id"], T.StructField("fp", T.LongType()), *slim.schema.fields[2:]])
    return slim.mapInArrow(run, out)


def postings(fp: str = "fp") -> Column:
    """The six postings of a fingerprint: the block pair's number in the bits
    that the two other blocks leave free."""
    out = []
    for n, (i, j) in enumerate(combinations(range(4), 2)):
        mask = (0xFFFF << (48 - 16 * i)) | (0xFFFF << (48 - 16 * j))
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.struct(F.lit(n).alias("pair"),
                            F.col(fp).bitwiseAND(F.lit(mask)).alias("bytes")))
    return F.array(*out)


def shared_bytes(x: Column) -> Column:
    """Positions whose bytes agree, from the XOR of two fingerprints."""
    return sum((F.when(F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0)
                for k in range(8)), F.lit(0))


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``a, b`` whose components are those of the fingerprints of
    ``distinct(fp)`` under ``MAX_BITS`` differing bits."""
    post = distinct.select("fp", F.inline(postings()))
    sizes = post.groupBy("pair", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    post = post.join(sizes, ["pair", "bytes"])
    least = 8 - MAX_BITS
    small = (post.where(F.col("n") <= PAIRED).groupBy("pair", "bytes")
             .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
             .select("fps", F.explode("fps").alias("a"))
             .select("a", F.explode(F.filter("fps", lambda y: (y > F.col("a"))
                     & (shared_bytes(y.bitwiseXOR(F.col("a"))) >= least)
                     & (F.bit_count(y.bitwiseXOR(F.col("a"))) <= MAX_BITS))).alias("b")))
    large = post.where(F.col("n") > PAIRED).select("fp").distinct()
    flips = [1 << k for k in range(63)] + [-(1 << 63)]
    met = large.select("fp", F.explode(F.concat(
        F.array(F.col("fp")), F.transform(F.array(*[F.lit(f) for f in flips]),
                                          lambda m: F.col("fp").bitwiseXOR(m)))).alias("at"))
    star = (met.groupBy("at").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
            .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))
    return small.unionByName(star).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, row: Column | None = None) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable).  Given ``row``, an expression
    that tells apart all rows, also those that share or lack an id: ``row``
    and ``kept`` too, which holds for one row of each component (that with
    the smallest id, nulls last, then with the smallest ``row``)."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle, row), "simhash")
    if row is None:
        first = F.min("doc_id")
    else:
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    distinct = stage(fps.groupBy("fp").agg(first.alias("rep")), "simhash-distinct")
    edges = links(distinct).select(F.col("a").alias("u"), F.col("b").alias("v"))
    comp = connected(edges, "simhash-components")
    lowest = (comp.join(distinct, comp["node"] == distinct["fp"])
              .groupBy("root").agg(F.min("rep").alias("least")))
    linked = stage(comp.join(lowest, "root").select(F.col("node").alias("fp"), "least"),
                   "simhash-linked")
    label = (distinct.join(linked, "fp", "left")
             .select("fp", F.coalesce("least", "rep").alias("least")))
    cols = ["doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")]
    if row is None:
        cols += [F.col("least").alias("component_id")]
    else:
        cols += [F.col("least.doc_id").alias("component_id"), "row",
                 (F.col("least.row") == F.col("row")).alias("kept")]
    return fps.join(label, "fp").select(*cols)
