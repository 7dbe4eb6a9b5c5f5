"""Merkle manifest of a dataset, kept as a content-addressed DAG (operator 13).

A document is a leaf: the SHA-256 of its fields.  The leaves of a source, in
the order of their ids, form a tree: every ``RUN`` consecutive nodes become
the hash of their digests' hex texts, until one is left, the source's
subroot; the subroots, in the order of the sources, form the tree of the
root.  H, everywhere, is the lower-case hex SHA-256 of the inputs put together.

1. *Leaves.*  Texts are read once and hashed where they are; a slim row per
   document is staged.
2. *Ranks.*  The leaves are range-partitioned by source and id, so a source
   with a third of all rows is spread out.  A task numbers its own rows; a
   source that began in an earlier partition adds the rows there, one number
   per partition, which is what the broadcast is bounded by.
3. *Records.*  A pass folds blocks of ``RUN ** LEVELS`` consecutive nodes of a
   tree, ``LEVELS`` levels at once, and stores for each block the records
   ``digest -> children`` of its nodes as one page under the digest of the
   block's own node.  Each pass leaves one node in 243.
4. *Descent.*  From the root, requests go down page by page: a page is found
   by its digest, the digits of a rank (base ``RUN``) choose the child, and
   the children not chosen are collected.  All leaves of a block share the
   descent above it, so the rows of a pass are as few as its blocks; the last
   page meets the block's leaf requests.  The collected segments run from the
   root down and are reversed into proofs.

Ids, sources and texts may be null; a null id or source comes first.  Rows
that repeat id and content are leaves of their own, one after the other (which
of them has which place is not fixed: they are equal).  Equal pages are stored
once.  Very long texts are hashed in the JVM like any other.  Other columns
are ignored, or carried along when named in ``keep``.  An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampwatch.llm.common import n_tasks, stage

RUN = 3
#: levels folded in a pass
LEVELS = 5
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, rank long, digest string"
PAGE = NODE + ", size int, page array<string>"
FRONTIER = NODE + ", subroot string, path array<string>"


def h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def field(value: Column) -> Column:
    """A field of a leaf: ``-`` if null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def depth_of(size: int) -> int:
    """Levels above ``size`` nodes."""
    depth = 0
    while size > 1:
        size, depth = -(-size // RUN), depth + 1
    return depth


def folded(nodes: list[str], depth: int) -> tuple[str, list[str]]:
    """The node ``depth`` levels above ``nodes``, and the records met: a
    digest followed by its children's."""
    records = []
    for _ in range(depth):
        up = []
        for i in range(0, len(nodes), RUN):
            children = nodes[i:i + RUN]
            up.append(h(*children))
            records.append(up[-1] + "".join(children))
        nodes = up
    return nodes[0], records


def descended(digest: str, depth: int, place: int, records: dict[str, str]) -> tuple[str, list[str]]:
    """The node at ``place`` below ``digest`` and, from the top down, per
    level the chosen child's place in its run followed by the other digests."""
    segments = []
    for level in range(depth - 1, -1, -1):
        at = place // RUN ** level % RUN
        run = records[digest]
        digest = run[at * HEX:(at + 1) * HEX]
        segments.append(f"{at}{run[:at * HEX]}{run[(at + 1) * HEX:]}")
    return digest, segments


def opened(page: list[str]) -> dict[str, str]:
    return {r[:HEX]: r[HEX:] for r in page}


def block_depth(rank: int, size: int) -> int:
    """Levels that a pass folds: all of a tree that is one block."""
    return depth_of(size) if rank == 0 and size < RUN ** LEVELS else LEVELS


def numbered(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``rank``, their place in ``order`` within a tree (nulls first)."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("within", T.LongType())])
    at = nodes.columns.index(tree)

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, last, n = TaskContext.get().partitionId(), object(), 0
        for b in batches:
            within = []
            for key in b.column(at).to_pylist():
                n = n + 1 if key == last else 0
                last = key
                within.append(n)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * len(within), pa.int32()), pa.array(within, pa.int64())],
                names=[*b.schema.names, "part", "within"])

    keys = [F.col(c).asc_nulls_first() for c in [tree, *order]]
    placed = stage(nodes.repartitionByRange(n_tasks(nodes), *keys).sortWithinPartitions(*keys)
                   .mapInArrow(number, schema), "merkle-numbered")
    counts = placed.groupBy("part", tree).agg(F.count("*").alias("n"))
    so_far = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a tree that goes on is the first of its partition: at most one row for each
    before = (counts.select(F.col("part").alias("__part"), F.col(tree).alias("__tree"),
                            F.sum("n").over(so_far).alias("__before")).where("__before > 0"))
    go_on = (F.col("part") == F.col("__part")) & F.col(tree).eqNullSafe(F.col("__tree"))
    return (placed.join(F.broadcast(before), go_on, "left")
            .withColumn("rank", F.col("within") + F.coalesce("__before", F.lit(0).cast("long")))
            .drop("part", "within", "__part", "__tree", "__before"))


def built(nodes: DataFrame) -> list[DataFrame]:
    """The passes over ``nodes(tree, rank, digest)``, lowest first: each
    block's node and its page; the last pass has one node per tree."""
    def fold(batches):
        import pyarrow as pa

        from lampwatch.llm.merkle import block_depth, folded
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string())]
        key, held, out = None, [], []

        def closed():
            digest, records = folded(held, block_depth(key[1], len(held)))
            return (*key, digest, len(held), records)

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                              names=["tree", "rank", "digest", "size", "page"])

        for b in batches:
            for tree, block, digest in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if (tree, block) != key:
                    if held:
                        out.append(closed())
                    key, held = (tree, block), []
                    if len(out) >= 100:
                        yield batch()
                        out = []
                held.append(digest)
        if held:
            out.append(closed())
            yield batch()

    passes = []
    while True:
        block = F.expr(f"rank div {RUN ** LEVELS}")
        rows = (nodes.select("tree", block.alias("block"), "rank", "digest")
                .repartition(n_tasks(nodes), "tree", "block").sortWithinPartitions("tree", "block", "rank"))
        passes.append(stage(rows.mapInArrow(fold, PAGE), "merkle-pages"))
        if not passes[-1].agg(F.max("rank")).first()[0]:
            return passes
        nodes = passes[-1]


def opened_pages(frontier: DataFrame, level: DataFrame) -> DataFrame:
    """The page that each request's digest names in the store of a pass."""
    store = (level.where(F.size("page") > 0).groupBy("digest")
             .agg(F.first("page").alias("page"), F.first("size").alias("size")))
    return frontier.join(store, "digest", "left")


def expanded(frontier: DataFrame, level: DataFrame) -> DataFrame:
    """Requests at the nodes above a pass, sent on to every node below it."""
    def down(batches):
        import pyarrow as pa

        from lampwatch.llm.merkle import LEVELS, RUN, block_depth, descended, opened
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]
        for b in batches:
            for tree, rank, digest, subroot, path, page, size in zip(*(c.to_pylist() for c in b.columns)):
                records, size = opened(page or []), size or 1
                depth = block_depth(rank, size) if records else 0
                out = []
                for place in range(size):
                    node, segments = descended(digest, depth, place, records)
                    out.append((tree, rank * RUN ** LEVELS + place, node, subroot, path + segments))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["tree", "rank", "digest", "subroot", "path"])

    rows = opened_pages(frontier, level).select("tree", "rank", "digest", "subroot", "path", "page", "size")
    return rows.mapInArrow(down, FRONTIER)


def manifest(leaves: DataFrame, id_col: str = "doc_id", tree_col: str = "source", leaf_col: str = "leaf",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per leaf: ``doc_id, leaf, subroot, root``, the ``keep`` columns
    and ``proof``, from the leaf up: per level the place of the node in its
    run, one character, followed by the other digests of the run."""
    spark = leaves.sparkSession
    slim = leaves.select(F.col(tree_col).cast("string").alias("tree"), F.col(id_col).alias("doc_id"),
                         F.col(leaf_col).alias("digest"), F.struct(*keep, F.lit(0).alias("_")).alias("kept"))
    slim = stage(slim, "merkle-leaves")
    ranked = stage(numbered(slim, "tree", ["doc_id", "digest"]), "merkle-ranked")
    passes = built(ranked)
    subroots = passes[-1].select("tree", "digest")
    tops = stage(numbered(subroots.select(F.lit("").alias("top"), "tree", "digest"), "top", ["tree"]),
                 "merkle-subroots")
    above = built(tops.select(F.lit("").alias("tree"), "rank", "digest"))
    root = above[-1].select("digest").first()
    out = ["doc_id", "leaf", "subroot", "root", "proof", *keep]
    if root is None:
        return ranked.select("doc_id", F.col("digest").alias("leaf"), F.lit("").alias("subroot"),
                             F.lit("").alias("root"), F.array().cast("array<string>").alias("proof"),
                             "kept.*").select(*out)

    frontier = spark.createDataFrame([("", 0, root["digest"], None, [])], FRONTIER)
    for level in reversed(above):
        frontier = expanded(frontier, level)
    found = frontier.select("rank", "digest", "path").join(tops.select("rank", "tree"), "rank")
    frontier = stage(found.select("tree", F.lit(0).cast("long").alias("rank"), "digest",
                                  F.col("digest").alias("subroot"), "path"), "merkle-frontier")
    for level in reversed(passes[1:]):
        frontier = stage(expanded(frontier, level), "merkle-frontier")

    pages = opened_pages(frontier, passes[0]).select(
        "tree", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("place"),
        F.lit(None).cast(slim.schema["doc_id"].dataType).alias("doc_id"), "digest",
        F.lit(None).cast(slim.schema["kept"].dataType).alias("kept"), "subroot", "path", "page", "size")
    none = F.lit(None)
    requests = ranked.select(
        "tree", F.expr(f"rank div {RUN ** LEVELS}").alias("block"), (F.col("rank") % RUN ** LEVELS).alias("place"),
        "doc_id", "digest", "kept", none.cast("string").alias("subroot"),
        none.cast("array<string>").alias("path"), none.cast("array<string>").alias("page"),
        none.cast("int").alias("size"))

    def answer(batches):
        import pyarrow as pa

        from lampwatch.llm.merkle import block_depth, descended, opened
        records, subroot, path, digest, depth = {}, None, [], None, 0
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in
                    ("block", "place", "digest", "subroot", "path", "page", "size")}
            rows, subroots, proofs = [], [], []
            for i, place in enumerate(cols["place"]):
                if place < 0:
                    records, subroot, path = opened(cols["page"][i] or []), cols["subroot"][i], cols["path"][i]
                    digest = cols["digest"][i]
                    depth = block_depth(cols["block"][i], cols["size"][i]) if records else 0
                    continue
                leaf, segments = descended(digest, depth, place, records)
                if leaf != cols["digest"][i]:
                    raise ValueError(f"the manifest holds {leaf} where {cols['digest'][i]} is asked for")
                rows.append(i)
                subroots.append(subroot)
                proofs.append([*reversed(path + segments)])
            if rows:
                some = b.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("digest"), pa.array(subroots, pa.string()),
                     pa.array(proofs, pa.list_(pa.string())), some.column("kept")],
                    names=["doc_id", "leaf", "subroot", "proof", "kept"])

    schema = (slim.select("doc_id", F.col("digest").alias("leaf"), F.lit("").alias("subroot"),
                          F.array(F.lit("")).alias("proof"), "kept").schema)
    met = (pages.unionByName(requests).repartition(n_tasks(leaves), "tree", "block")
           .sortWithinPartitions("tree", "block", "place"))
    return (met.mapInArrow(answer, schema).withColumn("root", F.lit(root["digest"]))
            .select("doc_id", "leaf", "subroot", "root", "proof", "kept.*").select(*out))


def folded_root(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    def up(digest, s):
        left = s.substr(F.lit(1), F.lit(1)).cast("int") * HEX
        return F.sha2(F.concat(s.substr(F.lit(2), left), digest,
                               s.substr(left + 2, F.length(s))), 256)
    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """H of a proof's digests, in its order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: s.substr(F.lit(2), F.length(s))), ""), 256)


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of documents and a check of each proof, after line feeds
    have been deleted from the texts of the documents whose id has an even
    CRC-32: ``doc_id, leaf, subroot, root, proof, folded_root, verified``.  A
    null id is never tampered with."""
    fields = [F.col(c) for c in FIELDS]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    leaves = docs.select("doc_id", "source", leaf_digest(*fields).alias("leaf"),
                         F.when(hit, leaf_digest(*fields[:-1], bare)).alias("tampered"))
    found = manifest(leaves, keep=("tampered",))
    again = folded_root(F.coalesce("tampered", "leaf"), F.col("proof"))
    return (found.withColumn("folded_root", again)
            .withColumn("verified", F.col("folded_root") == F.col("root")).drop("tampered"))
