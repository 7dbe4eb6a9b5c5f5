"""Helpers shared by the operators: staged tables in the cluster's shared
folder, atomic file output from tasks, connected components."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampwatch.session import scratch_path

#: the white space of the operators' word and copy rules: space, tab to carriage return
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine of the
    image; ``LAMPWATCH_TOKENIZERS`` names another folder."""
    folder = os.environ.get("LAMPWATCH_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it
    back: lineage is cut, later passes reread slim rows, and a lost executor
    costs only its own tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_tasks(df: DataFrame) -> int:
    """Reduce tasks of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_atomic(uri: str, name: str, payload: bytes) -> str:
    """Write one file below ``uri`` from a task.  The bytes go to a private
    name first and are then renamed, so a retried or speculative attempt
    leaves one whole file.  Returns the file's uri."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(uri)
    system.create_dir(base, recursive=True)
    tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(tmp) as out:
        out.write(payload)
    system.move(tmp, f"{base}/{name}")
    return f"{uri.rstrip('/')}/{name}"


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(u, v)`` by alternating large-star and
    small-star rounds; returns ``node, root`` (root: the smallest node of the
    component) for every node of an edge.  Each round is written to the
    shared folder; the number of rounds is logarithmic in the longest chain.
    Empty input gives no rows; null ends are ignored."""
    cur = (edges.where("u is not null and v is not null and u <> v")
           .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .distinct())
    cur = stage(cur, name)
    before = None
    while True:
        # large-star: link larger neighbours of each node to its smallest neighbour
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small-star: link a node and its smaller neighbours to the smallest of them
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        cur = stage(small, name)
        sums = cur.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.hash("u", "v").cast("long")),
                                                           F.lit(0)).alias("h")).first()
        now = (sums["n"], sums["h"])
        if now == before:
            break
        before = now
    roots = cur.select("v").distinct()
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))))
