"""The corpus pipeline: quality filter, exact dedup, near-duplicate removal,
mixing, tokenisation; part of subpackage ``lampwatch.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that stay, with the columns they came with; the last
returns the encoded documents.  ``run`` writes each stage's result to the
shared folder and rereads it as the next one's documents.

A dedup stage decides about rows, named by their place in the Parquet files
that it reads (64-bit hash of the file's path, and row number; the same in
every pass and retry, and one collision in 10^9 runs over 10^5 files), so
rows that share or lack a ``doc_id`` are kept or dropped one by one; it takes
out the rows that the operator drops.  The mix draws by ``doc_id``: rows that
share it share the draw.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lampwatch.llm import copies, mixing, pieces, quality, simhash
from lampwatch.llm.common import stage, table, vocabulary
from lampwatch.operators.joins import fits_broadcast
from lampwatch.session import ship_package

#: the mix by language that the corpus is to have, in shares of its words
TARGETS = {"en": 0.58, "de": 0.16, "fr": 0.16, "es": 0.10}


#: dropped rows that are broadcast; a place is two numbers
FEW = 50_000


def _placed(docs: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` as read from Parquet, and the place of each of its rows there."""
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place)
    except AnalysisException:  # not read from files as it is
        docs = stage(docs, "pipeline-placed")
        place = docs.metadataColumn("_metadata")
    return docs, F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("at"))


def _without(docs: DataFrame, place: Column, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows at the places ``dropped(place)``, which are
    broadcast if they are few by count, else shuffled with the texts."""
    dropped = stage(dropped, "pipeline-dropped")
    if fits_broadcast(dropped, FEW):
        dropped = F.broadcast(dropped)
    return docs.join(dropped, place == dropped["place"], "left_anti")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, place = _placed(docs)
    rows = docs.select(F.struct("doc_id", place.alias("place")).alias("row"), "text")
    found = copies.exact_copies(rows, id_col="row")
    return _without(docs, place, found.where("not kept").select("doc_id.place"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, place = _placed(docs)
    found = simhash.near_copies(docs, row=place)
    return _without(docs, place, found.where("not kept").select(F.col("row").alias("place")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = (table(spark, sf_dir, "labels").select("doc_id")
                .join(docs.select("doc_id", F.col("lang").alias("domain")), "doc_id"))
    return mixing.mixed_once(docs, labelled, TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, vocabulary("piece_bpe_32k.model"), digests=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing to target weights", mix),
    ("SentencePiece encoding", encode),
]

#: the quality and mixing stages are numeric fits, which SQL does not express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
