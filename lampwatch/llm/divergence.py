"""Audit of how sources of a language differ in their words (operator 12).

Terms are runs of ASCII letters and characters from U+0080 on, with only A-Z
lower-cased.  A language keeps the terms that at least ``LEAST_DOCS`` of its
documents hold.  Every (lang, source) group, and each language as a whole,
gives each kept term ``p = 1 + floor(10^9 (count + 1) / (N + V))``; two such
weights differ by ``f = floor((p - q)^2 / q)``.

1. *Collapse.*  Each task keeps one copy of a text per language, with how often
   each source has it; one shuffle by language and digest (texts compressed)
   brings the copies of a text together.  A text that is a third of all rows
   so arrives once per task.  The digest is 128 bits, beside the length.
2. *Tokenise once.*  Every different text is cut into terms once; its document
   frequency and counts are added to each of its sources with their
   multiplicity.  A task adds up before it shuffles.
3. *Sparse pairs.*  A term that neither source of a pair holds adds the same
   ``f`` of the two base weights; a term that one holds depends on its count
   alone.  So ``sum f`` is ``V`` times the base, plus per source a histogram
   of its counts, plus a correction for terms that both hold, and only these
   are paired.  ``p`` of an absent term never becomes a row.
4. The terms that stand out of a group are ranked in its own partition down to
   ``TOP`` before any shuffle by group.

All arithmetic is on whole numbers: ``p`` over decimals (a count times 10^9
may pass 64 bits), ``f`` over longs, where its sum over all terms fits as
``p`` of all terms add up to about 10^9 + V.

Null text, lang and source count as empty.  A group without terms, or in a
language that keeps none, is still compared (its ``f`` then is that of the
base weights, or 0).  Ids are not read, so they may repeat or be null; repeated
rows count as often as they are there.  Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lampwatch.llm.common import n_tasks, stage

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: characters of different texts, and terms, that a task holds before it passes them on
HELD_CHARS = 16_000_000
HELD_TERMS = 400_000
#: parts that the sources of a language are dealt to where they are paired
SALTS = 64
TEXTS = "lang string, digest binary, size long, text binary, sources array<string>, times array<long>"

#: bytes of no term, and A-Z, in the table that cuts and lower-cases
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(LETTERS).split()


def collapsed(docs: DataFrame) -> DataFrame:
    """``TEXTS`` rows: per language and text, the sources that hold it and how
    often; rows of one text may still be several, one per task, but share a
    partition and follow each other."""
    def collapse(batches):
        import pyarrow as pa
        import zstandard
        from xxhash import xxh3_128_digest

        from lampwatch.llm.divergence import HELD_CHARS
        squeeze = zstandard.ZstdCompressor(level=1).compress
        held, size = {}, 0

        def rows():
            cols = list(zip(*((lang, digest, n, text, list(by), list(by.values()))
                              for (lang, digest, n), (text, by) in held.items())))
            kinds = [pa.string(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              names=["lang", "digest", "size", "text", "sources", "times"])

        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = text.as_py()
                key = lang, xxh3_128_digest(raw), len(raw)
                found = held.get(key)
                if found is None:
                    held[key] = found = squeeze(raw), Counter()
                    size += len(raw)
                found[1][source] += 1
                if size >= HELD_CHARS:
                    yield rows()
                    held, size = {}, 0
        if held:
            yield rows()

    def read(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    slim = docs.select(read("lang").alias("lang"), read("source").alias("source"),
                       read("text").cast("binary").alias("text")).where(F.length("text") > 0)
    return (slim.mapInArrow(collapse, TEXTS).repartition(n_tasks(docs), "lang", "digest")
            .sortWithinPartitions("lang", "digest", "size"))


def counted(texts: DataFrame) -> DataFrame:
    """``lang, source, term, df, n``: documents and occurrences, partly added up."""
    def count(batches):
        import pyarrow as pa
        import zstandard

        from lampwatch.llm.divergence import HELD_TERMS, terms
        unpack = zstandard.ZstdDecompressor().decompress
        found, kept = {}, 0  # (lang, source): document frequencies and counts
        last, words, each = None, [], {}

        def rows():
            for (lang, source), (df, n) in found.items():
                names = pa.array(list(n), pa.binary()).cast(pa.string())
                # both hold the same terms, but may have met them in another order
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), names,
                     pa.array([df[t] for t in n], pa.int64()), pa.array(n.values(), pa.int64())],
                    names=["lang", "source", "term", "df", "n"])

        for b in batches:
            for lang, digest, size, text, sources, times in zip(*(b.column(i) for i in range(6))):
                lang, key = lang.as_py(), (lang.as_py(), digest.as_py(), size.as_py())
                if key != last:
                    last, words = key, terms(unpack(text.as_py()))
                    each = None
                if not words:
                    continue
                for source, m in zip(sources.as_py(), times.as_py()):
                    df, n = found.setdefault((lang, source), (Counter(), Counter()))
                    kept -= len(n)
                    if m == 1:
                        n.update(words)
                        df.update(set(words))
                    else:
                        each = each or Counter(words)
                        for t, k in each.items():
                            n[t] += k * m
                            df[t] += m
                    kept += len(n)
                if kept >= HELD_TERMS:
                    yield from rows()
                    found, kept = {}, 0
        yield from rows()

    return texts.mapInArrow(count, "lang string, source string, term string, df long, n long")


def weight(count: str, total: str, kept: str) -> Column:
    """``p`` of a term that occurs ``count`` times (0: an absent one)."""
    up = f"(CAST({count} + 1 AS DECIMAL(20, 0)) * {SCALE})"
    return F.expr(f"CASE WHEN {kept} > 0 THEN {up} DIV ({total} + {kept}) + 1 END")


def differs(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) DIV ({q})")


def pair_values(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, in
    either direction: base, one-sided terms by count, terms that both hold."""
    salt = F.pmod(F.hash("source"), F.lit(SALTS))
    one = sizes.select("lang", salt.alias("salt"), "source", "p0", "v")
    other = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                         F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = one.join(other, ["lang", "salt"]).where("source <> item").drop("salt")
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("v") * differs("p0", "q0"), F.lit(0)).alias("value"))

    # a term that only one of the two holds counts by how often it does
    counts = kept.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    met = (counts.join(pairs, ["lang", "source"])
           .groupBy("lang", "source", "item")
           .agg(F.sum(F.col("m") * (differs("p", "q0") - differs("p0", "q0"))).alias("own"),
                F.sum(F.col("m") * (differs("q0", "p") - differs("q0", "p0"))).alias("others")))
    alone = met.select(F.inline(F.array(
        F.struct("lang", "source", "item", F.col("own").alias("value")),
        F.struct("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                 F.col("others").alias("value")))))

    a = kept.select("lang", "term", "source", "p", "p0")
    b = kept.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    both = (a.join(b, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item")
            .agg(F.sum(differs("p", "q") - differs("p", "q0") - differs("p0", "q") + differs("p0", "q0")).alias("there"),
                 F.sum(differs("q", "p") - differs("q0", "p") - differs("q", "p0") + differs("q0", "p0")).alias("back")))
    shared = both.select(F.inline(F.array(
        F.struct("lang", "source", "item", F.col("there").alias("value")),
        F.struct("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                 F.col("back").alias("value")))))
    return (base.unionByName(alone).unionByName(shared).groupBy("lang", "source", "item")
            .agg(F.sum(F.col("value").cast("decimal(20,0)")).cast("long").alias("value")))


def audited(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` holds every
    other source of the language, part ``term`` the ``TOP`` terms that a
    group has more of than its language."""
    def read(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    found = stage(counted(collapsed(docs)).groupBy("lang", "source", "term")
                  .agg(F.sum("df").alias("df"), F.sum("n").alias("n")), "divergence-counts")
    words = (found.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total"))
             .where(F.col("df") >= LEAST_DOCS).drop("df"))
    kept = stage(found.drop("df").join(words, ["lang", "term"]), "divergence-kept")

    groups = docs.select(read("lang").alias("lang"), read("source").alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    whole = (kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
             .groupBy("lang").agg(F.sum("total").alias("all"), F.count("*").alias("v")))
    zero = F.lit(0).cast("long")
    sizes = (groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left")
             .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "all", "v")])
             .withColumn("p0", weight("0L", "size", "v")))
    sizes = stage(sizes, "divergence-groups")
    kept = kept.join(sizes, ["lang", "source"]).withColumn("p", weight("n", "size", "v"))

    out = ["lang", "source", "part", "item", "value", "rank"]
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(kept, sizes).withColumn("part", F.lit("pair")).withColumn("rank", ranked)
    more = (kept.withColumn("q", weight("total", "all", "v")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    differs("p", "q").alias("value"))
            .withColumn("rank", ranked).where(F.col("rank") <= TOP))
    return pairs.select(*out).unionByName(more.select(*out))
