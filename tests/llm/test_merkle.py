"""Merkle manifest (operator 13) against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lampwatch.llm import merkle as M
from tests.conftest import SF_SMALL


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return h(part(r["doc_id"]), part(r["source"]), part(r["lang"]), part(r["n_chars"]), part(text))


def tree(nodes):
    """The root, and per node its siblings from the bottom up with its place."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, k in enumerate(at):
            run = level[k // 3 * 3:k // 3 * 3 + 3]
            proofs[i].append((k % 3, run[:k % 3] + run[k % 3 + 1:]))
            at[i] = k // 3
        level = [h(*level[k:k + 3]) for k in range(0, len(level), 3)]
    return level[0], proofs


def up(digest, proof):
    for place, others in proof:
        digest = h(*others[:place], digest, *others[place:])
    return digest


def brute_force(rows):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    def text_order(s):
        return (s is not None, (s or "").encode())

    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    names = sorted(by_source, key=text_order)
    built = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        built[s] = tree([leaf_of(r, r["text"]) for r in by_source[s]])
    root, above = tree([built[s][0] for s in names])
    out = []
    for s, top in zip(names, above):
        subroot, proofs = built[s]
        for r, own in zip(by_source[s], proofs):
            proof = own + top
            hit = (r["doc_id"] is not None and r["text"] is not None
                   and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0)
            again = up(leaf_of(r, r["text"].replace("\n", "") if hit else r["text"]), proof)
            out.append((r["doc_id"], leaf_of(r, r["text"]), subroot, root,
                        h(*[d for _, others in proof for d in others]), again, again == root))
    return out


def found(docs):
    rows = M.audited(docs).withColumn("proof_sha256", M.proof_digest(F.col("proof"))).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(map(tuple, rows), key=str)


def test_query_equals_brute_force(llm):
    from lampwatch.llm.queries import op13_merkle

    rows = [r.asDict() for r in llm.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted(map(tuple, op13_merkle(llm, SF_SMALL).collect()), key=str)
    assert got == sorted(brute_force(rows), key=str)
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [243], [244], [1, 1], [729, 1, 10], [2, 730], [59_050]])
def test_sizes(llm, sizes):
    """One to several passes; block and page edges; a lone leaf is its own subroot."""
    rows = [(s * 1_000_000 + i, f"src{s}" if s else None, "en", i, "a\nb") for s, n in enumerate(sizes)
            for i in range(n)]
    docs = llm.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    want = brute_force([r.asDict() for r in docs.collect()])
    assert found(docs.repartition(5)) == sorted(want, key=str)


def test_odd_rows(odd_docs, no_docs):
    same = odd_docs.withColumn("source", F.when(F.col("doc_id") % 4 != 0, F.lit("é")).when(
        F.col("doc_id") % 3 == 0, F.lit("")))
    docs = same.withColumn("n_chars", F.when(F.col("doc_id") > 3, F.col("doc_id"))).withColumn(
        "lang", F.when(F.col("doc_id") != 2, F.lit("de")))
    docs = docs.unionByName(docs)  # every row twice
    rows = [r.asDict() for r in docs.select(*M.FIELDS).collect()]
    assert found(docs) == sorted(brute_force(rows), key=str)
    empty = no_docs.withColumn("n_chars", F.lit(1).cast("long"))
    assert found(empty) == []


def test_equal_blocks_are_stored_once(llm):
    """More equal rows than a page holds."""
    docs = llm.range(800).select(F.lit(7).cast("long").alias("doc_id"), F.lit("s").alias("source"),
                                 F.lit("en").alias("lang"), F.lit(3).cast("long").alias("n_chars"),
                                 F.lit("x\ny").alias("text"))
    rows = [r.asDict() for r in docs.collect()]
    assert found(docs) == sorted(brute_force(rows), key=str)


def test_any_change_is_noticed(llm):
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet")
    leaves = docs.select("doc_id", "source", M.leaf_digest(*map(F.col, M.FIELDS)).alias("leaf"))
    proofs = M.manifest(leaves)
    wrong = F.sha2(F.concat("leaf", F.lit("!")), 256)
    got = proofs.select((M.folded_root(F.col("leaf"), F.col("proof")) == F.col("root")).alias("good"),
                        (M.folded_root(wrong, F.col("proof")) == F.col("root")).alias("bad"))
    assert got.where("not good or bad").count() == 0
