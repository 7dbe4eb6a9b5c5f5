"""Operators 8 and 9 and the pipeline against plain versions of them."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import public_tokenizers
from lampwatch.llm import mixing, quality
from tests.conftest import SF_MID
from tests.llm.test_documents import components, near

TARGETS = {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15}


@pytest.fixture(scope="module")
def given(llm):
    """Documents, as frame and list, and labels."""
    docs = llm.read.parquet(f"{SF_MID}/documents.parquet")
    return docs, [r.asDict() for r in docs.collect()], llm.read.parquet(f"{SF_MID}/labels.parquet")


def plain_scores(rows, labels):
    """The discriminant by its definition: densities of shrunk normals."""
    x = np.array([quality.statistics(r["text"]) for r in rows])
    known = dict(labels.select("doc_id", "quality").collect())
    fold = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows}
    use = [i for i, r in enumerate(rows) if fold[r["doc_id"]] and known.get(r["doc_id"]) in (0, 1)]
    y = np.array([known[rows[i]["doc_id"]] for i in use])
    fit = x[use]
    z, fit = (x - fit.mean(0)) / fit.std(0), (fit - fit.mean(0)) / fit.std(0)
    covs = [np.cov(fit[y == c].T, bias=True) for c in (0, 1)]
    shares = [(y == c).mean() for c in (0, 1)]
    pooled = shares[0] * covs[0] + shares[1] * covs[1]
    logs = []
    for c in (0, 1):
        s = 0.7 * covs[c] + 0.3 * pooled
        s = 0.95 * s + 0.05 * np.trace(s) / len(s) * np.eye(len(s))
        off = z - fit[y == c].mean(0)
        far = np.einsum("ij,jk,ik->i", off, np.linalg.inv(s), off)
        logs.append(math.log(shares[c]) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * far)
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def test_quality_equals_plain(given):
    docs, rows, labels = given
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, labels).collect()}
    for r, s in zip(rows, plain_scores(rows, labels)):
        assert abs(got[r["doc_id"]] - s) < 1e-6


def plain_posteriors(rows, domain):
    """Naive Bayes over hashed byte pairs, one pair at a time."""
    def pairs(text):
        raw = (text or "").encode().lower()
        return Counter((a * 33 + b) % mixing.BINS for a, b in zip(raw, raw[1:]))

    names = sorted(TARGETS)
    count = {d: Counter() for d in names}
    seen = Counter()
    for r in rows:
        if domain.get(r["doc_id"]) in count:
            seen[domain[r["doc_id"]]] += 1
            count[domain[r["doc_id"]]] += pairs(r["text"])
    whole = {d: sum(count[d].values()) + 0.5 * mixing.BINS for d in names}
    out = []
    for r in rows:
        c = pairs(r["text"])
        n = sum(c.values())
        logs = [math.log(seen[d] / sum(seen.values())) + min(n, mixing.EVIDENCE) / max(n, 1)
                * sum(k * math.log((count[d][b] + 0.5) / whole[d]) for b, k in c.items()) for d in names]
        e = [math.exp(v - max(logs)) for v in logs]
        out.append([v / sum(e) for v in e])
    return np.array(out)


@pytest.mark.parametrize("budget", ["all", "once"])
def test_rates_equal_plain_solution(given, budget):
    """Posteriors by definition; under them the rates are feasible, meet the
    targets, and are as large a mix as non-negative least squares finds."""
    docs, rows, labels = given
    domain = {r["doc_id"]: r["lang"] for r in rows}
    listed = {r["doc_id"] for r in labels.collect()}
    labelled = labels.select("doc_id").join(docs.selectExpr("doc_id", "lang as domain"), "doc_id")
    got = {r["doc_id"]: r for r in mixing.mixed_rates(docs, labelled, TARGETS, budget).collect()}
    p = plain_posteriors(rows, {i: d for i, d in domain.items() if i in listed})
    names = sorted(TARGETS)
    assert np.abs(p - [[got[r["doc_id"]][f"p_{d}"] for d in names] for r in rows]).max() < 1e-6
    tokens = np.array([len((r["text"] or "").split()) for r in rows])
    rate = np.array([got[r["doc_id"]]["rate"] for r in rows])
    assert rate.min() >= 0 and (budget == "all" or rate.max() <= 1 + 1e-12)
    totals = np.einsum("i,ij->j", tokens * rate, p)
    assert np.abs(totals / totals.sum() - [TARGETS[d] for d in names]).max() < 2e-3
    if budget == "all":
        assert abs(totals.sum() / tokens.sum() - 1) < 2e-3
        return
    # plain projected gradient for a mix 2 % larger: box constraints let none exist
    goal = np.array([TARGETS[d] for d in names]) * totals.sum() * 1.02
    w, a = np.ones(len(rows)), (tokens[:, None] * p).T
    size = (a * a).sum()
    for _ in range(20_000):
        off = np.einsum("ji,i->j", a, w) - goal
        w = np.clip(w - np.einsum("ji,j->i", a, off) / size, 0, 1)
    assert np.abs(off).max() > 1e-3 * goal.max()


def test_pipeline_equals_replay(llm, given):
    """Each stage's rows, and the digests, against a plain replay."""
    import corpus_pipeline as p

    docs, rows, labels = given
    cur = rows
    for name, stage in p.STAGES:
        if name.startswith("quality"):
            cur = [r for r, s in zip(cur, plain_scores(cur, labels)) if s >= 0.3]
        elif name.startswith("exact"):
            best = {}
            for r in cur:
                text = r["text"] or ""
                best.setdefault("".join(text.split()), []).append((-len(text), r["doc_id"]))
            stay = {min(v)[1] for v in best.values()}
            cur = [r for r in cur if r["doc_id"] in stay]
        elif name.startswith("SimHash"):
            cur = sorted(cur, key=lambda r: r["doc_id"])
            root = near([(r["doc_id"], r["text"]) for r in cur])[1]
            cur = [r for i, r in enumerate(cur) if root.index(root[i]) == i]
        elif name.startswith("mixing"):
            labelled = labels.select("doc_id").join(docs.selectExpr("doc_id", "lang as domain"), "doc_id")
            rate = {r["doc_id"]: r["rate"] for r in
                    mixing.mixed_rates(docs, labelled.join(docs.select("doc_id"), "doc_id"), p.TARGETS, "once")
                    .join(docs.select("doc_id", mixing.dice("doc_id").alias("dice")), "doc_id")
                    .where("dice < rate").collect()}
            cur = [r for r in cur if r["doc_id"] in rate]
        docs = p.stage(stage(llm, docs, SF_MID), "test") if name != p.STAGES[-1][0] else stage(llm, docs, SF_MID)
        assert sorted(r["doc_id"] for r in cur) == sorted(r["doc_id"] for r in docs.select("doc_id").collect()), name
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in docs.collect()}
    for r in cur:
        ids = library.encode(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_pipeline_keeps_rows_not_ids(llm):
    """Rows that share or lack an id are told apart by both dedup stages."""
    import corpus_pipeline as p

    texts = [(7, "same text"), (7, "same  text"), (None, "alpha beta"), (None, "alpha  beta"), (7, "SAME text"),
             (7, "quite another one"), (None, "alpha BETA")]
    docs = llm.createDataFrame([(i, t, n) for n, (i, t) in enumerate(texts)], "doc_id long, text string, __row int")
    exact = p.exact_dedup(llm, docs, SF_MID)
    assert exact.columns == docs.columns
    assert sorted(r["__row"] for r in exact.collect()) == [1, 3, 4, 5, 6]
    left = p.near_dedup(llm, p.stage(exact, "test"), SF_MID)
    assert left.columns == docs.columns
    got = left.select("doc_id", F.lower("text").alias("t")).collect()
    assert sorted((r["doc_id"] or 0, "".join(r["t"].split())) for r in got) == [
        (0, "alphabeta"), (7, "quiteanotherone"), (7, "sametext")]
