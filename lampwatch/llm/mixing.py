"""Soft-membership mixing to target weights (operator 9).

1. *Classifier.*  A labelled table ``doc_id, domain`` gives a tempered naive
   Bayes over hashed byte pairs.  Its priors count every labelled row; its
   pairs come from at most ``FIT_ROWS`` labelled rows, shared out evenly over
   the domains (what a rare one leaves goes to the others) and the smallest
   by hash of their id in each; that bound is also what makes broadcasting
   the picked ids safe.  Class counts are summed per task and then grouped;
   the driver gets one number per domain and bin.
2. *Posteriors.*  Every document gets its words (tokens) and its domain
   posteriors, ``p(d)``, staged as slim rows.  The log-likelihood is taken
   per byte pair and weighed as ``EVIDENCE`` pairs, so that long documents
   keep soft memberships too.
3. *Rates.*  Projected gradient descent finds rates ``w >= 0`` that minimise
   ``|A w - t|² + RIDGE Σ tokens (w - 1)²`` in shares of all tokens, where
   ``A w`` are the expected domain totals ``Σ tokens p(d) w`` and ``t`` the
   targets.  A step is taken in the norm of the inverse of ``Σ tokens p pᵀ``
   over the rows that it can move: a rare domain weighs as much as a common
   one, and a step that meets no bound meets the targets.  Each step is one
   pass over the slim rows that sums the expected totals, and one before it
   that sums that matrix; the driver keeps the short list of steps, and a task
   replays a document's rate from them, so no step writes a table or lengthens
   a lineage.  It stops when every domain is within ``CLOSE`` of its target,
   as a share of that target, or after ``STEPS``; targets then missed are
   warned of, with the totals reached.

``budget`` is the total the targets share out: a number of tokens, "all" (the
input's total) or "once" (the largest total that asks no domain for more than
it has and that rates of at most 1 meet; a domain without labelled rows is not
asked, and the others' targets share out the whole).  Rates of at most 1 reach
no more than ``Σ tokens max(0, p x)`` along any ``x``; along the step of a
pass that missed, this bounds the total, which is then lowered to ``BELOW``
the bound.  A total of under half the input is warned of.

Null texts count as empty: no tokens, and the labelled table's shares as
posteriors.  Labels of unknown ids, null labels and domains without a target
are ignored; an id labelled twice takes the smallest domain; a target whose
domain has no labelled row stays unmet, with a warning.  Without any labelled
row all domains are equally likely and "once" takes every row.  Rows that
repeat are documents each; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampwatch.llm.common import stage

FIT_ROWS = 20_000
BINS = 1024
EVIDENCE = 50.0
RIDGE = 1e-6
STEPS = 80
CLOSE = 1e-4
BELOW = 1e-3


def pair_counts(text: str | None) -> np.ndarray:
    """Hashed byte pairs of a whole text, ASCII case folded."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    if len(raw) < 2:
        return np.zeros(BINS, np.int64)
    return np.bincount((raw[:-1].astype(np.uint16) * np.uint16(33) + raw[1:]) & np.uint16(BINS - 1),
                       minlength=BINS)


@dataclass
class Domains:
    """Domain names, labelled rows (d), log priors (d) and log-likelihoods (bins x d)."""

    names: list[str]
    seen: np.ndarray
    prior: np.ndarray
    likely: np.ndarray

    def posteriors(self, texts) -> np.ndarray:
        out = np.empty((len(texts), len(self.names)))
        for i, t in enumerate(texts):
            c = pair_counts(t)
            n = c.sum()
            out[i] = self.prior + (c @ self.likely) * (min(n, EVIDENCE) / n if n else 0)
        out = np.exp(out - out.max(1, keepdims=True)) if len(out) else out
        return out / out.sum(1, keepdims=True) if len(out) else out


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def quotas(have: dict[str, int], rows: int) -> dict[str, int]:
    """``rows`` shared out evenly over domains that ``have`` so many each; what
    one cannot fill goes to the others, and each gets one at least."""
    out = {}
    for i, (d, n) in enumerate(sorted(have.items(), key=lambda x: (x[1], x[0]))):
        out[d] = min(n, max(1, (rows - sum(out.values())) // (len(have) - i)))
    return out


def fitted(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id",
           text_col: str = "text") -> Domains:
    """Fit on ``labelled(doc_id, domain)``."""
    where = {d: i for i, d in enumerate(domains)}
    ids = (_slim(docs, id_col, text_col).where("doc_id is not null")
           .groupBy("doc_id").agg(F.count("*").alias("n")))
    known = stage(labelled.select(F.col("doc_id").cast("long"), F.col("domain").cast("string"))
                  .where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
                  .groupBy("doc_id").agg(F.min("domain").alias("domain")).join(ids, "doc_id"), "labelled")
    have, seen = {}, np.zeros(len(domains))
    for r in known.groupBy("domain").agg(F.count("*").alias("ids"), F.sum("n").alias("n")).collect():
        have[r["domain"]], seen[where[r["domain"]]] = r["ids"], r["n"]
    if not seen.all():
        warnings.warn(f"no labelled document in {[d for d, n in zip(domains, seen) if not n]}: "
                      "these targets stay unmet", stacklevel=3)
    picked = known.select("doc_id", "domain")
    if sum(have.values()) > FIT_ROWS:
        parts = [picked.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
                 for d, n in quotas(have, FIT_ROWS).items()]
        picked = parts[0]
        for p in parts[1:]:
            picked = picked.unionByName(p)

    def counts(batches):
        import pyarrow as pa

        from lampwatch.llm.mixing import BINS, pair_counts
        total = np.zeros((len(where), BINS), np.int64)
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                total[where[d]] += pair_counts(t.as_py())
        d, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(d.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(total[d, i])],
            names=["d", "bin", "n"])

    rows = _slim(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").select("domain", "text")
    pairs = np.full((len(domains), BINS), 0.5)
    for r in (rows.mapInArrow(counts, "d int, bin int, n long").groupBy("d", "bin")
              .agg(F.sum("n").alias("n")).collect()):
        pairs[r["d"], r["bin"]] += r["n"]
    prior = np.zeros(len(domains))
    if seen.any():
        with np.errstate(divide="ignore"):  # a domain without labelled rows has no members
            prior = np.log(seen / seen.sum())
    return Domains(list(domains), seen, prior, np.log(pairs / pairs.sum(1, keepdims=True)).T)


def memberships(docs: DataFrame, model: Domains, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, p array<double>`` per row."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column(1).to_pylist()
            p = model.posteriors(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len((t or "").split()) for t in texts], pa.int64()),
                 pa.array(list(p), pa.list_(pa.float64()))], names=["doc_id", "n_tokens", "p"])

    return _slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, p array<double>")


@dataclass
class Rates:
    """What a document's rate is replayed from."""

    most: float
    steps: list[np.ndarray]

    def of(self, p: np.ndarray) -> np.ndarray:
        w = np.ones(len(p))
        for step in self.steps:
            w = np.clip(w - p @ step - RIDGE * (w - 1), 0, self.most)
        return w


def _inverse(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Pseudo-inverse after domains are scaled alike, so that no rare one is ignored."""
    scale = 1 / np.sqrt(np.where(first > 0, first, np.inf))
    return np.linalg.pinv(gram * scale * scale[:, None], rcond=1e-10, hermitian=True) * scale * scale[:, None]


def _summed(members: DataFrame, of, width: int) -> np.ndarray:
    """``Σ tokens * of(p)`` over all rows (``of``: rows x width)."""
    def part(batches):
        import pyarrow as pa
        total = np.zeros(width)
        for b in batches:
            n = b.column(0).to_numpy()
            p = b.column(1).flatten().to_numpy().reshape(len(n), -1)
            total += n @ of(p)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)],
                                         names=["i", "v"])

    out = np.zeros(width)
    rows = members.select("n_tokens", "p").mapInArrow(part, "i int, v double")
    for r in rows.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def solved(members: DataFrame, weights: list[float], budget: float | str = "all",
           seen: np.ndarray | None = None) -> Rates:
    """Rates whose expected domain totals match ``weights`` of the budget.
    ``seen``: the labelled rows of each domain, by default some."""
    d = len(weights)
    share = np.array(weights, dtype=float) / sum(weights)
    met = np.ones(d, bool) if seen is None else seen > 0
    rates = Rates(1.0 if budget == "once" else np.inf, [])
    if budget == "once":
        if not share[met].any():
            return rates
        share = np.where(met, share, 0) / share[met].sum()

    def pairs(p, n=1.0):
        return (n * p[:, :, None] * p[:, None, :]).reshape(len(p), -1)

    sums = _summed(members, lambda p: np.concatenate([p, pairs(p)], axis=1), d + d * d)
    total = sums[:d].sum()
    if not total:
        return rates
    first, whole = sums[:d] / total, sums[d:].reshape(d, d) / total
    if budget == "all":
        asked = 1.0
    elif budget == "once":
        asked = min([1.0, *(first[share > 0] / share[share > 0])])
    else:
        asked = float(budget) / total
    now, best, plain = first, np.inf, False
    for k in range(STEPS):
        step = _inverse(whole, first) @ (now - share * asked)
        if not plain and (k or budget == "once"):
            def movable(p):
                w, way = rates.of(p), p @ step
                held = ((w >= rates.most) & (way < 0)) | ((w <= 0) & (way > 0))
                return pairs(p, (~held)[:, None, None])

            free = _summed(members, movable, d * d).reshape(d, d) / total
            step = _inverse(free + 1e-9 * whole, first) @ (now - share * asked)
        rates.steps.append(step)
        sums = _summed(members, lambda p: np.concatenate(
            [p * rates.of(p)[:, None], np.maximum(0, -(p @ step))[:, None]], axis=1), d + 1) / total
        now, goal, reach = sums[:d], share * asked, -(step @ share)
        off = (np.abs(now - goal) / np.where(goal > 0, goal, asked or 1.0))[met].max(initial=0)
        if off <= CLOSE:
            break
        plain, best = off > best / 2 and not plain, min(off, best)
        if budget == "once" and reach * asked > sums[d]:
            asked = sums[d] / reach * (1 - BELOW)
    else:
        warnings.warn(f"after {STEPS} steps the expected shares of all tokens are {now.tolist()}, "
                      f"the targets {goal.tolist()}", stacklevel=3)
    if budget == "once" and asked < 0.5:
        warnings.warn(f"a mix without repeats takes {asked:.2%} of all tokens", stacklevel=3)
    return rates


def mixed_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
                budget: float | str = "all", id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, rate`` and ``p_<domain>`` for
    each domain of ``targets``."""
    domains = sorted(targets)
    model = fitted(docs, labelled, domains, id_col, text_col)
    members = stage(memberships(docs, model, id_col, text_col), "mixing")
    rates = solved(members, [targets[d] for d in domains], budget, model.seen)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            n = len(b)
            p = b.column(2).flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, len(domains)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(rates.of(p)), *(pa.array(c) for c in p.T)],
                names=["doc_id", "n_tokens", "rate", *(f"p{i}" for i in range(len(domains)))])

    schema = "doc_id long, n_tokens long, rate double, " + ", ".join(
        f"p{i} double" for i in range(len(domains)))
    return members.mapInArrow(run, schema).toDF(
        "doc_id", "n_tokens", "rate", *(f"p_{d}" for d in domains))


def dice(id_col: str, seed: int = 9) -> Column:
    """A number in [0, 1) drawn from the id alone, the same in every run."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)


def mixed_once(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a mix without repeats takes, with all their
    columns: a row stays if the number drawn from its id is below its rate.
    Rates come from a function of the text where it is read, so texts are not
    shuffled."""
    domains = sorted(targets)
    model = fitted(docs, labelled, domains, id_col, text_col)
    members = stage(memberships(docs, model, id_col, text_col), "mixing")
    rates = solved(members, [targets[d] for d in domains], "once", model.seen)

    @F.pandas_udf("double")
    def rate(texts):
        import pandas as pd
        return pd.Series(rates.of(model.posteriors(list(texts))))

    return docs.where(dice(id_col) < rate(F.col(text_col).cast("string")))
