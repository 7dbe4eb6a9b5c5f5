"""Quality classifier: regularised quadratic discriminant (operator 8).

1. Each whole text is turned into ``FEATURES``, transformed statistics of
   its words, lines and bytes (logarithms of shares, so that the classes are
   closer to normal), once, in Arrow batches; the slim rows are staged.
2. The labelled rows are joined by id.  Rows whose crc32(id as text) mod
   ``FOLDS`` is 0 are held out and never fitted on.  Class counts, sums and
   sums of products are partial sums per task, added by a grouped sum; only
   those few hundred numbers reach the driver.
3. Class covariances shrink towards the pooled one, and towards a multiple
   of the identity; their Cholesky factors are inverted once and kept.
4. A score is the logistic of the difference of the two Mahalanobis
   log-densities plus the log prior odds.

Labels, language, source and id are no features.  Null texts count as empty;
empty texts are scored like any other.  Null labels, labels other than 0 and
1, and labels of unknown ids are ignored; an id labelled twice takes the
smaller label; a null id is never labelled and counts as the id text "".
With fewer than two fitted rows in a class every score is the share of label
1 (0.5 without labels).  An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampwatch.llm.common import stage

FOLDS = 5
#: scores from here on are predicted 1
CUT = 0.3
#: shares of the pooled covariance and of the identity in a class covariance
POOLED, ROUND = 0.3, 0.05

FEATURES = ("words", "word_length", "upper", "digits", "stops", "shouts", "bars", "signs",
            "high_bytes", "distinct", "top_word", "adjacent", "line_repeats", "line_words")


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, dtype=bool)
    m[list(chars)] = True
    return m


_UPPER = _mask(bytes(range(65, 91)))
_LETTER = _UPPER | _mask(bytes(range(97, 123)))
_DIGIT = _mask(b"0123456789")
_STOP = _mask(b".,;:")
_SHOUT = _mask(b"!?")
_SIGN = _mask(b"#$%&*+<=>@[\\]^_`{}~")
_HIGH = np.arange(256) >= 128


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, as ``FEATURES``."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    count = np.bincount(raw, minlength=256)
    size = len(raw)
    words = text.split()
    n = len(words)
    letters = int(count[_LETTER].sum())
    tally = Counter(words)
    lines = [x for x in text.split("\n") if x]

    def share(part, whole, usual, weight):
        """A share that short texts hold near its usual value."""
        return (float(part) + usual * weight) / (whole + weight)

    return [
        log(20 + n),
        log(share(size, n, 6.5, 10)),
        log(0.01 + share(count[_UPPER].sum(), letters, 0.02, 60)),
        log(0.005 + share(count[_DIGIT].sum(), size, 0.002, 60)),
        log(0.01 + share(count[_STOP].sum(), size, 0.02, 60)),
        log(0.002 + share(count[_SHOUT].sum(), size, 0.0, 60)),
        log(0.002 + share(count[124], size, 0.0, 60)),
        log(0.005 + share(count[_SIGN].sum(), size, 0.0, 60)),
        log(0.02 + share(count[_HIGH].sum(), size, 0.02, 60)),
        log(20 + len(tally)) / log(20 + n),
        log(0.02 + share(max(tally.values(), default=0), n, 0.07, 20)),
        log(0.01 + share(sum(map(eq, words, words[1:])), n, 0.005, 20)),
        log(0.02 + share(len(lines) - len(set(lines)), len(lines), 0.0, 4)),
        log(10 + n / max(1, len(lines))),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, x array<double>`` per row."""
    def run(batches):
        import pyarrow as pa

        from lampwatch.llm.quality import statistics
        for b in batches:
            x = [statistics(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "x"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, x array<double>").select(
        "doc_id", held_out("doc_id").alias("held_out"), "x")


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


@dataclass
class Discriminant:
    """Class means, inverted Cholesky factors and offsets; ``share`` is the
    constant score when nothing could be fitted."""

    share: float
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    mean: list[np.ndarray] | None = None
    factor: list[np.ndarray] | None = None
    offset: list[float] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.share)
        z = (x - self.shift) / self.scale
        side = [self.offset[c] - 0.5 * (((z - self.mean[c]) @ self.factor[c].T) ** 2).sum(1)
                for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(side[0] - side[1], -500, 500)))


def fit(rows: DataFrame) -> Discriminant:
    """Fit on ``x array<double>, label int`` (0 or 1)."""
    d = len(FEATURES)

    def moments(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        k = total.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], k), pa.int32()), pa.array(np.tile(np.arange(k), 2), pa.int32()),
             pa.array(total.ravel())], names=["label", "i", "v"])

    sums = np.zeros((2, 1 + d + d * d))
    part = rows.select("x", F.col("label").cast("int")).mapInArrow(moments, "label int, i int, v double")
    for r in part.groupBy("label", "i").agg(F.sum("v").alias("v")).collect():
        sums[r["label"], r["i"]] = r["v"]
    n = sums[:, 0]
    if min(n) < 2:
        return Discriminant(float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = sums[:, 1:1 + d] / n[:, None]
    cov = [sums[c, 1 + d:].reshape(d, d) / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)]
    shift = sums[:, 1:1 + d].sum(0) / n.sum()
    spread = [cov[c] + np.outer(mean[c] - shift, mean[c] - shift) for c in (0, 1)]
    scale = np.sqrt(np.maximum(np.diag(n[0] * spread[0] + n[1] * spread[1]) / n.sum(), 1e-12))
    cov = [c / np.outer(scale, scale) for c in cov]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    factor, offset = [], []
    for c in (0, 1):
        s = (1 - POOLED) * cov[c] + POOLED * pooled
        s = (1 - ROUND) * s + ROUND * np.eye(d) * max(np.trace(s) / d, 1e-6)
        low = np.linalg.cholesky(s)
        factor.append(np.linalg.inv(low))
        offset.append(log(n[c] / n.sum()) - float(np.log(np.diag(low)).sum()))
    return Discriminant(float(n[1] / n.sum()), shift, scale,
                        [(m - shift) / scale for m in mean], factor, offset)


def fitted(feats: DataFrame, labels: DataFrame, label_col: str = "quality",
           id_col: str = "doc_id") -> Discriminant:
    """Fit on the labelled rows outside the held-out fold."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)")
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    return fit(feats.where(~F.col("held_out")).join(known, "doc_id").select("x", "label"))


def scored(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``."""
    feats = stage(features(docs, id_col, text_col), "quality")
    model = fitted(feats, labels, label_col, id_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array(s >= CUT).cast(pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return feats.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted 1, with all their columns and without a
    shuffle of texts: the fitted model scores each text where it is read."""
    model = fitted(stage(features(docs, id_col, text_col), "quality"), labels, label_col, id_col)

    @F.pandas_udf("double")
    def score(texts):
        import numpy as np
        import pandas as pd

        from lampwatch.llm.quality import FEATURES, statistics
        x = np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))
        return pd.Series(model.scores(x))

    return docs.where(score(F.col(text_col).cast("string")) >= CUT)
