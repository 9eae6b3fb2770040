"""Quality scores by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text.  Preference pairs
join labelled good documents with labelled bad ones; the weights minimise the
logistic loss of the pairs' feature differences (Newton's method, L2).  The pairs
are those of at most ``FIT_ROWS`` labelled documents; the features' mean and
spread, and the decision threshold, which is the quantile of the scores at the
share of bad labels, are those of all labelled documents that aren't held out.
The reported score is the logistic of the distance to it, so 0.5 is the
threshold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded, stash
from ledgerline.operators.quantile import percentile_cont

#: Labelled documents, of those not held out, that the weights are fitted on at most.
FIT_ROWS = 40_000
#: Pairs that each fitted document of the larger class takes part in.
PAIRS_PER_ROW = 8
L2 = 1e-3
#: Buckets of the sample's hashes; pairs of a step of the fit.
BUCKETS, CHUNK = 4096, 16_384
SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]=_~^\\]")
_LETTER = re.compile(r"[^\W\d_]")


def _features(text: str) -> list[float]:
    """Numbers that describe one text; all finite, for the empty text too."""
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, chars = len(words), max(1, len(text))
    low = [w.lower() for w in words]
    counted = Counter(low)
    top = sum(c for _, c in counted.most_common(5))
    grams = Counter(zip(low, low[1:], low[2:]))
    repeated = sum(c for c in grams.values() if c > 1)
    lengths = np.array([len(w) for w in words] or [0])
    upper = sum(map(str.isupper, text))
    size = max(1, n)
    return [
        np.log1p(n), np.log1p(len(lines)), lengths.mean(), lengths.std(),
        len(SYMBOLS.findall(text)) / chars, upper / chars, sum(map(str.isdigit, text)) / chars,
        text.count("!") / size, text.count("?") / size, text.count(".") / size, text.count(",") / size,
        text.count("|") / size, text.count('"') / size, text.count("@") / size, text.count("http") / size,
        len(counted) / size, top / size, repeated / size, sum(a == b for a, b in zip(low, low[1:])) / size,
        1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)),
        sum(w.isupper() for w in words) / size, sum(w[-1] in ".,;:!?" for w in words) / size,
        sum(w[0].isupper() for w in words) / size, sum(1 for w in words if len(w) > 20) / size,
        sum(1 for w in words if not _LETTER.search(w)) / size, float(n < 5), float(n < 20),
    ]


def featured(rows: DataFrame) -> DataFrame:
    """``rows`` with ``features`` in place of their last column, the text."""
    keep = rows.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(keep)
        for batch in bounded(batches, last):
            made = [_features(t or "") for t in batch.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.list_(pa.float64()))],
                                             names=[*[f.name for f in keep], "features"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
    return rows.mapInArrow(run, f"{fields}features array<double>")


def _expanded(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standardised features, cut at eight spreads, and their squares."""
    z = np.clip((x - mean) / spread, -8, 8)
    return np.hstack([z, z * z])


def fit(features: np.ndarray, good: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, l2: float = L2,
        seed: int = 0, mean: np.ndarray | None = None, spread: np.ndarray | None = None) -> dict:
    """Bradley-Terry weights; without labels of both kinds they are zero, and every score is 0.5.

    ``mean`` and ``spread`` of the features are those of the given rows if they aren't given.
    """
    d = features.shape[1] if features.size else len(_features(""))
    model = {"mean": np.zeros(d), "spread": np.ones(d), "weights": np.zeros(2 * d), "threshold": 0.0}
    if not len(good) or good.all() or not good.any():
        return model
    model["mean"] = features.mean(axis=0) if mean is None else mean
    model["spread"] = np.maximum(features.std(axis=0) if spread is None else spread, 1e-9)
    x = _expanded(features, model["mean"], model["spread"])
    a, b, rng = np.flatnonzero(good), np.flatnonzero(~good), np.random.default_rng(seed)
    n = pairs_per_row * max(len(a), len(b))
    ups, downs = rng.permutation(np.resize(a, n)), rng.permutation(np.resize(b, n))
    w = model["weights"]
    for _ in range(25):  # Newton's method on the mean logistic loss
        gradient, hessian = l2 * w, l2 * np.eye(len(w))
        for at in range(0, n, CHUNK):  # the pairs' differences are never all there at once
            diff = x[ups[at:at + CHUNK]] - x[downs[at:at + CHUNK]]
            p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # chance that the pair is the other way round
            gradient = gradient - (diff * p[:, None]).sum(axis=0) / n
            hessian = hessian + (diff * (p * (1 - p))[:, None]).T @ diff / n
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    model["weights"] = w
    return model


def _sample(known: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` of the labelled documents, by the hash of their id.

    The hashes' buckets are counted first, and only documents of the first buckets
    that hold ``rows`` together are sent to the driver.
    """
    sizes = dict(known.groupBy("bucket").count().collect())  # a number for each of BUCKETS buckets at most
    kept, total = [], 0
    for bucket in sorted(sizes):
        total += sizes[bucket]
        if total > rows:
            break
        kept.append(bucket)
    if not kept:
        return np.zeros((0, 0)), np.zeros(0, bool)
    got = known.filter(F.col("bucket") <= kept[-1]).orderBy("bucket", "h").select("features", "label").toPandas()
    return np.vstack(got.features.to_numpy()), got.label.to_numpy() == 1


def _learn(seen: DataFrame, labels: DataFrame, label_col: str, fit_rows: int) -> dict:
    """The model: weights from a bounded sample, the features' mean and spread and the threshold from all labelled rows."""
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col(label_col).alias("label")).filter("label IN (0, 1)")
    marks = marks.groupBy("label_id").agg(F.max("label").alias("label"))
    h = F.xxhash64("doc_id")
    known = stash(seen.filter("NOT held_out").join(marks, F.col("doc_id") == F.col("label_id")).select(
        "features", "label", h.alias("h"), F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket")))
    d = len(_features(""))
    stats = known.agg(F.avg("label").alias("good"), *[f(F.col("features")[i]).alias(f"{n}{i}") for i in range(d)
                                                      for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if stats.good is None or stats.good in (0.0, 1.0):
        return fit(np.zeros((0, 0)), np.zeros(0, bool))
    mean, spread = (np.array([stats[f"{n}{i}"] for i in range(d)]) for n in "ms")
    model = fit(*_sample(known, fit_rows), mean=mean, spread=spread)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_raw(batch.column(0), model))], names=["raw"])

    scores = stash(known.select("features").mapInArrow(raw, "raw double"))
    return model | {"threshold": percentile_cont(scores, "raw", 1 - stats.good)}


def _raw(features: pa.Array, model: dict) -> np.ndarray:
    x = np.vstack([np.array(f) for f in features.to_pylist()])
    return _expanded(x, model["mean"], model["spread"]) @ model["weights"]


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Only labels of documents that aren't held out (crc32 of the id's digits mod
    3 is 1) are learnt from; a score depends on the text alone.  Null texts are
    empty texts and get a score.  Null ids aren't held out and have no label;
    of repeated labels the larger counts.  An empty table gives no rows; without
    labels of both kinds all scores are 0.5.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"))
    seen = stash(featured(rows))
    model = _learn(seen, labels, label_col, fit_rows)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _raw(batch.column(2), model) - model["threshold"]
            score = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return seen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
