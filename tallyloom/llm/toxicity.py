"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Every n-gram counts, by a hash bucket: a text's features are the distinct buckets of its n-grams,
each scaled by its log-count ratio times that ratio's size, and brought to unit length. The ratios
are drawn to 0 where a bucket was seen in few texts. Fitted on a bounded, hashed sample of labelled
rows, whose features are computed on the executors and weighed on the driver. Scoring reads every
text whole and shuffles nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.textblock import Block, append, blocks, freeing, sums, trim
from tallyloom.shipping import ship

#: Characters of an n-gram; labelled rows of each class that are fitted on at most, and the bytes of their texts.
ORDERS, SAMPLE, SAMPLE_BYTES = (4, 6, 8), 1500, 1 << 23
#: Buckets of each order (a power of two); texts of chance that a bucket's counts are mixed with; steps, step size and ridge of the fit.
BUCKET_BITS, PRIOR, STEPS, RATE, RIDGE = 20, 150.0, 50, 0.2, 1e-5
#: Share of a class in the fit that does not depend on its number of rows; features of a chunk of rows.
BALANCE, CHUNK = 0.2, 1 << 21
_LEAD = (np.arange(256) & 0xC0) != 0x80
_U = np.uint64


def grams(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of the block's character n-grams (A-Z as a-z) in text order, and where each text's begin."""
    lead = np.flatnonzero(_LEAD[block.u])
    doc = np.searchsorted(block.off, lead, "right") - 1
    ends = np.append(lead, len(block.u))
    for n in ORDERS:
        if len(lead) >= n:
            at = np.flatnonzero(doc[: len(lead) - n + 1] == doc[n - 1 :])
            h = block.hashes(lead[at], ends[at + n], lower=True)
            yield (h >> _U(64 - BUCKET_BITS)).astype(np.int32), np.searchsorted(doc[at], np.arange(block.n + 1))


class Distinct:
    """Finds the distinct buckets of each text: the last place of each one in a table of all buckets."""

    def __init__(self):
        self.last = np.zeros(1 << BUCKET_BITS, np.int32)

    def __call__(self, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
        """True where no later place of the same text has the bucket."""
        out = np.empty(len(bucket), bool)
        nth = np.arange(int(np.diff(first).max(initial=0)), dtype=np.int32)
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            b, own = bucket[i:j], nth[: j - i]
            self.last[b] = own
            out[i:j] = self.last[b] == own
        return out


@freeing
def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    distinct = Distinct()
    for b in batches:
        for lo, hi, block in blocks(b.column(0)):
            rows = [[] for _ in range(block.n)]
            for bucket, first in grams(block):
                keep = distinct(bucket, first)
                for i in range(block.n):
                    at = slice(first[i], first[i + 1])
                    rows[i].append(np.sort(bucket[at][keep[at]]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), pa.array([b"".join(r) for r in rows], pa.binary())], names=["y", "buckets"])


class Model:
    """A weight and a squared scale for every bucket, an intercept."""

    def __init__(self, weights: np.ndarray, square: np.ndarray, intercept: float):
        self.weights, self.square, self.intercept = weights.astype(np.float32), square.astype(np.float32), intercept

    @classmethod
    def constant(cls, intercept: float) -> Model:
        return cls(np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS), intercept)

    def scorer(self):
        """A function from a block to its texts' scores."""
        distinct = Distinct()

        def work(block: Block) -> list:
            z, length = np.zeros(block.n), np.zeros(block.n)
            for bucket, first in grams(block):
                keep = distinct(bucket, first)
                z += sums(np.where(keep, self.weights[bucket], 0).astype(np.float64), first)
                length += sums(np.where(keep, self.square[bucket], 0).astype(np.float64), first)
            z = np.divide(z, np.sqrt(length), out=np.zeros(block.n), where=length > 1e-9)
            return [1 / (1 + np.exp(-np.clip(z + self.intercept, -60, 60)))]

        return work


def scales(n0: np.ndarray, n1: np.ndarray, texts0: int, texts1: int) -> np.ndarray:
    """Log-count ratios times their sizes. PRIOR texts, in the sample's shares of the classes, are added to each bucket's counts."""
    p0, p1 = (PRIOR * t / max(1, texts0 + texts1) for t in (texts0, texts1))
    r = np.log((n1 + p1) / (texts1 + p1) / ((n0 + p0) / (texts0 + p0)))
    return r * np.abs(r)


def logistic(col: np.ndarray, first: np.ndarray, y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights over the scaled features of unit length, and the intercept, by full-batch Adam. Rows are col[first[i]:first[i + 1]], none empty."""
    n, size = len(y), np.diff(first)
    cut = np.unique(np.searchsorted(first, np.arange(0, first[-1], CHUNK), "left").clip(0, n - 1))
    parts = list(zip(cut.tolist(), [*cut[1:].tolist(), n], strict=True))
    scale = scale.astype(np.float32)
    length = np.concatenate([np.sqrt(np.add.reduceat(scale[col[first[i] : first[j]]] ** 2, first[i:j] - first[i])) for i, j in parts]).clip(1e-6)
    share = BALANCE * n / 2 / np.where(y == 1, (y == 1).sum(), (y == 0).sum()) + 1 - BALANCE
    share /= share.sum()
    w, b = np.zeros(len(scale)), float(np.log(share[y == 1].sum() / share[y == 0].sum()))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, STEPS + 1):
        g, total, now = RIDGE * w, 0.0, w.astype(np.float32)
        for i, j in parts:
            here = col[first[i] : first[j]]
            z = np.add.reduceat((now * scale)[here], first[i:j] - first[i]) / length[i:j] + b
            err = share[i:j] * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[i:j])
            g += np.bincount(here, np.repeat(err / length[i:j], size[i:j]), len(w)) * scale
            total += err.sum()
        g = np.append(g, total)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w * scale, float(b)


def _sorted(got: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, buckets and where each row's begin; rows without buckets are left out, the others stand in one order however they came."""
    y, buckets = got.column("y").to_numpy().astype(float), got.column("buckets")
    raw = [memoryview(x.as_buffer()) for x in buckets]
    order = [i for *_, i in sorted((y[i], len(x), zlib.crc32(x), i) for i, x in enumerate(raw) if len(x))]
    first = np.cumsum([0, *(len(raw[i]) // 4 for i in order)])
    col = np.empty(int(first[-1]), np.int32)
    for i, lo, hi in zip(order, first[:-1].tolist(), first[1:].tolist(), strict=True):
        col[lo:hi] = np.frombuffer(raw[i], "<i4")
    return y[order], col, first


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", sample: int = SAMPLE, most: int = SAMPLE_BYTES) -> Model:
    """Fit on up to `sample` rows of each class, by hash of their key, and of these on the first whose texts have `most` bytes together.

    labels: key and 0/1; other values and nulls are left out, and a key with both counts as 1.
    Without rows of both classes the model is the constant share of label 1.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    n = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    pick = [known.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(sample) for y in (0, 1)]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(pick[0].unionByName(pick[1])), "k")
    order = Window.partitionBy("y").orderBy(F.xxhash64("k"), "k", F.xxhash64("t"))  # of a class, at most `sample` keys
    size = F.sum(F.octet_length(F.coalesce("t", F.lit("")))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("upto", size).filter(F.col("upto") <= most).select("t", "y")
    got = rows.mapInArrow(_features, "y int, buckets binary").toArrow()
    y, col, first = _sorted(got)
    del got
    if len(set(y.tolist())) < 2:
        return Model.constant(float(np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1))))
    ones = int(first[np.searchsorted(y, 1)])
    n0, n1 = (np.bincount(c, minlength=1 << BUCKET_BITS) for c in (col[:ones], col[ones:]))
    scale = scales(n0, n1, int((y == 0).sum()), int((y == 1).sum()))
    weights, intercept = logistic(col, first, y, scale)
    del col
    trim()
    return Model(weights, scale**2, intercept)


def _make(model: Model):
    return model.scorer()


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and `score` (0 to 1) of every row.

    Null, empty and very short texts, which have no n-grams, get the intercept's score. Repeated
    rows and equal texts score alike. Texts count whole. An empty table gives no rows. A kept
    column called score stays as `score_`.
    """
    return append(docs, text, partial(_make, model), [("score", "double")], keep)


def held_out(key: str, folds: int, fold: int) -> Column:
    """True where crc32 of the key as text is fold modulo folds; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == fold
