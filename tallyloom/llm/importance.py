"""Quality by importance resampling.

Two generative models of hashed n-grams, one of target text (rows labelled good) and one of all
raw text, give each document the log of how much likelier the target is to have made it. Adding
Gumbel noise and taking the k largest samples k documents without replacement by that weight.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm import mixing
from tallyloom.llm.scratch import written
from tallyloom.llm.textblock import WORDPUNCT, Block, append, blocks, freeing, windows
from tallyloom.shipping import ship

#: Tokens of an n-gram, buckets of the models (a power of two), labelled target rows read at most, and how many
#: n-grams of a bucket the target is taken to hold besides, in the raw model's proportion: what the labelled rows are
#: too few to show counts as neutral.
ORDERS, BUCKET_BITS, TARGET, PRIOR = (1, 2), 16, 20_000, 100.0
#: k counts the documents whose log weight is at least -MARGIN; NOISE scales the Gumbel noise.
MARGIN, NOISE, SEED = 8.0, 1.0, 17
#: Keys are compared on a grid of 2**-FINE, and beyond +-2**WIDE as equal.
FINE, WIDE = 25, 19


_U = np.uint64
#: Buckets of the two n-grams that stand for a word's form: it repeats the word before it; it is all in capitals.
_AGAIN, _CAPITALS = 0x5BD1 % (1 << BUCKET_BITS), 0xE995 % (1 << BUCKET_BITS)
_UPPER, _LOWER = (np.isin(np.arange(256), range(a, a + 26)) for a in (65, 97))


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the block's n-grams, and their texts' numbers.

    Tokens are words as they are written and runs of punctuation. A word that repeats the one before
    it makes one n-gram more, and so does one of two bytes or more with A-Z and without a-z; these
    are the same for all words, since most words are too rare to tell much.
    """
    t = block.tokens(WORDPUNCT)
    h, doc = t.hashes(), t.doc()
    word = WORDPUNCT[block.u[t.start]] == 2 if len(h) else np.zeros(0, bool)
    again, capitals = np.zeros(len(h), bool), np.zeros(len(h), bool)
    if len(h):
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]) & word[1:]
        upper, lower = (np.concatenate([[0], np.cumsum(m[block.u])]) for m in (_UPPER, _LOWER))
        capitals = word & (t.end - t.start > 1) & (upper[t.end] > upper[t.start]) & (lower[t.end] == lower[t.start])
    found = [windows(t, h, n) for n in ORDERS]
    forms = [(np.full(int(m.sum()), b), doc[m]) for m, b in ((again, _AGAIN), (capitals, _CAPITALS))]
    bucket = [*((v >> _U(64 - BUCKET_BITS)).astype(np.int64) for v, _ in found), *(b for b, _ in forms)]
    return np.concatenate(bucket), np.concatenate([*(doc[at] for _, at in found), *(d for _, d in forms)])


@freeing
def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = 1 << BUCKET_BITS
    raw, target = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for b in batches:
        good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, block in blocks(b.column(0)):
            bucket, doc = grams(block)
            raw += np.bincount(bucket, minlength=n)
            if good[lo:hi].any():
                target += np.bincount(bucket[good[lo:hi][doc]], minlength=n)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most: int = TARGET) -> np.ndarray:
    """Log ratio of target to raw probability by bucket.

    The raw model counts every document; the target model up to `most` documents labelled 1, by
    hash of their key. A bucket's ratio is that of the target's count to the one expected of raw
    text, both with PRIOR added, so that it is near 0 where little is expected. Without labelled
    documents it is 0 everywhere, and all documents are kept.
    """
    ship(docs.sparkSession)
    good = labels.filter(F.col(label) == 1).select(F.col(key).alias("k")).filter("k is not null").distinct().orderBy(F.xxhash64("k"), "k").limit(most)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(good.withColumn("good", F.lit(True))), "k", "left")
    rows = rows.select("t", F.coalesce("good", F.lit(False)).alias("good"))
    got = rows.mapInArrow(_counts, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.ones(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    at = got.column("bucket").to_numpy()
    raw[at] += got.column("raw").to_numpy()
    target[at] += got.column("target").to_numpy()
    raw /= raw.sum()
    ratio = (target + PRIOR) / (target.sum() * raw + PRIOR)
    return np.log(ratio / (raw * ratio).sum())


def _weigh(ratio: np.ndarray, block: Block) -> list:
    bucket, doc = grams(block)
    return [np.bincount(doc, ratio[bucket], block.n), np.bincount(doc, minlength=block.n).astype(np.int64)]


def _make(ratio: np.ndarray):
    return partial(_weigh, ratio)


def _noise(key: str) -> Column:
    """Gumbel noise that depends on the row's key alone."""
    u = (F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(SEED)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    return -NOISE * F.log(-F.log(u))


def _rank(value: Column) -> Column:
    """The place of a key on the grid, from the largest; fits mixing.thresholds."""
    top = float(1 << WIDE)
    return F.floor((top - F.least(F.greatest(value, F.lit(-top + 1)), F.lit(top - 1))) * float(1 << FINE)).cast("bigint")


def weighed(docs: DataFrame, ratio: np.ndarray, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and log_weight, n_grams, gumbel_key, rank of every row; a kept column of such a name gets `_` appended."""
    out = append(docs.withColumn("_noise", _noise(key)), text, partial(_make, ratio), [("log_weight", "double"), ("n_grams", "bigint")], [*(docs.columns if keep is None else keep), "_noise"], ["gumbel_key", "rank"])
    return out.withColumn("gumbel_key", F.col("log_weight") + F.col("_noise")).withColumn("rank", _rank(F.col("gumbel_key"))).drop("_noise")


def cut(rows: DataFrame) -> int:
    """The rank below which rows are in the top k, k being the rows of log weight -MARGIN or more."""
    k = rows.filter(F.col("log_weight") >= -MARGIN).count()
    one = rows.select(F.lit(0).alias("g"), F.lit(1).cast("bigint").alias("size"), "rank")
    budget = rows.sparkSession.createDataFrame([(0, float(k))], "g int, budget double")
    got = mixing.thresholds(one, budget, "g", "size", "rank").collect()
    return int(got[0].cut)


def select(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, log_weight, n_grams, gumbel_key and selected of every row.

    Null and empty texts weigh 0, so they count as no worse than the corpus. Repeated rows have
    equal keys and are selected together; rows tied at the threshold are all left out. Texts count
    whole. An empty table gives no rows.
    """
    rows = written(weighed(docs, fit(docs, labels, key=key, text=text), key, text, [key]), "weights")
    return rows.withColumn("selected", F.col("rank") < cut(rows)).drop("rank")


def keep_selected(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The selected rows of docs, with docs' columns, whatever their names.

    Texts are scored again, which costs less than carrying them. Null and empty texts weigh 0 and
    rows without a key share their noise; repeated rows are selected together; an empty table
    stays empty; very long texts count whole.
    """
    ratio = fit(docs, labels, key=key, text=text)
    top = cut(written(weighed(docs, ratio, key, text, [key]), "weights"))
    extra = ["log_weight", "n_grams", "gumbel_key", "rank"]
    own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # names of docs may clash with the added ones
    where = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    out = weighed(own, ratio, where[key], where[text]).filter(F.col("rank") < top).drop(*extra)
    return out.toDF(*docs.columns)
