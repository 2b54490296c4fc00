"""URL filter: host and path rules, and boosted trees on lexical features for the rest."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.boosting import Boosted
from tallyloom.llm.textblock import freeing
from tallyloom.shipping import ship

#: Verdict, host, path prefix.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Distinct labelled URLs of each verdict that the trees are fitted on, about (a hash sample), pseudo-counts of a suffix, folds of its rates.
SAMPLE, PRIOR, FOLDS = 10_000, 10, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one or for null."""
    return F.translate(_part(url, r"(?s)^.*?://([^/?#]*)"), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty where the host's rule finds no ://."""
    return _part(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The rule and its verdict: of those that fit, the one whose host and prefix are longest."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def lexical(url: str | None, suffix: dict[str, float], prior: float) -> list[float]:
    """Length, host length, depth, digit ratio, entropy, parameters, labels, hyphens, fragment, suffix statistics."""
    url = url or ""
    rest = url.partition("://")[2]
    bare, _, fragment = rest.partition("#")
    bare, _, query = bare.partition("?")
    host, _, path = bare.partition("/")
    host, n = host.lower(), max(1, len(url))
    labels = host.split(".")
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(url).values())
    return [
        len(url), len(host), path.count("/") + bool(path), sum(map(str.isdigit, url)) / n, entropy, len(query.split("&")) if query else 0,
        len(labels), host.count("-"), float(bool(fragment)), len(path), suffix.get(labels[-1], prior), suffix.get(".".join(labels[-2:]), prior),
    ]


def suffixes(url: str | None) -> set[str]:
    """The last label of the host, and the last two."""
    labels = (url or "").partition("://")[2].split("/")[0].split("?")[0].split("#")[0].lower().split(".")
    return {labels[-1], ".".join(labels[-2:])}


class UrlModel:
    """Trees fitted on labelled URLs: 1 is block.

    The rates of suffixes that a URL is fitted with come from the other folds' URLs, so its own
    label is not among its features.
    """

    def __init__(self, urls: list[str | None], y: np.ndarray):
        fold = np.array([zlib.crc32((u or "").encode()) % FOLDS for u in urls], np.int64)
        x = np.zeros((len(urls), 12))
        for f in range(FOLDS):
            at = np.flatnonzero(fold == f)
            if len(at):
                others = np.flatnonzero(fold != f).tolist()
                x[at] = self.features([urls[i] for i in at.tolist()], *self.rates([urls[i] for i in others], y[others]))
        self.suffix, self.prior = self.rates(urls, y)
        self.trees = Boosted().fit(x, y)

    @staticmethod
    def rates(urls: list[str | None], y: np.ndarray) -> tuple[dict[str, float], float]:
        """The share of blocked URLs by suffix, drawn to the share of all, and that."""
        seen, bad = Counter(), Counter()
        for url, v in zip(urls, y.tolist(), strict=True):
            for s in suffixes(url):
                seen[s] += 1
                bad[s] += v
        prior = float((y.sum() + 1) / (len(y) + 2))
        return {s: (bad[s] + PRIOR * prior) / (n + PRIOR) for s, n in seen.items()}, prior

    @staticmethod
    def features(urls: list[str | None], suffix: dict[str, float], prior: float) -> np.ndarray:
        return np.array([lexical(u, suffix, prior) for u in urls], float).reshape(len(urls), 12)

    def score(self, urls: list[str | None]) -> np.ndarray:
        return self.trees.score(self.features(urls, self.suffix, self.prior))


@freeing
def _scored(batches: Iterable[pa.RecordBatch], model: UrlModel) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(b.column("url").to_pylist()), pa.float64())], names=[*b.schema.names, "score"])


def labelled(rows: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """About `sample` distinct URLs of each verdict of the rules, in order, and whether each is blocked."""
    known = rows.select("url", rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)[1].alias("v")).filter("v is not null")
    share = {r.v: min(1.0, sample / r.n) for r in known.groupBy("v").agg(F.approx_count_distinct("url").alias("n")).collect() if r.n}
    place = F.shiftrightunsigned(F.xxhash64("url"), 11) / float(1 << 53)
    wanted = F.lit(False)
    for v, s in sorted(share.items()):
        wanted = wanted | ((F.col("v") == v) & (place < s))
    found = sorted((r.url, r.v == "block") for r in known.filter(wanted).distinct().collect())
    return [u for u, _ in found], np.array([float(b) for _, b in found])


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """key, host, path, rule, score and verdict (allow or block) of every row.

    The rules' own verdicts are the labelled URLs; about `sample` distinct ones of each verdict,
    those with a hash below a threshold, fit the trees on the driver. A row that no rule fits is
    blocked if its score is 0.5 or more. Without labelled URLs, or with one class only, the score is
    the constant share of blocked ones. Null URLs have empty host and path; repeated rows are judged
    alike; very long URLs count whole; no other column of pages is kept, so none clashes; an empty
    table gives no rows.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    model = UrlModel(*labelled(rows, rules, sample))
    kind = pages.schema[key].dataType.simpleString()
    out = rows.mapInArrow(partial(_scored, model=model), f"key {kind}, url string, score double")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(host, path, rules)
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return out.select(F.col("key").alias(key), host.alias("host"), path.alias("path"), rule.alias("rule"), "score", F.coalesce(verdict, own).alias("verdict"))
