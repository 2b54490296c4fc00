"""How stable answers are across replicate runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions import stats


def pairs(df: DataFrame, unit: Sequence[str], run: str, carry: Sequence[str]) -> DataFrame:
    """Unordered pairs of runs of one unit: carried columns end in _a and _b, run _a is the lesser."""
    side = lambda s: df.select(*unit, *[F.col(c).alias(f"{c}_{s}") for c in [run, *carry]])
    return side("a").join(side("b"), list(unit)).filter(F.col(f"{run}_a") < F.col(f"{run}_b"))


def agreement(paired: DataFrame, by: Sequence[str], field: str) -> DataFrame:
    """Pairs and the share that agree on the field; a pair with a null on either side counts in n_pairs only."""
    same = F.col(f"{field}_a") == F.col(f"{field}_b")
    return paired.groupBy(*by).agg(F.count("*").alias("n_pairs"), F.round(F.avg(same.cast("bigint")), 6).alias("agreement_rate"))


def agreement_of(df: DataFrame, unit: Sequence[str], by: Sequence[str], fields: Mapping[str, Column]) -> DataFrame:
    """field, by, n_runs_pairs, n_pairs, n_same: over all unordered pairs of rows of a unit, without making a pair.

    n rows of a unit make n (n - 1) / 2 pairs, m of them filled m (m - 1) / 2 that are filled on both
    sides, and c rows of one value c (c - 1) / 2 that agree. Rows are counted by unit and value first,
    so a unit of any size is sums.
    """
    rows = F.array(*[F.struct(F.lit(f).alias("field"), x.cast("string").alias("value")) for f, x in fields.items()])
    one = df.select(*unit, *[c for c in by if c not in unit], F.inline(rows))
    keys = list(dict.fromkeys([*unit, *by]))
    equal = one.groupBy("field", *keys, "value").agg(F.count("*").alias("c"))
    two = lambda n: n * (n - 1) / 2
    filled = F.when(F.col("value").isNotNull(), F.col("c")).otherwise(0)
    units = equal.groupBy("field", *keys).agg(F.sum("c").alias("n"), F.sum(filled).alias("m"), F.sum(two(filled)).alias("same"))
    return units.groupBy("field", *by).agg(*[F.sum(x).cast("bigint").alias(n) for n, x in (("n_run_pairs", two(F.col("n"))), ("n_pairs", two(F.col("m"))), ("n_same", F.col("same")))])


def agreement_by_field(paired: DataFrame, fields: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per field: pairs filled on both sides, and the share of them that agree."""
    rows = F.array(*[F.struct(F.lit(f).alias("field"), (a.isNotNull() & b.isNotNull()).alias("both"), (a == b).alias("same")) for f, (a, b) in fields.items()])
    g = paired.select(F.inline(rows)).groupBy("field").agg(F.count_if("both").alias("n_pairs"), F.count_if(F.col("both") & F.col("same")).alias("n_same"))
    return g.select("field", "n_pairs", F.round(stats.share(F.col("n_same"), F.col("n_pairs")), 6).alias("agreement_rate"))
