"""Comparison with an outside benchmark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions import stats


def calibrate(banner: DataFrame, benchmark: DataFrame, crosswalk: DataFrame, cut_name: str = "TOTAL", banner_col: str = "Total") -> DataFrame:
    """human_pct, synthetic_pct, delta and rel_delta per question and row label.

    crosswalk: wtab_label, question_key, row_label. benchmark: question_label, row_label, banner_col,
    value, is_pct; only percentages of one banner column count, as fractions. banner: one creative's.
    """
    h = benchmark.filter((F.col("banner_col") == banner_col) & F.col("is_pct")).select(F.col("question_label").alias("wtab_label"), "row_label", (F.col("value") / 100).alias("human_pct"))
    s = banner.filter(F.col("cut_name") == cut_name).select("question_key", F.col("tb_pct").alias("synthetic_pct"))
    out = h.join(crosswalk, ["wtab_label", "row_label"]).join(s, "question_key")
    return deltas(out).select("question_key", "row_label", "human_pct", "synthetic_pct", "delta", "rel_delta")


def deltas(df: DataFrame, ours: str = "synthetic_pct", theirs: str = "human_pct") -> DataFrame:
    gap = F.col(ours) - F.col(theirs)
    return df.withColumns({"delta": F.round(gap, 6), "rel_delta": F.round(stats.share(gap, F.col(theirs)), 6)})


def spearman(df: DataFrame, by: Sequence[str], a: str, b: str) -> DataFrame:
    """Rank correlation per group, tied values at their mean rank; null where either side is all ties."""
    rank = lambda c: F.rank().over(Window.partitionBy(*by).orderBy(c)) + (F.count("*").over(Window.partitionBy(*by, c)) - 1) / 2
    ranked = df.withColumns({"_a": rank(a), "_b": rank(b)})
    rho = F.try_divide(F.covar_pop("_a", "_b"), F.stddev_pop("_a") * F.stddev_pop("_b"))
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), (F.round(rho, 6) + 0.0).alias("rho"))
