"""Box metrics and the banner: counts by question and cut, made from one pre-aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions import stats
from tallyloom.operators.reshape import fan_out

BOXES = ("is_tb", "is_t2b", "is_b2b", "is_bot")


def with_boxes(df: DataFrame, code: str = "primary_code", scale: str = "scale_max") -> DataFrame:
    """Top, top-two, bottom-two and bottom box flags; null where the code or the scale is."""
    c, s = F.col(code), F.col(scale)
    return df.withColumns({"is_tb": c == 1, "is_t2b": c.isin(1, 2), "is_b2b": (c == s) | (c == s - 1), "is_bot": c == s})


def banner_counts(df: DataFrame, keys: Sequence[str], cuts: Mapping[str, Column | str], code: str = "primary_code") -> DataFrame:
    """Counts per key, cut_name and cut_value.

    All measures are sums, so rows are first summed by key and all cuts together, which the map
    side combines; only those sums are fanned out.
    """
    named = {f"_cut{i}": (F.col(c) if isinstance(c, str) else c) for i, c in enumerate(cuts.values())}
    cells = df.withColumns(named).groupBy(*keys, *named).agg(
        F.count("*").alias("n"), F.count(code).alias("n_valid"), *[F.count_if(b).alias(b.replace("is_", "") + "_n") for b in BOXES], F.sum(code).alias("code_sum")
    )
    out = fan_out(cells, dict(zip(cuts, named, strict=True)))
    measures = ["n", "n_valid", *[b.replace("is_", "") + "_n" for b in BOXES], "code_sum"]
    return out.groupBy(*keys, "cut_name", "cut_value").agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


def banner(df: DataFrame, keys: Sequence[str], cuts: Mapping[str, Column | str], code: str = "primary_code", digits: int = 6) -> DataFrame:
    """The tidy banner: n, n_valid, tb/t2b/b2b/bot shares of n, mean code."""
    b = banner_counts(df, keys, cuts, code)
    pct = [F.round(stats.share(F.col(f"{m}_n"), F.col("n")), digits).alias(f"{m}_pct") for m in ("tb", "t2b", "b2b", "bot")]
    return b.select(*keys, "cut_name", "cut_value", "n", "n_valid", *pct, F.round(stats.share(F.col("code_sum"), F.col("n_valid")), digits).alias("mean_score"))


def persona_flags(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """One row per persona: whether any of its rows meets each condition; null if none can say."""
    return df.groupBy(key).agg(*[F.bool_or(c).alias(n) for n, c in flags.items()])


def sensitivity(df: DataFrame, keep: Column, keys: Sequence[str], cuts: Mapping[str, Column | str], code: str = "primary_code") -> DataFrame:
    """The banner with all rows and with only those that `keep` holds for, side by side, and the top-box change."""
    on = [*keys, "cut_name", "cut_value"]
    a = banner(df, keys, cuts, code).select(*on, F.col("n").alias("n_all"), F.col("tb_pct").alias("tb_all"))
    b = banner(df.filter(keep), keys, cuts, code).select(*on, F.col("n").alias("n_kept"), F.col("tb_pct").alias("tb_kept"))
    return a.join(b, on, "left").withColumn("tb_change", F.round(F.col("tb_kept") - F.col("tb_all"), 6))


def z_tests(counts: DataFrame, keys: Sequence[str], cut: str, hits: str = "tb_n", n: str = "n") -> DataFrame:
    """Each two values of a cut compared by a two-proportion z test.

    Takes banner_counts: pairs are made among the few values of one cut and key, never among rows.
    """
    c = counts.filter(F.col("cut_name") == cut)
    side = lambda s: c.select(*keys, F.col("cut_value").alias(f"value_{s}"), F.col(hits).alias(f"hits_{s}"), F.col(n).alias(f"n_{s}"))
    pairs = side("a").join(side("b"), list(keys)).filter("value_a < value_b")
    z = stats.two_proportion_z(F.col("hits_a"), F.col("n_a"), F.col("hits_b"), F.col("n_b"))
    pairs = pairs.withColumn("z", z)
    return pairs.select(*keys, "value_a", "value_b", "n_a", "n_b", (F.round("z", 6) + 0.0).alias("z"), F.round(stats.two_sided_p(F.col("z")), 6).alias("p_value"))


def compare_modalities(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Top-box count and share per key."""
    g = df.groupBy(*keys).agg(F.count_if("is_tb").alias("tb_n"), F.count("*").alias("n"))
    return g.select(*keys, "tb_n", F.round(stats.share(F.col("tb_n"), F.col("n")), 6).alias("tb_pct"))
