"""Reshaping: blocks of columns to rows, rows to banner cuts, tidy to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = ("question", "meta", "type", "rating_label", "rating", "selected", "qual")


def unpivot_blocks(df: DataFrame, blocks: Sequence[Mapping[str, str]], ids: Sequence[str], ordinal: str = "q_idx") -> DataFrame:
    """One row per input row and block: ids, the ordinal (from 1) and the block's fields.

    blocks: for each block, its field names and the columns they come from, in one order. Blocks of
    nulls stay; filter on a field to drop them. Narrow: no shuffle, and unused columns are pruned.
    """
    rows = F.array(*[F.struct(*[F.col(c).alias(f) for f, c in b.items()]) for b in blocks])
    out = df.select(*ids, F.posexplode(rows).alias("_i", "_b"))
    return out.select(*ids, (F.col("_i") + 1).cast("bigint").alias(ordinal), *[F.col(f"_b.{f}").alias(f) for f in blocks[0]])


def question_blocks(n: int, fields: Sequence[str] = BLOCK) -> list[dict[str, str]]:
    """The blocks of a wide file: Q1_question .. Qn_qual."""
    return [{f: f"Q{i}_{f}" for f in fields} for i in range(1, n + 1)]


def fan_out(df: DataFrame, cuts: Mapping[str, Column | str]) -> DataFrame:
    """Each row once per cut, with cut_name and cut_value (text)."""
    rows = [F.struct(F.lit(n).alias("cut_name"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("cut_value")) for n, c in cuts.items()]
    return df.select("*", F.inline(F.array(*rows)))


def pivot_cuts(tidy: DataFrame, keys: Sequence[str], cut: str, values: Sequence[str], measure: str) -> DataFrame:
    """The tidy banner as a wide table, a column per value of the cut. Values are listed, so nothing is scanned to find them."""
    return tidy.groupBy(*keys).pivot(cut, list(values)).agg(F.first(measure))
