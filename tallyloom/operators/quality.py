"""Gates that stop a build, and the data-quality suite, which reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


class GateError(AssertionError):
    """A gate that did not hold."""


def gate(df: DataFrame, checks: Mapping[str, tuple[Column, object]]) -> dict[str, object]:
    """Evaluate aggregate checks in one pass; raise GateError naming all whose value is not the one expected."""
    row = df.agg(*[c.alias(n) for n, (c, _) in checks.items()]).first()
    bad = {n: (row[n], want) for n, (_, want) in checks.items() if row[n] != want}
    if bad:
        raise GateError("; ".join(f"{n}: {got}, expected {want}" for n, (got, want) in bad.items()))
    return row.asDict()


def gate_raw(raw: DataFrame, section: str, expected: Mapping[str, int]) -> dict[str, object]:
    """Gate 1: rows of each section's files, and of all together."""
    one = {s: (F.count_if(F.col(section) == s), n) for s, n in expected.items()}
    return gate(raw, one | {"all": (F.count("*"), sum(expected.values()))})


def gate_personas(persona: DataFrame, run: DataFrame, n: int, n_runs: int, n_rows: int) -> dict[str, object]:
    """Gate 2: personas are unique, none lacks an age band or a creative; the runs' rows add up."""
    key = F.struct("archetype_id", "modality")
    gate(persona, {
        "personas": (F.count("*"), n), "unique": (F.countDistinct(key), n),
        "no_band": (F.count_if(F.col("age_band_banner").isNull()), 0), "no_creative": (F.count_if(F.col("creative").isNull()), 0),
    })
    return gate(run, {"runs": (F.count("*"), n_runs), "rows": (F.coalesce(F.sum("n_rows"), F.lit(0)), n_rows)})


def gate_questions(questions: DataFrame, n: int, n_meta: int) -> dict[str, object]:
    """Gate 3: distinct question slots and metas."""
    return gate(questions, {"questions": (F.countDistinct("slot_key"), n), "metas": (F.countDistinct("meta"), n_meta)})


def gate_facts(fact: DataFrame, rows: int, primary: int, replicated: int, verbatims: int) -> dict[str, object]:
    """Gate 4: rows of the fact; primary rows; rows of keys with two runs, of twice as many rows as keys; verbatims; and that single rows and replicated ones make all."""
    twice = F.col("run_count") == 2
    key = F.struct("archetype_id", "slot_key")
    return gate(fact, {
        "rows": (F.count("*"), rows), "primary": (F.count_if("is_primary_run"), primary), "keys": (F.countDistinct(key), primary),
        "replicated_rows": (F.count_if(twice), 2 * replicated), "replicated_keys": (F.countDistinct(F.when(twice, key)), replicated),
        "verbatims": (F.count("qual_text"), verbatims), "single_rows": (F.count_if(~twice), rows - 2 * replicated),
    })


def suite(parts: Sequence[tuple[DataFrame, Mapping[str, tuple[Column, int]]]]) -> DataFrame:
    """(check_id, observed, expected, passed): each part's checks share one pass over it."""
    out = None
    for df, checks in parts:
        rows = F.array(*[F.struct(F.lit(n).alias("check_id"), F.col(f"_{i}").cast("bigint").alias("observed"), F.lit(want).cast("bigint").alias("expected")) for i, (n, (_, want)) in enumerate(checks.items())])
        one = df.agg(*[c.alias(f"_{i}") for i, (c, _) in enumerate(checks.values())]).select(F.inline(rows))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("passed", F.col("observed") == F.col("expected"))


def _wrong(sizes: Mapping[str, int]) -> Column:
    """How many cohorts (cohort_code, n) have another size than expected, are not expected, or lack."""
    c = F.col
    right = F.lit(False)
    for k, n in sizes.items():
        right = right | ((c("cohort_code") == k) & (c("n") == n))
    there = F.count_if(F.coalesce(c("cohort_code").isin(*sizes), F.lit(False)))
    return F.count_if(~F.coalesce(right, F.lit(False))) + (F.lit(len(sizes)) - there)


def survey_suite(fact: DataFrame, staged: DataFrame, persona: DataFrame, raw_ages: DataFrame, run: DataFrame, universe: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """DQ01 to DQ16 over the curated model. expected: counts by check id; violations are expected 0.

    DQ04 counts cohorts whose size is not the one expected: expected has `DQ04:<cohort>` for each,
    and a cohort without an entry is a violation, as is an entry without its cohort. DQ13 counts
    slots without exactly one primary row, and personas with two primary runs in one section. DQ15
    counts replicated keys, and DQ15r their rows; DQ16 counts the runs' rows, and DQ16n the runs. Of
    these, DQ15r and DQ16n are there where expected has them.
    """
    c, want = F.col, lambda k: expected.get(k, 0)
    label = lambda: F.exists("selected_options", lambda o: o["option_label"].rlike(r"^\d+\.\s"))
    closed = c("q_type").isin(4, 5)
    slots = fact.groupBy("archetype_id", "slot_key").agg(F.count_if("is_primary_run").alias("n_primary"), F.max("run_count").alias("n_runs"))
    section = ["section_code"] if "section_code" in fact.columns else []
    chosen = fact.filter("is_primary_run").groupBy("archetype_id", *section).agg(F.countDistinct("run_id").alias("runs")).select((c("runs") > 1).alias("bad")) if section else None
    bad = slots.select((c("n_primary") != 1).alias("bad"))
    bad = bad if chosen is None else bad.unionByName(chosen)
    sizes = {k.split(":", 1)[1]: n for k, n in expected.items() if k.startswith("DQ04:")}
    scale = universe.select("question_key", "scale_max").distinct()
    cohorts = persona.groupBy("cohort_code").agg(F.countDistinct("archetype_id").alias("n"))
    orphans = staged.join(persona.select("archetype_id").distinct(), "archetype_id", "left_anti")
    one = F.count("*")
    return suite([
        (fact, {
            "DQ01": (one, want("DQ01")), "DQ03": (F.countDistinct("slot_key"), want("DQ03")),
            "DQ08": (F.count_if((c("q_type") == 1) & c("qual_text").isNull()), want("DQ08")),
            "DQ09": (F.count_if(closed & (F.size("selected_options") < 1)), 0), "DQ10": (F.count_if(label()), 0), "DQ12": (F.count("qual_text"), want("DQ12")),
        }),
        (persona, {"DQ02": (F.countDistinct("archetype_id"), want("DQ02")), "DQ06": (F.count_if(c("age_band_banner").isNull()), 0), "DQ14": (F.count_if(c("income_high_usd") < c("income_low_usd")), 0)}),
        (cohorts, {"DQ04": (_wrong(sizes), 0)} if sizes else {"DQ04": (one, want("DQ04"))}),
        (orphans, {"DQ05": (one, 0)}),
        (raw_ages, {"DQ07": (F.count_if("age_band_is_imputed"), want("DQ07"))}),
        (scale, {"DQ11": (F.count_if(~c("scale_max").between(2, 12)), 0)}),
        (bad, {"DQ13": (F.count_if("bad"), 0)}),
        (slots, {"DQ15": (F.count_if(c("n_runs") == 2), want("DQ15"))}),
        *([(fact, {"DQ15r": (F.count_if(c("run_count") == 2), want("DQ15r"))})] if "DQ15r" in expected else []),
        (run, {"DQ16": (F.sum("n_rows"), want("DQ16"))} | ({"DQ16n": (one, want("DQ16n"))} if "DQ16n" in expected else {})),
    ])


def profile(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Columns that a new file lacks, has besides, or has in another place."""
    have = df.columns
    moved = [c for c, d in zip(have, expected, strict=False) if c != d and c in expected]
    return {"missing": [c for c in expected if c not in have], "extra": [c for c in have if c not in expected], "moved": moved}
