"""The curated model: personas, runs, questions, scales and the long fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions import parse, text

#: The creative of each letter code in group names.
CREATIVES = {"G": "Goyer", "S": "Sheridan"}
NO_CHILDREN = "no_children"


def personas(raws: Sequence[DataFrame], attributes: Sequence[str], modality: str = "READ") -> DataFrame:
    """One row per persona over all sections, with the derived attributes.

    Sections are cut to the attributes first, since their widths differ, and united without copies.
    """
    base = raws[0].select(*attributes)
    for r in raws[1:]:
        base = base.unionByName(r.select(*attributes))
    a = lambda n: F.col(f"archetype_{n}")
    score = text.to_long(a("nps_score"))
    return base.distinct().withColumns({
        "modality": F.lit(modality),
        "creative": text.creative(F.col("group_name"), CREATIVES),
        "cohort_code": text.cohort(F.col("group_name")),
        "gender_clean": text.proper(a("gender")),
        "age_raw": a("age_range"),
        "age_exact": parse.age_exact(a("age_range")),
        "age_band_banner": parse.age_band(a("age_range")),
        "age_band_is_imputed": parse.age_imputed(a("age_range")),
        "income_low_usd": parse.income_low(a("income_range")),
        "income_high_usd": parse.income_high(a("income_range")),
        "nps_score": score,
        "nps_band": parse.nps_band(score),
        "is_parent": a("children_status") != NO_CHILDREN,
    })


def runs(rows: DataFrame, source: str = "_source_file") -> DataFrame:
    """One row per source file: run_id, section, whether it combines cohorts, rows."""
    by = rows.groupBy(text.slug_column(F.col(source)).alias("run_id")).agg(F.min(source).alias("source_file"), F.count("*").alias("n_rows"))
    run = F.col("run_id")
    return by.withColumns({"section_code": text.section(run), "is_combined_file": text.combined(run), "creative_of_file": F.when(run.contains("_g_"), CREATIVES["G"]).when(run.contains("_s_"), CREATIVES["S"])})


def question_key(meta: Column, question: Column) -> Column:
    """The digest of a question; null if either part is."""
    return F.md5(F.concat(meta, F.lit("|"), question))


def with_slots(df: DataFrame, unit: Sequence[str], order: str = "q_idx") -> DataFrame:
    """question_key, occurrence_no and slot_key.

    A file may repeat one text under one meta; the n-th occurrence within the unit (persona, run)
    is a slot of its own.
    """
    df = df.withColumn("question_key", question_key(F.col("meta"), F.col("question_text")))
    nth = F.row_number().over(Window.partitionBy(*unit, "question_key").orderBy(order))
    df = df.withColumn("occurrence_no", nth)
    return df.withColumn("slot_key", F.concat_ws("#", "question_key", "occurrence_no"))


def option_universe(df: DataFrame, key: Sequence[str], opts: str = "selected_options") -> DataFrame:
    """Distinct (key, option_code, option_label) seen, with scale_max: the largest scale point of the key."""
    o = df.select(*key, F.explode(opts).alias("_o")).select(*key, "_o.option_code", "_o.option_label").distinct()
    return o.withColumn("scale_max", F.max(F.when(F.col("option_code") < parse.SENTINEL, F.col("option_code"))).over(Window.partitionBy(*key)))


def scales(universe: DataFrame, key: Sequence[str]) -> DataFrame:
    """One scale_max per key, so that joining it never multiplies rows."""
    return universe.select(*key, "scale_max").distinct()


def primary_run(df: DataFrame, unit: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """run_rank, run_count and is_primary_run; every row stays. Both windows share one shuffle."""
    part = Window.partitionBy(*unit)
    ranked = df.withColumns({"run_rank": F.row_number().over(part.orderBy(*order)), "run_count": F.count("*").over(part)})
    return ranked.withColumn("is_primary_run", F.col("run_rank") == 1)


def standalone_first(run: str = "run_id") -> list[Column]:
    """Runs of single-cohort files before those of combined ones, then by id."""
    return [text.combined(F.col(run)).asc(), F.col(run).asc()]


def responses(long: DataFrame) -> DataFrame:
    """The typed long table: blank text to null, numbers parsed, options split."""
    c = F.col
    return long.withColumns({
        "question_text": text.filled(c("question")),
        "q_type": text.to_long(c("type")),
        "rating_label": text.filled(c("rating_label")),
        "rating_value": text.to_long(text.tidy(c("rating"))),
        "selected_options": parse.options(c("selected")),
        "qual_text": text.filled(c("qual")),
    }).filter("question_text is not null").withColumns({
        "qual_len": F.char_length(F.coalesce("qual_text", F.lit(""))).cast("bigint"),
        "qual_norm": text.straighten(c("qual_text")),
        "primary_code": parse.primary_code(c("selected_options")),
    }).drop("question", "type", "rating", "selected", "qual")


def facts(resp: DataFrame, persona: DataFrame, id_cols: Sequence[str] = ("archetype_id", "modality")) -> DataFrame:
    """Responses of known personas with slot keys, scale and primary-run flag.

    The unit of a run choice is a slot of a persona, so a text repeated in one file keeps all its
    rows. Personas are joined by (persona, modality).
    """
    slots = with_slots(resp, [*id_cols, "run_id"])
    known = slots.join(persona.select(*id_cols, "creative", "cohort_code").distinct(), list(id_cols))
    ranked = primary_run(known, [*id_cols, "slot_key"], standalone_first())
    scale = scales(option_universe(slots, ["question_key"]), ["question_key"])
    return ranked.join(scale, "question_key", "left")


def reused_ids(df: DataFrame, key: str, modality: str) -> DataFrame:
    """Ids seen under more than one modality, with how many."""
    return df.groupBy(key).agg(F.countDistinct(modality).alias("n_modalities")).filter("n_modalities > 1")
