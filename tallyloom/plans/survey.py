"""From files to marts: the whole build of a survey in one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions import text
from tallyloom.operators import metrics, ml, model, reshape, stability
from tallyloom.sources import sink, wide_csv

#: The banner's cuts by persona attribute, besides the total.
CUTS = {"CREATIVE": "creative", "COHORT": "cohort_code", "GENDER": "gender_clean", "AGE": "age_band_banner", "NPS": "nps_band"}
UNIT = ("archetype_id", "modality")


class Built(NamedTuple):
    """The curated model and its marts, by name."""

    personas: DataFrame
    runs: DataFrame
    responses: DataFrame
    universe: DataFrame
    facts: DataFrame
    banner: DataFrame
    stability: DataFrame
    drivers: DataFrame


def curate(raws: Mapping[str, DataFrame], blocks: Mapping[str, int], modality: str = "READ") -> tuple[DataFrame, ...]:
    """personas, runs, responses, universe and facts of raw sections, whose files differ in width.

    A section without rows adds none; at least one section must be given.
    """
    persona = model.personas(list(raws.values()), wide_csv.attribute_columns(), modality)
    long, run = None, None
    for section, raw in raws.items():
        tagged = raw.withColumns({"run_id": text.slug_column(F.col("_source_file")), "modality": F.lit(modality), "section_code": F.lit(section)})
        one = reshape.unpivot_blocks(tagged, reshape.question_blocks(blocks[section]), [*UNIT, "run_id", "section_code"])
        long = one if long is None else long.unionByName(one)
        files = raw.select("_source_file")
        run = files if run is None else run.unionByName(files)
    resp = model.responses(long)
    universe = model.option_universe(model.with_slots(resp, [*UNIT, "run_id"]), ["question_key"])
    return persona, model.runs(run), resp, universe, model.facts(resp, persona)


def marts(persona: DataFrame, facts: DataFrame, cuts: Mapping[str, Column | str] | None = None, flags: Mapping[str, Column] | None = None) -> tuple[DataFrame, ...]:
    """The banner over primary runs, agreement of replicated runs by meta, and the driver features.

    flags: behaviour cuts, as conditions on boxed facts. Personas without an answer to the label's meta have no row among the drivers.
    """
    cuts = cuts or {"TOTAL": F.lit("Total")} | CUTS
    boxed = metrics.with_boxes(facts)
    primary = boxed.filter("is_primary_run")
    own = [x for x in cuts.values() if isinstance(x, str) and x not in facts.columns]
    banner = metrics.banner(primary.join(persona.select(*UNIT, *own), list(UNIT)), ["meta", "question_key", "question_text"], cuts)
    same = stability.agreement_of(facts.filter("run_count > 1"), [*UNIT, "slot_key"], ["meta"], {"code": F.col("primary_code"), "verbatim": F.col("qual_norm")})
    behaviour = metrics.persona_flags(primary, "archetype_id", {"cut_any": F.lit(True)} | dict(flags or {}))
    return banner, same, ml.driver_features(boxed, persona, behaviour)


def build(spark: SparkSession, globs: Mapping[str, str | Sequence[str]], blocks: Mapping[str, int] = wide_csv.SECTIONS, modality: str = "READ", cuts: Mapping[str, Column | str] | None = None, flags: Mapping[str, Column] | None = None, path: str | None = None) -> Built:
    """Everything from the files of each section.

    With a path, all tables are written there in place of older ones, the files are read for the
    curated model only, and the marts are made from the written facts. Without one nothing is read
    until a table is used.
    """
    curated = curate(wide_csv.load(spark, globs, blocks), blocks, modality)

    def kept(name: str, df: DataFrame) -> DataFrame:
        if path is None:
            return df
        sink.replace(df, f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    model_of = [kept(n, df) for n, df in zip(Built._fields, curated, strict=False)]
    made = marts(model_of[0], model_of[-1], cuts, flags)
    return Built(*model_of, *(kept(n, df) for n, df in zip(Built._fields[len(curated) :], made, strict=True)))
