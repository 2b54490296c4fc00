"""Strict reader of wide respondent files: attributes, then n blocks of question columns, all text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.operators.reshape import question_blocks

IDENTITY = ("archetype_id", "group_name", "sample_name")
#: Persona attributes in file order, without their `archetype_` prefix.
ATTRIBUTES = (
    "title", "name", "age_range", "gender", "race", "marital_status", "children_status", "children", "education_level", "field_of_study",
    "occupation", "income_range", "political_affiliation", "religious_affiliation", "location", "location_type", "hobbies_and_interests",
    "lived_experience", "nps_score", "persona_summary", "goals_and_motivations", "audience_insights_triggers", "psychographic_values",
    "psychographic_interests", "psychographic_lifestyle", "purchasing_behaviors", "challenges_pain_points", "decision_making_steps",
    "triggers_to_switch", "product_expectations", "product_influencers", "media_channels", "psychometric_vector_name",
    "psychometric_vector_summary", "psychometric_vector_characteristics", "psychometric_vector_emotions", "why_psychometric_vector_fits",
    "group_dynamics", "adoption_category_name", "adoption_rationale", "composite_attitude_score_summary", "nps_summary", "lived_experience_summary",
)
#: Question blocks of each section's files.
SECTIONS = {"2.1": 20, "2.2": 35, "2.3": 36}


def attribute_columns() -> list[str]:
    return [*IDENTITY, *(f"archetype_{a}" for a in ATTRIBUTES)]


def columns(n: int) -> list[str]:
    return [*attribute_columns(), *(c for b in question_blocks(n) for c in b.values())]


def schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns(n)])


def source_file() -> Column:
    """The path of a row's file, without percent escapes."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read(spark: SparkSession, paths: str | Sequence[str], n: int) -> DataFrame:
    """One family's files as text columns, with `_source_file` and `_loaded_at`.

    Fields may hold line breaks and doubled quotes. A short or long row, or a header other than
    the schema's, fails any action. The schema is always given, never inferred.
    """
    rows = spark.read.schema(schema(n)).options(header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False, encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(paths)
    return rows.select("*", source_file().alias("_source_file"), F.current_timestamp().alias("_loaded_at"))


def load(spark: SparkSession, globs: Mapping[str, str | Sequence[str]], blocks: Mapping[str, int] = SECTIONS) -> dict[str, DataFrame]:
    """A DataFrame per section; files of one section may be globbed, since each row carries its file."""
    return {section: read(spark, paths, blocks[section]) for section, paths in globs.items()}


def view(df: DataFrame, name: str) -> DataFrame:
    """df under a name that SQL can use; nothing is read yet."""
    df.createOrReplaceTempView(name)
    return df
