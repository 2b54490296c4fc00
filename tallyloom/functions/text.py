"""Text: null-safe extraction, slugs, cohort codes, quotes, white space."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

#: Typographic quotes and their plain forms, in the same order.
CURLY, STRAIGHT = "‘’“”", "''\"\""


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null (not empty) without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def to_long(text: Column) -> Column:
    """The text as a long, null where it is not one; never an error."""
    return text.try_cast("bigint")


def straighten(text: Column) -> Column:
    """The grouping copy of a verbatim: typographic quotes made plain. Keep the raw column beside it."""
    return F.translate(text, CURLY, STRAIGHT)


def tidy(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def filled(text: Column) -> Column:
    """Null for blank text, else the text."""
    return F.when(tidy(text) != "", text)


def proper(text: Column) -> Column:
    """Trimmed, each word capitalised."""
    return F.initcap(F.trim(text))


def creative(group: Column, names: dict[str, str]) -> Column:
    """The name of the first letter code found between hyphens in a group name; null without one."""
    out = F.lit(None).cast("string")
    for code, name in reversed(names.items()):
        out = F.when(group.contains(f"-{code}-"), F.lit(name)).otherwise(out)
    return out


def cohort(group: Column) -> Column:
    """Letter between hyphens, a dot, the digit after the last dot: `G.2`. Null if either is missing."""
    return F.concat(extract(group, r"-([A-Z])-"), F.lit("."), extract(group, r"\.(\d)$"))


def slug(name: str) -> str:
    """The run id of a source file's name: lower case, words joined by underscores, no project prefix or results suffix."""
    stem = re.sub(r"\.csv$", "", name.rsplit("/", 1)[-1], flags=re.I)
    stem = re.sub(r"\s*—.*$", "", stem)
    words = re.findall(r"[a-z0-9]+", stem.lower())
    first = next((i for i, w in enumerate(words) if len(w) == 1 and w.isalpha()), 0)  # the creative's letter
    return "read_" + "_".join(words[first:])


def slug_column(path: Column) -> Column:
    """slug() of the last part of a path, as a column."""
    stem = F.regexp_replace(F.regexp_extract(F.lower(path), r"([^/]*)$", 1), r"\.csv$|\s*—.*$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"\s*—.*$", ""), r"[^a-z0-9]+", "_")
    return F.concat(F.lit("read_"), F.regexp_replace(F.regexp_replace(stem, r"^.*?(?:^|_)([a-z]_)", "$1"), r"^_|_$", ""))


def section(run: Column) -> Column:
    """`2.1` of a run id that ends in 2_1 or 2_1x."""
    return F.regexp_replace(extract(run, r"(\d_\d)x?$"), "_", ".")


def combined(run: Column) -> Column:
    """True for the run of a file that holds several cohorts."""
    return run.endswith("x")
