"""Coding of open-ended text by a pluggable coder; the default one works offline and is deterministic."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyloom.shipping import ship

#: Tasks that the rows of one prompt are dealt to.
SALTS = 8
CODES = "sentiment string, primary_theme string, secondary_theme string, mentions boolean, is_actionable boolean"


class Coder(Protocol):
    """A version, which is part of a code's identity, and codes for a list of prompts."""

    version: str

    def code(self, prompts: Sequence[str]) -> list[tuple]: ...


class KeywordCoder:
    """Codes by plain substrings of the lower-cased text.

    sentiment: more positive than negative keywords found, or fewer, else neutral. Themes: the
    first two, in the order given, with a keyword found. mentions, is_actionable: any keyword of
    the list found.
    """

    def __init__(self, themes: Mapping[str, Sequence[str]], positive: Sequence[str], negative: Sequence[str], mentions: Sequence[str] = (), actionable: Sequence[str] = ()):
        self.themes, self.lists = {k: tuple(v) for k, v in themes.items()}, (tuple(positive), tuple(negative), tuple(mentions), tuple(actionable))
        self.version = "keywords-" + hashlib.md5(repr((self.themes, self.lists)).encode()).hexdigest()[:12]

    def code(self, prompts: Sequence[str]) -> list[tuple]:
        out = []
        for p in prompts:
            low = p.lower()
            pos, neg, mentions, action = (sum(k in low for k in words) for words in self.lists)
            found = [t for t, words in self.themes.items() if any(k in low for k in words)] + [None, None]
            out.append(("positive" if pos > neg else "negative" if neg > pos else "neutral", found[0], found[1], mentions > 0, action > 0))
        return out


def _coded(batches: Iterator[pd.DataFrame], coder: Coder) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in CODES.split(", ")]
    for whole in batches:
        for _, b in whole.groupby("batch", sort=False):
            out = pd.DataFrame(coder.code(b["prompt"].tolist()), columns=names, dtype=object)
            out.insert(0, "prompt_key", b["prompt_key"].tolist())
            yield out


#: What a coder is asked, and its version; {question} and {response} are filled in.
PROMPT, PROMPT_VERSION = "Question: {question}\nResponse: {response}\nReturn sentiment, primary and secondary theme, mentions and whether it is actionable.", "p1"


def prompt_of(question, response, template: str = PROMPT, version: str = PROMPT_VERSION):
    """The prompt of an answer as a column, begun by its version; null where the response is null or blank."""
    parts = [F.lit(f"[{version}] ")]
    for i, piece in enumerate(template.replace("{response}", "{question}").split("{question}")):
        if i:
            parts.append(F.coalesce(question, F.lit("")) if template.index("{question}") < template.index("{response}") and i == 1 or template.index("{question}") > template.index("{response}") and i == 2 else response)
        parts.append(F.lit(piece))
    return F.when(F.length(F.trim(response)) > 0, F.concat(*parts))


def code_fact(fact: DataFrame, coder: Coder, meta: str = "meta", question: str = "question_text", response: str = "qual_text") -> DataFrame:
    """Coded verbatims of the primary runs: prompts are put together from question and response and coded in batches by meta.

    A batch that the coder gets holds answers to one meta only, in a fixed order; a common prompt is
    coded once and its codes are joined back with the rows dealt by a salt as well.
    """
    rows = fact.filter(F.col("is_primary_run")).withColumn("prompt_text", prompt_of(F.col(question), F.col(response)))
    return code(rows, F.col("prompt_text"), coder, batch=meta).drop("prompt_text")


def code(df: DataFrame, prompt, coder: Coder, batch: str | None = None) -> DataFrame:
    """df with the coder's columns; rows without a prompt are dropped.

    Each distinct prompt is coded once; its key holds the coder's version, so stored codes can be
    used again as long as neither changes. batch: a column whose values are never mixed in what one
    call of the coder gets (the least one of a prompt that several have). Codes are joined back SALTS
    times over, so that the rows of a very common prompt do not meet in one task.
    """
    ship(df.sparkSession)
    rows = df.withColumn("prompt", prompt).filter("prompt is not null").withColumn("prompt_key", F.md5(F.concat(F.lit(coder.version + "|"), "prompt")))
    by = F.lit("") if batch is None else F.coalesce(F.col(batch).cast("string"), F.lit(""))
    one = rows.groupBy("prompt_key").agg(F.min("prompt").alias("prompt"), F.min(by).alias("batch"))
    if batch is not None:
        one = one.repartition("batch", F.pmod(F.xxhash64("prompt_key"), F.lit(SALTS))).sortWithinPartitions("batch", "prompt_key")
    codes = one.mapInPandas(partial(_coded, coder=coder), f"prompt_key string, {CODES}")
    codes = codes.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return rows.drop("prompt").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(codes, ["prompt_key", "_salt"]).drop("_salt")


def features(coded: DataFrame, key: str, themes: Sequence[str]) -> DataFrame:
    """Per persona: shares of positive and negative answers and of each theme, for the driver model."""
    share = lambda c: F.avg(c.cast("double"))
    sides = {f"share_{s}": share(F.col("sentiment") == s) for s in ("positive", "negative")}
    both = {f"theme_{t}": share(F.coalesce((F.col("primary_theme") == t) | (F.col("secondary_theme") == t), F.lit(False))) for t in themes}
    return coded.groupBy(key).agg(*[c.alias(n) for n, c in (sides | both).items()])


def audit_sample(coded: DataFrame, key: str, n: int = 100) -> DataFrame:
    """n rows for a human to check: those whose keys have the least digests, so a rerun gives the same ones."""
    return coded.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
