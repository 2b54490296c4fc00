"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text. The ledger keeps the measurements and one bit per failed
rule; a policy is a versioned mask over those bits, so policies and ablations never read a text
again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.textblock import Block, append, sums, windows

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_LEAD = (np.arange(256) & 0xC0) != 0x80
_UPPER = np.isin(np.arange(256), range(65, 91))
_ALPHA = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_WORD = np.isin(np.arange(256), [32, *range(9, 14)], invert=True)

MEASURES = [(m, "bigint") for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha", "n_upper", "n_chars_all")]


def measure(block: Block) -> list[np.ndarray]:
    """MEASURES of each text of the block."""
    u, n = block.u, block.n
    words = block.tokens()
    lead = _LEAD[u]
    per_text = lambda mask: sums(mask, block.off)

    # Lines: split at \n, keep those with a word, find ones that occurred before in the same text.
    cut = np.flatnonzero(u == 10)
    start = np.sort(np.concatenate([block.off[:-1], cut + 1]))
    owner = np.searchsorted(block.off[:-1], np.concatenate([np.arange(0), cut]), "right") - 1
    line_doc = np.sort(np.concatenate([np.arange(n), owner]))
    last = np.append(np.minimum(start[1:] - 1, len(u)), len(u))
    end = np.where(np.append(line_doc[1:] != line_doc[:-1], True) if n else np.zeros(0, bool), block.off[line_doc + 1] if n else 0, last)
    wordy = (np.searchsorted(words.start, end) - np.searchsorted(words.start, start)) > 0
    start, end, line_doc = start[wordy], end[wordy], line_doc[wordy]
    key = block.hashes(start, end) + line_doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    dup_lines = np.bincount(line_doc[order[1:][again]], minlength=n)
    lines = np.bincount(line_doc, minlength=n)

    # Words inside a 3-word window that occurs twice or more in the same text.
    win, at = windows(words, words.hashes(), 3)
    owner = words.doc()
    key = win + owner[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    order = np.argsort(key)
    again = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][again]] = True
    twice[order[:-1][again]] = True
    covered = np.zeros(len(words.start) + 2, bool)
    hit = at[twice]
    for j in range(3):
        covered[hit + j] = True
    return [
        words.counts, per_text(lead & _WORD[u]), per_text(_SYMBOL[u]), dup_lines, sums(covered[: len(words.start)], words.first),
        lines, per_text(_ALPHA[u] & lead), per_text(_UPPER[u]), per_text(lead),
    ]


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


#: name: true where the rule fails. The order fixes the bit; rules are only ever appended.
RULES: dict[str, Column] = {}


def _rules() -> dict[str, Column]:
    if not RULES:
        mean = _share("word_chars", "n_words")
        RULES.update({
            "too_few_words": F.col("n_words") < 50,
            "repeated_windows": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
            "symbols": _share("n_symbols", "n_words") > 0.2,
            "duplicate_lines": _share("n_dup_lines", "n_lines") > 0.5,
            "word_length": (mean < 2) | (mean > 20),
            "shouting": _share("n_upper", "n_alpha") > 0.6,
            "few_letters": _share("n_alpha", "word_chars") < 0.5,
            "too_many_words": F.col("n_words") > 1_000_000,
        })
    return RULES


BASE = ("too_few_words", "repeated_windows")
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "duplicate_lines", "shouting"),
    "v2": (*BASE, "symbols", "duplicate_lines", "shouting", "word_length", "few_letters"),
}
PRODUCTION = "v2"


def mask_of(rules) -> int:
    names = list(_rules())
    return sum(1 << names.index(r) for r in rules)


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: the kept columns, MEASURES and `failed`, a bit per failed rule.

    Null and empty texts measure 0 everywhere (they fail too_few_words). Repeated rows each get
    their row. Texts count whole, however long. An empty table gives an empty ledger.
    """
    out = append(docs, text, lambda: measure, MEASURES, keep)
    bits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(_rules().values())), F.lit(0).cast("bigint"))
    return out.withColumn("failed", bits)


def passes(policy: str = PRODUCTION) -> Column:
    """True where no rule of the policy failed."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(led: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule: rows that fail it, rows only it rejects under the policy, rows the rest of the policy rejects."""
    mask = mask_of(POLICIES[policy])
    by = led.groupBy("failed").agg(F.count("*").alias("n"))  # at most 2**rules rows
    names = list(_rules())
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit")) for i, r in enumerate(names)])
    hit, inside = F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("failed").bitwiseAND(F.lit(mask))
    rest = inside.bitwiseAND(F.bitwise_not(F.col("bit"))) != 0
    return by.select("failed", "n", F.inline(rows)).groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(inside == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("n_without"),
    )
