"""Plain Python versions to hold the operators against, and awkward tables."""

import itertools
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for their own columns.
CLASH = "size string, rank string, score string, log_weight string, key string, n string, tile string, copies string, failed string, low string, _k string, _masked string"


def prose(seed, n, vocabulary=300):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


def awkward(spark, rows=None, clash=True):
    """Documents with nulls in every column, empty and long texts, repeated rows, ties and clashing columns."""
    long = prose(1, 40_000)
    base = rows or [
        (1, "plain words here", "en", "a", 3), (1, "plain words here", "en", "a", 3), (2, None, "en", "a", None), (3, "", None, None, 0),
        (4, " \n\t ", "en", "b", 4), (None, "no id at all", "en", "b", 1), (5, long, "en", "c", len(long)), (6, "plain words here", "fr", "a", 3),
        (7, "é ß “quoted” 日本 \U0001f600 end", "de", "b", 9), (8, "x", "en", "c", 1),
    ]
    df = spark.createDataFrame(base, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c.split()[0]: F.lit("other") for c in CLASH.split(", ")})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def classes(sets):
    """Least id reachable by links of 0.75, for a dict of sets by id."""
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}
